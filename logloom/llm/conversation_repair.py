"""Conversation repair: the cheapest edits that make a conversation legal, by one integer minimum.

The rows of a conversation, by turn, are kept, given another role, deleted, or get rows
inserted between them, until the initials of the roles read `(s?(ua)+)?`. Blank rows and
duplicates must go; a truncated row that stays costs extra. Of the cheapest ways the one whose
edit letters (D, I, K, R) come first in ASCII wins.

Weights. A way through the rows is a path in a DAG whose nodes are (gap, state of the grammar),
and its weight one big integer: the cost in the high digits, then one digit a letter, as many
places as the rows can have letters, the first letter in the highest place and zeros where a shorter
way has none. Smaller integers are cheaper ways, and among equally cheap ones those whose
letters come first. `min` on integers decides everything.

Long conversations. The DP walks blocks of BLOCK rows from the end, so integers stay short.
At a block's border only the cost goes on (the integers without their letters): the letters of
two ways through a block from the same node first differ inside the block, since a letter
leads from a node to one other node and no way through a block is the beginning of another.
So the result is exact, and the work grows with the rows.

Scale. Rows reduce natively to one character each (role initial and fault); equal rows of a turn
are one row with a count. The range partitioner spreads a long conversation over tasks, each
joins the characters of its rows, and one row a conversation (as long as the audit that is
asked for) is planned. Texts move once, to be written out in order: the rows of a conversation
stream through one task with its audit ahead of them, since a hash of all its text is one
sequence; nothing but the audit is held.

Edge cases: a null role, text or id counts as one space; null turns come first; rows of one
turn are ordered by the hash of role and text, so equal rows are adjacent; a role with another
initial than s, u, a must be replaced or deleted; very long texts are read row by row; rows of a
null conv_id are one conversation; `gaps` is null if it does not fit a long; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

#: Costs of the edits.
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
#: Rows whose letters share one integer.
BLOCK = 256
#: Plans of short conversations that a task remembers.
REMEMBERED = 1 << 16
#: White space that does not count as text.
SPACE = " \t\n\x0b\x0c\r"
NEEDED = ["conv_id", "turn", "role", "text"]

# States of the grammar: nothing yet, after s, after u, after a; the next state on each initial.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_KEPT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER,
         (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_SPOKEN = (_USER, _USER, _ASSISTANT, _USER)  # where an inserted or replaced role leads
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_D, _I, _K, _R = 1, 2, 3, 4
_LETTERS = " DIKR"
#: A row as a character: its initial (s, u, a, other) and its first fault.
_INITIALS, _SOUND, _BLANK, _DUPLICATE, _TRUNCATED = "suax", 0, 1, 2, 3


def _code(character: str) -> tuple[str, int]:
    return _INITIALS[(ord(character) - 65) // 4], (ord(character) - 65) % 4


# ---------------------------------------------------------------------------------------
# The DP


def _block(rows: list[tuple[str, int]], after: list[int], last: bool) -> list[tuple[int, str]]:
    """(cost of all that is left, letters in this block) from each state before the rows.

    `after` holds the costs from each state behind them.
    """
    width = 3 * (3 * len(rows) + 2)
    top = width - 3

    def led(value: int, cost: int, letter: int) -> int:
        """The weight of a way that begins with one more edit."""
        return ((cost + (value >> width)) << width) + (letter << top) + ((value & (1 << width) - 1) >> 3)

    def with_inserts(plain: list[int | None]) -> list[int]:
        """The least weight from each state in a gap, with up to two rows inserted there."""
        def least(state: int, inserts: int) -> int | None:
            ways = [plain[state]]
            if inserts:
                onward = least(_SPOKEN[state], inserts - 1)
                ways.append(None if onward is None else led(onward, INSERT, _I))
            return min((w for w in ways if w is not None), default=None)

        return [least(state, 2) for state in range(4)]

    values: list[int] = [a << width for a in after]
    if last:
        values = with_inserts([0, None, None, 0])
    for initial, fault in reversed(rows):
        kept, extra = [], TRUNCATED * (fault == _TRUNCATED)
        for state in range(4):
            ways = [led(values[state], DELETE, _D)]
            if fault not in (_BLANK, _DUPLICATE):
                if (state, initial) in _KEPT:
                    ways.append(led(values[_KEPT[state, initial]], extra, _K))
                ways.append(led(values[_SPOKEN[state]], REROLE + extra, _R))
            kept.append(min(ways))
        values = with_inserts(kept)
    return [(v >> width, "".join(_LETTERS[v >> at & 7] for at in range(top, -3, -3)).rstrip()) for v in values]


def plan(characters: str, block: int = BLOCK) -> tuple[int, str]:
    """(cost, letters) of the cheapest edits of a conversation given as one character a row."""
    rows = [_code(c) for c in characters]
    begins = list(range(0, len(rows), block))
    found, after = [], [0, 0, 0, 0]
    for begin in reversed(begins):
        ways = _block(rows[begin : begin + block], after, begin == begins[-1])
        found.append([letters for _, letters in ways])
        after = [cost for cost, _ in ways]
    state, at, audit = _START, 0, []
    for letters in reversed(found):
        audit.append(letters[state])
        for letter in letters[state]:
            if letter in "IR":
                state = _SPOKEN[state]
            elif letter == "K":
                state = _KEPT[state, rows[at][0]]
            at += letter != "I"
    return after[_START] if rows else 0, "".join(audit)


def _planned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    legal = {"su", "ua", "au"}
    short = lru_cache(REMEMBERED)(plan)  # short conversations often have the same characters
    for batch in batches:
        out = []
        for characters in batch.column("characters").to_pylist():
            codes = [_code(c) for c in characters]
            faults = [fault for _, fault in codes]
            illegal = sum(a[0] + b[0] not in legal for a, b in zip(codes, codes[1:]))
            out.append((*(faults.count(f) for f in (_BLANK, _DUPLICATE, _TRUNCATED)), illegal, *(short if len(characters) <= 64 else plan)(characters)))
        columns = list(zip(*out)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string())],
            ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


# ---------------------------------------------------------------------------------------
# Rows to characters, characters to conversations


def _filled(rows: DataFrame) -> DataFrame:
    """The needed columns; a null role or text is one space; `key` tells role and text apart."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return common.with_columns_of(rows, NEEDED).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("key"))


def _joined_characters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of a task's sorted rows: its characters in order."""
    names = ["conv_id", "part", "characters"]
    part, kept, held, kind = TaskContext.get().partitionId(), None, None, None
    for batch in batches:
        kind = batch.column(0).type
        done = []
        for conversation, characters in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held is None or conversation != kept:
                if held is not None:
                    done.append((kept, "".join(held)))
                kept, held = conversation, []
            held.append(characters)
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], kind), pa.array([part] * len(done), pa.int32()), pa.array([d[1] for d in done], pa.string())], names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([kept], kind), pa.array([part], pa.int32()), pa.array(["".join(held)], pa.string())], names)


def _character(initial: Column, fault: Column) -> Column:
    return F.char(F.lit(65) + initial * 4 + fault)


def plans(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation of the rows."""
    filled = _filled(rows)
    said = F.rtrim("text", F.lit(SPACE))
    fault = F.when(said == "", _BLANK).when(F.right(said, F.lit(1)).isin(".", "!", "?"), _SOUND).otherwise(_TRUNCATED)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    # Equal rows of a turn are one row with a count; role and text stay behind.
    facts = common.cut(
        filled.select("conv_id", "turn", "key", initial.alias("initial"), fault.alias("fault"))
        .groupBy("conv_id", "turn", "key").agg(
            F.first("initial").alias("initial"), F.first("fault").alias("fault"), F.count(F.lit(1)).alias("n")))
    # Null turns come first, so the smallest of (has a turn, turn) is where a text is first seen.
    place = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    again = (
        facts.groupBy("conv_id", "key").agg(F.min(place).alias("seen"), F.count(F.lit(1)).alias("turns"))
        .where("turns > 1").select(F.col("conv_id").alias("_conv"), F.col("key").alias("_key"), "seen")
    )
    marked = facts.join(again, facts.conv_id.eqNullSafe(again["_conv"]) & (facts.key == again["_key"]), "left")
    later = F.coalesce(place > F.col("seen"), F.lit(False))
    own = F.when((F.col("fault") != _BLANK) & later, _DUPLICATE).otherwise(F.col("fault"))
    rest = F.when(F.col("fault") == _BLANK, _BLANK).otherwise(_DUPLICATE)
    characters = F.concat(
        _character(F.col("initial"), own), F.repeat(_character(F.col("initial"), rest), (F.col("n") - 1).cast("int")))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "key"]
    kind = rows.schema["conv_id"].dataType.simpleString()
    pieces = (
        marked.select("conv_id", "turn", "key", characters.alias("characters"))
        .repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "characters")
        .mapInArrow(_joined_characters, f"conv_id {kind}, part int, characters string")
    )
    whole = pieces.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("part", "characters"))), lambda p: p["characters"]), "").alias("characters"))
    planned = whole.mapInArrow(
        _planned, f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    wide = "decimal(20,0)"
    gaps = (
        facts.select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("_conv"))
        .agg((F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count("turn")).try_cast("long").alias("gaps"),
             F.count("turn").alias("turns"))
    )
    return planned.join(gaps, planned.conv_id.eqNullSafe(gaps["_conv"])).select(
        "conv_id", F.when(F.col("turns") == 0, F.lit(0).cast("long")).otherwise(F.col("gaps")).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit")


# ---------------------------------------------------------------------------------------
# The repaired rows


def _in_order(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The rows of each conversation by turn, its audit ahead of them; a conversation lies in one task."""
    filled = _filled(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "key", "role", "text", F.lit(None).cast("string").alias("audit"))
    null = F.lit(None)
    ahead = planned.select(
        "conv_id", F.lit(0).alias("kind"), null.cast("long").alias("turn"), null.cast("binary").alias("key"),
        null.cast("string").alias("role"), null.cast("string").alias("text"), "audit")
    order = [F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "key"]
    return (
        filled.unionByName(ahead).repartition("conv_id").sortWithinPartitions(*order)
        .select("conv_id", "kind", "turn", "role", "text", "audit")
    )


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edit, turn, role, text) of each repaired row, and (conv_id, None, ...) ahead of a conversation."""
    audit, at, state, conversation = "", 0, _START, None

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _SPOKEN[state]
            yield conversation, "I", None, _ROLES[state], ""

    for batch in batches:
        for piece in common.text_slices(batch):
            for row in piece.to_pylist():
                if row["kind"] == 0:
                    yield from inserted()
                    conversation, audit, at, state = row["conv_id"], row["audit"], 0, _START
                    yield conversation, None, None, None, None
                    continue
                yield from inserted()
                letter, at = audit[at], at + 1
                if letter == "K":
                    state = _KEPT[state, row["role"][:1]]
                    yield conversation, "K", row["turn"], row["role"], row["text"]
                elif letter == "R":
                    state = _SPOKEN[state]
                    yield conversation, "R", row["turn"], _ROLES[state], row["text"]
    yield from inserted()


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired rows (conv_id, place, edit, turn, role, text); inserted ones have no turn and an empty text."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, place = [], 0, 0
        schema = pa.schema([("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        types: list[pa.DataType] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types[:] = [batch.column(0).type]
                yield batch

        def out() -> pa.RecordBatch:
            columns = list(zip(*held))
            arrays = [pa.array(c, t) for c, t in zip(columns[1:], schema.types)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], types[0]), *arrays], ["conv_id", *schema.names])

        for conversation, edit, turn, role, text in _walk(noted()):
            if edit is None:
                place = 0
                continue
            held.append((conversation, place, edit, turn, role, text))
            place, size = place + 1, size + len(text) + 100
            if size >= common.CHUNK_BYTES:
                yield out()
                size = 0
        if held:
            yield out()

    return _in_order(rows, planned).mapInArrow(written, f"conv_id {kind}, place long, edit string, turn long, role string, text string")


def digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): hash of the repaired `role:text` lines of each planned conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, types = [], []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types[:] = [batch.column(0).type]
                yield batch

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], types[0]), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])
            done.clear()
            return batch

        current = None
        for conversation, edit, _, role, text in _walk(noted()):
            if edit is None:
                if current:
                    done.append((current[0], current[1].hexdigest()))
                if len(done) >= 10_000:
                    yield out()
                current = (conversation, hashlib.sha256(), [])
                continue
            line = f"{role}:{text}".encode()
            current[1].update(b"\n" + line if current[2] else line)
            current[2][:] = [True]
        if current:
            done.append((current[0], current[1].hexdigest()))
        if done:
            yield out()

    return _in_order(rows, planned).mapInArrow(hashed, f"conv_id {kind}, repaired_sha256 string")


# ---------------------------------------------------------------------------------------
# The query


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with planted faults: by the check sum of `conv_id:turn`, a row is dropped, emptied,
    loses its sentence ends, comes twice, or becomes the user's."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    check = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return common.with_columns_of(rows, NEEDED).withColumn("_check", check).where("_check <> 0").select(
        "conv_id", "turn",
        F.when(F.col("_check") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("_check") == 1, "").when(F.col("_check") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("_check") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    broken = damaged(rows)
    planned = common.cut(plans(broken))
    hashes = digests(broken, planned)
    ids = rows.groupBy(F.col("conv_id").alias("id")).agg(F.count(F.lit(1)).alias("rows"))
    both = (
        ids.join(planned, F.col("id").eqNullSafe(planned.conv_id), "left").drop("conv_id")
        .join(hashes, F.col("id").eqNullSafe(hashes.conv_id), "left")
    )
    # No rows after the damage: `blank` is never null otherwise.
    gone = F.col("blank").isNull()
    zero = lambda c: F.when(gone, F.lit(0).cast("long")).otherwise(F.col(c)).alias(c)
    return both.select(
        F.col("id").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: The same rows by a recursive DP over (cost, letters) as text; CRC-32 by its table.
SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
checked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: unicode(x)::BIGINT)),
             lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS h
  FROM conversations, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM checked WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS r,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         lag(left(role, 1)) OVER w AS before
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text), copy)),
faults AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open FROM placed),
steps AS (
  SELECT *, blank OR seen > 1 AS must, CASE WHEN open AND NOT blank AND seen = 1 THEN 3 ELSE 0 END AS extra,
         max(i) OVER (PARTITION BY conv_id) AS n FROM faults),
-- Best (cost in nine digits, letters) from each state before row i: e nothing yet, s, u, a.
dp AS (
  SELECT conv_id, max(i) + 1 AS i, '000000000' AS e, '000000006II' AS s, '000000003I' AS u, '000000000' AS a FROM steps GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, least(pe, printf('%09d', left(pu, 9)::INT + 3) || 'I' || pu[10:], printf('%09d', left(pa, 9)::INT + 6) || 'II' || pa[10:]),
         least(ps, printf('%09d', left(pu, 9)::INT + 3) || 'I' || pu[10:], printf('%09d', left(pa, 9)::INT + 6) || 'II' || pa[10:]),
         least(pu, printf('%09d', left(pa, 9)::INT + 3) || 'I' || pa[10:]), least(pa, printf('%09d', left(pu, 9)::INT + 3) || 'I' || pu[10:])
  FROM (
    SELECT t.conv_id, t.i,
           least(printf('%09d', left(e, 9)::INT + 4) || 'D' || e[10:],
                 CASE WHEN NOT must THEN printf('%09d', left(u, 9)::INT + 3 + extra) || 'R' || u[10:] END,
                 CASE WHEN NOT must AND r = 's' THEN printf('%09d', left(s, 9)::INT + extra) || 'K' || s[10:]
                      WHEN NOT must AND r = 'u' THEN printf('%09d', left(u, 9)::INT + extra) || 'K' || u[10:] END) AS pe,
           least(printf('%09d', left(s, 9)::INT + 4) || 'D' || s[10:],
                 CASE WHEN NOT must THEN printf('%09d', left(u, 9)::INT + 3 + extra) || 'R' || u[10:] END,
                 CASE WHEN NOT must AND r = 'u' THEN printf('%09d', left(u, 9)::INT + extra) || 'K' || u[10:] END) AS ps,
           least(printf('%09d', left(u, 9)::INT + 4) || 'D' || u[10:],
                 CASE WHEN NOT must THEN printf('%09d', left(a, 9)::INT + 3 + extra) || 'R' || a[10:] END,
                 CASE WHEN NOT must AND r = 'a' THEN printf('%09d', left(a, 9)::INT + extra) || 'K' || a[10:] END) AS pu,
           least(printf('%09d', left(a, 9)::INT + 4) || 'D' || a[10:],
                 CASE WHEN NOT must THEN printf('%09d', left(u, 9)::INT + 3 + extra) || 'R' || u[10:] END,
                 CASE WHEN NOT must AND r = 'u' THEN printf('%09d', left(u, 9)::INT + extra) || 'K' || u[10:] END) AS pa
    FROM dp JOIN steps t ON t.conv_id IS NOT DISTINCT FROM dp.conv_id AND t.i = dp.i - 1)),
best AS (SELECT conv_id, left(e, 9)::BIGINT AS cost, e[10:] AS audit FROM dp WHERE i = 1),
letters AS (
  SELECT conv_id, k, audit[k] AS c, length(replace(audit[:k], 'I', '')) AS i, length(replace(audit[:k], 'D', '')) AS j
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)),
lines AS (
  SELECT l.conv_id, k, c, j, CASE WHEN c = 'K' THEN role END AS own, CASE WHEN c = 'I' THEN '' ELSE text END AS text
  FROM letters l LEFT JOIN steps t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.i = l.i WHERE c <> 'D'),
shift AS (SELECT conv_id, max(CASE WHEN j = 1 AND own[1] = 's' THEN 1 ELSE 0 END) AS s FROM lines GROUP BY conv_id),
whole AS (
  SELECT l.conv_id, string_agg(coalesce(own, CASE WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY k) AS t
  FROM lines l JOIN shift ON l.conv_id IS NOT DISTINCT FROM shift.conv_id GROUP BY l.conv_id),
counts AS (
  SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END::BIGINT AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen > 1) AS duplicate,
         count(*) FILTER (extra > 0) AS truncated, count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM steps GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM ids LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN whole ON whole.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
