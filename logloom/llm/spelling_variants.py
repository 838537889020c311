"""Spelling variant grouping: PartEnum signatures over letter multisets, equi-joined and verified.

A word is a binary vector with one dimension for each (letter, occurrence number). One inserted
or deleted letter changes one dimension, one replaced letter at most two, so near words lie
within Hamming distance two. The letters are dealt to PARTS parts of about equal weight; two
such vectors agree on at least PARTS - 2 parts, so enumerating all choices of PARTS - 2 parts
gives signatures of which near words share one. Each signature also carries the half of the
word that the one edit leaves alone (its first or its last half) and a length class, which
keep buckets short at any vocabulary size and lose no pair: an edit lies in one half only.

The join tests the words themselves (one edit, by code points) as its condition, so no
candidate pair is ever written. A pair that shares several signatures is taken at the first of
them only, which both rows can tell from their part hashes, so nothing has to be made distinct.

Words are counted per batch in the scan, with a bounded table in each task, before the shuffle. Only the
letters' weights (one row a letter) reach the driver. Roots come from pointer doubling: n at
least doubles with each form, so chains are short and rounds few; each is a written table.

Edge cases: null texts have no words, a null doc_id counts as an empty string in the check sum;
whole texts are read, however long; ties of n go to the smallest word in code-point order;
repeated rows count again; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

#: Parts of the letters; a signature takes all but two of them.
PARTS = 4
#: Bits of a part's hash; those of all parts share one long.
BITS = 15
#: Least code points and occurrences of a word.
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One in this many (document, run) pairs loses a letter.
DAMAGE = 97
#: Different words that a task counts before it hands its counts on.
TABLE = 1 << 17

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


# ---------------------------------------------------------------------------------------
# Words and their counts


def _counts(damage: int):
    """Counts of the words of each batch; equal words of a task are added up before they leave it."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})
            seen.clear()
            return batch

        for batch in batches:
            for piece in common.text_slices(batch):
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    begin = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for run, n in Counter(_RUN.findall((text or "").translate(_LOWER))).items():
                        if damage and (check := zlib.crc32(run.encode(), begin)) % damage == 0:
                            at = check % len(run)
                            run = run[:at] + run[at + 1:]
                        seen[run] += n
                    if len(seen) >= TABLE:
                        yield out()
        yield out()

    return counted


def vocabulary(documents: DataFrame, damage: int = 0) -> DataFrame:
    """(word, n): words of at least LEAST_LETTERS code points found at least LEAST_COUNT times."""
    rows = common.with_columns_of(documents, ["doc_id", "text"])
    counts = rows.mapInArrow(_counts(damage), "word string, n long")
    return (
        counts.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


# ---------------------------------------------------------------------------------------
# Near words


def _dealt_letters(words: DataFrame, parts: int) -> list[str]:
    """The letters of each part, dealt from the most frequent one down to the lightest part."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    dealt, weight = [""] * parts, [0] * parts
    for letter, count in sorted(letters.collect(), key=lambda r: (-r[1], r[0])):
        lightest = weight.index(min(weight))
        dealt[lightest] += letter
        weight[lightest] += count
    return dealt


def _part(word: str, letters: str) -> Column:
    """BITS-bit hash of the letters of a word, with repeats, that belong to a part."""
    own = F.array_join(F.array_sort(F.split(F.regexp_replace(word, f"[^{letters}]", ""), "")), "") if letters else F.lit("")
    return F.xxhash64(own).bitwiseAND((1 << BITS) - 1)


def _same(i: int) -> str:
    return f"((a.parts ^ b.parts) & {((1 << BITS) - 1) << (BITS * i)}L) = 0"


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(a, na, b, nb): all pairs of words (word, n) that differ by one code point inserted, deleted or replaced.

    A pair comes once, the shorter word first, or the smaller of two equally long ones.
    """
    if not 3 <= parts <= 4:
        raise ValueError("parts must be 3 or 4: their hashes share one long")
    dealt = _dealt_letters(words, parts)
    packed = F.lit(0).cast("long")
    for i, letters in enumerate(dealt):
        packed = packed.bitwiseXOR(F.shiftleft(_part("word", letters), BITS * i))
    known = words.select("word", "n", F.length("word").alias("length"), packed.alias("parts"))
    # The class is the shorter length of a pair, so a word is in its own and in the next shorter one.
    classed = known.withColumn("class", F.explode(F.array("length", F.col("length") - 1)))
    half = F.floor(F.col("class") / 2).cast("int")
    first, last = F.col("word").substr(F.lit(1), half), F.col("word").substr(half + 1 + F.col("length") - F.col("class"), F.length("word"))
    choices = list(combinations(range(parts), parts - 2))
    signatures = []
    for number, chosen in enumerate(choices):
        mask = sum(((1 << BITS) - 1) << (BITS * i) for i in chosen)
        for side, kept in enumerate((first, last)):
            signatures.append(F.struct(
                F.lit(2 * number + side).cast("byte").alias("choice"),
                F.xxhash64(F.lit(2 * number + side), F.col("class"), F.col("parts").bitwiseAND(F.lit(mask)), kept).alias("signature"),
            ))
    signed = (
        classed.withColumn("s", F.explode(F.array(*signatures)))
        .select("s.signature", "s.choice", "class", "word", "n", "parts")
    )
    return (
        signed.alias("a").join(signed.alias("b"), F.expr(_condition(choices, parts)))
        .select(F.col("a.word").alias("a"), F.col("a.n").alias("na"), F.col("b.word").alias("b"), F.col("b.n").alias("nb"))
    )


def _condition(choices: list[tuple[int, ...]], parts: int) -> str:
    """Equal signatures, the first that a pair shares, one edit apart."""
    earlier = []
    for number, chosen in enumerate(choices):
        missed = [f"NOT ({' AND '.join(_same(i) for i in c)})" for c in choices[:number]]
        if missed:
            earlier.append(f"(a.choice DIV 2 <> {number} OR ({' AND '.join(missed)}))")
    half = "int(a.class / 2)"
    return " AND ".join([
        "a.signature = b.signature", "a.choice = b.choice", "a.class = b.class",
        "length(a.word) = a.class", "(length(b.word) > a.class OR a.word < b.word)",
        # The last half counts only where the first halves differ.
        f"(a.choice % 2 = 0 OR substr(a.word, 1, {half}) <> substr(b.word, 1, {half}))",
        *earlier,
        "levenshtein(a.word, b.word, 1) = 1",
    ])


# ---------------------------------------------------------------------------------------
# Forms and roots


def group_variants(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the words (word, n).

    A word's form is its most frequent near word if that is at least twice as frequent; its root
    is the end of the chain of forms.
    """
    words = common.cut(words)
    pairs = near_pairs(words, parts)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), (-F.col("nb")).alias("less"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), (-F.col("na")).alias("less"), F.col("a").alias("near")),
    )).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("less", "near")).alias("best"))
    joined = words.join(best, "word", "left")
    strong = -F.col("best.less") >= 2 * F.col("n")
    formed = common.cut(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
    ))
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root): each word's chain followed to its end, its length halved in each round."""
    while True:
        steps = common.cut(steps)
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = steps.join(onward, "root", "left")
        if longer.where("next is not null").isEmpty():
            return steps
        steps = longer.select("word", F.coalesce("next", "root").alias("root"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return group_variants(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet"), DAMAGE))


#: The same rows through deletion neighbourhoods; CRC-32 by its table.
SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
run AS (
  SELECT d, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents)
  GROUP BY 1, 2),
bytes AS (
  SELECT d, r, n, flatten(list_transform(string_split(d || ':' || r, ''),
         lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)) AS b
  FROM run),
crc AS (
  SELECT r, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, tab),
word AS (
  SELECT CASE WHEN h % 97 = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word, sum(n)::BIGINT AS n
  FROM crc GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
less AS (
  SELECT DISTINCT word, n, word[:i - 1] || word[i + 1:] AS k, i FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM word a JOIN less b ON a.word = b.k
  UNION SELECT a.word, b.word, b.n FROM less a JOIN word b ON a.k = b.word),
best AS (
  SELECT word, count(*) AS n_near, min((-m, other)) AS b FROM near GROUP BY word),
form AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN -b[1] >= 2 * n THEN b[2] END AS form, CASE WHEN -b[1] >= 2 * n THEN -b[1] END::BIGINT AS form_n
  FROM word w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM form
  UNION ALL SELECT c.word, f.form FROM chain c JOIN form f ON c.root = f.word WHERE f.form IS NOT NULL),
root AS (SELECT word, arg_min(root, -n) AS root FROM (SELECT c.word, c.root, f.n FROM chain c JOIN form f ON c.root = f.word) GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM form JOIN root USING (word)
"""
