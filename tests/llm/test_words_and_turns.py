"""Spelling variants, language identification and conversation repair against plain versions."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import pytest

from logloom.llm import conversation_repair as cr
from logloom.llm import jaccard_join as jj
from logloom.llm import language_id as li
from logloom.llm import spelling_variants as sv
from logloom.session import ship_package

SMALL = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string"
TURN = "conv_id long, turn long, role string, text string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.mark.parametrize("query,sql", [(jj.op1_ngram_jaccard_join, jj.SQL), (sv.op11_spelling_variants, sv.SQL), (cr.op13_conversation_repair, cr.SQL)])
def test_query_equals_sql(spark, query, sql):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = query(spark, SMALL)
    expected = con.sql(sql)
    got = found.select(*expected.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected.fetchall())) and got


# ---------------------------------------------------------------------------------------
# Spelling variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    form, found = {}, {}
    for w, n in counts.items():
        others = [(-m, x) for x, m in counts.items() if near(w, x)]
        best = min(others, default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n else None
        found[w] = [form[w], None, n, len(others), -best[0] if form[w] else None]
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        found[w][1] = root
    return {w: tuple(f) for w, f in found.items()}


def written(spark, rows, path, schema):
    path = str(path)
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("parts", [3, 4])
def test_variants_equal_brute_force(spark, parts):
    pick = random.Random(parts)
    counts = {}
    for _ in range(60):
        word = "".join(pick.choice("abcéü") for _ in range(pick.randrange(5, 9)))
        counts[word] = pick.choice([3, 6, 12, 24, 24, 200])
        for _ in range(4):
            i = pick.randrange(len(word))
            word = pick.choice([word[:i] + word[i + 1:], word[:i] + "x" + word[i:], word[:i] + "b" + word[i + 1:]])
            if len(word) >= 5:
                counts.setdefault(word, pick.choice([3, 5, 7, 50]))
    counts |= {"zzzzz": 3, "zzzzzz": 6, "zzzzzzz": 12, "zzzzzzzz": 24, "longest" * 500: 3, "longest" * 500 + "s": 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in sv.group_variants(words, parts).collect()}
    assert found == plain_variants(counts)
    assert found["zzzzz"][1] == "zzzzzzzz"


def test_pairs_come_once(spark):
    words = spark.createDataFrame([(w, 3) for w in ("abcdef", "abcdeg", "abcdefg", "bbcdef", "abcdee")], "word string, n long")
    pairs = sorted(tuple(r) for r in sv.near_pairs(words).select("a", "b").collect())
    expected = sorted((a, b) if (len(a), a) < (len(b), b) else (b, a) for a, b in itertools.combinations(
        ("abcdef", "abcdeg", "abcdefg", "bbcdef", "abcdee"), 2) if near(a, b))
    assert pairs == expected


def test_vocabulary_of_odd_rows(spark, monkeypatch):
    rows = [(1, "Straße STRASSE ÉTÉÉÉ, étééé"), (1, None), (None, "straße-straße apples"), (2, ""), (2, "apples Apples " * 300),
            (3, "x" * 100_000), (3, "x" * 100_000), (4, "x" * 100_000)]
    documents = spark.createDataFrame([(*r, "w", 1) for r in rows], DOCUMENT + ", word string, n int")
    expected = Counter()
    for doc, text in rows:
        for run in sv._RUN.findall((text or "").translate({c: c + 32 for c in range(65, 91)})):
            check = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if check % 3 == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1:]
            expected[run] += 1
    expected = {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}
    got = {r.word: r.n for r in sv.vocabulary(documents, 3).collect()}
    assert got == expected and len(got) > 1
    empty = documents.limit(0)
    assert sv.group_variants(sv.vocabulary(empty)).collect() == []


# ---------------------------------------------------------------------------------------
# Language identification


def test_held_out_languages(spark):
    where = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{where}/documents.parquet").collect()}
    rows = li.op12_language_id(spark, where).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    sure = [r for r in held if not r.rejected]
    assert len(sure) >= 0.97 * len(held) and sum(r.lang_pred == lang[r.doc_id] for r in sure) >= 0.99 * len(sure)


def test_languages_of_odd_rows(spark):
    english, french = "the cat sat on the mat and the dog ran away ", "le chat est sur la table et le chien est parti "
    rows = [(1, english * 5, "en"), (2, french * 5, "fr"), (3, english * 5, "en"), (4, None, "en"), (5, "123 456!", "fr"),
            (6, french.upper(), None), (6, "", None), (None, english * 4000, None), (7, french * 40, None), (7, french * 40, None)]
    documents = spark.createDataFrame([(*r, 0.5, True) for r in rows], DOCUMENT + ", lang string, score double, rejected boolean")
    languages = li.learn(documents)
    assert set(languages) == {"en", "fr"} and languages["en"][0] == 0.5  # the null text is not learned from
    found = [(r.doc_id, r.lang_pred, r.rejected) for r in li.predict(documents, languages).collect()]
    assert sorted(found, key=repr) == sorted([
        (1, "en", False), (2, "fr", False), (3, "en", False), (4, "und", True), (5, "und", True), (6, "fr", False),
        (6, "und", True), (None, "en", False), (7, "fr", False), (7, "fr", False)], key=repr)
    assert li.learn(documents.limit(0)) == {} and li.predict(documents.limit(0), languages).collect() == []
    unlabelled = li.predict(documents, {}).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    # Equal sizes: the more frequent language, then the smaller name.
    assert li.classifier({"b": (0.5, b""), "a": (0.5, b""), "c": (0.4, b"")})("word")[0] == "a"


def test_sample_counts_copies_once(spark, monkeypatch):
    monkeypatch.setattr(li, "SAMPLE", 3)
    rows = [(i, "copy of one text", "en") for i in range(50)] + [(100 + i, f"text number {chr(97 + i)}", "en") for i in range(2)]
    share, content = li.learn(spark.createDataFrame(rows, DOCUMENT + ", lang string"))["en"]
    assert share == 1.0 and content.count(b"copy of one text") == 1 and content.count(b"text number") == 2


# ---------------------------------------------------------------------------------------
# Conversation repair


def brute_plan(rows):
    """Cheapest edits by trying all of them: rows are (initial, fault)."""
    found = []

    def walk(i, state, cost, letters):
        # No cheapest way costs more than deleting everything.
        if cost > 4 * len(rows):
            return
        if i == len(rows) and state in ("", "a"):
            found.append((cost, letters))
        spoken = "a" if state == "u" else "u"
        walk(i, spoken, cost + 3, letters + "I")
        if i < len(rows):
            initial, fault = rows[i]
            walk(i + 1, state, cost + 4, letters + "D")
            if fault not in (cr._BLANK, cr._DUPLICATE):
                extra = 3 * (fault == cr._TRUNCATED)
                walk(i + 1, spoken, cost + 3 + extra, letters + "R")
                if initial == spoken or (initial, state) == ("s", ""):
                    walk(i + 1, initial, cost + extra, letters + "K")

    walk(0, "", 0, "")
    return min(found)


def characters(rows):
    return "".join(chr(65 + cr._INITIALS.index(i) * 4 + f) for i, f in rows)


def test_plan_equals_brute_force():
    every = [(i, f) for i in "suax" for f in range(4)]
    for n in range(3):
        for rows in itertools.product(every, repeat=n):
            for block in (1, 256):
                assert cr.plan(characters(rows), block) == brute_plan(rows), rows
    pick = random.Random(5)
    for _ in range(150):
        rows = [(pick.choice("suuaaax"), pick.choice([0, 0, 0, 1, 2, 3, 3])) for _ in range(pick.randrange(3, 6))]
        expected = brute_plan(rows)
        assert {cr.plan(characters(rows), block) for block in (1, 2, 3, 256)} == {expected}, rows


def test_blocks_of_long_conversations():
    pick = random.Random(8)
    rows = [(pick.choice("suuaaax"), pick.choice([0, 0, 0, 1, 2, 3, 3])) for _ in range(1500)]
    whole = cr.plan(characters(rows), 1500)
    assert all(cr.plan(characters(rows), block) == whole for block in (1, 7, 256))
    assert len(cr.plan(characters(rows * 40))[1]) >= 60_000


def plain_repair(rows):
    """One conversation's (turn, role, text), as the contract words it."""
    key = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, key(r)))
    seen, symbols = set(), []
    for _, role, text in rows:
        body = text.rstrip(cr.SPACE)
        fault = cr._BLANK if not body else cr._DUPLICATE if (role, text) in seen else 0 if body[-1] in ".!?" else cr._TRUNCATED
        seen.add((role, text))
        symbols.append((role[0] if role[:1] in ("s", "u", "a") else "x", fault))
    cost, audit = brute_plan(symbols)
    turns, lines, at, state = {r[0] for r in rows} - {None}, [], 0, ""
    for letter in audit:
        spoken = "assistant" if state == "u" else "user"
        if letter != "D":
            role = rows[at][1] if letter == "K" else spoken
            state = role[0]
            lines.append(f"{role}:{'' if letter == 'I' else rows[at][2]}")
        at += letter != "I"
    faults = [f for _, f in symbols]
    pairs = [a[0] + b[0] for a, b in zip(symbols, symbols[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in (1, 2, 3)),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_conversations_of_odd_rows(spark):
    long = "word " * 60_000
    conversations = {
        1: [(0, "user", "Hi."), (1, "assistant", "Yes."), (3, "user", "Hi.")],
        2: [(None, "system", "Be kind."), (None, None, None), (5, "user", "So?"), (5, "assistant", "So."), (5, "assistant", "So.")],
        3: [(7, "tool", "x = 1"), (9, "user", long), (10, "assistant", long + "!")],
        4: [(None, "", ""), (None, "user", " \t\n")],
        5: [(2, "user", "a."), (2, "user", "b."), (2, "user", "c."), (2, "user", "a.")],
        None: [(1, "assistant", "No.\n"), (2, "user", " ")],
        6: [(-(2**63), "user", "Low."), (2**62 - 5, "assistant", "High.")],
    }
    rows = [(c, *r) for c, turns in conversations.items() for r in turns]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], TURN + ", audit string, cost int").repartition(5)
    planned = cr.plans(frame).cache()
    hashes = {r.conv_id: r.repaired_sha256 for r in cr.digests(frame, planned).collect()}
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes[r.conv_id]) for r in planned.collect()}
    expected = {c: plain_repair(turns) for c, turns in conversations.items()}
    expected[6] = (None, *expected[6][1:])  # more turns than a long can count
    assert got == expected
    texts = {}
    for r in cr.repaired(frame, planned).collect():
        texts.setdefault(r.conv_id, {})[r.place] = f"{r.role}:{r.text}"
    joined = {c: hashlib.sha256("\n".join(t[i] for i in range(len(t))).encode()).hexdigest() for c, t in texts.items()}
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: joined.get(c, empty) for c in hashes} == hashes
    assert cr.plans(frame.limit(0)).collect() == [] and cr.digests(frame.limit(0), planned.limit(0)).collect() == []


def test_query_keeps_emptied_conversations(spark, tmp_path):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Gone."), (None, None, None, None)] + [(c, t, pick, f"{c} {t}.") for c in (2, 3) for t in range(40) for pick in ("user",)]
    spark.createDataFrame(rows, TURN).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in cr.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {dropped, None, 2, 3}
    gone = got[dropped]
    assert (gone.gaps, gone.blank, gone.duplicate, gone.truncated, gone.illegal, gone.cost, gone.audit) == (0, 0, 0, 0, 0, 0, "")
    assert gone.repaired_sha256 == hashlib.sha256(b"").hexdigest()
    broken = []
    for t in range(40):
        check = zlib.crc32(f"2:{t}".encode()) % 20
        text = "" if check == 1 else f"2 {t}" if check == 2 else f"2 {t}."
        broken += [(t, "user", text)] * (0 if check == 0 else 2 if check == 3 else 1)
    assert got[2].blank == sum(r[2] == "" for r in broken) and got[2].illegal == len(broken) - 1
    assert got[2].gaps == max(r[0] for r in broken) - min(r[0] for r in broken) + 1 - len({r[0] for r in broken})
