"""Jaccard join and substring dedup against brute force."""

import hashlib
import random

import pytest

import logloom.llm.jaccard_join as jj
from logloom.llm import common, substring_dedup as sd
from logloom.session import ship_package

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def words_of(text):
    return (text or "").encode().split()


def brute_components(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = [x.lower() for x in words_of(t)]
        sets[i] = {tuple(w[j:j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root, degree = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= percent * len(sets[x] | sets[y]):
                degree[x] += 1
                degree[y] += 1
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), degree[i]) for i, s in sets.items()}


def thue_morse():
    """Two words of 1,024 letters that any polynomial modulo a power of two takes for one."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    return word, word.translate(str.maketrans("ab", "ba"))


def near_copies(seed, groups=6, copies=40):
    pick = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{pick.randrange(400)}" for _ in range(pick.choice([2, 3, 12, 60, 150]))]
        for _ in range(pick.randrange(1, copies)):
            text = list(base)
            for _ in range(pick.randrange(0, 4)):
                text[pick.randrange(len(text))] = f"w{pick.randrange(400)}"
            rows.append((len(rows), pick.choice([" ", "\n", "\t "]).join(text)))
    return rows


@pytest.mark.parametrize("percent,words,frequent", [(90, 3, 16), (80, 5, 16), (90, 3, 2)])
def test_components_equal_brute_force(spark, monkeypatch, percent, words, frequent):
    monkeypatch.setattr(jj, "FREQUENT", frequent)  # few copies already count as frequent
    rows = near_copies(percent + words + frequent)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jj.jaccard_components(frame, words, percent).collect()}
    assert got == brute_components(rows, words, percent)


def test_long_words_are_told_apart(spark):
    one, two = thue_morse()
    assert one != two
    rows = [(i, f"{w} {w} {w}" if i < 2 else f"{w} x y z") for i, w in enumerate((one, two, one, two, one))]
    got = {r.doc_id: (r.component_id, r.n_links) for r in jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: (0, 0), 1: (1, 0), 2: (2, 1), 3: (3, 0), 4: (2, 1)}
    rows = [(i, " ".join([w] * 50)) for i, w in enumerate((one, two, one))]
    got = {r.doc_id: r.n_removed for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 50}


def test_links_of_copies_and_odd_rows(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (3, "A  b c d"), (None, "a b c d"), (5, ""), (6, None), (7, "q")]
    got = sorted((r.doc_id or -1, r.n_links) for r in jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(-1, 0), (1, 2), (2, 2), (3, 2), (5, 0), (6, 0), (7, 0)]


def test_jaccard_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "A b c d", "x"), (5, "a B c d", "x"), (5, "a B c d", "x"),
            (None, "a b c d", "x"), (9, "one", "x"), (8, "one", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, representative string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jj.jaccard_components(frame).collect())
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (5, 2, 4), (5, 2, 4), (-1, 2, None), (9, 1, 8), (8, 1, 8)],
                         key=lambda r: (r[0], r[1]))
    assert jj.jaccard_components(frame.limit(0)).count() == 0
    kept = jj.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 8]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in common.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_ranks_count_up_within_a_key(spark):
    frame = spark.createDataFrame([(k, i) for k in "ab" for i in range(50 if k == "a" else 3)] * 2, "k string, i long")
    rows = common.ranked(frame, ["k"], ["i"], "rank", 4).collect()
    for k, n in (("a", 100), ("b", 6)):
        assert sorted(r["rank"] for r in rows if r.k == k) == list(range(n))


def brute_removed(rows, window):
    first, out = {}, {}
    for i, t in sorted(r for r in rows if r[0] is not None):
        w = words_of(t)
        drop = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first.setdefault(tuple(w[j:j + window]), i) < i:
                drop[j:j + window] = [True] * window
        out[i] = (len(w), sum(drop), b" ".join(x for x, d in zip(w, drop) if not d).decode())
    return out


def test_substring_dedup_equals_brute_force(spark):
    pick = random.Random(5)
    parts = [" ".join(pick.choice("abcdefgh") for _ in range(pick.choice([0, 5, 49, 50, 51, 80, 200]))) for _ in range(20)]
    rows = [(i, f"{pick.choice(parts)} {pick.choice(['a b ' * 60, 'x ' * 120, pick.choice(parts)])}") for i in range(60)]
    rows += [(61, None), (62, ""), (63, " \n\t")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, place string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in sd.remove_repeats(frame).collect()}
    assert got == brute_removed([(i, t or "") for i, t in rows], 50)


def test_substring_edge_rows(spark):
    text = "a b c " * 40
    frame = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in sd.remove_repeats(frame).collect())
    assert got == [(-1, 0), (1, 0), (1, 0), (2, 120)]
    assert sd.remove_repeats(frame.limit(0)).count() == 0


def test_substring_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = {i: (n, g, hashlib.sha256(t.encode()).hexdigest()) for i, (n, g, t) in brute_removed(rows, 50).items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.op9_substring_dedup(spark, SMALL).collect()}
    assert got == want
