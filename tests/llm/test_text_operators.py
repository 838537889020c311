"""Toxicity, secrets, fingerprints, quality rules, URL filters, HTML extraction, and the pipeline."""

import base64
import hashlib
import os
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logloom.llm import fingerprint as fp
from logloom.llm import html_extract, packing, quality_rules, secret_scan, toxicity, url_filter
from logloom.session import ship_package

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def documents(spark, folder=SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_toxicity_on_held_out_labels(spark):
    rows = toxicity.op2_toxicity(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    pairs = [(a.score > b.score) + (a.score == b.score) / 2 for a in held if a.toxic for b in held if not b.toxic]
    assert sum(pairs) / len(pairs) > 0.85
    assert sum(r.predicted and not r.toxic for r in held) <= 0.02 * len(held)


def test_toxicity_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "some words", 0.5), (2, "", 0.5)], "doc_id long, text string, _score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score_toxicity(docs, none).collect()] == [0.0] * 4
    one = spark.createDataFrame([(1, 1), (2, None), (77, 0)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, one).count() == 4
    assert toxicity.without_toxic(docs, none).columns == docs.columns
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0


def base_spans(text):
    found = [(m.start(), 0, m.end(), "assign") for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_base_secrets_equal_the_patterns(spark, tmp_path):
    pick = random.Random(4)
    odd = ["token=token:abcdef", "SECRET : 'abc' secret=abcdef", "é api_key: \"abcd+/==\" AKIA" + "B2" * 9, "AKIAAKIA" + "C" * 12, "0" * 24 + "g" + "a" * 23,
           "paſsword=abcdefg", "passwd:" + "f" * 40, None, "", "deadbeef" * 3, "deadbeef" * 2]
    odd += ["".join(pick.choice(["token", "secret", "=", ":", " ", "é", "AKIA", "Z9" * 8, "deadbeef", '"', "apikey", "zz"]) for _ in range(30)) for _ in range(80)]
    frame = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    for r in secret_scan.op4_secret_scans(spark, str(tmp_path)).collect():
        want = base_spans(odd[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))
    assert secret_scan.scan_secrets(frame.withColumn("row", F.lit(0)).limit(0)).count() == 0


def test_battery_tells_random_from_written():
    pick = random.Random(6)
    made = [base64.b64encode(bytes(pick.randrange(256) for _ in range(30))).decode() for _ in range(200)]
    tested = [t for t in map(secret_scan.battery, made) if t]
    assert sum(p >= 0.05 for _, p in tested) >= 0.85 * len(tested)
    for text in ("the-quick-brown-fox-2020", "some_long_identifier_name_1", "HTTP/1/index/home/page1", "aaaaaaaaaaaaaaaaaaaa1111"):
        assert secret_scan.battery(text)[1] < 0.005
    assert secret_scan.battery("justlettersandnothingelse") is None
    first = secret_scan.cuts({("hex:3", b): 10 for b in range(200)} | {("hex:3", 2): 400, ("hex:3", 0): 900})
    assert first["hex:3"] > 2


def test_redaction(spark):
    frame = spark.createDataFrame([(1, "é token = abcdef and password: token=secretive end", 9, "z"), (1, "plain", 5, "z"), (None, None, 0, "z"), (1, "plain", 5, "z")],
                                  "doc_id long, text string, n_chars long, spans string")
    rows = sorted(map(tuple, secret_scan.redact(frame).collect()), key=repr)
    assert [r[1] for r in rows].count("plain") == 2 and (None, None, None, "z") in rows
    changed = next(r for r in rows if r[1] and "SECRET" in r[1])
    assert "abcdef" not in changed[1] and changed[1].startswith("é [SECRET] and ") and changed[2] == len(changed[1])


def paragraphs(text):
    return {p for p in re.split(r"\n+|(?<=[.!?])[ \t\n\x0b\f\r]+", text.strip(" ")) if p}


def test_fingerprints_equal_set_likeness(spark, monkeypatch):
    monkeypatch.setattr(fp, "IN_RANGE", 20)  # several id ranges
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    ids = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in fp.op3_document_fingerprints(spark, SMALL).collect()}
    assert len(got) == len(ids)
    for i, doc in enumerate(ids):
        text, after = texts[doc], texts[ids[(i + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        row = got[doc]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row.near_edited == pytest.approx(near(paragraphs(text), paragraphs(edited)))
        assert row.near_next == pytest.approx(near(paragraphs(text), paragraphs(after)))
    prints = {}
    for doc in ids:
        assert prints.setdefault(texts[doc], got[doc].fingerprint) == got[doc].fingerprint


def test_peeling_retries_larger(spark, monkeypatch):
    monkeypatch.setattr(fp, "SPACE", 0.1)  # the first sketches are too small
    frame = spark.range(30).select("id", F.sequence(F.lit(1).cast("long"), F.col("id") + 20).alias("a"), F.sequence(F.lit(11).cast("long"), F.col("id") * 2 + 30).alias("b"))
    for r in fp.likeness(frame, ["id"], {"near": ("a", "b")}).collect():
        a, b = set(range(1, r.id + 21)), set(range(11, r.id * 2 + 31))
        assert r.near == pytest.approx(len(a & b) / len(a | b))


def test_sketches_that_no_try_peels_are_compared(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROUNDS", 1)
    monkeypatch.setattr(fp, "SPACE", 0.001)
    monkeypatch.setattr(fp, "LARGER", 1)
    frame = spark.range(12).select("id", F.sequence(F.lit(1).cast("long"), F.col("id") + 30).alias("a"), F.sequence(F.lit(11).cast("long"), F.col("id") * 2 + 30).alias("b"))
    for r in fp.likeness(frame, ["id"], {"near": ("a", "b")}).collect():
        a, b = set(range(1, r.id + 31)), set(range(11, r.id * 2 + 31))
        assert r.near == pytest.approx(len(a & b) / len(a | b))


def read_print(text):
    """(digests, cells by part) of a fingerprint, read without Spark."""
    n, held = text.split(":")
    cell = lambda c: (int(c[:-24], 16), int(c[-24:-8], 16), int(c[-8:], 16)) if c else (0, 0, 0)
    return int(n), [[cell(c) for c in part.split(",")] for part in held.split(";")]


def test_likeness_comes_from_the_returned_fingerprints(spark):
    frame = fp.op3_document_fingerprints(spark, SMALL).withColumn("alone", fp.likeness_of_fingerprints(F.col("fingerprint"), F.col("edited_fingerprint")))
    rows = frame.collect()
    assert sum(r.alone is not None for r in rows) >= 0.7 * len(rows)
    assert all(r.alone is None or r.alone == r.near_edited for r in rows)
    for r in rows:
        n, parts = read_print(r.fingerprint)
        assert len(parts) & (len(parts) - 1) == 0 and all(len(part) == 3 * fp.CELLS for part in parts)
        # Every digest is in one cell of each table of its part.
        assert sum(c[0] for part in parts for c in part) == 3 * n
        assert n <= fp.LOAD * len(parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_fingerprints_of_different_lengths_fold(spark, seed):
    pick = random.Random(seed)
    longer = [[pick.getrandbits(62) for _ in range(n)] for n in (0, 1, 16, 17, 33, 200, 900)]
    data = [(i, a, a[: len(a) // 2] + [pick.getrandbits(62) for _ in range(extra)]) for i, a in enumerate(longer) for extra in (0, 3, 400)]
    got = fp.likeness(spark.createDataFrame(data, "id long, a array<long>, b array<long>"), ["id", "a", "b"], {"near": ("a", "b")}).collect()
    for r in got:
        a, b = set(r.a), set(r.b)
        assert r.near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert len(got) == len(data)


def test_fingerprint_of_a_very_long_text(spark):
    text = " ".join(f"Sentence number {i} of many." for i in range(30_000))
    frame = spark.createDataFrame([(1, text, "a", 7), (2, text + " More.", "b", 8)], "doc_id long, text string, own string, next int")
    one, two = fp.fingerprints(frame).orderBy("doc_id").collect()
    assert len(read_print(one.fingerprint)[1]) == 2048 and read_print(two.fingerprint)[0] == 30_001
    assert one.near_next == two.near_next == pytest.approx(30_000 / 30_001)


def test_fingerprint_edge_rows(spark):
    frame = spark.createDataFrame([(None, "x. y."), (1, None), (1, None), (2, "x. y."), (3, "")], "doc_id long, text string")
    rows = fp.fingerprints(frame).collect()
    assert len(rows) == 5 and len({r.fingerprint for r in rows if r.n_chars}) == 1
    assert fp.fingerprints(frame.limit(0)).count() == 0
    assert fp.fingerprints(frame.where("doc_id = 2")).first().near_next == 1.0


def brute_statistics(text):
    w = [x.decode() for x in (text or "").encode().split()]
    triples = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
    counts = Counter(triples)
    covered = {j + k for j, t in enumerate(triples) if counts[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), sum(c in quality_rules.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics_equal_brute_force(spark):
    pick = random.Random(8)
    odd = [None, "", " \n ", "a", "a b", "a b c", "a b c a b c", "x " * 50, "é\u00a0ü é", "a\n a\na\n\nb|$"]
    odd += [" ".join(pick.choice("ab") + pick.choice(["", "\n", "#"]) for _ in range(pick.randrange(80))) for _ in range(60)]
    odd += [r.text for r in documents(spark).collect()]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(odd)], "doc_id long, text string, words int")
    for r in quality_rules.judge(frame).collect():
        want = brute_statistics(odd[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    assert quality_rules.judge(frame.limit(0)).count() == 0


@pytest.mark.parametrize("hashed", ["CAST(0 AS BIGINT)", "shiftleft(pmod(xxhash64(words[i], words[i + 1], words[i + 2]), 3), 61)"])
def test_quality_counts_are_exact_when_windows_collide(spark, monkeypatch, hashed):
    monkeypatch.setattr(quality_rules, "WINDOW_HASH", hashed)
    pick = random.Random(9)
    odd = ["a b c", "a b c d", "a b c x a b c", "a b c d e f a b c g b c d"]
    odd += [" ".join(pick.choice("abcdefgh") for _ in range(pick.randrange(90))) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(odd)) * 2, "doc_id long, text string")
    rows = quality_rules.statistics(frame).collect()
    assert len(rows) == 2 * len(odd)
    assert [r.n_repeat_words for r in rows] == [brute_statistics(odd[r.doc_id])[4] for r in rows]


def test_quality_of_a_very_long_text(spark):
    pick = random.Random(5)
    text = " ".join(str(pick.randrange(150)) for _ in range((1 << 20) + 10))
    row = quality_rules.statistics(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == brute_statistics(text)


def plain_votes(text):
    """1 good, 0 bad, -1 none for each rule, and whether the base limits fail."""
    n, chars, signs, same, repeats = brute_statistics(text)
    words = [x.decode() for x in (text or "").encode().split()]
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    letters = sum(unicodedata.category(c)[0] == "L" for w in words for c in w) / max(chars, 1)
    ended = sum(x.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?:;\"')" for x in lines)
    stops = len(set(words) & set(quality_rules.STOP_WORDS))
    per, rows = max(n, 1), max(len(lines), 1)
    pairs = [(n < 60, n >= 120), (not 2.5 <= chars / per <= 14, 3 <= chars / per <= 11), (signs / per > 0.25, signs / per < 0.05),
             (same > 0.3 * rows, same == 0 and len(lines) > 1), (repeats > 0.25 * per, repeats < 0.05 * per), (letters < 0.7, letters > 0.9),
             (ended < 0.1 * rows, ended > 0.5 * rows), (stops < 2 and n >= 40, stops >= 4)]
    return n, [0 if bad else 1 if good else -1 for bad, good in pairs], n < 50 or 100 * repeats > 50 * n


def test_quality_verdicts_equal_a_plain_version(spark):
    """Expectation-maximisation over single documents, not over counted patterns."""
    texts = {r.doc_id: r.text for r in documents(spark, MEDIUM).collect()}
    plain = {doc: plain_votes(text) for doc, text in texts.items()}
    votes = np.array([v for n, v, _ in plain.values() if n])
    good, bad = votes == 1, votes == 0
    share, on_good, on_bad = 0.8, np.full(votes.shape[1], 0.8), np.full(votes.shape[1], 0.8)

    def log_odds(good, bad):
        return np.log(share / (1 - share)) + good @ np.log(on_good / (1 - on_bad)) + bad @ np.log((1 - on_good) / on_bad)

    for _ in range(quality_rules.ROUNDS):
        p = 1 / (1 + np.exp(-log_odds(good, bad)))
        share = np.clip(p.mean(), 0.01, 0.99)
        cast = good | bad
        on_good = np.clip((1.6 + p @ good) / (2 + p @ cast), 0.55, 0.995)
        on_bad = np.clip((1.6 + (1 - p) @ bad) / (2 + (1 - p) @ cast), 0.55, 0.995)
    got = quality_rules.op6_quality_rules(spark, MEDIUM).collect()
    assert len(got) == len(texts)
    for r in got:
        _, found, failed = plain[r.doc_id]
        odds = log_odds(np.array(found) == 1, np.array(found) == 0)
        assert r.base_failed == failed
        assert abs(odds) < 1e-6 or r.kept == (not failed and odds >= 0)
    assert 0 < sum(not r.kept and not r.base_failed for r in got) < len(got) / 2


def test_quality_keeps_labelled_good_texts(spark):
    rows = quality_rules.op6_quality_rules(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_estimate_finds_the_better_rules():
    pick = random.Random(3)
    truth = [pick.random() < 0.7 for _ in range(4000)]
    right = [0.95, 0.9, 0.6, 0.85]
    votes = Counter(tuple(-1 if pick.random() < 0.2 else int(t == (pick.random() < p)) for p in right) for t in truth)
    share, found = quality_rules.estimate(list(votes.items()), 4)
    assert abs(share - 0.7) < 0.05 and found[0][0] > 0.88 and found[2][0] < 0.75


def test_url_rules(spark):
    urls = {"http://WWW.Example.ORG/es/1": ("org/", "www.example.org", "/es/1"), "http://example.org/es/1?x": ("example.org/es/",) * 1 + ("example.org", "/es/1"),
            "https://a.example.org/en/12#t": ("example.org/en/1", "a.example.org", "/en/12"), "https://badexample.org/en/1": ("org/", "badexample.org", "/en/1"),
            "x://fr.com/fr/": ("com/fr/", "fr.com", "/fr/"), "x://com/de/9": ("com/de/", "com", "/de/9"), "x://b.net/a://c": (None, "b.net", "/a://c"),
            "x://y.org": (None, "y.org", ""), "no scheme": (None, "", ""), None: (None, "", ""), "://?": (None, "", "")}
    urls["http://WWW.Example.ORG/es/1"] = ("example.org/es/", "www.example.org", "/es/1")
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] * 2, "page_id long, url string, template string")
    rows = url_filter.judge_urls(frame).collect()
    assert len(rows) == 2 * len(urls)
    for r in rows:
        assert (r.rule, r.host, r.path) == list(urls.values())[r.page_id]
        assert r.verdict in ("allow", "block")
    assert url_filter.judge_urls(frame.limit(0)).count() == 0


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    fits = [(len(t), t, said) for said, t in url_filter.RULES for name, begin in [t.split("/", 1)]
            if (host == name or host.endswith("." + name)) and path.startswith("/" + begin)]
    return max(fits)[1:] if fits else (None, None)


def plain_shares(paths, depth):
    """The blocked share of every (host, path), by dictionaries; paths holds (rows, verdict of the rule)."""
    varies = re.compile(r"^[0-9]+(\.\w+)?$|^[0-9a-fA-F]{8}[0-9a-fA-F-]*$|[0-9].*[0-9].*[0-9]", re.A)

    def shape(segment):
        if not varies.search(segment):
            return segment
        end = re.search(r"\.[A-Za-z]\w*$", segment, re.A)
        return "*" + (end[0] if end else "")

    parts = {key: [shape(x) for x in key[1].split("/") if x] for key in paths}
    branch = {key: () for key in paths}
    for level in range(depth):
        values, step = {}, {}
        for key, found in parts.items():
            if len(found) > level:
                values.setdefault((key[0], branch[key]), set()).add(found[level])
        for key, found in parts.items():
            if len(found) > level:
                wide = len(values[key[0], branch[key]]) > url_filter.WIDE
                step[key] = "*" if wide else found[level]
        for key, segment in step.items():
            branch[key] += (segment,)
    for key, found in parts.items():
        if len(found) > depth:
            branch[key] += ("**",)
    labels = {}
    for key, (n, said) in paths.items():
        for level in range(len(branch[key]) + 1):
            node = labels.setdefault((key[0], branch[key][:level]), [0, 0])
            node[0] += n * (said == "block")
            node[1] += n * (said is not None)

    def share(host, node):
        blocked, n = labels[host, node]
        above, weight = url_filter.PRIOR, url_filter.STRENGTH
        if node:
            above = share(host, node[:-1])
            all_blocked, all_n = labels[host, node[:-1]]
            if not n or abs(blocked / n - all_blocked / all_n) <= url_filter.ALIKE * (all_blocked / all_n * (1 - all_blocked / all_n) / n) ** 0.5:
                return above
        return (blocked + above * weight) / (n + weight)

    return {key: share(key[0], branch[key]) for key in paths}


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_url_verdicts_equal_a_plain_version(spark, folder):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    split = {page: plain_split(url) for page, url in urls.items()}
    counts = Counter(split.values())
    shares = plain_shares({key: (n, plain_rule(*key)[1]) for key, n in counts.items()}, url_filter.depth_of(url_filter.RULES))
    rows = url_filter.op7_url_filter(spark, folder).collect()
    assert len(rows) == len(urls)
    for r in rows:
        key = split[r.page_id]
        rule, said = plain_rule(*key)
        assert ((r.host, r.path), r.rule) == (key, rule)
        assert r.verdict == (said or ("block" if shares[key] > url_filter.REJECT else "allow"))


def test_unlabelled_branches_take_after_their_siblings(spark):
    urls = [f"http://h.com/x/s{c}/{i}" for c in "abcdefghijk" for i in range(3)] + ["http://h.com/x/sl/1", "http://h.com/y/z"]
    urls += [f"http://h.com/y/{c}/1" for c in "abcdefghijklmnopq" for _ in range(9)]
    urls += [f"http://h.com/a/b/c/d/{k}/{i}" for k in ("good", "bad") for i in range(30)] + ["http://h.com/a/b/c/d/bad/new/1"]
    urls += ["http://other.com/x/sl/1"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [("block", f"h.com/x/s{c}/") for c in "abcdefghijk"] + [("allow", f"h.com/y/{c}/") for c in "abcdefghijklmnopq"]
    rules += [("allow", "h.com/a/b/c/d/good/"), ("block", "h.com/a/b/c/d/bad/1"), ("block", "h.com/a/b/c/d/bad/2")]
    got = {urls[r.page_id]: r for r in url_filter.judge_urls(frame, tuple(rules)).collect()}
    assert url_filter.depth_of(rules) == 7
    said = {u: r.verdict for u, r in got.items() if r.rule is None}
    assert said["http://h.com/x/sl/1"] == "block" and said["http://h.com/y/z"] == "allow"
    assert said["http://h.com/a/b/c/d/bad/3"] == "block" and said["http://other.com/x/sl/1"] == "allow"
    assert len({round(got[u].blocked_share, 6) for u in said}) > 2


def test_random_values_behind_names_are_found(spark):
    pick = random.Random(2)
    letters = secret_scan.ALPHABETS["base64"][:62]
    values = ["".join(pick.choice(letters) for _ in range(40)) for _ in range(200)]
    texts = [f"see session={v} and" for v in values[:100]] + [f"AWS_KEY={v}&x=1 +_{v}" for v in values[100:]]
    docs = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "row long, doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.spans] for r in secret_scan.scan_secrets(docs).collect()}
    assert sum(values[i] in found[i] for i in range(100)) >= 90
    assert sum(values[i] in found[i] for i in range(100, 200)) >= 90
    assert all(set(f) <= {values[i]} for i, f in found.items())


def test_one_rule_for_classes_of_any_size():
    """The same value is judged alike beside few and many random ones."""
    first = [secret_scan.cuts({("hex:3", b): n for b in range(200)} | {("hex:3", 0): n})["hex:3"] for n in (1, 10, 1000)]
    assert len(set(first)) == 1
    assert secret_scan.cuts({("hex:3", 60): 1}) == {"hex:3": 2}


def test_url_templates_learn_from_labels(spark):
    urls = [f"http://h.com/de/list/{i}" for i in range(40)] + [f"http://h.com/ok/{'abcdefghij'[i % 10]}" for i in range(40)]
    urls += [f"http://h.com/shop/{i}.html" for i in range(30)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge_urls(frame, (("block", "h.com/shop/1"), ("allow", "h.com/ok/"))).collect()
    assert {r.template for r in got if "/shop/" in r.path} == {"/shop/*.html"}
    assert {r.verdict for r in got if "/ok/" in r.path} == {"allow"}
    assert {r.verdict for r in got if r.path in ("/shop/2.html", "/shop/25.html")} == {"block"}


def test_html_extraction_of_the_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in html_extract.op8_html_extraction(spark, SMALL).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        parts = [re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)) for x in re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", inner))]
        want = [" ".join(html_extract.html.unescape(x).split()) for x in parts]
        assert r.text == "\n\n".join(x for x in want if x) and r.n_chars == len(r.text)


def test_html_parts_that_are_no_text(spark):
    page = ("<html><body class='nav'><header><p>Site name.</p></header><div id=cookie-notice>We use cookies, do you agree?</div><nav><a href=x>Home</a></nav>"
            "<main><h1>Title &amp; more</h1><p>First <i>long</i> text, with some\n words and marks. More of it, as it goes on.<p>Second&nbsp;one. &lt;b&gt; &am"
            "<script>var a = '</p>';</script><style>p{}</style><form><p>Mail?</p></form><aside>Side text.</aside><ul><li>Point one, fine.<li>Point two.</ul>"
            "<section class='reader comments'><p>I like it, a lot, really.</p></section></main><footer>&copy; me</footer><!-- <p>no</p> --></body></html>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "plain words only."), (4, "u", "cut off <p>here and <di")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = {(r.page_id, r.text) for r in html_extract.extract(frame).collect()}
    want = "\n\n".join(["Title & more", "First long text, with some words and marks. More of it, as it goes on.", "Second one. <b> &am", "Point one, fine.", "Point two."])
    assert (1, want) in got and (2, "") in got and (3, "") in got and (4, "plain words only.") in got and len(got) == 5
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_html_uses_all_paths_of_the_corpus(spark):
    """One path a page, more than 50,000 of them, deep ones and long labels apart: totals equal plain sums over all pages."""
    long = "c" * 40
    deep = "<div>" * 30
    pages = [f"<body><div class=k{i}><p>Text {i}, a sentence. And more.</p></div><div class={long}{i % 3}>Menu</div>{deep}<b>x</b><p class={'ab'[i % 2]}>deep.</p></body>"
             for i in range(200)]
    corpus = {}
    for page in pages:
        for key, s in html_extract._sums(html_extract.blocks(page)).items():
            corpus[key] = [a + b for a, b in zip(corpus.get(key, [0] * 4), s)]
    assert len(corpus) >= 2 * 200 + 2 * 3 + 2 + 1  # paths and regions that differ late are different
    frame = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(7)
    for r in html_extract.extract(frame).collect():
        found = html_extract.blocks(pages[r.page_id])
        able = [(b.path, b.region, b.article, b.text) for b in found if not b.never]
        assert r.text == html_extract.content(able, html_extract._sums(found), corpus)
    many = "".join(f"<div id=d{i}>Words of part {i}.</div>" for i in range(60_000))
    nested = "<div>" * 20_000 + "end of it."
    rows = spark.createDataFrame([(1, "u", many), (2, "u", nested)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(rows).collect()}
    assert got[1].count("\n\n") == 59_999 and got[2] == "end of it."


def test_pipeline(spark):
    docs = documents(spark)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, packing.common.cut(stage(spark, kept, SMALL))
        assert kept.columns == docs.columns, name
        assert kept.count() <= before.count()
        if name == "secrets":
            assert not [r for r in kept.collect() if base_spans(r.text)]
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in kept.collect()}
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0, name
