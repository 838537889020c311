"""Quality rules by weak supervision.

Rules look at a text's statistics and vote good, bad, or abstain. Expectation-maximisation over
the votes of the whole corpus estimates how often each rule is right on good and on bad
texts, and the share of good texts; no label is used. A text is kept if its posterior
probability of being good is at least one half, unless a base rule fails.

The corpus reaches the driver as counts of vote patterns, at most 3^RULES rows. The posterior is a
sum of log-odds, a plain column. Only built-in functions are used. Repeated 3-word windows
are found by sorting one array of packed hashes and places a text: a place takes as many bits as
the text's number of words needs, the hash the rest. Neighbours are compared word by word. Two
different windows with one hash show as neighbours that differ; such a text is sorted by
the words themselves, so the count is exact at every length.

Edge cases: null and blank texts have no words and fail; very long texts are judged whole; repeated
rows are judged one by one; a probability of exactly one half keeps the text; null ids stay null; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Frequent words of the corpus languages.
STOP_WORDS = ("the of and to in is that for with from der die das und ist nicht von mit den ein le la les de et un une est que"
              " pour dans el los las en es por con para una").split()
ROUNDS = 60
#: The hash of the 3-word window at place i.
WINDOW_HASH = "xxhash64(words[i], words[i + 1], words[i + 2])"


def _hash_is(i: str, j: str) -> str:
    return f"shiftright(packed[{i}], place_bits) = shiftright(packed[{j}], place_bits)"


def _words_are(i: str, j: str) -> str:
    start = lambda k: f"CAST(packed[{k}] & place_mask AS INT) + 1"
    return f"slice(words, {start(i)}, 3) = slice(words, {start(j)}, 3)"


def _repeat_places() -> Column:
    """Places (ascending) of 3-word windows that occur twice or more in the text's `words`."""
    return F.expr(f"""
        sort_array(transform(
          filter(sequence(0, size(packed) - 1), i ->
            (i > 0 AND {_hash_is("i", "i - 1")} AND {_words_are("i", "i - 1")})
            OR (i < size(packed) - 1 AND {_hash_is("i", "i + 1")} AND {_words_are("i", "i + 1")})),
          i -> CAST(packed[i] & place_mask AS INT)))
    """)


def _collide() -> Column:
    """Whether different windows of the text share a hash; then some neighbours among them differ."""
    return F.expr(f"exists(sequence(1, size(packed) - 1), i -> {_hash_is('i', 'i - 1')} AND NOT {_words_are('i', 'i - 1')})")


def _repeat_places_by_words() -> Column:
    """The same places, from windows sorted by their words."""
    windows = F.expr("""sort_array(transform(sequence(0, n_words - 3), i ->
        named_struct('a', words[i], 'b', words[i + 1], 'c', words[i + 2], 'place', i)))""")
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def places(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 1)
        repeated = F.filter(at, lambda i: ((i > 0) & same(F.get(w, i), F.get(w, i - 1)))
                            | ((i < F.size(w) - 1) & same(F.get(w, i), F.get(w, i + 1))))
        return F.sort_array(F.transform(repeated, lambda i: F.get(w, i)["place"]))

    # One element, so that the sorted windows are computed once.
    return F.element_at(F.transform(F.array(windows), places), 1)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and what the rules look at, one row per row of docs(doc_id, text)."""
    bits = F.length(F.bin(F.col("n_words").cast("long")))
    text = F.col("text")
    split = docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text")).select(
        "doc_id", "text", F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    counted = split.withColumn("n_words", F.size("words")).withColumn("place_bits", bits).withColumn(
        "place_mask", F.expr("shiftleft(1L, place_bits) - 1L"))
    packed = counted.withColumn("packed", F.expr("""
        CASE WHEN n_words < 3 THEN CAST(array() AS ARRAY<BIGINT>) ELSE sort_array(transform(sequence(0, n_words - 3), i ->
          shiftleft(shiftright(__HASH__, place_bits), place_bits) | CAST(i AS BIGINT))) END""".replace("__HASH__", WINDOW_HASH)))
    places = F.when(F.size("packed") < 2, F.array().cast("array<int>")).when(_collide(), _repeat_places_by_words())
    found = packed.withColumn("places", places.otherwise(_repeat_places()))
    covered = F.expr("""
        CASE WHEN size(places) = 0 THEN 0L ELSE
          aggregate(sequence(1, size(places)), 3L, (n, i) -> CASE WHEN i = size(places) THEN n
            ELSE n + least(3, places[i] - places[i - 1]) END) END""")
    joined = F.array_join("words", "")
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace(joined, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.size(F.filter("lines", lambda x: x.rlike(r"[.!?:;\"')][\x20\x09-\x0D]*$"))).cast("long").alias("n_ended"),
        F.size(F.array_intersect("words", F.array(*[F.lit(w) for w in STOP_WORDS]))).cast("long").alias("n_stops"),
    )


def rules() -> dict[str, tuple[Column, Column]]:
    """Rule -> (bad if true, good if true); neither abstains."""
    c, per = F.col, F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(c("n_lines"), F.lit(1))
    size = c("word_chars") / per
    signs, letters = c("n_symbols") / per, c("n_letters") / F.greatest(c("word_chars"), F.lit(1))
    return {
        "length": (c("n_words") < 60, c("n_words") >= 120),
        "word_size": ((size < 2.5) | (size > 14), size.between(3, 11)),
        "symbols": (signs > 0.25, signs < 0.05),
        "same_lines": (c("n_dup_lines") > 0.3 * lines, (c("n_dup_lines") == 0) & (c("n_lines") > 1)),
        "repeats": (c("n_repeat_words") > 0.25 * per, c("n_repeat_words") < 0.05 * per),
        "letters": (letters < 0.7, letters > 0.9),
        "line_ends": (c("n_ended") < 0.1 * lines, c("n_ended") > 0.5 * lines),
        "stop_words": ((c("n_stops") < 2) & (c("n_words") >= 40), c("n_stops") >= 4),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> tuple[float, list[tuple[float, float]]]:
    """(share of good texts, each rule's accuracy on good and on bad texts) from counted votes.

    A vote is 1 good, 0 bad, -1 none. Abstaining says nothing. Accuracies stay above one
    half, which fixes which of the two classes is the good one.
    """
    share, right = 0.8, [(0.8, 0.8)] * n_rules
    for _ in range(ROUNDS):
        total = good = 0.0
        sums = [[1.6, 2.0, 1.6, 2.0] for _ in range(n_rules)]  # a weak prior: right in 8 of 10
        for votes, n in patterns:
            odds = math.log(share / (1 - share))
            for (g, b), v in zip(right, votes):
                odds += math.log(g / (1 - b)) if v == 1 else math.log((1 - g) / b) if v == 0 else 0
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            total += n
            good += n * p
            for s, v in zip(sums, votes):
                if v >= 0:
                    s[0] += n * p * v
                    s[1] += n * p
                    s[2] += n * (1 - p) * (1 - v)
                    s[3] += n * (1 - p)
        share = min(0.99, max(0.01, good / total)) if total else share
        right = [(min(0.995, max(0.55, s[0] / s[1])), min(0.995, max(0.55, s[2] / s[3]))) for s in sums]
    return share, right


def judge(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) with statistics, votes, probability, base_failed and kept."""
    votes = {name: F.when(bad, 0).when(good, 1).otherwise(-1) for name, (bad, good) in rules().items()}
    stats = common.cut(statistics(docs).select("*", *[v.cast("int").alias(f"vote_{k}") for k, v in votes.items()]))
    names = [f"vote_{k}" for k in votes]
    counted = stats.where("n_words > 0").groupBy(*names).count().collect()  # at most 3^RULES rows
    share, right = estimate([(tuple(r[:-1]), r[-1]) for r in counted], len(names))
    odds = F.lit(math.log(share / (1 - share)))
    for name, (g, b) in zip(names, right):
        odds = odds + F.when(F.col(name) == 1, math.log(g / (1 - b))).when(F.col(name) == 0, math.log((1 - g) / b)).otherwise(0.0)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        stats.withColumn("probability", 1 / (1 + F.exp(-odds)))
        .withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("probability") >= 0.5))
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
