"""Secret scans: fixed patterns, and a randomness test battery for everything else.

Patterns find assigned values, access ids and long hex runs. Beyond them, each run of 20 or
more letters, digits and `+/_=-` that mixes letters with digits is a candidate. Its encoding
is inferred (hex, base 32, base 36, base 64), and three tests ask whether it could be drawn
uniformly from that alphabet: chi-squared of the symbols, runs of character classes, serial
correlation. Fisher's method combines their p-values.

A run is cut at inner `=` signs, so a value behind any name is tested by itself, and a part that no
encoding fits is cut at its punctuation. A part that touches a base span is no candidate.

Random strings have uniform p-values, text has p-values near zero. For each length class and
encoding, the p-values of the whole corpus are counted in bins, PRIOR random ones added; from the
upper half follows how many candidates are random, and the smallest cut is taken at which at most
`FDR` of the accepted ones are expected not to be. Short candidates, where the tests tell less,
thus need a larger p-value than long ones. The rule is the same for classes of any size: the added
ones only matter in small classes. Only those counts reach the driver (a fixed number of bins).

Edge cases: texts of any length are scanned whole; null and empty texts have no spans; repeated rows are scanned one by one; equal
starts are ordered by kind; null ids stay null; extra columns are kept out of the report and
kept in the redacted documents; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

#: What the base patterns look for, and the least length of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "random")

RANDOM_LEAST = 20
FDR, P_BINS, LEAST_P = 0.05, 200, 0.01
#: Random candidates that each class is taken to have beside those found.
PRIOR = 25
REDACTED = "[SECRET]"

_table = lambda chars: np.isin(np.arange(256), [ord(c) for c in chars])
_DIGITS, _LOWERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_HEX = _table(_DIGITS + "abcdef")
_TOKEN = _table(_DIGITS + _LOWERS + _LOWERS.upper() + "+/_=-")
#: Encodings, narrowest first.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _LOWERS.upper() + "234567",
    "base36": _DIGITS + _LOWERS,
    "BASE36": _DIGITS + _LOWERS.upper(),
    "base64": _LOWERS.upper() + _LOWERS + _DIGITS + "+/",
    "base64url": _LOWERS.upper() + _LOWERS + _DIGITS + "-_",
}


def _runs(mask: np.ndarray, breaks: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of runs of `least` or more true values; a run ends at a break."""
    opens = mask.copy()
    opens[1:] &= ~mask[:-1]
    opens[breaks] = mask[breaks]
    closes = mask.copy()
    closes[:-1] &= ~mask[1:]
    closes[breaks - 1] = mask[breaks - 1]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = b - a >= least
    return a[long], b[long]


# ---------------------------------------------------------------------------------------
# The battery


def _upper_chi2(x: float, df: float) -> float:
    """Chi-squared tail by Wilson and Hilferty's cube-root normal."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str) -> tuple[str, float] | None:
    """(encoding, combined p-value that the token is random), or None if no encoding fits."""
    body = token.rstrip("=")
    name = next((k for k, a in ALPHABETS.items() if set(body) <= set(a)), None)
    if name is None or len(body) < RANDOM_LEAST or not any(c.isdigit() for c in body) or not any(c.isalpha() for c in body):
        return None
    alphabet = ALPHABETS[name]
    x = np.array([alphabet.index(c) for c in body], float)
    n, m = len(x), len(alphabet)
    counts = np.bincount(x.astype(int), minlength=m)
    chi = float(((counts - n / m) ** 2).sum() * m / n)
    p_chi = _upper_chi2(chi, m - 1)
    kind = np.array([0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in body])
    share = np.bincount([0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in alphabet], minlength=4) / m
    change = 1 - float((share**2).sum())
    seen = int((kind[1:] != kind[:-1]).sum())
    # Neighbouring changes share a symbol, hence the covariance term.
    both = 1 - 2 * float((share**2).sum()) + float((share**3).sum()) - change**2
    spread = math.sqrt(max(1e-9, (n - 1) * change * (1 - change) + 2 * (n - 2) * both))
    p_runs = _two_sided((abs(seen - (n - 1) * change) - 0.5) / spread)
    used = float(((np.bincount(kind, minlength=4) - n * share)[share > 0] ** 2 / (n * share[share > 0])).sum())
    p_kinds = _upper_chi2(used, max(1, int((share > 0).sum()) - 1))
    y = x - (m - 1) / 2
    serial = float((y[1:] * y[:-1]).sum()) / ((m * m - 1) / 12 * math.sqrt(n - 1))
    p_serial = _two_sided(serial)
    tests = [p_chi, min(1.0, p_runs), p_kinds, p_serial]
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in tests)
    half, term, tail = fisher / 2, 1.0, 0.0  # chi-squared tail of even degrees of freedom
    for k in range(len(tests)):
        tail += term
        term *= half / (k + 1)
    return name, min(1.0, math.exp(-half) * tail)


def _parts(token: str) -> list[tuple[int, int, tuple[str, float]]]:
    """(start, end, battery result) of the candidates of a run of token characters."""
    found = []
    for part in re.finditer(r"[^=]+(=+$)?", token):
        if tested := battery(part[0]):
            found.append((part.start(), part.end(), tested))
        elif len(part[0]) > RANDOM_LEAST and not any(set(part[0].rstrip("=")) <= set(a) for a in ALPHABETS.values()):
            inner = ((m.start() + part.start(), m.end() + part.start(), battery(m[0])) for m in re.finditer(r"[A-Za-z0-9]+", part[0]))
            found += [x for x in inner if x[2]]
    return found


def _length_class(n: int) -> int:
    return min(7, n.bit_length() * 2 - 8 + (n >> max(0, n.bit_length() - 2) & 1))


# ---------------------------------------------------------------------------------------
# Scanning


def _base(text: str, data: bytes, hexes: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base spans in code points; hexes are byte spans."""
    spans = []
    low = data.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in data:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(a, b, 2) for a, b in _points(data, hexes)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def _points(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans of single-byte characters as code points."""
    out, at, points = [], 0, 0
    for a, b in spans:
        points += len(data[at:a].decode())
        at = a
        out.append((points, points + b - a))
    return out


_SPAN = "struct<start:long,end:long,kind:int>"
_MAYBE = "struct<start:long,end:long,kind:int,class:string,bin:int>"
_SCAN = f"row long, doc_id long, base array<{_SPAN}>, maybe array<{_MAYBE}>"


def _scan(batches):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())])
    maybe_type = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()),
                            ("class", pa.string()), ("bin", pa.int32())])
    for batch in batches:
        for part in common.text_slices(batch):
            texts = part.column("text").to_pylist()
            raw = [(t or "").encode() for t in texts]
            edges = np.r_[0, np.cumsum([len(x) for x in raw])]
            data = np.frombuffer(b"".join(raw), np.uint8)
            found = {}
            for name, table, least in (("hex", _HEX, HEX_LEAST), ("random", _TOKEN, RANDOM_LEAST)):
                found[name] = [[] for _ in texts]
                if len(data):
                    breaks = np.unique(edges[(edges > 0) & (edges < len(data))])
                    a, b = _runs(table[data], breaks, least)
                    for i, x, y in zip(np.searchsorted(edges, a, "right") - 1, a, b):
                        found[name][i].append((int(x - edges[i]), int(y - edges[i])))
            bases, maybes = [], []
            for text, bits, hexes, tokens in zip(texts, raw, found["hex"], found["random"]):
                base, maybe = _base(text or "", bits, hexes), []
                for (x, y), (run, _) in zip(tokens, _points(bits, tokens)):
                    for opens, closes, tested in _parts(bits[x:y].decode()):
                        a, b = run + opens, run + closes
                        if not any(s < b and a < e for s, e, _ in base):
                            maybe.append({"start": a, "end": b, "kind": 3, "class": f"{tested[0]}:{_length_class(b - a)}",
                                          "bin": min(P_BINS - 1, int(tested[1] * P_BINS))})
                bases.append([{"start": a, "end": b, "kind": k} for a, b, k in base])
                maybes.append(maybe)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array(bases, pa.list_(span)), pa.array(maybes, pa.list_(maybe_type))],
                ["row", "doc_id", "base", "maybe"])


def cuts(counts: dict[tuple[str, int], int]) -> dict[str, int]:
    """For each class the first bin whose candidates are accepted."""
    first = {}
    for name in {c for c, _ in counts}:
        bins = np.array([counts.get((name, b), 0) for b in range(P_BINS)], float) + PRIOR / P_BINS
        least = max(1, int(LEAST_P * P_BINS))
        random = 2 * bins[P_BINS // 2 :].sum()
        accepted = bins[::-1].cumsum()[::-1]
        expected = random * (1 - np.arange(P_BINS) / P_BINS)
        rate = np.maximum(0, accepted - expected) / np.maximum(1, accepted)
        fine = np.flatnonzero(rate[least : P_BINS // 2] <= FDR)
        first[name] = least + int(fine[0]) if len(fine) else P_BINS // 2
    return first


def scan_secrets(docs: DataFrame) -> DataFrame:
    """docs(row, doc_id, text) as (row, doc_id, spans): base and accepted random spans, in order.

    spans is an array of (start, kind, end) in code points; kind counts along KINDS.
    """
    spark = docs.sparkSession
    scanned = common.cut(docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, _SCAN))
    binned = scanned.select(F.explode("maybe").alias("m")).groupBy("m.class", "m.bin").count().collect()
    first = cuts({(r[0], r[1]): r[2] for r in binned})
    table = F.create_map(*[F.lit(x) for pair in first.items() for x in pair]) if first else None
    chosen = F.filter("maybe", lambda m: m["bin"] >= table[m["class"]]) if first else F.col("maybe")
    plain = lambda a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return scanned.select("row", "doc_id", F.array_sort(F.concat(plain(F.col("base")), plain(chosen))).alias("spans"))


def _named(spans: F.Column) -> F.Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s["kind"]], s["start"], s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every found secret replaced; other columns stay, n_chars is counted anew."""
    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                for span in sorted(spans or [], key=lambda s: -s["start"]):
                    text = text[: span["start"]] + REDACTED + text[span["end"] :] if span["end"] <= len(text) else text
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.string())], ["_row", "text"])

    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64("doc_id", "text").alias("row"))
    found = (
        scan_secrets(held.select("row", "_row.doc_id", "_row.text")).where(F.size("spans") > 0)
        .groupBy("row").agg(F.first("spans").alias("spans"))  # equal rows have equal spans
    )
    merged = held.join(found, "row", "left").withColumn("spans", _disjoint(F.col("spans")))
    schema = merged.select("_row", F.col("_row.text").alias("text")).schema
    new = merged.select("_row", F.col("_row.text").alias("text"), "spans").mapInArrow(run, schema)
    return new.select(*[
        F.col("text") if c == "text"
        else F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"_row.`{c}`").alias(c)
        for c in docs.columns
    ])


def _disjoint(spans: F.Column) -> F.Column:
    """Overlapping spans as one."""
    empty = F.array().cast("array<struct<start:long,end:long>>")

    def add(found, s):
        joins = (F.size(found) > 0) & (F.try_element_at(found, F.lit(-1))["end"] >= s["start"])
        last = F.try_element_at(found, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(found, 1, F.size(found) - 1), F.array(grown))).otherwise(
            F.concat(found, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    return F.when(spans.isNotNull(), F.aggregate(spans, empty, add))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.lit(0).cast("long").alias("row"), "doc_id", "text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    number = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return scan_secrets(docs).select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(_named(base), 256).alias("base_sha256"), _named(spans).alias("spans"))
