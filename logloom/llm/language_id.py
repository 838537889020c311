"""Language identification by compression: the language whose dictionary shortens a text most.

Each language has a raw-content zstandard dictionary of passages of its labelled texts. A text
is reduced to its lower-case letters with single spaces, encoded whole with each dictionary,
and belongs to the language of the smallest encoding. Only equal sizes (texts too short to
match anything) are settled by the languages' shares of the labelled rows, then by name.
The score is the winner's share of share * 2^(-BITS_PER_BYTE * extra bytes); a text is
rejected where the second smallest encoding is less than MARGIN larger than the smallest.

Labels are learned from a bounded sample: of each language the SAMPLE different texts with
the smallest hashes (copies of a text count once), and of each of them one passage of at most
PASSAGE characters at a place given by the hash. With many languages the dictionaries get
shorter, so that all together stay below TOTAL_BYTES; every prediction reads its whole text.

Edge cases: null texts and texts without a letter are `und` with score 0, rejected; without
any labelled text everything is `und`; rows without a label are not learned from but judged;
very long texts are encoded whole, in one piece; repeated rows are judged each; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

#: Different texts sampled of each language, and most characters taken of each.
SAMPLE, PASSAGE = 256, 500
#: Bytes of a language's dictionary, and of all dictionaries together.
DICTIONARY_BYTES, TOTAL_BYTES = 1 << 16, 1 << 25
#: Rows of sampled hashes that are broadcast at most.
BROADCAST_ROWS = 1 << 20
#: Compression level.
LEVEL = 12
#: Least share by which the second smallest encoding must be larger.
MARGIN = 0.01
#: How many bits of evidence a byte counts for in the score.
BITS_PER_BYTE = 2
#: The answer for texts without letters.
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_WORDS = regex.compile(r"[\p{L}\p{M}]+")


def _letters(text: str | None) -> bytes:
    """The words of a text in lower case, or nothing if it has no letter."""
    return (" ".join(_WORDS.findall(text.lower())) + " ").encode() if text and _LETTER.search(text) else b""


# ---------------------------------------------------------------------------------------
# Learning


def learn(documents: DataFrame, learned: Column | None = None) -> dict[str, tuple[float, bytes]]:
    """(share of the labelled rows, dictionary) of each language, from rows (text, lang) where `learned` holds."""
    rows = documents if learned is None else documents.where(learned)
    rows = rows.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("hash"))
    texts = common.cut(rows.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("rows")))
    smallest = texts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).where(F.col("rank") <= SAMPLE)
    counts = {r[0]: r[1] for r in texts.groupBy("lang").agg(F.sum("rows")).collect()}
    if not counts:
        return {}
    sampled = smallest.select("lang", "hash")
    if len(counts) * SAMPLE <= BROADCAST_ROWS:  # at most SAMPLE rows a language
        sampled = F.broadcast(sampled)
    place = F.pmod(F.xxhash64("hash"), F.greatest(F.length("text") - PASSAGE, F.lit(0)) + 1)
    passages = (
        rows.join(sampled, ["lang", "hash"])
        .groupBy("lang", "hash").agg(F.min(F.col("text").substr(place.cast("int") + 1, F.lit(PASSAGE))).alias("passage"))
    )
    size = min(DICTIONARY_BYTES, TOTAL_BYTES // len(counts))
    found: dict[str, list[bytes]] = {lang: [] for lang in counts}
    for lang, _, passage in sorted(passages.collect()):
        found[lang].append(_letters(passage))
    whole = sum(counts.values())
    return {lang: (counts[lang] / whole, b"".join(found[lang])[:size]) for lang in sorted(counts)}


# ---------------------------------------------------------------------------------------
# Judging


def classifier(languages: dict[str, tuple[float, bytes]]) -> Callable[[str | None], tuple[str, float, float]]:
    """A function from a text to (language, score, margin)."""
    plain = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)

    def encoder(content: bytes) -> zstandard.ZstdCompressor:
        if len(content) < 8:  # too short to be a dictionary
            return zstandard.ZstdCompressor(compression_params=plain)
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=data, compression_params=plain)

    known = [(lang, share, encoder(content)) for lang, (share, content) in languages.items()]

    def judge(text: str | None) -> tuple[str, float, float]:
        letters = _letters(text)
        if not letters or not known:
            return UNDETERMINED, 0.0, 0.0
        sizes = sorted((len(encode.compress(letters)), -share, lang) for lang, share, encode in known)
        least, share, lang = sizes[0]
        margin = (sizes[1][0] - least) / least if len(sizes) > 1 else 1.0
        weights = sum(-s * 2.0 ** (BITS_PER_BYTE * max(least - size, -500)) for size, s, _ in sizes)
        return lang, min(1.0, -share / weights), margin

    return judge


def predict(documents: DataFrame, languages: dict[str, tuple[float, bytes]], margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) for every row of documents (doc_id, text)."""

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = classifier(languages)
        for batch in batches:
            found = [judge(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64()),
                "margin": pa.array([f[2] for f in found], pa.float64()),
                "rejected": pa.array([f[2] < margin or f[0] == UNDETERMINED for f in found], pa.bool_()),
            })

    rows = common.with_columns_of(documents, ["doc_id", "text"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judged, f"doc_id {kind}, lang_pred string, score double, margin double, rejected boolean")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning; a null id counts as an empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(documents, learn(documents, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")
