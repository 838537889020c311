"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its sentences and lines; its digests are their distinct hashes. A
sketch has cells in three tables; each digest goes to one cell a table, which holds the number
of its digests and the exclusive-or of their hashes and of their checks. Subtracting two
versions' sketches cancels what they share. A cell that holds one digest (its check tells)
gives that digest away; taking it out of its other cells peels the next, until the cells are
empty.

The fingerprint is a version's sketch as text, with nothing left out. Digests are dealt to its 2^b
parts by b bits of a hash, at most `LOAD` a part on average, so cost grows with the length of a text,
not with its square. Parts whose bits agree but for the highest add up, so a longer sketch folds to a
shorter one and any two can be subtracted. `likeness_of_fingerprints` does so for stored texts.

A fingerprint has room for the differences of an edited version. A part that does not peel is
dealt to `AGAIN` larger sketches of both versions' digests, then to larger ones with another seed; what
the largest cannot peel is compared digest by digest. The likeness of two texts is
(shared digests) / (all digests), from the sizes and the peeled differences; 1 if both texts have no
paragraph.

Only built-in functions are used. Documents are dealt to ranges of ids (at most `RANGES`, from
quantiles), so that "the next document" is one shuffle of the texts and a lead inside a range;
the first document of each range is also sent to the range before, a bounded list. All else
happens inside the row, and the next document's sketch is its own, read by the same lead.

Edge cases: a null text is empty; equal texts have equal fingerprints; rows that repeat a
doc_id follow each other in the order of their texts; a null doc_id comes after all others; one document is its
own next; extra columns are ignored, whatever their names; a very long text has more parts, not larger ones;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Documents of an id range, and ranges at most.
IN_RANGE, RANGES = 512, 65_536
#: Digests of a version in a part on average at most, and cells of a part in each table.
LOAD, CELLS = 16, 8
#: Sketches a failed part is dealt to; their cells a table for each digest, the factor of each further try, tries.
AGAIN, SPACE, LARGER, TRIES = 4, 0.6, 4, 2
#: Peeling rounds; a sketch that needs more has failed.
ROUNDS = 10
PARAGRAPH_END = r"\n+|(?<=[.!?])\s+"


def digests(text: Column) -> Column:
    """Distinct hashes of a text's paragraphs."""
    parts = F.filter(F.split(F.trim(text), PARAGRAPH_END), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _let(value: Column, use) -> Column:
    """use(value) with the value computed once, not once for each use inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hash(digest: Column, seed: int) -> Column:
    return F.xxhash64(digest, F.lit(seed))


def _check(digest: Column, seed: int) -> Column:
    return _hash(digest, seed + 7).bitwiseAND(F.lit(0xFFFFFFFF))


# ---------------------------------------------------------------------------------------
# Sketches, as columns


def _placed(found: Column, width: Column, seed: int) -> Column:
    """Digests with their check and their cell in each of the three tables."""
    def place(d):
        cells = [(F.pmod(_hash(d, seed + t), width) + width * t).cast("int").alias(f"p{t}") for t in range(3)]
        return F.struct(d.alias("key"), _check(d, seed).alias("check"), *cells)

    return F.transform(found, place)


def _hits(cell: Column, digest: Column) -> Column:
    return (digest["p0"] == cell) | (digest["p1"] == cell) | (digest["p2"] == cell)


def _sketch(placed: Column, width: Column) -> Column:
    """Cells 0 .. 3 * width - 1 of (cell, n, key, check)."""
    def cell(i):
        empty = F.struct(i.cast("int").alias("cell"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"),
                         F.lit(0).cast("long").alias("check"))
        return F.aggregate(placed, empty, lambda c, d: F.when(_hits(c["cell"], d), F.struct(
            c["cell"].alias("cell"), (c["n"] + 1).alias("n"), c["key"].bitwiseXOR(d["key"]).alias("key"),
            c["check"].bitwiseXOR(d["check"]).alias("check"))).otherwise(c))

    return F.transform(F.sequence(F.lit(0).cast("long"), width * 3 - 1), cell)


def _used(cells: Column) -> Column:
    return F.filter(cells, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))


def _subtracted(one: Column, two: Column) -> Column:
    return _used(F.zip_with(one, two, lambda a, b: F.struct(
        a["cell"].alias("cell"), (a["n"] - b["n"]).alias("n"), a["key"].bitwiseXOR(b["key"]).alias("key"),
        a["check"].bitwiseXOR(b["check"]).alias("check"))))


def _peeled(cells: Column, width: Column, seed: int) -> Column:
    """(cells left, digests recovered) after ROUNDS rounds."""
    def round_(state, _):
        left = state["cells"]
        pure = F.filter(left, lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"], seed)))
        single = F.array_distinct(F.transform(pure, lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key"), c["check"].alias("check"))))
        known = F.transform(single, lambda s: F.struct(
            s["n"].alias("n"), s["key"].alias("key"), s["check"].alias("check"),
            *[(F.pmod(_hash(s["key"], seed + t), width) + width * t).cast("int").alias(f"p{t}") for t in range(3)]))

        def without(known):
            rest = F.transform(left, lambda c: F.aggregate(known, c, lambda x, s: F.when(_hits(x["cell"], s), F.struct(
                x["cell"].alias("cell"), (x["n"] - s["n"]).alias("n"), x["key"].bitwiseXOR(s["key"]).alias("key"),
                x["check"].bitwiseXOR(s["check"]).alias("check"))).otherwise(x)))
            return F.struct(_used(rest).alias("cells"), (state["found"] + F.size(known)).alias("found"))

        return F.when(F.size(left) == 0, state).otherwise(_let(known, without))

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_)


def _left(cells: Column, width: Column, seed: int) -> Column:
    """The number of digests that a subtracted sketch gives away, or null where it does not peel."""
    return _let(_peeled(cells, width, seed), lambda end: F.when(F.size(end["cells"]) == 0, end["found"]))


# ---------------------------------------------------------------------------------------
# Fingerprints: sketches in parts


def version(found: Column) -> Column:
    """(n, bits, parts): the sketch of an array of digests; a part has its cells and its digests."""
    n = F.size(found)
    bits = F.when(n > LOAD, F.length(F.bin(F.floor((n - 1) / LOAD)))).otherwise(0)
    dealt = F.transform(found, lambda d: F.struct(d.alias("key"), _hash(d, 5).alias("spread")))

    def halves(groups, level):
        half = lambda bit: F.transform(groups, lambda g: F.filter(g, lambda d: F.getbit(d["spread"], level) == bit))
        return F.concat(half(0), half(1))

    levels = F.transform(F.array_repeat(F.lit(0), bits), lambda _, i: i)
    groups = F.aggregate(levels, F.array(dealt), halves)
    width = F.lit(CELLS).cast("long")

    def part(group):
        keys = F.transform(group, lambda d: d["key"])
        return F.struct(_let(_placed(keys, width, 0), lambda placed: _sketch(placed, width)).alias("cells"), keys.alias("keys"))

    return F.struct(n.alias("n"), bits.alias("bits"), F.transform(groups, part).alias("parts"))


def as_text(sketch: Column) -> Column:
    """A version's sketch as text: digests, then parts by semicolons and cells by commas, empty where nothing is held."""
    def cell(c):
        held = F.concat(F.hex(c["n"]), F.lpad(F.hex(c["key"]), 16, "0"), F.lpad(F.hex(c["check"]), 8, "0"))
        return F.when((c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0), "").otherwise(F.lower(held))

    parts = F.transform(sketch["parts"], lambda p: F.array_join(F.transform(p["cells"], cell), ","))
    return F.concat(sketch["n"].cast("string"), F.lit(":"), F.array_join(parts, ";"))


def from_text(fingerprint: Column) -> Column:
    """The sketch that `as_text` wrote, without digests."""
    number = lambda digits: F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0).cast("long"))

    def cell(c, i):
        first = F.length(c) - 24
        high, low = (number(F.substr(c, first + at, F.lit(8))) for at in (1, 9))
        return F.when(c == "", F.struct(i.cast("int").alias("cell"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"),
                                        F.lit(0).cast("long").alias("check"))).otherwise(F.struct(
            i.cast("int").alias("cell"), number(F.substr(c, F.lit(1), first)).cast("int").alias("n"),
            F.shiftleft(high, 32).bitwiseOR(low).alias("key"), number(F.substr(c, first + 17, F.lit(8))).alias("check")))

    held = F.split(F.split_part(fingerprint, F.lit(":"), F.lit(2)), ";")
    parts = F.transform(held, lambda p: F.struct(F.transform(F.split(p, ","), cell).alias("cells"), F.array().cast("array<bigint>").alias("keys")))
    return F.struct(F.split_part(fingerprint, F.lit(":"), F.lit(1)).cast("int").alias("n"),
                    (F.length(F.bin(F.size(held).cast("long"))) - 1).alias("bits"), parts.alias("parts"))


def _folded(parts: Column, times: Column) -> Column:
    """Parts added up to half their number, as many times."""
    def add(x, y):
        return F.struct(F.zip_with(x["cells"], y["cells"], lambda a, b: F.struct(
            a["cell"].alias("cell"), (a["n"] + b["n"]).alias("n"), a["key"].bitwiseXOR(b["key"]).alias("key"),
            a["check"].bitwiseXOR(b["check"]).alias("check"))).alias("cells"), F.concat(x["keys"], y["keys"]).alias("keys"))

    def fold(held, _):
        half = F.shiftright(F.size(held), 1)
        return F.zip_with(F.slice(held, F.lit(1), half), F.slice(held, half + 1, half), add)

    return F.aggregate(F.array_repeat(F.lit(0), times), parts, fold)


def _peeled_again(one: Column, two: Column) -> Column:
    """The differing digests of a part whose cells did not peel, from larger sketches."""
    def dealt(keys, k):
        return F.filter(keys, lambda d: F.pmod(_hash(d, 6), F.lit(AGAIN)) == k)

    def attempt(side, number):
        seed = 1000 * (number + 1)
        load = F.size(side["one"]) + F.size(side["two"])

        def peel(width):
            sketch = lambda keys: _let(_placed(keys, width, seed), lambda placed: _sketch(placed, width))
            return _let(_subtracted(sketch(side["one"]), sketch(side["two"])), lambda left: _left(left, width, seed))

        return _let(F.greatest(F.lit(4), F.ceil(load * SPACE * LARGER**number)).cast("long"), peel)

    def found(side):
        # Digests that no try could peel are compared themselves, so that the likeness is exact.
        unpeeled = F.size(F.array_except(side["one"], side["two"])) + F.size(F.array_except(side["two"], side["one"]))
        return F.coalesce(*[attempt(side, k) for k in range(TRIES)], unpeeled)

    return F.aggregate(F.sequence(F.lit(0), F.lit(AGAIN - 1)), F.lit(0), lambda total, k: total + _let(
        F.struct(dealt(one, k).alias("one"), dealt(two, k).alias("two")), found))


def difference(one: Column, two: Column, again: bool = True) -> Column:
    """The number of digests that only one version has; without `again` null where the sketches alone do not tell."""
    def of_part(x, y):
        width = F.lit(CELLS).cast("long")
        first = _let(_subtracted(x["cells"], y["cells"]), lambda left: _left(left, width, 0))
        return F.coalesce(first, _peeled_again(x["keys"], y["keys"])) if again else first

    bits = F.least(one["bits"], two["bits"])
    parts = F.zip_with(_folded(one["parts"], one["bits"] - bits), _folded(two["parts"], two["bits"] - bits), of_part)
    return F.aggregate(parts, F.lit(0).cast("long"), lambda total, d: total + d)


def _near(one: Column, two: Column, again: bool = True) -> Column:
    size = one["n"] + two["n"]
    return _let(difference(one, two, again), lambda d: F.when(size == 0, 1.0).otherwise((size - d) / (size + d)))


def likeness_of_fingerprints(one: Column, two: Column) -> Column:
    """The likeness of two fingerprints as text alone, null where their differences do not peel."""
    sides = F.struct(from_text(one).alias("one"), from_text(two).alias("two"))
    return _let(sides, lambda s: _near(s["one"], s["two"], again=False))


def likeness(frame: DataFrame, keys: list[str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """keys and one likeness column for each named pair of digest columns; nothing is shuffled."""
    near = [_let(F.struct(version(F.col(a)).alias("one"), version(F.col(b)).alias("two")),
                 lambda s: _near(s["one"], s["two"])).alias(name) for name, (a, b) in pairs.items()]
    return frame.select(*keys, *near)


# ---------------------------------------------------------------------------------------
# Documents and their next ones


def sketch_of(text: str) -> Column:
    return _let(digests(F.col(text)), version)


def with_next(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) with next_text, and the sketches `own` and `next` of both."""
    spark = docs.sparkSession
    lowest = -(1 << 63)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.withColumn("_key", F.coalesce("doc_id", F.lit(lowest)))
    count = keyed.count()
    ranges = max(1, min(RANGES, count // IN_RANGE))
    shares = [(i + 1) / ranges for i in range(ranges - 1)]
    bounds = keyed.agg(F.percentile_approx("_key", shares, 100_000)).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    if bounds:
        steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
        table = F.array(*[F.lit(b).cast("long") for b in bounds])
        # Binary search: the number of bounds that are not above the key.
        found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
            F.when(at + step <= len(bounds), F.element_at(table, F.least(at + step, F.lit(len(bounds)))) <= F.col("_key")).otherwise(False),
            at + step).otherwise(at))
    else:
        found = F.lit(0)
    dealt = keyed.withColumn("range", found)
    # One row a range, at most RANGES: the range before each one (the last for the first) borrows its first row.
    line = Window.orderBy("range")
    heads = dealt.groupBy("range").agg(F.max("_key").alias("_key"))
    extra = heads.select("_key", F.coalesce(F.lead("range").over(line), F.min("range").over(Window.partitionBy())).alias("range"))
    lent = keyed.join(F.broadcast(extra), "_key").select("doc_id", "text", "_key", "range", F.lit(1).alias("_lent"))
    both = dealt.select("doc_id", "text", "_key", "range", F.lit(0).alias("_lent")).unionByName(lent)
    order = Window.partitionBy("range").orderBy("_lent", F.desc("_key"), "text")
    return (
        both.withColumn("next_text", F.lead("text").over(order)).withColumn("own", sketch_of("text"))
        .withColumn("next", F.lead("own").over(order)).where("_lent = 0").select("doc_id", "text", "next_text", "own", "next")
    )


def edited_text() -> Column:
    """The text with its last third replaced by as much of the next text's beginning."""
    third = F.floor(F.length("text") / 3).cast("int")
    return F.concat(F.substring("text", 1, F.length("text") - third), F.substring("next_text", F.lit(1), third))


def fingerprints(docs: DataFrame) -> DataFrame:
    rows = with_next(docs).withColumn("edited", edited_text()).withColumn("edit", sketch_of("edited"))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edit")).alias("edited_fingerprint"),
        _near(F.col("own"), F.col("edit")).alias("near_edited"), _near(F.col("own"), F.col("next")).alias("near_next"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
