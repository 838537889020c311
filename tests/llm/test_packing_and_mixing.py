"""Packing round trips, and the mix's distance from its target."""

import random
import zlib
from fractions import Fraction
from math import ceil, floor

import numpy as np
import pytest
from tokenizers import Tokenizer

from logloom.llm import mixing, packing
from logloom.session import ship_package

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def test_encoder_equals_the_tokenizer():
    path = packing._tokenizer_path(None)
    encoder, tokenizer = packing._Encoder(path), Tokenizer.from_file(path)
    odd = ["a  b", " x y ", "\n a\nb \n", "tab\t x", "<|endoftext|> hi<|endoftext|> x", "don't  'll we'll. it's!", "", "x　 y",
           "1 2  3\r\n 4 ", "é è\n\nü", " ", "\x1c a \x1d b", "end... of?! it's", "word\u00a0nb sp", "a,b. c,d."]
    pick = random.Random(1)
    odd += ["".join(pick.choice("ab C.,'!? \n\t1é") for _ in range(60)) for _ in range(300)]
    for text in odd * 2:  # the second time from the cache
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode(text) == want, repr(text)


def check_sequences(rows, capacity=2048):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_query_round_trip(spark):
    rows = packing.op5_best_fit_packing(spark, SMALL).collect()
    tokenizer = Tokenizer.from_file(packing._tokenizer_path(None))
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(pieces) == len(docs)
    for doc in docs:
        ids = np.array([*tokenizer.encode(doc.text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for i, r in enumerate(sorted(pieces[doc.doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used, least = check_sequences(rows), -(-sum(r.length for r in rows) // 2048)
    assert used <= 1.03 * least + 2


def test_packing_of_lengths(spark):
    pick = random.Random(2)
    lengths = [pick.choice([1, 2, 3, 100, 255, 256, 257, 700, 1024, 1025, 2047, 2048, pick.randrange(1, 2049)]) for _ in range(600)]
    frame = spark.createDataFrame([(i % 7, i, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECE)
    rows = packing.pack(frame).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    # no worse than first fit, longest first
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= n), None)
        if at is None:
            rooms.append(2048 - n)
        else:
            rooms[at] -= n
    assert check_sequences(rows) <= 1.05 * len(rooms) + 1


def test_packing_edge_rows(spark):
    frame = spark.createDataFrame([(None, None, 1), (1, "", 1), (2, "a", 1), (2, "a", 1), (3, "word " * 9000, 1)], "doc_id long, text string, rank int")
    rows = packing.pack_documents(frame).collect()
    check_sequences(rows)
    assert sorted(r.length for r in rows if r.doc_id != 3) == [1, 1, 2, 2]
    assert packing.pack_documents(frame.limit(0)).count() == 0


def test_weights_left_out_or_zero_come_last(spark):
    rows = [(i, ["a", "b", "c", None, "ll"][i % 5]) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")

    def sources(weights):
        return [r.source for r in mixing.mix(docs, weights, block=1).orderBy("position").collect()]

    found = sources({"a": 3.0, "b": 1.0, "c": 0})
    assert len(found) == 500 and set(found[:133]) == {"a", "b"} and 98 <= found[:133].count("a") <= 100
    assert set(found[:200]) == {"a", "b"} and set(found[200:]) == {"c", None, "ll"}
    found = sources({"ll": 59.0, None: 1.0})
    assert found[:60].count("ll") in (58, 59, 60) and set(found[:60]) <= {"ll", None}
    assert sorted(map(str, sources({}))) == sorted(str(s) for _, s in rows)
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": -1.0})


def plain_schedule(blocks, weights):
    """(source, block) of every slot: each slot looks at all sources for the released block with the earliest deadline."""
    order, done = [], dict.fromkeys(blocks, 0)
    while left := [s for s in blocks if done[s] < blocks[s]]:
        share = {s: Fraction(weights[s]) / sum(Fraction(weights[x]) for x in left) for s in left}
        placed, t = dict.fromkeys(left, 0), 0
        while all(done[s] < blocks[s] for s in left):
            ready = [(ceil((placed[s] + 1) / share[s]), s) for s in left if floor(placed[s] / share[s]) <= t]
            s = min(ready)[1]
            order.append((s, done[s]))
            placed[s] += 1
            done[s] += 1
            t += 1
    return order


@pytest.mark.parametrize("folder,given", [
    (SMALL, None), ("/root/testdata/sf0.01", None), ("/root/testdata/sf0.01", {f"src{i}": 0.3 + i * i / 7 for i in range(20)})])
def test_mix_equals_a_plain_schedule(spark, folder, given):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source")
    got = (mixing.op10_mixing(spark, folder) if given is None else mixing.mix(docs, given, period=50)).orderBy("position").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    held = {}
    for r in got:
        held.setdefault("null" if r.source is None else "s:" + r.source, []).append((r.slot, r.position))
    size = mixing.BLOCK
    blocks = {s: -(-len(x) // size) for s, x in held.items()}
    order = plain_schedule(blocks, {s: len(x) ** 0.5 if given is None else given[s[2:]] for s, x in held.items()})
    want = {s: [] for s in held}
    for t, (s, i) in enumerate(order):
        want[s] += [(t, t * size + k) for k in range(min(size, len(held[s]) - i * size))]
    assert want == held


def test_mix_keeps_all_rows_in_every_phase(spark):
    rows = [(i, "s%d" % (0 if i % 3 else i % 11), "x") for i in range(900)] + [(5, None, "x"), (5, None, "x"), (None, "s1", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, slot string")
    mixed = mixing.mix(frame, {"s0": 1.0, "s1": 3.0}, block=2, period=100).orderBy("position").collect()
    assert len(mixed) == len(rows) and len({r.position for r in mixed}) == len(rows)
    blocks = {r.slot: r.source for r in mixed}
    assert sorted(blocks) == list(range(len(blocks)))
    assert mixing.mix(frame.limit(0)).count() == 0


def test_packing_follows_the_written_order(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, "s%d" % (i % 3), "word " * (300 + 400 * (i % 4))) for i in range(240)], "doc_id long, source string, text string")

    def packed(weights):
        held = packing.common.cut(mixing.mix(docs, weights).repartitionByRange(4, "position").sortWithinPartitions("position").select(*docs.columns))
        assert len(held.inputFiles()) > 1
        rows = corpus_pipeline.packing_stage(spark, held, SMALL).collect()
        check_sequences(rows)
        return rows

    weights = {"s0": 6.0, "s1": 1.0, "s2": 1.0}
    rows, other = packed(weights), packed({"s0": 1.0, "s1": 1.0, "s2": 6.0})
    assert sorted(r[:5] for r in rows) == sorted(r[:5] for r in other)
    assert {(r.doc_id, r.sequence_id) for r in rows} != {(r.doc_id, r.sequence_id) for r in other}
    places = {r.doc_id: r.position for r in mixing.mix(docs, weights).collect()}
    heads = [places[r.doc_id] for r in sorted(rows, key=lambda r: r.sequence_id) if r.offset == 0]
    assert heads == sorted(heads)
    assert sorted({r.sequence_id for r in rows}) == list(range(len(heads)))
    early = [r.doc_id % 3 for r in rows if r.sequence_id < len(heads) // 3]
    assert early.count(0) > len(early) / 2


def test_written_order_is_read_back(spark, tmp_path):
    frame = spark.range(1000)
    frame.orderBy("id").write.option("maxRecordsPerFile", 70).parquet(str(tmp_path / "t"))
    rows = packing.common.in_written_order(spark.read.parquet(str(tmp_path / "t")), "place").collect()
    assert len(rows) == 1000 and all(r.id == r.place for r in rows)
    assert packing.common._written("a/part-100000-x-c000.parquet") > packing.common._written("a/part-20000-x-c000.parquet")


def test_many_periods_stay_within_one_block_of_the_real_weights():
    weights = {"hot": 186.7, "rare": 0.31, **{f"s{i}": 42.8 + i / 7 for i in range(19)}}
    total, n = sum(weights.values()), 30_000
    plan, states = mixing.phases({s: int(w / total * n) + 1 for s, w in weights.items()}, weights, 100)
    share, base, _ = plan[0]
    assert base == 0
    seen = {s: 0 for s in weights}
    slot = 0
    for phase, start, slots, following in states:
        if phase:
            break
        assert start == slot and following == seen  # a task begins where the one before ends
        for (t, s, i), _ in zip(mixing.turns(share, start, following), range(slots)):
            assert i == seen[s]
            seen[s] += 1
            slot = t + 1
            if slot % 37 == 0:
                assert all(abs(seen[x] - slot * w / total) < 1 for x, w in weights.items())
    assert slot > 29_000 and len(states) > 200
