"""Packing against one-by-one best fit, ids against the tokenizer, and resharding against its laws."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm.packing import RunIds, best_fit_decreasing, pack
from rankloom.llm.queries import QUERIES, word_tokenizer
from rankloom.llm.resharding import equal_capacities, min_cost_flow, reshard, rewrite_affected

ODD = [
    "it's we'll €$ a€$b naïve—x 12ab <|endoftext|> ×÷ a×b İstanbul ΣΑΣ é \x1cab\x1c a\x00b ≮ x", None, "", "   ",
    "x" * 5000, "Ü,é.È×a ÷é áb ́ Å,x", "The THE the!! a.b,c 'twas don't", "é" * 10, "a b a b",
]


def ids_of(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def one_by_one(lengths, capacity):
    """Bins' fill after best-fit decreasing, placing one after another."""
    bins = []
    for n in sorted(lengths, reverse=True):
        rooms = [(capacity - b, i) for i, b in enumerate(bins) if capacity - b >= n]
        if rooms:
            bins[min(rooms)[1]] += n
        else:
            bins.append(n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(12))
def test_runs_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 50, 2048])
    lengths = [rng.randint(1, capacity) for _ in range(rng.choice([1, 40, 400]))] + [1] * (seed % 3) * 5
    bins, places = defaultdict(int), defaultdict(list)
    for r in best_fit_decreasing(dict(Counter(lengths)), capacity):
        for k in range(r.count):
            b, i = divmod(k, r.per_bin)
            bins[r.bin + b] += r.length
            places[r.bin + b].append((r.offset + i * r.length, r.length))
    assert sorted(bins.values()) == one_by_one(lengths, capacity)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity


def test_ids_are_the_tokenizers():
    import pyarrow as pa

    got = [x.tolist() for x in RunIds(word_tokenizer()).of(pa.array(ODD, pa.string()))]
    assert got == [ids_of(t) for t in ODD]


def test_ids_of_words_with_combining_marks():
    """The tokenizer composes before it lower-cases: an upper-case letter and a mark may stay apart where lower-case ones join."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    rng = random.Random(5)
    marks = "\u0308\u0331\u030a\u030c\u0301\u0327\u0323\u0345"
    texts = ["T\u0308", "W\u0308 w\u0308", "J\u030c", "H\u0331 W\u030a Y\u030a", "A T\u0308A'S T", "\u0308T", "T \u0308", "T\n\u0308T", "Ü\u0304"]
    texts += ["".join(rng.choice("TWJHYAtwjhyaÜü' .1" + marks) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    plain = Tokenizer.from_file(word_tokenizer())
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in RunIds(word_tokenizer(), added=True).of(pa.array(texts))] == want


MARKED = ["ab <|endoftext|> cd", "ab<|EndOfText|>cd", "<|startoftext|>", "x <|endoftext|", "<|endoftext|><|endoftext|> it's", "a b", None, ""]


def test_added_tokens_are_the_unmodified_tokenizers(spark, tmp_path):
    import pyarrow as pa
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(word_tokenizer())
    texts = ODD + MARKED
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in RunIds(word_tokenizer(), added=True).of(pa.array(texts, pa.string()))] == want
    assert want[len(ODD)] == [3937, 49407, 4480] != ids_of(MARKED[0])
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["ids_crc32"] for r in QUERIES["op1_best_fit_packing"](spark, str(tmp_path)).collect()
           if r["length"] <= 2048 and r["piece"] == 0}
    crc = {i: zlib.crc32(np.array([*ids, 0], "<u4").tobytes()) for i, ids in enumerate(want) if len(ids) < 2048}
    assert {k: got[k] for k in crc} == crc


def test_pack(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("length", F.lit("x")).withColumn("piece", F.lit(1))
    got = pack(docs, word_tokenizer(), 32).collect()
    want = Counter()
    for key, text in rows:
        ids = ids_of(text) + [0]
        for piece, at in enumerate(range(0, len(ids), 32)):
            part = ids[at:at + 32]
            want[key, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 32
    assert len(by) == len(one_by_one([r["length"] for r in got], 32))


def test_pack_nothing(spark):
    assert pack(spark.createDataFrame([], "doc_id bigint, text string"), word_tokenizer()).collect() == []


def cheapest(supply, capacity):
    """Moved bytes at least: what does not fit at home."""
    return sum(n - min(n, capacity[i] if i < len(capacity) else 0) for i, n in enumerate(supply))


@pytest.mark.parametrize("seed", range(8))
def test_flow_moves_the_fewest_bytes(seed):
    rng = random.Random(seed)
    supply = [rng.randint(0, 50) for _ in range(rng.randint(1, 9))]
    capacity = equal_capacities(sum(supply), rng.randint(1, 7))
    flow = min_cost_flow(supply, capacity)
    for i, n in enumerate(supply):
        assert sum(v for (a, _), v in flow.items() if a == i) == n
    for j, n in enumerate(capacity):
        assert sum(v for (_, b), v in flow.items() if b == j) == n
    assert sum(v for (a, b), v in flow.items() if a != b) == cheapest(supply, capacity)


def test_flow_of_many_shards():
    """One pass over the shards; no more transfers than shards on both sides."""
    rng = np.random.default_rng(3)
    supply = rng.integers(0, 1000, 100_000).tolist()
    capacity = equal_capacities(sum(supply), 30_000)
    flow = min_cost_flow(supply, capacity)
    assert len(flow) <= len(supply) + 2 * len(capacity) and sum(flow.values()) == sum(supply)
    assert sum(v for (a, b), v in flow.items() if a == b) == sum(map(min, supply, capacity))


def test_flow_refuses_other_totals():
    with pytest.raises(ValueError):
        min_cost_flow([1], [2])


def test_reshard(spark, tmp_path):
    rows = [(i % 90 if i % 11 else None, "ä" * (i * 7 % 60) if i % 5 else None, "abc"[i % 3] if i % 7 else None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part string").withColumn("size", F.lit("x"))
    got = reshard(docs, F.col("part"), 5).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t, _ in rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(5))
    sizes = [sum(r["size"] for r in v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 6 * 136
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    assert all(r["moved"] == (r["old_shard"] != r["shard"]) for r in got)


def test_reshard_nothing(spark):
    assert reshard(spark.createDataFrame([], "doc_id bigint, text string"), F.lit("a"), 3).collect() == []


def test_rewrite_affected(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * (i % 9)) for i in range(60)], "doc_id bigint, text string")
    moves = reshard(docs, F.when(F.col("doc_id") < 40, "a").otherwise("b"), 2).cache()
    changed = {r["shard"] for r in rewrite_affected(docs, moves, str(tmp_path / "out")).collect()}
    back = spark.read.parquet(str(tmp_path / "out"))
    assert changed == {0, 1}
    assert {(r["doc_id"], r["_shard"]) for r in back.collect()} == {(r["doc_id"], r["shard"]) for r in moves.collect()}
    for wrong in (docs.unionAll(docs.limit(1)), docs.withColumn("_part", F.lit(1))):
        with pytest.raises(ValueError):
            rewrite_affected(wrong, moves, str(tmp_path / "none"))
