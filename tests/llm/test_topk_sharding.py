from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import zlib

from logbrook.llm import sharding, topk


def best(rows, top=5, every=50):
    """Brute force over usable vectors (vec_id, list)."""
    usable = [(i, [int(np.floor(np.float64(x) * 256)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    asked = {}
    for i, q in sorted(usable):
        if i % every == 0:
            asked.setdefault(i, q)
    for i, q in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))
        out |= {(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:top], 1)}
    return out


def found(spark, rows, block_rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    vectors = topk.usable(df, "vec_id", "embedding")
    hits = topk.search(topk.build_index(vectors, block_rows), vectors.filter("vec_id % 50 = 0"))
    return [tuple(r) for r in hits.collect()]


def test_search_as_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 7)]) for i in range(260)]
    rows += [(i, [0.5] * 7) for i in range(300, 340)]  # ties and equal vectors
    rows += [(400, None), (401, [None] * 7), (450, [float("nan")] * 7), (500, [float("inf")] + [0.0] * 6), (None, [0.1] * 7)]
    rows += [(550, []), (551, []), (600, [1.0, 2.0]), (601, [-3.0, 100.0]), (602, [0.0, 0.0])]
    for block_rows in (64, 1000):
        got = found(spark, rows, block_rows)
        assert len(got) == len(set(got)) and set(got) == best(rows)


def test_no_vectors(spark):
    assert found(spark, [(1, None)], 64) == []


def test_bitmap_sums():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 512, (130, 9)).astype(np.uint64)
    weights = rng.integers(-300, 300, 9)
    total, constant = topk.weighted_sum(topk.slices_of(values, 9), weights)
    want = values.astype(np.int64) @ weights
    assert [s + constant for s in topk.sums_at(total, np.arange(130))] == want.tolist()


def test_hard_rows_fall_into_even_shards(hard, none):
    thin = hard.select("doc_id", "text", "source")
    got = sharding.interleave(thin, "source", "doc_id").collect()
    assert sorted(map(str, ((r["doc_id"], r["text"], r["source"]) for r in got))) == sorted(str(tuple(r)) for r in thin.collect())
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    in_all = Counter(r["source"] for r in got)
    for shard, n in Counter((r["shard"], r["source"]) for r in got).items():
        assert abs(n - Fraction(in_all[shard[1]], 8)) <= 2
    assert sharding.interleave(none, "source", "doc_id").count() == 0


def test_query_sizes_and_checksums(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = sharding.op3_sharding(spark, sf_dir).collect()
    again = sharding.op3_sharding(spark, sf_dir).collect()
    assert set(map(tuple, got)) == set(map(tuple, again))
    want = sorted((d["doc_id"], len(d["text"].encode()) + 1, zlib.crc32(d["text"].encode())) for d in docs)
    assert sorted((g["doc_id"], g["size"], g["text_crc32"]) for g in got) == want
    assert {g["law"] for g in got} == {"rows"} and {g["grown_shard"] for g in got} == {None}


def test_written_shards_come_back(spark, hard, tmp_path):
    rows = sharding.interleave(hard, "source", "doc_id")
    sharding.write_shards(rows, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == hard.count() and set(back.columns) == {*hard.columns, "shard", "slot"}
