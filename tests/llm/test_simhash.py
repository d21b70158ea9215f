import random
from itertools import combinations

import numpy as np
from xxhash import xxh64_intdigest

from logbrook.llm import simhash


def slow_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(prints):
    """Smallest linked print of each distinct print, over all pairs."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 4:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {p: root(p) for p in prints}


def expected(rows):
    prints = [slow_print(r[1]) for r in rows]
    linked = classes(prints)
    smallest = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            smallest[linked[p]] = min(smallest.get(linked[p], r[0]), r[0])
    return sorted(((r[0], f"{p:016x}", smallest.get(linked[p])) for r, p in zip(rows, prints)), key=str)


def test_query_as_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = simhash.op4_simhash_near_dedup(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_hard_rows(hard, none):
    rows = [tuple(r) for r in hard.collect()]
    got = [(r["doc_id"], f"{r['simhash'] & (1 << 64) - 1:016x}", r["component"]) for r in simhash.near_duplicates(hard).collect()]
    assert sorted(got, key=str) == expected(rows)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_one_row_of_each_component_stays(hard):
    rows = [tuple(r) for r in hard.collect()]
    kept = [tuple(r) for r in simhash.keep_one(hard).collect()]
    linked = classes([slow_print(r[1]) for r in rows])
    groups = [linked[slow_print(r[1])] for r in kept]
    assert len(groups) == len(set(groups)) == len(set(linked.values()))
    assert set(kept) <= set(rows)


def test_dense_and_cut_groups_lose_no_link(spark):
    rng = random.Random(9)
    center = rng.getrandbits(64)
    prints = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(9))) for _ in range(400)}
    prints |= {rng.getrandbits(64) for _ in range(300)}
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "u long")
    want = classes(prints)
    for rows in (4096, 40):
        found = simhash.components(simhash.links(df, group_rows=rows))
        root = {r["node"] & (1 << 64) - 1: r["root"] for r in found.collect()}
        got = {p: root.get(p, p if p < 1 << 63 else p - (1 << 64)) for p in prints}
        pairs = {(want[p], got[p]) for p in prints}
        assert len(pairs) == len(set(want.values())) == len({b for _, b in pairs})


def test_manhattan_distance_is_a_lower_bound():
    rng = random.Random(1)
    for _ in range(200):
        a, b = rng.getrandbits(64), rng.getrandbits(64)
        counts = [[(x >> s & 3).bit_count() for s in range(0, 64, 2)] for x in (a, b)]
        even = simhash._EVEN
        code = [((x | x >> 1) & even) | ((x & x >> 1 & even) << 1) for x in (a, b)]
        distance = sum(abs(p - q) for p, q in zip(*counts))
        assert (code[0] ^ code[1]).bit_count() == distance <= (a ^ b).bit_count()
