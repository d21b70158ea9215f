from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from logbrook.llm import mixing


def words(text):
    return (text or "").encode().split()


def level(sizes, total):
    """Targets by repeated sharing, as the contract words it."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    open_, left = set(order), total
    while open_ and left > 1e-9:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += share * weight[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def check(rows, got):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    target = level(sizes, 1.5 * sum(sizes.values()))
    taken = defaultdict(int)
    assert sorted(str((r[0], len(words(r[1])), r[3])) for r in rows) == sorted(str((g["doc_id"], g["size"], g["source"])) for g in got)
    for g in got:
        assert g["source_size"] == sizes[g["source"]] and g["target"] == pytest.approx(target[g["source"]])
        assert 0 <= g["taken"] <= 2 * g["size"]
        taken[g["source"]] += g["taken"]
    seats = {g["source"]: g["source_seats"] for g in got}
    for source, t in target.items():
        # Whole seats, the last one cut to the target; without a seat the target itself.
        whole = seats[source] * mixing.BLOCK_TOKENS
        assert taken[source] == min(max(round(t), whole - mixing.BLOCK_TOKENS), whole or mixing.BLOCK_TOKENS - 1, 2 * sizes[source])
        assert abs(taken[source] - t) <= mixing.BLOCK_TOKENS
    for g in got:
        parts = [tuple(map(int, part.split(":"))) for part in g["shards"].split(",") if part]
        assert parts == sorted(set(parts)) and sum(n for _, n in parts) == g["taken"]


def test_hard_rows(hard, none):
    check([tuple(r) for r in hard.collect()], mixing.mix_counts(hard).collect())
    assert mixing.mix_counts(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM read_parquet('{sf_dir}/documents.parquet')")
    want = con.execute(mixing.OP5_SQL)
    names = [d[0] for d in want.description]
    got = mixing.op5_mixing(spark, sf_dir).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)


def test_other_quotas_take_other_words(hard, monkeypatch):
    """The quotas decide: a source that is dealt half of its seats gives half of its words."""
    whole = mixing.mix_counts(hard, block_tokens=16).collect()
    dealt = mixing.dealt
    half = lambda sources, block, shard: dealt(sources, block, shard).filter("number <> 0 OR j % 2 = 0").withColumn(
        "j", F.when(F.col("number") == 0, F.expr("j div 2")).otherwise(F.col("j"))
    )
    monkeypatch.setattr(mixing, "dealt", half)
    halved = mixing.mix_counts(hard, block_tokens=16).collect()
    first = min(g["source"].encode() for g in whole if g["source"] is not None).decode()
    taken = [sum(g["taken"] for g in got if g["source"] == first) for got in (whole, halved)]
    assert 0 < abs(taken[1] - taken[0] / 2) + 1 <= 17
    others = [sorted((str(g["doc_id"]), g["taken"]) for g in got if g["source"] != first) for got in (whole, halved)]
    assert others[0] == others[1]


def test_clashing_columns(hard):
    names = ("epoch", "__row", "__spans", "__tie", "number", "block", "place", "spans", "size")
    clash = hard.withColumns({name: F.lit("x") for name in names})
    plain = sorted(map(str, (tuple(r) for r in mixing.mixed_documents(hard, block_tokens=16).collect())))
    mixed = mixing.mixed_documents(clash, block_tokens=16)
    assert set(names) < set(mixed.columns)
    assert sorted(map(str, (tuple(r) for r in mixed.select(*hard.columns, "shard").collect()))) == plain
    assert mixing.mix_counts(clash).count() == hard.count()


def test_shards_hold_the_mixture(hard):
    _, _, quotas = mixing.plan(hard, block_tokens=16)
    by_shard = defaultdict(dict)
    for q in quotas.collect():
        by_shard[q["shard"]][q["number"]] = q["seats"]
    total = sum(map(len, map(words, (r["text"] for r in hard.collect()))))
    assert abs(sum(sum(s.values()) for s in by_shard.values()) - 1.5 * total / 16) <= 1


def test_seats_by_highest_quotients(spark):
    sources = spark.createDataFrame([(0, 53.0), (1, 24.0), (2, 23.0)], "number long, target double")
    quotas = {}
    for q in mixing.seats(sources, block_tokens=10, shard_seats=4).collect():
        quotas.setdefault(q["shard"], {})[q["number"]] = q["seats"]
    bids = sorted((-t / (2 * j + 1), n) for n, t in ((0, 53.0), (1, 24.0), (2, 23.0)) for j in range(9))[:10]
    for shard in range(3):
        want = [n for _, n in bids[4 * shard : 4 * shard + 4]]
        assert quotas[shard] == {n: want.count(n) for n in set(want)}


def test_texts_hold_the_words_taken(hard):
    counts = defaultdict(int)
    for g in mixing.mix_counts(hard, block_tokens=16).collect():
        counts[g["doc_id"], g["source"]] += g["taken"]
    texts = defaultdict(list)
    for r in hard.collect():
        texts[r["doc_id"]].append(words(r["text"]))
    got = defaultdict(int)
    for r in mixing.mixed_documents(hard, block_tokens=16).collect():
        kept = words(r["text"])
        assert kept and r["n_chars"] == len(r["text"])
        whole = [iter(t) for t in texts[r["doc_id"]]]
        assert any(all(w in t for w in kept) for t in whole)  # in the order of the text
        got[r["doc_id"], r["source"]] += len(kept)
    assert got == {k: n for k, n in counts.items() if n}


def test_words_go_to_the_shards_of_their_seats(hard):
    rows, spans, quotas = mixing.plan(hard, block_tokens=16, shard_seats=40)
    number = {r["source"]: r["number"] for r in mixing.targets(rows.groupBy("source").agg(F.max("source_size").alias("source_size"))).collect()}
    planned = {(q["number"], q["shard"]): q["seats"] for q in quotas.collect()}
    got = defaultdict(int)
    for r in mixing.mixed_documents(hard, block_tokens=16, shard_seats=40).collect():
        got[number[r["source"]], r["shard"]] += len(words(r["text"]))
    of_spans = spans.join(rows.select("__row", "source"), "__row").groupBy("source", "shard").agg(F.sum(F.col("stop") - F.col("start")).alias("n"))
    assert got == {(number[r["source"]], r["shard"]): r["n"] for r in of_spans.collect()}
    end = {n: max(shard for m, shard in planned if m == n) for n, _ in planned}
    assert len(set(end.values())) > 1 and max(end.values()) > 5
    for (n, shard), seats in planned.items():
        short = 16 * mixing.REPEATS  # a source's short block, once in each pass
        assert seats * 16 - short <= got[n, shard] + (16 if shard == end[n] else 0)
        assert got[n, shard] <= seats * 16 + (short + 16 if shard == end[n] else 0)
    assert all(shard == end.get(n, max(end.values())) for n, shard in set(got) - set(planned))
