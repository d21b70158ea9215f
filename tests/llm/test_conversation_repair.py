import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from logbrook.llm import conversation_repair as r

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def states():
    return {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(turns):
    """(cost, letters, texts) by a plain forward program over (role, text, fault); least cost, then least letters."""
    after = states()
    best = {"": (0, "", ())}

    def inserted(found):
        found = dict(found)
        for _ in range(3):
            for state, (cost, letters, texts) in list(found.items()):
                new = after[state]
                offer = (cost + 3, letters + "I", (*texts, {"u": "user", "a": "assistant"}[new] + ":"))
                found[new] = min(found.get(new, offer), offer)
        return found

    for role, text, fault in turns:
        offers = {}

        def offer(state, value):
            offers[state] = min(offers.get(state, value), value)

        for state, (cost, letters, texts) in inserted(best).items():
            offer(state, (cost + 4, letters + "D", texts))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 * (fault == "truncated")
            if role and state + role[:1] in ("s", "u", "su", "ua", "au"):
                offer(role[:1], (cost + extra, letters + "K", (*texts, f"{role}:{text}")))
            name = {"u": "user", "a": "assistant"}[after[state]]
            offer(after[state], (cost + 3 + extra, letters + "R", (*texts, f"{name}:{text}")))
        best = offers
    done = inserted(best)
    return min(done[state] for state in ("", "a") if state in done)


def judged(rows):
    seen, result = set(), []
    for role, text in rows:
        shown = text.rstrip(WHITE)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        result.append((role, text, fault))
    return result


def expected(rows):
    """Digest rows by conversation of (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        convs.setdefault(conv, []).append((turn, role, text))
    result = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest()))
        marked = judged([t[1:] for t in turns])
        cost, letters, texts = cheapest(marked)
        known = [t[0] for t in turns if t[0] is not None]
        faults = [m[2] for m in marked]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        result[conv] = (
            conv,
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(name) for name in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            letters,
            hashlib.sha256("\n".join(texts).encode()).hexdigest(),
        )
    return result


def digests(spark, rows, parts=5):
    found = r.repair_digests(r.repair(spark.createDataFrame(rows, SCHEMA).repartition(parts))).collect()
    result = {row["conv_id"]: tuple(row) for row in found}
    assert len(result) == len(found)
    return result


def random_turns(rng, conv, size):
    texts = ["Yes.", "No!", "cut", "why?  \n", " \t", "", None, "a b", "..", "é.", "long " * 400 + "."]
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "unknown", "Sys"]
    return [(conv, rng.choice([None, *range(size)]) if rng.random() < 0.1 else n, rng.choice(roles), rng.choice(texts)) for n in range(size)]


def test_unrolled_runs_are_cheapest():
    rng = random.Random(3)
    for _ in range(300):
        runs = tuple((rng.choice([0, 1, 2, 3, 4, 5, 6, 8]), rng.choice([1, 1, 2, 3])) for _ in range(rng.randrange(1, 5)))
        runs = tuple(run for n, run in enumerate(runs) if not n or run[0] != runs[n - 1][0])
        turns = []
        for symbol, length in runs:
            role = ("system", "user", "assistant", "tool", "")[symbol >> 1]
            turns += [(role, "x", "blank" if symbol == r.GONE else "truncated" if symbol & 1 else "")] * length
        cost, letters, _ = cheapest(turns)
        edits, state = r.unroll(runs, r.NONE, r.END, True)
        assert "".join(edits) == letters and len(edits) == len(turns) and r.END[state] == 0
        costs = r.END
        for symbol, length in reversed(runs):
            costs = r.over_run(symbol, length, costs)
        assert costs[r.NONE] == cost == r.apply(r.run_matrix(list(runs)), r.END)[r.NONE]


def test_a_long_run_takes_few_steps():
    costs = r.over_run(2, 1 << 40, r.END)
    # Every second turn of one user after another is made an answer.
    assert costs[r.NONE] == 3 * (1 << 39)
    edits, _ = r.unroll(((2, 3001),), r.NONE, r.END, True)
    assert len(edits) == 3001 and "".join(edits) == cheapest([("user", "x", "")] * 3001)[1]


def test_hard_conversations_equal_the_plain_program(spark):
    rng = random.Random(11)
    rows = [row for conv in [None, *range(40)] for row in random_turns(rng, conv, rng.choice([1, 2, 5, 9]))]
    rows += rows[:7] + rows[:3]
    rows += [(90, n, "system", "same.") for n in range(6)] + [(91, None, None, None)] * 5
    assert digests(spark, rows) == expected(rows)


def test_a_conversation_with_most_turns_is_cut_into_ranges(spark):
    rng = random.Random(5)
    hot = [(7, n, rng.choice(["user", "assistant", "assistant", "system"]), f"text {rng.randrange(1500)}" + rng.choice([".", "", "!"])) for n in range(1600)]
    hot += [(7, 1600, "user", "again and again.")] * 400
    rows = hot + [row for conv in range(15) for row in random_turns(rng, conv + 10, 4)] + random_turns(rng, 1, 3)
    turns = spark.createDataFrame(rows, SCHEMA).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edits = r.repair(turns)
        assert edits.filter("conv_id = 7").select("part").distinct().count() > 3
        found = {row["conv_id"]: tuple(row) for row in r.repair_digests(edits).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == expected(rows)


def test_repaired_turns_have_the_form(spark):
    rng = random.Random(8)
    rows = [row for conv in range(12) for row in random_turns(rng, conv, 6)]
    edits = r.repair(spark.createDataFrame(rows, SCHEMA))
    convs = {}
    for row in r.repaired_turns(edits).orderBy("conv_id", "part", "seq", "number").collect():
        convs.setdefault(row["conv_id"], []).append(f"{row['role']}:{row['text']}")
    wanted = expected(rows)
    for conv, found in wanted.items():
        assert hashlib.sha256("\n".join(convs.get(conv, [])).encode()).hexdigest() == found[-1]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert r.repair_digests(r.repair(empty)).collect() == []
    rows = [(1, 0, "user", "Hello."), (1, 1, "assistant", "Hi.")]
    names = ["part", "seq", "tie", "digest", "kind", "symbol", "fault", "edits", "_kind", "_copy", "_id", "cost"]
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in names})
    assert digests(spark, rows) == {row["conv_id"]: tuple(row) for row in r.repair_digests(r.repair(clash)).collect()}
    assert r.damage(clash).columns == ["conv_id", "turn", "role", "text"]


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! {c}") for c in range(30) for t in range(4)] + [(None, None, None, None), (5, None, "user", None)]
    found = sorted(map(str, (tuple(x) for x in r.damage(spark.createDataFrame(rows, SCHEMA)).collect())))
    wanted = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = {1: "", 2: text.translate(dict.fromkeys(map(ord, ".!?")))}.get(kind, text)
        wanted += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert found == sorted(map(str, wanted))


@pytest.mark.parametrize("extra", [False, True])
def test_query_equals_sql(spark, sf_dir, tmp_path, extra):
    path = f"{sf_dir}/conversations.parquet"
    if extra:
        rng = random.Random(2)
        rows = [row for conv in [None, *range(60)] for row in random_turns(rng, conv, rng.choice([1, 2, 4]))]
        path = str(tmp_path / "conversations.parquet")
        spark.createDataFrame(rows + rows[:9], SCHEMA).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    source = f"{path}/*.parquet" if extra else path
    con.execute(f"CREATE VIEW conversations AS FROM read_parquet('{source}')")
    found = con.execute(r.OP11_SQL)
    names = [d[0] for d in found.description]
    result = r.op11_conversation_repair(spark, str(tmp_path) if extra else sf_dir).select(names).collect()
    assert sorted(map(str, (tuple(x) for x in result))) == sorted(map(str, found.fetchall()))
