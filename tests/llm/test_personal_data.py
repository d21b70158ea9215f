import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from logbrook.llm import personal_data as p

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


def base_spans(text):
    """The base patterns as they are stated, with their checks."""
    text, found = text or "", []
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        for match in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", match.group())
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(n) <= 255 for n in match.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append((kind, match.start(), match.end()))
    return found


def card(rng, size=16):
    digits = "4" + "".join(rng.choice("0123456789") for _ in range(size - 2))
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def texts(seed=3):
    rng = random.Random(seed)
    words = "river stone über 山の cloud 12 house, green. call phone card mail 7 of 😀 the".split()

    def prose(size):
        return " ".join(rng.choice(words) for _ in range(size))

    rows = []
    for n in range(220):
        parts = [prose(rng.randrange(1, 9))]
        for _ in range(rng.randrange(0, 4)):
            parts.append(
                rng.choice(
                    [
                        f"ab.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
                        ".".join(str(rng.randrange(300)) for _ in range(4)),
                        card(rng, rng.choice([16, 16, 16, 19])),
                        f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
                    ]
                )
            )
            parts.append(prose(rng.randrange(0, 6)))
        rows.append(" ".join(parts))
    return rows


HARD = [
    None, "", " \n\t", "a@b", "a@b.c", "a@b.c.@d.e", "a@b.c_x@y.z and .@q.r", "x" * 30_000 + "@y.zz", "y" * 40_000,
    "a@" + "b." * 20_000 + "c", "1.2.3.4.5.6.7.8", "300.1.2.3.4 001.2.3.4 256.1.1.1 1.2.3.04567", "9" * 30_000, "1 " * 20_000 + "2",
    "1-" * 9000, "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "41111111 11111111-", "5 -4111111111111111", "4111  1111111111111",
    "4111111111111112", "+1 (555) 010-9999", "++1 23456789", "+12 ()..-3 +123456789012345678 +1234567", "+ 1 2", "+1" + " 2" * 9000,
    "+1 (269) 555-3296 4524132264652876 and", "555-9331 4111111111111111 53.121.55.90 qu", "é😀a@b.co 山 1.1.1.1 \x0b+12345678😀4111111111111111",
    "1" * 16 + " " + "2" * 15, "0" * 16, "0-0 " * 4 + "0" * 8, "a@b.c" * 300, "١٢٣.1.1.1.1", "a@b.c, a@b.c",
]


def rows_of(df):
    return [(r["doc_id"], [tuple(s) for s in r["base"]], [tuple(s) for s in r["spans"]]) for r in df.collect()]


@pytest.fixture(scope="module")
def found(spark):
    rows = list(enumerate(texts() + HARD)) + [(None, "mail x@y.zz"), (None, "mail x@y.zz"), (5, "twice 1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    clash = docs.withColumns({n: F.lit("z") for n in ("base", "spans", "start", "base_email", "loose_ip", "votes", "key", "feature")})
    return rows, rows_of(p.personal_spans(clash))


def test_base_spans_equal_the_stated_patterns(found):
    rows, result = found
    assert len(result) == len(rows)
    wanted = sorted(((str(i), base_spans(text)) for i, text in rows))
    assert sorted((str(i), base) for i, base, _ in result) == wanted


def test_random_strings_of_the_patterns_letters(spark):
    rng = random.Random(9)
    letters = ["1", "2", "9", "0", " ", "-", ".", "@", "+", "(", "a", "_", "é", "12", "255", "4111111111111111", "1.1.1.1"]
    rows = [(n, "".join(rng.choice(letters) for _ in range(rng.randrange(1, 40)))) for n in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in p.candidates(docs).select("doc_id", "base").collect()}
    assert base == {n: base_spans(text) for n, text in rows}


def test_spans_that_a_base_pattern_runs_past_are_added(found):
    rows, result = found
    by_id = {i: (base, spans) for i, base, spans in result}
    number = len(texts()) + HARD.index("+1 (269) 555-3296 4524132264652876 and")
    assert by_id[number] == ([], [("card", 18, 34), ("phone", 0, 17)])
    number = len(texts()) + HARD.index("555-9331 4111111111111111 53.121.55.90 qu")
    assert ("card", 9, 25) in by_id[number][1] and ("ip", 26, 38) in by_id[number][1]


def test_base_spans_stay_in_order_and_little_is_added(found):
    rows, result = found
    texts_ = {i: text for i, text in rows if i is not None and i != 5}
    for i, base, spans in result:
        assert set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (p.KINDS.index(s[0]), s[1]))
        for kind, start, stop in set(spans) - set(base):
            if i in texts_ and kind == "card":
                assert luhn(re.sub("[^0-9]", "", texts_[i][start:stop]))
            assert not any(b[1] < stop and start < b[2] for b in base)


def test_clean_documents_are_left_alone(spark):
    rng = random.Random(1)
    clean = ["On 12.05.2024 and 2024-05-12 we sold 1234567890 parts, see 10.2.4 and 3.5-7.", "Order 123456789012345 of 1 000 000 000 000",
             "version 1.2.3 at 12:30, 5 x 4 = 20, call 911", "hash 9f86d081884c7d65 and password=b7db7aa4a5fcc78305", "me @ home . alone"]
    rows = list(enumerate(texts())) + [(1000 + n, text) for n, text in enumerate(clean)]
    rows += [(2000 + n, f"see {rng.randrange(10**15, 10**16)}") for n in range(30)]
    result = rows_of(p.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, base, spans in result:
        if i is not None and i >= 1000:
            text = dict(rows)[i]
            assert spans == base and all(kind == "card" and luhn(text[a:b]) for kind, a, b in spans)


def test_documents_without_text(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert p.personal_spans(nothing).collect() == []
    one = spark.createDataFrame([(1, None), (2, "plain words")], "doc_id long, text string")
    assert sorted(rows_of(p.personal_spans(one))) == [(1, [], []), (2, [], [])]


# ---- the label model ------------------------------------------------------------------------


def test_reliabilities_are_found_without_labels():
    """Votes drawn from known chances: the estimated ones are close, and so are the probabilities."""
    rng = random.Random(4)
    chances = [(0.95, 0.03), (0.9, 0.2), (0.85, 0.1), (0.6, 0.3), (0.8, 0.25)]
    counts, truth = {}, {}
    for _ in range(30_000):
        true = rng.random() < 0.4
        votes = "".join("+" if rng.random() < c[0 if true else 1] else "-" for c in chances)
        counts["phone", votes] = counts.get(("phone", votes), 0) + 1
        truth.setdefault(votes, []).append(true)
    found, models = p.reliabilities(counts)
    assert abs(models["phone"]["prior"] - 0.4) < 0.02
    for voter, (when_true, when_false) in zip(p.VOTERS, chances):
        false, true = models["phone"][voter]["+"]
        assert abs(true - when_true) < 0.03 and abs(false - when_false) < 0.03
    error = sum(abs(found[f"phone|{votes}"] * len(seen) - sum(seen)) for votes, seen in truth.items())
    assert error / 30_000 < 0.02


def test_weights_equal_counting_by_hand():
    rows = [("ip|left=space", 90.0, 1.0), ("ip|left=word", 1.0, 9.0), ("ip|digits=8", 91.0, 10.0)]
    weights = p.span_weights(rows)
    from math import log

    assert weights["ip"] == pytest.approx(log(92 / 11))
    assert weights["ip|left=word"] == pytest.approx(log(1.5 / 92.5) - log(10 / 13))
    assert weights["ip|left"] == pytest.approx(log(0.5 / 92.5) - log(1 / 13))


def test_training_equals_plain_python(spark, found):
    """Votes and features counted natively give the weights that a loop over all candidates gives."""
    rows, _ = found
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = p.candidates(docs).cache()
    weights, models = p.train(held)
    spans = [s for r in held.select("spans").collect() for s in r["spans"]]
    held.unpersist()
    counts = {}
    for s in spans:
        counts[s["kind"], s["votes"]] = counts.get((s["kind"], s["votes"]), 0) + 1
    chances, again = p.reliabilities(counts)
    assert models == again
    sums = {}
    for s in spans:
        for feature in s["features"]:
            pair = sums.setdefault(feature, [0.0, 0.0])
            pair[0] += chances[f"{s['kind']}|{s['votes']}"]
            pair[1] += 1 - chances[f"{s['kind']}|{s['votes']}"]
    wanted = p.span_weights([(f, round(a, 6), round(b, 6)) for f, (a, b) in sorted(sums.items())])
    assert weights.keys() == wanted.keys()
    assert all(abs(weights[f] - wanted[f]) < 1e-6 for f in weights)


def test_votes(spark):
    cases = [
        ("email", "write to ", "a.b@mail.example.com", " ", "+++++"),
        ("email", "at ", "a..b@x.qqq", "", "+-00+"),
        ("ip", "server ", "10.0.0.300", ".", "-+++" + "+"),
        ("card", "visa ", "4111111111111111", "", "+++++"),
        ("card", "order id=", "4111111111111112", "", "-++--"),
        ("phone", "tel ", "+1 (269) 555-3296", "", "+++++"),
        ("phone", "", "12.05.2024", "", "--00+"),
    ]
    df = spark.createDataFrame([(c[0], (0, 1, c[2], c[1], c[3])) for c in cases], "kind string, s struct<start:int,stop:int,found:string,before:string,after:string>")
    for kind in p.KINDS:
        rows = df.filter(F.col("kind") == kind).select("s", p.votes_of(kind, F.col("s")).alias("votes")).collect()
        for row in rows:
            wanted = next(c[4] for c in cases if c[2] == row["s"]["found"])
            assert row["votes"] == wanted, row


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    result = {r["doc_id"]: r for r in p.op12_personal_data(spark, sf_dir).collect()}
    assert len(result) == len(rows)
    for row in rows:
        base, got = base_spans(row["text"]), result[row["doc_id"]]
        spelled = [f"{k}:{a}:{b}" for k, a, b in base]
        assert got["base_sha256"] == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        assert [got[f"n_{k}"] for k in p.KINDS] == [sum(b[0] == k for b in base) for k in p.KINDS]
        assert set(spelled) <= set(got["spans"].split(",")) | {""} and got["n_added"] >= 0


def test_plan_is_native(spark, sf_dir):
    plan = p.op12_personal_data(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExternalRDD|MapPartitions", plan)
