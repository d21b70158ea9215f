import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from logbrook.llm import collocations as c


def brute(rows, least, top):
    """Best phrases of (lang, text) rows by counting every phrase."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered):
            words = tuple(w for w in re.split(r"[ \t]+", piece) if w)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, words[i : i + k]] += 1
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in found.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words) and 100 * a >= 100 * counts[lang, words[i:j]]:
                    dropped.add((lang, words[i:j]))
    ranked = {}
    for (lang, words), a in found.items():
        if (lang, words) not in dropped:
            cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
            score, _, left, right = min((1000 * a * totals[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            ranked.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    result = []
    for lang, phrases in ranked.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def texts(seed=4):
    rng = random.Random(seed)
    words = ["Tree", "river", "of", "the", "The", "stone\x1cwall", "señor", "山", "a b", "x", "zu", "Ärger", "<|", "0"]
    ends = [" ", " ", " ", " ", "\t ", ", ", ". ", "\n", "; ", "\x0b", "? "]

    def text(size):
        return "".join(rng.choice(words) + rng.choice(ends) for _ in range(size))

    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(rng.choice(["en", "en", "en", None, "und", "de"]), text(rng.choice([1, 3, 40, 120]))) for _ in range(60)]
    rows += [("en", f"before{i} {passage} after")for i in range(12)]
    rows += [("de", "  lead  " + passage + "."), ("fr", "only once"), ("en", None), ("en", ""), ("de", " .,\n "), ("en", "x " * 4000)]
    rows += [("en", text(9000))] + rows[:6] * 3
    return rows


@pytest.fixture(scope="module")
def hard_texts(spark):
    rows = texts()
    return rows, spark.createDataFrame(rows, "lang string, text string").repartition(7)


@pytest.mark.parametrize("least, top", [(5, 25)])
def test_equals_counting_every_phrase(spark, hard_texts, least, top):
    rows, docs = hard_texts
    found = sorted(tuple(row) for row in c.collocations(docs, least, top).collect())
    assert found == brute(rows, least, top)
    assert len({row[0] for row in found}) > 1


def test_small_limits_change_nothing(spark, hard_texts, monkeypatch):
    """Long texts in chunks, counts passed on early, stretches cut, and a bitmap that lets nearly everything through."""
    rows, docs = hard_texts
    for name, value in (("_CHUNK", 700), ("_DISTINCT", 9), ("_POSITIONS", 513), ("_BITS", 64), ("_SEGMENT_BITS", 64), ("_PLACES", 64), ("OCTAVE", 2)):
        monkeypatch.setattr(c, name, value)
    import cloudpickle

    cloudpickle.register_pickle_by_value(c)
    try:
        found = sorted(tuple(row) for row in c.collocations(docs, 6, 15).collect())
    finally:
        cloudpickle.unregister_pickle_by_value(c)
    assert found == brute(rows, 6, 15)


def test_low_bounds_are_not_opened(spark, hard_texts, monkeypatch):
    """Once rare words have given enough phrases, frequent words stay closed."""
    rows, docs = hard_texts
    opened = []
    grown = c._grown
    monkeypatch.setattr(c, "_grown", lambda codes, nodes, least: (opened.append(nodes), grown(codes, nodes, least))[1])
    monkeypatch.setattr(c, "OCTAVE", 2)
    only = docs.filter("lang = 'en'")
    found = sorted(tuple(row) for row in c.collocations(only, 10, 5).collect())
    assert found == brute([row for row in rows if row[0] == "en"], 10, 5)
    most = max(nodes.agg(F.max(F.col("firsts")[0])).first()[0] for nodes in opened)
    assert most < c.count_words(only, 42).agg(F.max("a")).first()[0] // 4


def test_codes_of_a_text_do_not_depend_on_chunks(monkeypatch):
    text = "One two.three\tFOUR  five;\n six".encode()
    whole = [w for words in c.tokens(text) for w in words if w]
    monkeypatch.setattr(c, "_CHUNK", 5)
    assert [w for words in c.tokens(text) for w in words if w] == whole
    assert whole == [b"one", b"two", b".", b"three", b"four", b"five", b".", b".", b"six"]


def test_shared_codes_lead_to_other_codes(spark, hard_texts, monkeypatch):
    _, docs = hard_texts
    honest, seeds = c.count_words, []

    def count(docs, seed):
        seeds.append(seed)
        words = honest(docs, seed)
        return words.withColumn("code", F.lit(5).cast("long")) if seed == 42 else words

    monkeypatch.setattr(c, "count_words", count)
    words, totals, seed = c.coded_words(docs, 30)
    assert seed == 43 and seeds == [42, 43]
    assert words.select("lang", "code").distinct().count() == words.count() > 0


def test_large_counts_are_exact(spark):
    """Products pass 64 bits, scores are floors."""
    a, l, r, n = 123_456_789_012, 223_456_789_013, 987_654_321_098, 91_234_567_890_123_456
    phrases = spark.createDataFrame([("en", 2, 1, 2, 0, 0, 0, a, [l])], "lang string, k int, w1 long, w2 long, w3 long, w4 long, w5 long, a long, firsts array<long>")
    rests = spark.createDataFrame([("en", 2, 0, 0, 0, r)], "lang string, w1 long, w2 long, w3 long, w4 long, r long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    row = c.cut_scores(phrases, rests, totals).first()
    assert (row["score"], row["l"], row["r"]) == (1000 * a * n // (l * r), l, r)


def test_nothing_and_clashing_columns(spark):
    nothing = spark.createDataFrame([], "lang string, text string")
    result = c.collocations(nothing)
    assert result.collect() == [] and result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [("en", "a b c")] * 4
    docs = spark.createDataFrame(rows, "lang string, text string")
    clash = docs.withColumns({name: F.lit("z") for name in ("word", "code", "a", "n", "k", "w1", "codes", "floor", "rank", "_up")})
    assert sorted(map(tuple, c.collocations(clash, 3, 9).collect())) == brute(rows, 3, 9) == [("en", 1, "a b c", 4, 4, 4, 12, 3000)]


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM read_parquet('{os.path.join(sf_dir, 'documents.parquet')}')")
    found = con.execute(c.OP13_SQL)
    names = [d[0] for d in found.description]
    rows = c.op13_phrase_collocations(spark, sf_dir).select(names).collect()
    assert sorted(map(tuple, rows)) == sorted(found.fetchall()) and rows
    assert np.all([row["a"] >= c.LEAST for row in rows])
