import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from logbrook.llm import lm


def brute(rows):
    """Base columns, and shares of words in classes."""
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 10 == 0 for r in rows]
    tokens = [[*(r[1] or "").encode().lower().split(), "end"] for r in rows]
    c = Counter(t for h, ts in zip(held, tokens) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    base = [
        (r[0], h, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts))
        for r, h, ts in zip(rows, held, tokens)
    ]
    return base, c


def check(rows, got):
    want, _ = brute(rows)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got = sorted(((g["doc_id"], g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"], g["base_score"]) for g in got), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])


def test_hard_rows(hard, none):
    got = lm.score_documents(hard).collect()
    check([tuple(r) for r in hard.collect()], got)
    assert all(math.isfinite(g["score"]) and g["score"] <= 0 for g in got)
    assert lm.score_documents(none).count() == 0


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = lm.op10_lm_scoring(spark, sf_dir).collect()
    check(rows, got)
    held = [g for g in got if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_scores_are_those_of_a_normalised_model(hard):
    """The score of each text again, word by word, from the table and the shares; both sum to one."""
    docs = hard.select("doc_id", "text")
    counts = lm.word_counts(docs)
    few = lm.read_lexicon(counts, frequent_words=50)
    table = lm.fit(lm.class_trigrams(docs, few))
    assert np.allclose((10.0 ** table.astype(float)).sum(axis=1), 1, atol=1e-4)
    _, c = brute([tuple(r) for r in hard.collect()])
    members = defaultdict(list)
    for word in c:
        members[0 if word == "end" else few.class_of(word)].append(word)
    share = {}
    for k, found in members.items():
        if k < lm.OWN_CLASSES:
            assert len(found) == 1
            share[found[0]] = 0.0
            continue
        total = sum(c[w] for w in found) + 0.1 * (len(found) + 1)
        assert few.log_total[k] == pytest.approx(math.log10(total))
        assert sum((c[w] + 0.1) / total for w in found) + 0.1 / total == pytest.approx(1)


def test_held_out_words_and_scores_word_by_word(spark):
    rows = [(i, f"the river the stone w{i % 3} " * 5) for i in range(40)] + [(999983, "the never seen"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    got = lm.score_documents(df).collect()
    check(rows, got)
    counts = lm.word_counts(df)
    lexicon = lm.read_lexicon(counts)
    table = lm.fit(lm.class_trigrams(df, lexicon))
    _, c = brute(rows)
    for g, (doc_id, text) in zip(sorted(got, key=lambda g: str(g["doc_id"])), sorted(rows, key=lambda r: str(r[0]))):
        words = (text or "").encode().lower().split()
        classes = [0, 0, *(lexicon.class_of(w) for w in words), 0]
        total = sum(float(table[a * lm.CLASSES + b, k]) for a, b, k in zip(classes, classes[1:], classes[2:]))
        for w, k in zip(words, classes[2:]):
            if k >= lm.OWN_CLASSES:
                total += math.log10(c[w] + 0.1) - lexicon.log_total[k]
        assert g["score"] == pytest.approx(total, rel=1e-5)


def test_estimation_finds_the_distribution():
    rng = np.random.default_rng(0)
    far, near = rng.normal(0, 1, (2, 2, 3))  # the two places add up in the model's scores
    codes, n = [], []
    for one in (0, 1):
        for two in (0, 1):
            chances = np.exp(far[one] + near[two])
            chances /= chances.sum()
            for word in range(3):
                codes.append((one * lm.CLASSES + two) * lm.CLASSES + word)
                n.append(int(1e6 * chances[word]))
    table = 10.0 ** lm.train(np.array(codes), np.array(n)).astype(float)
    for code, count in zip(codes, n):
        assert table[code // lm.CLASSES, code % lm.CLASSES] == pytest.approx(count / 1e6, abs=0.05)
