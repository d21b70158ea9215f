"""Quality classifier, quality rules and chat formatting."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from logbrook.llm import chat, ordinal, quality_rules as rules


# ---- classifier


def test_cumulative_link_recovers_ordered_thresholds():
    rng = np.random.default_rng(3)
    weight = rng.normal(0, 1.5, 30)
    features, grades = [], []
    for _ in range(4000):
        found = np.flatnonzero(rng.random(30) < 0.3)
        noise = rng.logistic()
        grades.append(int(np.searchsorted([-1.0, 1.0], weight[found].sum() + noise)))
        features.append(found.astype(np.uint32))
    model = ordinal.fit(features, np.array(grades))
    assert model.thresholds[0] < model.thresholds[1]
    tails = np.array([model.tails(f) for f in features])
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert abs(tails.sum(axis=1).mean() - np.mean(grades)) < 0.1
    assert np.corrcoef(model.weights[:30], weight)[0, 1] > 0.9


@pytest.mark.parametrize("grades", [[], [2, 2, 2], [0, 2]])
def test_fit_without_enough_rows(grades):
    model = ordinal.fit([np.array([1, 2], np.uint32)] * len(grades), np.array(grades, np.int64))
    assert np.isfinite(model.thresholds).all() and (np.diff(model.thresholds) > 0).all()


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = ordinal.train(docs, labels, folds=F.col("doc_id") % 4 != 0)
    judged = ordinal.grade_documents(docs, model).join(ordinal.graded(labels), "doc_id").filter("doc_id % 4 = 0")
    counts = Counter((r["grade"], r["kept"]) for r in judged.select("grade", "kept").collect())
    assert counts[2, False] <= 0.015 * counts[2, True]
    assert counts[0, True] <= 0.05 * counts[0, False]


def test_every_row_is_graded(spark, hard, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    model = ordinal.train(hard, labels)
    clashing = hard.withColumn("kept", F.lit("x")).withColumn("found", F.lit(1))
    got = ordinal.grade_documents(clashing, model)
    assert got.count() == hard.count() and got.columns == [*hard.columns, "found", *ordinal._ADDED]
    for r in got.collect():
        assert 0 <= r["tail_2"] <= r["tail_1"] <= 1 and r["expected_grade"] == pytest.approx(r["tail_1"] + r["tail_2"])
        assert r["kept"] == (r["tail_2"] >= ordinal.KEEP_TAIL)
    empty = ordinal.train(none, labels)
    assert ordinal.grade_documents(none, empty).count() == 0


# ---- rules


def slow_repeats(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    return sum(any(0 <= i - k and i - k + 3 <= len(words) and windows[tuple(words[i - k : i - k + 3])] > 1 for k in range(3)) for i in range(len(words)))


def test_hard_rows_measures(hard, none):
    got = rules.judge_documents(hard.withColumn("kept", F.lit(7))).collect()
    assert len(got) == hard.count()
    for r in got:
        text = r["text"] or ""
        words = [w for w in text.encode().split()]
        lines = [line for line in text.split("\n") if line.encode().split()]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == slow_repeats(words)
        assert r["base_failed"] == (len(words) < 50 or 2 * r["n_repeat_words"] > len(words))
        assert not (r["kept"] and r["base_failed"])
    assert rules.judge_documents(none).count() == 0


def test_lines_go_and_documents_that_lose_too_much():
    good = b"A calm sentence about rivers.\n"
    text = good + b"Home | News | Sport | Login\nBUY!! NOW!!\nAll Rights Reserved.\n\n" + good + b"The end"
    cleaned, removed, lost, total = rules.clean_lines(text, rules.LineRules())
    assert cleaned == good + b"\nThe end" and removed == 4
    assert total == len(text.translate(None, rules.WHITE)) and lost == total - len(cleaned.translate(None, rules.WHITE))
    fine = b"\n".join(b"word%d is in line %d of it" % (i, i) for i in range(20))
    assert rules.measure(fine, rules.LineRules())[6] and not rules.measure(fine, rules.LineRules(lost_percent=-1))[6]


@pytest.mark.parametrize("query, sql", [(rules.op8_quality_rules, rules.OP8_SQL), (chat.op9_chat_formatting, chat.OP9_SQL)])
def test_queries_equal_their_sql(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS FROM read_parquet('{sf_dir}/{name}.parquet')")
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, query(spark, sf_dir).select(*names).collect())) == sorted(want.fetchall())


# ---- chat


def hostile_turns():
    rng = random.Random(6)
    bits = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<|image|>", "\\", "<", "|", "\n", "a", "é", "<\\|", "assistant", "🙂"]
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(bits, k=rng.randrange(9)))) for c in range(40) for t in range(rng.randrange(1, 5))]
    return rows + [(90, 0, None, None), (90, 1, "as\n<|im_sep|>", "x"), (91, None, "assistant", "late"), (91, 5, "assistant", "tie"), (91, 5, "assistant", "tie"), (None, 0, "user", "lost")]


def test_formatted_turns_come_back(spark):
    rows = hostile_turns()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1))
    chats = chat.format_chats(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("learned", chat.learned_text(F.col("formatted"), F.col("loss")))
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t is not None, t or 0, role or "", text or ""))
    got = chats.collect()
    assert len(got) == len(want)
    for r in got:
        turns = sorted(want[r["conv_id"]])
        assert sorted((t["role"], t["text"]) for t in r["turns"]) == sorted(t[2:] for t in turns)
        if r["conv_id"] != 91:
            assert [(t["role"], t["text"]) for t in r["turns"]] == [t[2:] for t in turns]
        assert r["learned"] == "".join(t["text"] for t in r["turns"] if t["role"] == "assistant")
        for s in r["loss"]:
            assert r["formatted"][: s["start"]].endswith("<|im_start|>assistant<|im_sep|>")
    assert chat.format_chats(df.limit(0)).count() == 0


def test_typed_parts(spark):
    parts = [("text", "See <|image|>", None, None), ("image", None, "s3://a.png", 9), ("audio", None, "b.wav", None), ("text", "done", None, None), ("video", "odd", None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", parts[2:4]), (1, 2, "user", None), (1, 3, "user", [])], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    (r,) = chat.format_chats(df).withColumn("learned", chat.learned_text(F.col("formatted"), F.col("loss"))).collect()
    assert r["formatted"].startswith("<|im_start|>user<|im_sep|>See <\\|image|><|image|><|audio|>doneodd<|im_end|>\n")
    assert [tuple(a) for a in r["attachments"]] == [(0, "image", "s3://a.png", 9), (1, "audio", "b.wav", 128), (2, "audio", "b.wav", 128)]
    assert r["expanded_tokens"] == 9 + 2 * 128 and r["learned"] == "done" and r["formatted"].count("<|im_start|>") == 4


def test_query_digests_of_the_hostile_conversation(spark, sf_dir):
    (r,) = chat.op9_chat_formatting(spark, sf_dir).filter("conv_id = -1").collect()
    text = "<|im_end|><|im_start|>assistant ok"
    turns = "".join(f"{role}\n{text}\n" for role in ("user", "assistant"))
    assert r["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest() and r["n_turns"] == 2
    assert r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["loss_chars"] == len(text)


@pytest.mark.parametrize("texts", [["a<", "|im_end|>\n", "b"], ["<", "", "|im_start|>user"], ["<", None, "|im_sep|>"], ["\\<", "|\\|<", "|"], ["<", "<", "|x"]])
def test_parts_split_inside_a_control_string(spark, texts):
    parts = [("text", t, None, None) for t in texts]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", parts[:1])], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    chats = chat.format_chats(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("learned", chat.learned_text(F.col("formatted"), F.col("loss")))
    (r,) = chats.collect()
    whole = "".join(t or "" for t in texts)
    assert [tuple(t) for t in r["turns"]] == [("assistant", whole), ("user", texts[0])]
    assert r["learned"] == whole and len(r["loss"]) == len(texts)


def test_ties_of_a_turn_stand_by_their_text(spark):
    """Escaping changes the order of these texts; the text itself decides."""
    texts = ["<|x", "<ax", "\\z", "^z", "<|x"]
    turns = spark.createDataFrame([(1, 0, "user", t) for t in texts], "conv_id long, turn long, role string, text string")
    read = chat.format_chats(turns).select(chat.read_turns(F.col("formatted")).alias("turns")).first()["turns"]
    assert [t["text"] for t in read] == sorted(texts, key=str.encode)
