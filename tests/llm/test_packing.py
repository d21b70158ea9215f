import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logbrook.llm import packing

MODEL = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def ids_of(text):
    return [*MODEL.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, pieces):
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        want[doc_id].append(ids_of(text))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(want)
    for doc_id, texts in want.items():
        left = sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in by_doc[doc_id])
        if len(texts) > 1:  # repeated rows: only the total can be told
            assert sum(p[1] for p in left) == sum(map(len, texts))
            continue
        at = 0
        for start, length, crc, total in left:
            assert start == at and total == len(texts[0])
            assert crc == zlib.crc32(np.array(texts[0][start : start + length], "<u4").tobytes())
            at += length
        assert at == len(texts[0])
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0 and {p["tier"] for p in parts} == {at}
        assert len({p["step_group"] for p in parts}) == 1
    steps = defaultdict(set)
    for s, parts in by_sequence.items():
        steps[parts[0]["step_group"]].add((s, parts[0]["tier"]))
    for held in steps.values():
        assert len({tier for _, tier in held}) == 1
        assert sum(tier for _, tier in held) <= packing.STEP_TOKENS
    return by_sequence


def test_query_packs_every_id_once(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(rows, packing.op6_packing(spark, sf_dir).collect())


def test_hard_rows(hard, none):
    check([tuple(r) for r in hard.collect()], packing.pack_documents(hard).collect())
    assert packing.pack_documents(none).count() == 0


def test_few_sequences_outside_the_tiers(spark):
    df = spark.createDataFrame([(i, "stone river " * (17 * i % 900 + 1)) for i in range(300)], "doc_id long, text string").coalesce(2)
    sequences = check([tuple(r) for r in df.collect()], packing.pack_documents(df).collect())
    lengths = [sum(p["length"] for p in parts) for parts in sequences.values()]
    assert sum(n not in packing.TIERS for n in lengths) <= 2 * 11
    assert set(packing.TIERS) <= set(lengths)


@pytest.mark.parametrize("text", ["Anea, THE end.", "a<|endoftext|>b <|ENDOFTEXT|>", "don't 's I'LL x1y22", "\x1cé́ z É", "İİK ǅ ΑΣ", "🙂🙂 山水,。", ""])
def test_words_give_the_ids_of_the_text(text):
    encoder = packing.WordEncoder(packing.TOKENIZER, cached=2)
    for _ in range(3):
        got = np.frombuffer(encoder.encode(text.encode()), "<u4").tolist()
        assert got == MODEL.encode(text, add_special_tokens=False).ids


def test_every_letter_before_a_sign_gives_the_ids_of_the_text():
    words = [a + chr(c) + sign for c in range(0x80, 0x30000) if chr(c).isalpha() for a in ("", "k") for sign in ",."]
    encoder = packing.WordEncoder(packing.TOKENIZER, cached=len(words) * 2)
    encoder.encode(" ".join(words).encode())
    want = MODEL.encode_batch_fast(words, add_special_tokens=False)
    assert [w for w, e in zip(words, want) if np.frombuffer(encoder.encode(w.encode()), "<u4").tolist() != e.ids] == []


def test_words_are_kept_without_the_signs_behind_them():
    encoder = packing.WordEncoder(packing.TOKENIZER)
    text = "anea, Anea. anea!! anea écrite, Écrite don't."
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == MODEL.encode(text, add_special_tokens=False).ids
    assert {w.decode() for w in encoder} == {"anea", ",", ".", "!!", "écrite", "Écrite", "don't."}


def test_latin_letters_and_signs_give_the_ids_of_the_text():
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    words = [a + c + b for c in letters for a in ("", "k", "É") for b in ("", "z", "ß", "!!", "'", ".%%%", "'s.")]
    encoder = packing.WordEncoder(packing.TOKENIZER)
    want = MODEL.encode_batch_fast(words, add_special_tokens=False)
    assert [w for w, e in zip(words, want) if np.frombuffer(encoder.encode(w.encode()), "<u4").tolist() != e.ids] == []


def test_chunks_end_at_white_space():
    text = b"ab cde  f\nghij klm"
    assert b"".join(packing.chunks(text, 4)) == text
    assert sum((p.split() for p in packing.chunks(text, 4)), []) == text.split()
