import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from logbrook.llm import suffix_array as sa


def brute(texts):
    """Removed byte positions of each text, from a count of all windows."""
    data = [(t or "").encode() if not isinstance(t, bytes) else t for t in texts]
    counts = Counter(b[i : i + sa.LENGTH] for b in data for i in range(len(b) - sa.LENGTH + 1))
    gone = []
    for b in data:
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - sa.LENGTH + 1):
            if counts[b[i : i + sa.LENGTH]] > 1:
                mask[i : i + sa.LENGTH] = True
        gone.append(mask)
    return data, gone


def expected(rows):
    out = []
    data, gone = brute([r[1] for r in rows])
    for (doc_id, *_), b, mask in zip(rows, data, gone):
        left = np.frombuffer(b, np.uint8)[~mask].tobytes()
        spans = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        out.append((doc_id, len(b), int(mask.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def measured(df):
    ranges = sa.with_ranges(df)
    out = []
    for r in ranges.collect():
        left, gone = sa.cut((r["text"] or "").encode(), r["__ranges"])
        out.append((r["doc_id"], len((r["text"] or "").encode()), len((r["text"] or "").encode()) - len(left), len(gone), hashlib.sha256(left).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=str)


def test_hard_rows_as_brute_force(hard):
    rows = [tuple(r) for r in hard.collect()]
    assert order(measured(hard)) == order(expected(rows))


def test_query_as_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert order(map(tuple, sa.op1_suffix_array_dedup(spark, sf_dir).collect())) == order(expected(rows))


def test_groups_cut_over_chunks_and_buckets(spark, monkeypatch):
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(260))
    texts = ["".join(rng.choice("xyz ") for _ in range(rng.randrange(0, 90))) + shared[: rng.choice([199, 200, 230, 260])] + str(i) * 40 for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    records = df.selectExpr("doc_id as __row", "text as __text")
    bitmap = np.full(1 << 17, 255, np.uint8)
    batches = list(sa._records(records.toArrow().to_batches(), bitmap, 1 << 20))
    live = [r for b in batches for r in b.to_pylist() if r["context"] is not None]
    live.sort(key=lambda r: (r["lead"], r["hash"], r["salt"]))
    monkeypatch.setattr(sa, "_CHUNK_RECORDS", 7)
    import pandas as pd
    import pyarrow as pa

    kinds = batches[0].schema
    ranges = [(r["row"], r["start"], r["stop"]) for b in batches for r in b.to_pylist() if r["context"] is None]
    edges = []
    for at in range(0, len(live), 50):
        for out in sa._bucket(iter([pa.RecordBatch.from_pylist(live[at : at + 50], schema=kinds)]), 3):
            for r in out.to_pylist():
                if r["row"] is not None:
                    ranges.append((r["row"], r["start"], r["stop"]))
                else:
                    edges.append(r)
    for _, group in pd.DataFrame(edges).groupby("part"):
        ranges += list(sa._across((0,), group).itertuples(index=False, name=None))
    _, gone = brute(texts)
    for number, mask in enumerate(gone):
        found = np.zeros(len(mask), bool)
        for row, start, stop in ranges:
            if row == number:
                found[start:stop] = True
        assert np.array_equal(found, mask), number


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(sa, "_PIECE", 1000)
    rng = random.Random(4)
    passage = bytes(rng.randrange(97, 123) for _ in range(333))
    text = bytes(rng.randrange(97, 123) for _ in range(2900)) + passage + bytes(rng.randrange(97, 123) for _ in range(1500)) + passage
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"__row": [0], "__text": [text.decode()]})
    leads = pa.Table.from_batches(sa._leads(iter([batch])))
    hashes = leads.column("hash").to_pylist()
    assert len(hashes) > len(set(hashes))
    starts = set()
    for buffer in sa._buffers(iter([batch])):
        found = buffer.anchors()
        for first, last, piece, begin in zip(found["first"], found["last"], found["piece"], found["begins"][found["piece"]]):
            starts |= {int(p - begin) + buffer.offsets[piece] for p in range(first, last + 1)}
    assert starts == set(range(len(text) - sa.LENGTH + 1))


def test_multikey_order():
    rng = np.random.default_rng(2)
    strings = rng.integers(0, 2, (300, 24)).astype(np.uint8)
    strings[:, :14] = 0
    groups = rng.integers(0, 4, 300)
    order_ = sa.multikey_order(groups, strings.view(">u8"))
    keys = [(groups[i], strings[i].tobytes()) for i in order_]
    assert keys == sorted(keys) and sorted(order_) == list(range(300))


def test_texts_are_cut_and_rows_kept(hard, none):
    rows = [tuple(r) for r in hard.collect()]
    data, gone = brute([r[1] for r in rows])
    want = []
    for r, b, mask in zip(rows, data, gone):
        text = None if r[1] is None else np.frombuffer(b, np.uint8)[~mask].tobytes().decode(errors="ignore")
        want.append((r[0], text, r[2], r[3], len(text or "") if mask.any() else len(r[1] or "")))
    assert order(map(tuple, sa.remove_repeats(hard).collect())) == order(want)
    assert sa.remove_repeats(none).count() == 0


@pytest.mark.parametrize("ranges, left", [(None, b"abcdef"), ([(1, 3), (2, 4)], b"aef"), ([(0, 6)], b""), ([(0, 1), (1, 2)], b"cdef")])
def test_cut(ranges, left):
    spans = None if ranges is None else [{"start": a, "stop": b} for a, b in ranges]
    assert sa.cut(b"abcdef", spans)[0] == left
