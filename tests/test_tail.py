"""The tailing source: planning and reading without Spark, then as a stream."""

import json
import os
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from logbrook.sources import tail
from logbrook.sources.lines import follow_lines, read_lines


def folder(path, **options):
    return tail.Folder({"path": str(path), **{k: str(v) for k, v in options.items()}})


def reader(path, max_bytes=None, registry=None, **options):
    return tail.TailReader(folder(path, **options), max_bytes, registry)


def lines_of(source, parts):
    rows = []
    for part in parts:
        for batch in source.read(part):
            assert isinstance(batch, pa.RecordBatch)
            rows += [tuple(r.values()) for r in batch.to_pylist()]
    return rows


def texts(rows):
    return [r[2] for r in rows]


def put(path, data, mode="ab"):
    with open(path, mode) as f:
        f.write(data)


def test_only_whole_lines_and_exact_offsets(tmp_path):
    log = tmp_path / "a.log"
    put(log, b"one\ntwo\r\npart")
    source = reader(tmp_path)
    start, end = source.initialOffset(), source.latestOffset()
    assert end == {str(log): 9}
    assert lines_of(source, source.partitions(start, end)) == [(str(log), 0, "one"), (str(log), 4, "two")]
    assert source.latestOffset() == end
    put(log, b"ial\nnext\n")
    after = source.latestOffset()
    assert texts(lines_of(source, source.partitions(end, after))) == ["partial", "next"]


def test_offsets_survive_a_new_reader(tmp_path):
    log = tmp_path / "a.log"
    put(log, b"one\n")
    first = reader(tmp_path)
    end = first.latestOffset()
    put(log, b"two\n")
    second = reader(tmp_path)  # knows nothing but the offset from the checkpoint
    after = second.latestOffset()
    assert texts(lines_of(second, second.partitions(end, after))) == ["two"]


def test_files_are_followed_independently(tmp_path):
    put(tmp_path / "a.log", b"a1\n")
    source = reader(tmp_path)
    end = source.latestOffset()
    source.partitions({}, end)
    put(tmp_path / "b.log", b"b1\n")
    put(tmp_path / "notes.txt", b"no log\n")
    after = source.latestOffset()
    assert texts(lines_of(source, source.partitions(end, after))) == ["b1"]


def test_smaller_file_is_read_from_its_start(tmp_path):
    log = tmp_path / "a.log"
    put(log, b"old line 1\nold line 2\n")
    source = reader(tmp_path)
    end = source.latestOffset()
    source.partitions({}, end)
    put(log, b"new\n", "wb")
    after = source.latestOffset()
    assert texts(lines_of(source, source.partitions(end, after))) == ["new"]
    put(log, b"newer\n")
    assert texts(lines_of(source, source.partitions(after, source.latestOffset()))) == ["newer"]


def test_missing_file_keeps_its_offset(tmp_path):
    log = tmp_path / "a.log"
    put(log, b"one\n")
    source = reader(tmp_path)
    end = source.latestOffset()
    source.partitions({}, end)
    os.rename(log, tmp_path / "a.away")
    assert source.latestOffset() == end
    os.rename(tmp_path / "a.away", log)
    assert source.partitions(end, source.latestOffset()) == []


def test_missing_folder_is_empty(tmp_path):
    assert reader(tmp_path / "later").latestOffset() == {}


def test_cap_and_registry(tmp_path):
    lines = [f"line {i}".encode() for i in range(100)]
    put(tmp_path / "a.log", b"\n".join(lines) + b"\n" + b"x" * 500 + b"\nend\n")
    registry = str(tmp_path / "state" / "offsets.json")
    got, start = [], {}
    while True:
        source = reader(tmp_path, max_bytes=64, registry=registry)  # a restart before every batch
        end = source.latestOffset()
        if end == start:
            break
        parts = source.partitions(start, end)
        batch = lines_of(source, parts)
        assert sum(len(line) + 1 for line in texts(batch)) <= 64 or len(batch) == 1
        got += texts(batch)
        start = end
    assert got == [b.decode() for b in lines] + ["x" * 500, "end"]
    with open(registry) as f:
        assert json.load(f) == start


def test_invalid_utf8_does_not_stop_the_stream(tmp_path):
    put(tmp_path / "a.log", b"ok\n\xff\xfe\nok\n")
    source = reader(tmp_path)
    assert len(lines_of(source, source.partitions({}, source.latestOffset()))) == 3


def test_options_are_checked(tmp_path):
    with pytest.raises(ValueError):
        tail.Folder({})
    with pytest.raises(ValueError):
        folder(tmp_path, splitBytes=0)


@settings(max_examples=60, deadline=None)
@given(
    lines=st.lists(st.text(alphabet="aé\r {", max_size=12), max_size=40),
    split=st.integers(1, 50),
    block=st.integers(1, 30),
)
def test_any_split_gives_every_line_once(tmp_path_factory, lines, split, block):
    path = tmp_path_factory.mktemp("split") / "a.log"
    raw = [line.encode() for line in lines]
    put(path, b"".join(r + b"\n" for r in raw))
    expected, at = [], 0
    for r in raw:
        expected.append((str(path), at, r.removesuffix(b"\r").decode()))
        at += len(r) + 1
    source = folder(path.parent)
    old = tail.BLOCK, tail.PROBE
    tail.BLOCK, tail.PROBE = block, block
    try:
        parts = [tail.ByteRange(str(path), low, min(low + split, at), 0, at) for low in range(0, at, split)]
        assert lines_of(source, parts) == expected
    finally:
        tail.BLOCK, tail.PROBE = old


def test_batch_read(spark, tmp_path):
    random.seed(3)
    exact, at = [], 0
    path = tmp_path / "a.log"
    with open(path, "wb") as f:
        for i in range(3000):
            line = f"line {i} " + "é" * random.randint(0, 200)
            exact.append((str(path), at, line))
            at += f.write(line.encode() + b"\n")
        f.write(b"no newline at the end")
    exact.append((str(path), at, "no newline at the end"))
    rows = read_lines(spark, str(tmp_path), offsets=True)
    assert rows.rdd.getNumPartitions() == 1  # below the least split
    assert sorted(tuple(r) for r in rows.collect()) == sorted(exact)
    plain = read_lines(spark, str(tmp_path), offsets=False)
    assert plain.columns == ["file", "off", "line"]
    assert sorted(r["line"] for r in plain.collect()) == sorted(e[2] for e in exact)


def test_relative_folder(spark, tmp_path, monkeypatch):
    put(tmp_path / "a.log", b"one\n")
    monkeypatch.chdir(tmp_path)
    assert [r["line"] for r in read_lines(spark, ".", offsets=True).collect()] == ["one"]


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    got = []

    def run():
        query = (
            follow_lines(spark, str(source))
            .writeStream.foreachBatch(lambda df, _: got.extend(r["line"] for r in df.collect()))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        out, got[:] = sorted(got), []
        return out

    put(source / "a.log", b"one\ntwo\nthr")
    assert run() == ["one", "two"]
    assert run() == []
    put(source / "a.log", b"ee\n")
    put(source / "b.log", b"other\n")
    assert run() == ["other", "three"]
    put(source / "a.log", b"fresh\n", "wb")
    assert run() == ["fresh"]


def test_capped_stream_loses_nothing(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    put(source / "a.log", b"".join(b"line %d\n" % i for i in range(500)))
    sizes = []
    query = (
        follow_lines(
            spark, str(source), maxBytesPerTrigger=1500, registry=str(tmp_path / "state" / "o.json")
        )
        .writeStream.foreachBatch(lambda df, _: sizes.append(df.count()))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(processingTime="0 seconds")
        .start()
    )
    query.processAllAvailable()
    query.stop()
    assert sum(sizes) == 500 and len(sizes) >= 3 and max(sizes) < 250
