"""Streams that wait with a deadline, batches that are replayed, and backups before overwriting."""

import json

import pytest

from geolith.sources import files
from geolith.streaming import waiting
from geolith.streaming.versions import VersionedTable, append_batches


def put(folder, n, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{n:03}.json").write_text("\n".join(map(json.dumps, rows)))


def run(spark, folder, out, checkpoint, patience=60_000):
    events = spark.readStream.schema(waiting.EVENTS).option("maxFilesPerTrigger", 1).json(str(folder))
    q = waiting.settled(events, patience).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    q.awaitTermination()
    return sorted((r["tile"], r["source"], r["value"]) for r in spark.read.schema(waiting.SETTLED).parquet(str(out)).collect())


def test_inputs_in_time_and_fallbacks(spark, tmp_path):
    event = lambda tile, kind, value, at: {"tile": tile, "kind": kind, "value": value, "at": f"2024-05-01T10:{at}:00"}
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    put(source, 0, [event("a", "ask", "fa", "00"), event("b", "ask", "fb", "00"), event("early", "input", "ie", "00")])
    put(source, 1, [event("a", "input", "ia", "01"), event("early", "ask", "fe", "01"), event("nobody", "input", "x", "01")])
    put(source, 2, [event("later", "input", "x", "04")])  # b's time is over once this has been seen
    put(source, 3, [event("b", "input", "too late", "05"), event("a", "input", "again", "05"), event("c", "ask", "fc", "05"), event("c", "input", "ic", "05")])
    put(source, 4, [event("later", "input", "y", "59")])
    want = [("a", "input", "ia"), ("b", "fallback", "fb"), ("c", "input", "ic"), ("early", "input", "ie")]
    assert run(spark, source, out, checkpoint) == want
    put(source, 5, [{**event("d", "ask", None, "00"), "at": "2024-05-01T11:10:00"}, {**event("a", "ask", "z", "00"), "at": "2024-05-01T11:10:00"}])
    put(source, 6, [{"tile": "later", "kind": "input", "value": "z", "at": "2024-05-01T12:00:00"}])
    put(source, 7, [{"tile": "later", "kind": "input", "value": "z", "at": "2024-05-01T12:30:00"}])
    assert run(spark, source, out, checkpoint) == sorted([*want, ("d", "fallback", None)], key=str)


def test_a_replayed_batch_is_there_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k LONG, v STRING")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k LONG, v STRING")

    def fails():
        raise RuntimeError("between writing and entering")

    with pytest.raises(RuntimeError):
        table.write(first, 0, enter=fails)
    assert table.read().count() == 0
    table.write(first, 0)
    table.write(first.union(first), 0)  # entered already
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b")] and table.backup().count() == 0
    table.write(spark.createDataFrame([(3, "c")], "k LONG, v STRING"), 1)
    whole = spark.createDataFrame([(9, "new")], "k LONG, v STRING")
    with pytest.raises(RuntimeError):
        table.write(whole, 2, whole=True, enter=fails)
    assert table.read().count() == 3
    table.write(whole, 2, whole=True)
    table.write(spark.createDataFrame([(10, "newer")], "k LONG, v STRING"), 3, whole=True)
    assert [tuple(r) for r in table.read().collect()] == [(10, "newer")]
    assert sorted(r["k"] for r in table.backup().collect()) == [1, 2, 3]  # the first backup stays


def test_a_stream_that_fails_between_batches(spark, tmp_path):
    source = tmp_path / "in"
    table = VersionedTable(spark, str(tmp_path / "t"), "k LONG")
    put(source, 0, [{"k": 1}, {"k": 2}])
    put(source, 1, [{"k": 3}])
    calls = []

    def change(rows):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return rows

    stream = lambda: spark.readStream.schema("k LONG").option("maxFilesPerTrigger", 1).json(str(source))
    with pytest.raises(Exception, match="lost"):
        append_batches(stream(), table, str(tmp_path / "check"), change).awaitTermination()
    append_batches(stream(), table, str(tmp_path / "check"), change).awaitTermination()
    assert sorted(r["k"] for r in table.read().collect()) == [1, 2, 3]


def test_the_first_backup_of_a_file_wins(spark, tmp_path):
    spark.dataSource.register(files.FileSink)
    out = lambda text, name="d/a.txt": spark.createDataFrame([(name, text.encode())], "name STRING, content BINARY").write.format("geolith_files").mode("append").option("backup", str(tmp_path / "kept")).save(str(tmp_path / "out"))
    for text in ("one", "two", "three"):
        out(text)
    out("other", "b.txt")
    assert (tmp_path / "out/d/a.txt").read_text() == "three" and (tmp_path / "kept/d/a.txt").read_text() == "one"
    assert not (tmp_path / "kept/b.txt").exists() and sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["a.txt", "b.txt"]
