"""Tables that follow change streams, sinks that appear together, merged folders and numbered lines."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodewright.sinks import commits, compaction
from lodewright.sinks.fanout import Sink, read_together, write_together
from lodewright.sources.lines import numbered_lines
from lodewright.streaming import folded
from lodewright.streaming.changes import start_changes, stream_changes
from lodewright.streaming.jobs import start_copy
from lodewright.streaming.keyed import keyed_changes, state_session
from lodewright.streaming.settings import StreamSettings

SCHEMA = "id int, seq int, op string, name string"


def _files(path) -> set[str]:
    return {str(file.relative_to(path)) for file in Path(path).rglob("*.parquet")}


def _last(changes, deleted=False):
    """The last change of each key."""
    out = {}
    for row in changes:
        if row[0] not in out or (row[1] or -1) > (out[row[0]][1] or -1):
            out[row[0]] = row
    return sorted((r for r in out.values() if deleted or r[2] != "D"), key=str)


class _Follower:
    """A change stream into a folded table, part by part."""

    def __init__(self, spark, tmp_path, buckets=16):
        self.spark, self.path, self.buckets = spark, tmp_path, buckets
        self.checkpoint = "checkpoint-1"

    def feed(self, rows):
        frame = self.spark.createDataFrame(rows, SCHEMA)
        frame.coalesce(2).write.mode("append").parquet(f"{self.path}/files")
        return self.stream()

    def stream(self):
        settings = StreamSettings(f"{self.path}/{self.checkpoint}")
        changes = stream_changes(self.spark, f"{self.path}/files", SCHEMA, max_files=1)
        start_changes(changes, f"{self.path}/batches", ["id"], ["seq"], settings, f"{self.path}/log").awaitTermination()
        return self

    def fold(self):
        return folded.fold_new(
            self.spark, f"{self.path}/table", f"{self.path}/batches", f"{self.path}/log", SCHEMA, ["id"], ["seq"], self.buckets
        )

    def rows(self):
        return sorted(map(tuple, folded.folded_rows(self.spark, f"{self.path}/table", SCHEMA).collect()), key=str)


def test_a_fold_rewrites_only_the_buckets_of_new_changes(spark, tmp_path):
    chance = random.Random(3)
    first = [(chance.randrange(60), seq, chance.choice("UUUD"), f"n{seq}") for seq in range(400)]
    own = _Follower(spark, tmp_path)
    assert own.rows() == [] and own.fold() == []
    touched = own.feed(first).fold()
    assert 8 < len(touched) <= 16
    assert own.rows() == _last(first)
    assert own.fold() == []
    before = _files(tmp_path / "table" / "data")

    # One key changes; a change that comes late, and one of a deleted key, undo nothing.
    gone = next(row[0] for row in _last(first, deleted=True) if row[2] == "D")
    late = [(7, 1000, "U", "new"), (7, -5, "D", "late"), (gone, 0, "U", "late")]
    rewritten = own.feed(late).fold()
    assert len(rewritten) <= 2
    after = _files(tmp_path / "table" / "data")
    assert before < after
    assert {name.split("/")[1] for name in after - before} == {f"key_bucket={n}" for n in rewritten}
    assert own.rows() == _last(first + late)


def test_a_fold_reads_no_folded_batch_again(spark, tmp_path):
    own = _Follower(spark, tmp_path)
    own.feed([(1, 1, "U", "a"), (2, 2, "U", "b")]).fold()
    for file in (tmp_path / "batches").rglob("*.parquet"):
        file.write_bytes(b"not readable")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    own.feed([(3, 3, "U", "c")]).fold()
    assert [row[0] for row in own.rows()] == [1, 2, 3]


def test_a_lost_checkpoint_overwrites_no_batch(spark, tmp_path):
    own = _Follower(spark, tmp_path)
    own.feed([(1, 1, "U", "a")]).fold()
    own.checkpoint = "checkpoint-2"
    own.feed([(1, 2, "U", "b")])
    assert len(list((tmp_path / "batches").glob("run_id=*"))) == 2
    own.fold()
    assert own.rows() == [(1, 2, "U", "b")]


def test_a_fold_that_is_cut_off_is_done_again(spark, tmp_path, monkeypatch):
    own = _Follower(spark, tmp_path)
    own.feed([(i, i, "U", "a") for i in range(20)]).fold()
    own.feed([(3, 100, "D", None), (50, 101, "U", "z")])
    held = own.rows()

    def broken(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "put", broken)
        with pytest.raises(OSError):
            own.fold()
    assert own.rows() == held
    assert own.fold()
    assert [row[0] for row in own.rows()] == sorted([i for i in range(20) if i != 3] + [50], key=lambda i: str((i,)))
    with pytest.raises(ValueError):
        folded.fold_new(spark, f"{tmp_path}/table", f"{tmp_path}/batches", f"{tmp_path}/log", SCHEMA, ["id"], ["seq"], 2)


def test_sinks_appear_together_or_not_at_all(spark, tmp_path):
    log, schema = f"{tmp_path}/log", "id bigint"
    fails = [True]

    def second(rows):
        if fails[0]:
            raise OSError("lost")
        return rows.select("id")

    sinks = [Sink(f"{tmp_path}/a", lambda rows: rows.where("id < 5")), Sink(f"{tmp_path}/b", second, "json")]

    def seen(name, kind="parquet"):
        return sorted(row.id for row in read_together(spark, f"{tmp_path}/{name}", log, schema, kind).collect())

    with pytest.raises(OSError):
        write_together(spark.range(8), sinks, log, "set")
    assert any((tmp_path / "a").rglob("*.parquet"))
    assert seen("a") == seen("b", "json") == []
    fails[0] = False
    for _ in range(2):
        write_together(spark.range(8), sinks, log, "set")
        assert (seen("a"), seen("b", "json")) == ([0, 1, 2, 3, 4], list(range(8)))
    fails[0] = True
    with pytest.raises(OSError):
        write_together(spark.range(10, 14), sinks, log, "set", batch=1)
    assert seen("b", "json") == list(range(8))


def test_the_log_keeps_the_last_entries_only(spark, tmp_path):
    for number in range(2 * commits.SLOTS + 1):
        commits.put(spark.range(number % 3 + 1), f"{tmp_path}/log", "own", number)
    commits.put(spark.range(1), f"{tmp_path}/log", "other", 4)
    rows = commits.newest(spark, f"{tmp_path}/log", "id long").collect()
    assert sorted((r["name"], r[commits.NUMBER]) for r in rows) == [("other", 4)] + [("own", 32)] * 3
    assert len(list((tmp_path / "log" / "name=own").glob("slot=*"))) == commits.SLOTS
    assert commits.newest(spark, f"{tmp_path}/none", "id long") is None


def test_finished_folders_are_merged_once(spark, tmp_path):
    source, target, parts = f"{tmp_path}/small", f"{tmp_path}/merged", ["day", "kind"]
    rows = spark.range(300).selectExpr("id", "concat('2024-01-0', id % 3 + 1) day", "if(id % 2 = 0, 'a b', null) kind")
    rows.repartition(12).write.partitionBy(*parts).json(source)
    schema = "id bigint, day string, kind string"

    def found():
        read = compaction.read_merged(spark, source, target, "json", schema, parts)
        return sorted(map(tuple, read.select("id", "day", "kind").collect()), key=str)

    wanted = found()
    assert len(wanted) == 300
    assert compaction.retired(spark, source, target, parts).count() == 0
    for last, number, folders in (("2024-01-02", 0, 2), ("2024-01-03", 1, 2), ("2024-01-03", None, 0)):
        todo = compaction.plan(spark, source, target, parts, F.col("day") < last)
        assert todo.count() == folders
        assert compaction.run(spark, todo, source, target, "json", schema, parts) == number
        assert found() == wanted
    assert len(list(Path(target, "data").rglob("*.json"))) == 4
    assert {r.day for r in compaction.retired(spark, source, target, parts).collect()} == {"2024-01-01", "2024-01-02"}

    # More bytes than a bin holds make more bins; folders that are merged stay out of the plan.
    small = compaction.plan(spark, source, target, parts, F.lit(True), file_bytes=400)
    assert {(r.day, r.bins > 1, r.files > r.bins) for r in small.collect()} == {("2024-01-03", True, True)}
    extra = spark.createDataFrame([(999, "2024-01-01", "a b")], schema)
    extra.write.mode("append").partitionBy(*parts).json(source)
    with pytest.raises(ValueError):
        compaction.plan(spark, source, target, parts, F.lit(True))


def test_a_table_is_pointed_at_merged_folders(spark, tmp_path):
    source, target = f"{tmp_path}/small", f"{tmp_path}/merged"
    spark.range(40).selectExpr("id", "id % 2 part").repartition(6).write.partitionBy("part").json(source)
    spark.sql(f"CREATE TABLE merged_parts (id BIGINT, part STRING) USING json PARTITIONED BY (part) LOCATION '{source}'")
    spark.sql("MSCK REPAIR TABLE merged_parts")
    todo = compaction.plan(spark, source, target, ["part"], F.col("part") == "1")
    number = compaction.run(spark, todo, source, target, "json", "id bigint", ["part"])
    compaction.publish_merged(spark, "merged_parts", target, ["part"], number)
    files = {row.f.split("/")[-4] if "run_number" in row.f else "small" for row in spark.table("merged_parts").select(F.input_file_name().alias("f")).collect()}
    assert files == {"small", "data"} or len(files) == 2
    assert sorted(row.id for row in spark.table("merged_parts").collect()) == list(range(40))


def test_lines_keep_their_numbers_over_splits(spark, tmp_path):
    chance = random.Random(5)
    files = {f"f{i}": [("x" * chance.randrange(30)) + str(n) for n in range(chance.choice([1, 400, 3000]))] for i in range(4)}
    files["blank"] = ["", "", "a", ""]
    (tmp_path / "text").mkdir()
    for name, lines in files.items():
        (tmp_path / "text" / name).write_text("\n".join(lines) + "\n")
    (tmp_path / "text" / "empty").write_text("")
    wanted = sorted((name, i + 1, line) for name, lines in files.items() for i, line in enumerate(lines))
    for size in ("1k", "100m"):
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", size)
        session.conf.set("spark.sql.files.openCostInBytes", "1")
        found = numbered_lines(session, f"{tmp_path}/text").collect()
        assert sorted((r.file.split("/")[-1], r.line_no, r.value) for r in found) == wanted


def test_keyed_state_passes_on_what_is_later(spark, tmp_path):
    session = state_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    settings = StreamSettings(f"{tmp_path}/checkpoint")

    def feed(rows, keep_days=1.0):
        session.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/files")
        changes = stream_changes(session, f"{tmp_path}/files", SCHEMA)
        passed = keyed_changes(changes, ["id"], ["seq"], keep_days=keep_days)
        start_copy(passed, f"{tmp_path}/passed", settings, "parquet").awaitTermination()
        read = spark.read.schema(passed.schema).parquet(f"{tmp_path}/passed")
        return sorted(((r.id, r.version, r.seq, r.op, r.name) for r in read.collect()), key=str)

    first = feed([(1, 5, "U", "a"), (1, 4, "U", "b"), (2, 3, "D", None), (3, None, "U", "c"), (None, 1, "U", "n")])
    assert first == sorted([(1, 1, 5, "U", "a"), (2, 1, 3, "D", None), (3, 1, None, "U", "c"), (None, 1, 1, "U", "n")], key=str)
    # Late, repeated, of a deleted key, first after a null; and one that is later.
    second = feed([(1, 4, "D", "x"), (1, 5, "U", "again"), (2, 2, "U", "late"), (3, 0, "U", "d"), (None, 2, "D", "n")])
    assert second == sorted([*first, (3, 2, 0, "U", "d"), (None, 2, 2, "D", "n")], key=str)
    third = feed([(1, 6, "D", "e")], keep_days=0)
    assert third == sorted([*second, (1, 2, 6, "D", "e")], key=str)
    # The deletion's time has run out with the batch after it; then older changes are those of a new key.
    feed([(9, 1, "U", "f")], keep_days=0)
    last = feed([(1, 1, "U", "g"), (2, 1, "U", "late")], keep_days=0)
    assert (1, 1, 1, "U", "g") in last and not any(row[4] == "late" for row in last)
