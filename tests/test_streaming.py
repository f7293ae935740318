from datetime import datetime, timedelta

import pytest
from conftest import plan_of

from loadloom.session import numbered_folders
from loadloom.streaming import keyed_sync

DDL = "k string, v bigint, x double"


def write(spark, folder, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def setup(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], DDL).schema

    def sync(files=1000):
        keyed_sync.sync(keyed_sync.read_stream(spark, source, schema, files), target, "k", ["v"])

    def state():
        return {tuple(r) for r in keyed_sync.read_state(spark, target, schema, "k", ["v"]).collect()}

    return source, target, schema, sync, state


def test_latest_wins_over_several_syncs(spark, setup):
    source, target, schema, sync, state = setup
    assert state() == set()
    write(spark, source, [("a", 1, 1.0), ("a", 3, 3.0), ("b", 1, 1.0)])
    sync()
    assert state() == {("a", 3, 3.0), ("b", 1, 1.0)}
    write(spark, source, [("a", 2, 2.0), ("c", 1, None)])  # a late row for a
    sync()
    after = {("a", 3, 3.0), ("b", 1, 1.0), ("c", 1, None)}
    assert state() == after
    sync()
    assert state() == after


def test_compaction_changes_nothing_and_syncs_go_on(spark, setup):
    source, target, schema, sync, state = setup
    for i in range(3):
        write(spark, source, [("a", i, float(i)), (f"k{i}", 1, 0.0)])
        sync()
    before = state()
    keyed_sync.compact(spark, target, schema, "k", ["v"])
    assert state() == before
    at = keyed_sync.layout(spark, target)
    assert not at.log and all("/base/upto=2/" in p for p in at.base.values())
    write(spark, source, [("a", 9, 9.0)])
    sync()
    assert ("a", 9, 9.0) in state() and len(state()) == len(before)


def test_a_batch_written_twice_counts_once(spark, setup):
    source, target, schema, sync, state = setup
    write(spark, source, [("a", 1, 1.0)])
    sync()
    (path,) = keyed_sync.layout(spark, target).log
    keyed_sync._write(spark.createDataFrame([("a", 1, 1.0)], DDL), path, "k", keyed_sync.PARTS)
    assert state() == {("a", 1, 1.0)}


def test_unfinished_batch_is_not_read(spark, setup):
    source, target, schema, sync, state = setup
    write(spark, source, [("a", 1, 1.0)])
    sync()
    spark.createDataFrame([("a", 5, 5.0)], DDL).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{target}/log/batch=99")
    assert state() == {("a", 1, 1.0)}


def test_many_small_batches_equal_one_large(spark, setup):
    source, target, schema, sync, state = setup
    for i in range(4):
        write(spark, source, [("a", i, float(i)), ("b", -i, float(i))])
    sync(files=1)
    assert state() == {("a", 3, 3.0), ("b", 0, 0.0)}
    assert len(keyed_sync.layout(spark, target).log) == 4


def test_untouched_parts_stay_and_are_read_without_a_shuffle(spark, setup):
    source, target, schema, sync, state = setup
    write(spark, source, [(f"k{i}", 1, float(i)) for i in range(40)])
    sync()
    keyed_sync.compact(spark, target, schema, "k", ["v"])
    first = keyed_sync.layout(spark, target).base
    assert "Exchange" not in plan_of(keyed_sync.read_state(spark, target, schema, "k", ["v"]))
    write(spark, source, [("k7", 2, 7.5)])
    sync()
    keyed_sync.compact(spark, target, schema, "k", ["v"])
    second = keyed_sync.layout(spark, target).base
    assert sum(first[p] != second[p] for p in first) == 1 and first.keys() == second.keys()
    before = state()
    keyed_sync.vacuum(spark, target)
    assert state() == before and ("k7", 2, 7.5) in before and len(before) == 40
    assert numbered_folders(spark, f"{target}/log", "batch") == []


def test_deletions_composite_keys_and_maps(spark, tmp_path):
    ddl = "a string, b int, v bigint, m map<string,int>, gone boolean"
    source, target = str(tmp_path / "in") + "/", str(tmp_path / "out")
    schema = spark.createDataFrame([], ddl).schema

    def step(*rows):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(source)
        keyed_sync.sync(keyed_sync.read_stream(spark, source, schema), target, ["a", "b"], ["v"])

    def state():
        rows = keyed_sync.read_state(spark, target, schema, ["a", "b"], ["v"], "gone").collect()
        return sorted((r["a"], r["b"], r["v"], r["m"]) for r in rows)

    step(("x", 1, 1, {"p": 1}, None), ("x", 2, 1, {}, False), ("y", 1, 1, None, False))
    step(("x", 1, 5, None, True))
    assert state() == [("x", 2, 1, {}), ("y", 1, 1, None)]
    keyed_sync.compact(spark, target, schema, ["a", "b"], ["v"])
    step(("x", 1, 4, {"late": 1}, False), ("y", 1, 2, {"q": 2}, False))
    assert state() == [("x", 2, 1, {}), ("y", 1, 2, {"q": 2})]


def test_the_number_of_parts_is_kept_and_another_one_refused(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], DDL).schema
    take = lambda parts: keyed_sync.sync(keyed_sync.read_stream(spark, source, schema), target, "k", ["v"], parts)
    write(spark, source, [(f"k{i}", 1, float(i)) for i in range(1000)])
    take(8)
    with pytest.raises(ValueError, match=r"\[8\] parts, not 10"):
        keyed_sync.compact(spark, target, schema, "k", ["v"], 10)
    keyed_sync.compact(spark, target, schema, "k", ["v"])
    write(spark, source, [(f"k{i}", 2, float(i)) for i in range(500, 1500)])
    with pytest.raises(ValueError, match="parts"):
        take(64)
    take(None)
    keyed_sync.compact(spark, target, schema, "k", ["v"], 8)
    keyed_sync.vacuum(spark, target)
    rows = keyed_sync.read_state(spark, target, schema, "k", ["v"]).collect()
    assert sorted(r["k"] for r in rows) == sorted(f"k{i}" for i in range(1500))
    assert all(r["v"] == (2 if int(r["k"][1:]) >= 500 else 1) for r in rows)


EVENTS = "k string, t timestamp, n int, gone boolean"


@pytest.fixture
def expiring(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], EVENTS).schema
    start = datetime(2024, 1, 1)

    def step(*rows, compact=True, keep=10):
        rows = [(k, None if day is None else start + timedelta(days=day), n, gone) for k, day, n, gone in rows]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)
        keyed_sync.sync(keyed_sync.read_stream(spark, source, schema), target, "k", ["n"], 4, "t")
        if compact:
            keyed_sync.compact(spark, target, schema, "k", ["n"], None, "gone", "t", timedelta(days=keep))

    def state(deleted=None):
        return {(r["k"], r["n"]) for r in keyed_sync.read_state(spark, target, schema, "k", ["n"], deleted).collect()}

    def late():
        return {(r["k"], r["n"]) for r in keyed_sync.read_late(spark, target, schema).collect()}

    return target, step, state, late


def test_deletions_expire_and_later_rows_are_reported(spark, expiring):
    target, step, state, late = expiring
    step(("a", 0, 1, False), ("b", 0, 1, False), ("c", 0, 1, None))
    step(("a", 1, 2, True), ("b", 8, 2, True))
    assert state("gone") == {("c", 1)} and state() == {("a", 2), ("b", 2), ("c", 1)}
    step(("d", 12, 1, False))  # the watermark is day 2: the deletion of a leaves
    assert state() == {("b", 2), ("c", 1), ("d", 1)} and late() == set()
    step(("a", 1, 9, False), ("b", 3, 1, False), ("e", None, 1, False))  # too late; in time but older than the deletion; no time
    assert late() == {("a", 9)} and state("gone") == {("c", 1), ("d", 1), ("e", 1)}
    step(("d", 5, 2, False))  # an older time moves no watermark
    assert keyed_sync.watermark(spark, target) == 1_704_067_200_000_000 + 2 * 86_400_000_000
    keyed_sync.vacuum(spark, target)
    assert state() == {("b", 2), ("c", 1), ("d", 2), ("e", 1)}
    step(("f", 30, 1, True))
    assert state() == {("c", 1), ("d", 2), ("e", 1), ("f", 1)}


def test_deletions_are_bounded_over_many_batches(spark, expiring):
    target, step, state, late = expiring
    for day in range(12):
        step((f"k{day}", day, 1, False), (f"k{day}", day, 2, True), keep=2)
        assert len(state()) <= 3
    assert state("gone") == set() and late() == set()


def test_a_compaction_that_fails_after_the_watermark_keeps_the_deletions(spark, expiring, monkeypatch):
    target, step, state, late = expiring
    step(("a", 0, 1, False), ("a", 1, 2, True))
    with monkeypatch.context() as m:
        m.setattr(keyed_sync, "_resolved", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            step(("b", 20, 1, False))
    assert ("a", 2) in state() and state("gone") == {("b", 1)}
    step(("a", 1, 3, False))
    assert late() == {("a", 3)} and state() == {("b", 1)}


def test_expiry_needs_its_columns(spark, setup):
    source, target, schema, sync, state = setup
    write(spark, source, [("a", 1, 1.0)])
    sync()
    with pytest.raises(ValueError, match="keep_for"):
        keyed_sync.compact(spark, target, schema, "k", ["v"], keep_for=timedelta(days=1))
