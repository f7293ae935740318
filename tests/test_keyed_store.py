import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loadloom.operators.keys import unseen_rows
from loadloom.session import numbered_folders, scratch_path
from loadloom.sources import keyed_store
from loadloom.streaming import keyed_sync

DDL = "id string, n bigint, x double, m map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame([(i, n, float(n), {"a": n}) for i, n in rows], DDL)


def ids(df):
    return sorted((r["id"], r["n"]) for r in df.select("id", "n").collect())


@pytest.fixture
def target(spark):
    return scratch_path(spark, "store")


def rows_upto(n, value=0):
    return [(str(i), value) for i in range(n)]


def test_versions_share_the_folders_of_equal_parts(spark, target):
    assert keyed_store.version(spark, target) is None
    assert keyed_store.publish(frame(spark, rows_upto(200)), target, "id", 16) == 0
    changed = [(i, 7 if i == "5" else n) for i, n in rows_upto(200)]
    assert keyed_store.publish(frame(spark, changed).repartition(3), target, "id") == 1
    first, second = (keyed_store.version(spark, target, v) for v in (0, 1))
    assert len(set(first.paths()) - set(second.paths())) == 1 and len(first.paths()) == 16
    assert ids(keyed_store.read(spark, target, 0)) == sorted(rows_upto(200))
    assert ids(keyed_store.read(spark, target)) == sorted(changed)
    # Nothing changed, all gone, and back.
    assert keyed_store.publish(frame(spark, changed), target, "id") == 2
    assert keyed_store.version(spark, target, 2).paths() == second.paths()
    assert keyed_store.publish(frame(spark, []), target, "id") == 3
    assert keyed_store.read(spark, target).count() == 0 and keyed_store.read(spark, target).columns == ["id", "n", "x", "m"]
    assert keyed_store.publish(frame(spark, rows_upto(3)), target, "id", 16) == 4
    assert ids(keyed_store.read(spark, target, 2)) == sorted(changed)


def test_settings_are_kept_and_bad_batches_refused(spark, target):
    keyed_store.publish(frame(spark, rows_upto(20)), target, "id", 4)
    with pytest.raises(ValueError, match="4 parts"):
        keyed_store.publish(frame(spark, rows_upto(20)), target, "id", 8)
    with pytest.raises(ValueError, match="parts by"):
        keyed_store.publish(frame(spark, rows_upto(20)), target, "n")
    with pytest.raises(ValueError, match="columns"):
        keyed_store.publish(frame(spark, rows_upto(20)).drop("x"), target, "id")
    for bad in ([("1", 1), ("1", 2)], [(None, 1)]):
        for store in (keyed_store.append_unseen, keyed_store.publish):
            with pytest.raises(ValueError, match="not a key"):
                store(frame(spark, bad), target)
    with pytest.raises(ValueError, match="no version 7"):
        keyed_store.read(spark, target, 7)
    with pytest.raises(ValueError, match="does not exist"):
        keyed_store.append_unseen(frame(spark, []), target + "x")
    assert keyed_store.versions(spark, target) == [0]


@pytest.mark.parametrize("step", ["_filters", "repartition", "coalesce"])
def test_a_failed_version_does_not_exist_and_is_written_over(spark, target, monkeypatch, step):
    keyed_store.publish(frame(spark, rows_upto(30)), target, "id", 4)
    new = frame(spark, rows_upto(40, 1))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed_store if step == "_filters" else type(new), step, crash)
        with pytest.raises(RuntimeError):
            keyed_store.publish(new, target, "id")
    assert ids(keyed_store.read(spark, target)) == sorted(rows_upto(30))
    assert keyed_store.publish(new, target, "id") == 1
    assert ids(keyed_store.read(spark, target)) == sorted(rows_upto(40, 1))


def test_appends_equal_the_anti_join_and_read_only_what_may_hold_a_key(spark, target):
    keyed_store.publish(frame(spark, rows_upto(3000)), target, "id", 8)
    at = keyed_store.version(spark, target)
    rng = random.Random(1)
    new = frame(spark, [(f"new {i}", 1) for i in range(500)])
    few = keyed_store.folders_that_may_hold(new, target, at)
    assert few.count() <= 20  # of 500: false positives
    old = frame(spark, [(str(rng.randrange(3000)), 1)])
    only = keyed_store.folders_that_may_hold(old, target, at).collect()
    assert len(only) == 1 and only[0]["path"].endswith(f"={only[0]['part']}")
    read = keyed_store.unseen_in(old, target, at).inputFiles()
    assert len([f for f in read if "/data/" in f]) == 1
    every = keyed_store.folders_that_may_hold(frame(spark, rows_upto(3000)), target, at)
    assert every.count() == 3000  # no key is ever ruled out wrongly
    batch = frame(spark, rows_upto(3100, 9)).unionByName(new)
    want = ids(unseen_rows(batch, keyed_store.read(spark, target), "id"))
    assert ids(keyed_store.unseen_in(batch, target, at)) == want and len(want) == 600
    assert keyed_store.append_unseen(batch, target) == 1
    assert keyed_store.append_unseen(batch, target) is None
    assert ids(keyed_store.read(spark, target)) == sorted(rows_upto(3000) + want)
    assert keyed_store.append_unseen(frame(spark, rows_upto(3200, 4)), target) == 2
    folded = keyed_store.fold(spark, target)
    assert folded == 3 and keyed_store.fold(spark, target) is None
    assert len(keyed_store.version(spark, target).paths()) == 8
    assert keyed_store.changes_between_versions(spark, target, 2, 3, ["n"]).count() == 0
    assert keyed_store.publish(keyed_store.read(spark, target), target, "id") == 4
    assert keyed_store.version(spark, target).paths() == keyed_store.version(spark, target, 3).paths()


def test_changes_read_no_folder_that_both_versions_have(spark, target):
    before = rows_upto(400)
    keyed_store.publish(frame(spark, before), target, "id", 32)
    after = [(i, 5 if i == "17" else n) for i, n in before if i != "250"] + [("new", 1)]
    keyed_store.publish(frame(spark, after), target, "id")
    changes = keyed_store.changes_between_versions(spark, target, 0, 1, ["n", "x"])
    got = {(r["id"], r["change"], r["old_n"], r["new_n"]) for r in changes.collect()}
    assert got == {("17", "update", 0, 5), ("250", "delete", 0, None), ("new", "insert", None, 1)}
    shared = {p for _, p in keyed_store.version(spark, target, 0).paths()} & {p for _, p in keyed_store.version(spark, target, 1).paths()}
    assert len(shared) >= 28
    files = changes.inputFiles()
    assert files and not any(p + "/" in f for p in shared for f in files)


def test_the_feed_of_all_versions_leads_a_sync_to_the_last_one(spark, target):
    states = [rows_upto(50), rows_upto(45, 1), [("7", 3)] + [(str(i), 1) for i in range(20, 60)], []]
    out = scratch_path(spark, "synced")
    for n, rows in enumerate(states):
        keyed_store.publish(frame(spark, rows), target, "id", 8)
        keyed_store.store_changes(spark, target, n, ["n", "m"])
        if n == 1:
            keyed_store.store_changes(spark, target, n, ["n", "m"])
        feed = keyed_store.read_changes(spark, target)
        keyed_sync.sync(feed, out, "id", ["version"], 4)
        state = keyed_sync.read_state(spark, out, feed.schema, "id", ["version"], "deleted")
        assert ids(state) == sorted(rows)


def test_old_versions_expire_with_the_folders_that_no_kept_one_has(spark, target):
    for n in range(5):
        rows = [(i, n if int(i) % 25 == n else 0) for i, _ in rows_upto(100)]
        keyed_store.publish(frame(spark, rows), target, "id", 8)
    before = {v: ids(keyed_store.read(spark, target, v)) for v in (3, 4)}
    held = {p for v in (3, 4) for _, p in keyed_store.version(spark, target, v).paths()}
    assert keyed_store.expire(spark, target) == [0, 1, 2] and keyed_store.versions(spark, target) == [3, 4]
    assert {v: ids(keyed_store.read(spark, target, v)) for v in (3, 4)} == before
    left = {f"data/version={v}/part={p}" for v in numbered_folders(spark, f"{target}/data", "version", False) for p in numbered_folders(spark, f"{target}/data/version={v}", "part", False)}
    assert left == held
    assert keyed_store.append_unseen(frame(spark, rows_upto(110, 1)), target) == 5
    assert len(ids(keyed_store.read(spark, target))) == 110
    assert keyed_store.changes_between_versions(spark, target, 3, 5, ["n"]).where("change = 'insert'").count() == 10
    assert keyed_store.expire(spark, target, 9) == []


def test_point_lookups_prune_parts_at_run_time(spark, target):
    keyed_store.publish(frame(spark, rows_upto(500, 2)), target, "id", 64)
    asked = spark.createDataFrame([("3", 1), ("4", 2), ("3", 3), ("none", 4), (None, 5)], "id string, at int")
    found = keyed_store.point_lookup(asked, target, ["n", "x"])
    assert "dynamicpruning" in plan_of(found).lower()
    got = sorted((r["at"], r["id"], r["n"], r["x"]) for r in found.collect())
    assert got == [(1, "3", 2, 2.0), (2, "4", 2, 2.0), (3, "3", 2, 2.0), (4, "none", None, None), (5, None, None, None)]
    scans = [s for s in _scans(found) if "part#" in s.toString()]
    assert scans and max(s.metrics().apply("numPartitions").value() for s in scans) <= 4


def test_more_requests_than_fit_a_broadcast_give_the_same(spark, target, no_broadcast, monkeypatch):
    monkeypatch.setattr(keyed_store, "MOST_REQUESTS", 50)
    keyed_store.publish(frame(spark, rows_upto(500, 2)), target, "id", 8)
    asked = spark.range(400, 600).select(F.col("id").cast("string").alias("id"))
    found = keyed_store.point_lookup(asked, target, ["n"])
    assert "dynamicpruning" not in plan_of(found).lower()
    assert tuple(found.agg(F.count("*"), F.count("n")).first()) == (200, 100)


def _scans(df):
    def below(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            yield from below(plan.executedPlan())
            return
        if "QueryStage" in name:
            yield from below(plan.plan())
            return
        if name.startswith("Scan parquet"):
            yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from below(children.apply(i))

    return list(below(df._jdf.queryExecution().executedPlan()))


def test_composite_keys(spark, target):
    rows = spark.range(60).selectExpr("id % 6 as a", "cast(id div 6 as string) as b", "id as v")
    keyed_store.publish(rows, target, ["a", "b"], 4)
    more = spark.range(40, 80).selectExpr("id % 6 as a", "cast(id div 6 as string) as b", "-id as v")
    assert keyed_store.append_unseen(more, target) == 1
    assert sorted(r["v"] for r in keyed_store.read(spark, target).collect()) == sorted([*range(60), *[-i for i in range(60, 80)]])
