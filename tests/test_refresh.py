from datetime import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators import keys
from loadloom.operators.lookup import Lookup, look_up
from loadloom.plans import refresh
from loadloom.session import scratch_path
from loadloom.sources import tables


def frame(spark, hours, value=1.0):
    rows = [(str(h), h, value) for h in hours]
    df = spark.createDataFrame(rows, "id string, h int, Temperature double")
    return df.select("id", F.timestamp_seconds(F.col("h") * 3600).alias("DateTime"), "Temperature")


def ids(df):
    return sorted(int(r["id"]) for r in df.select("id").collect())


def test_plan(spark):
    train, test, source = frame(spark, range(10)), frame(spark, range(10, 15)), frame(spark, range(2, 20))
    out = refresh.plan_refresh(source, train, test, frame(spark, range(15)), ["id", "DateTime", "Temperature"])
    assert out.refreshed
    assert ids(out.train) == list(range(15))
    assert ids(out.test) == ids(out.features_added) == list(range(15, 20))
    late = refresh.late_rows(source, frame(spark, range(5, 10)), test)
    assert ids(late) == [2, 3, 4]


def test_nothing_newer_or_no_mark(spark):
    train, test = frame(spark, range(5)), frame(spark, range(5, 8))
    same = refresh.plan_refresh(frame(spark, range(8)), train, test, train, ["id", "DateTime", "Temperature"])
    assert not same.refreshed and ids(same.test) == [5, 6, 7] and same.train_added.count() == 0
    emptied = refresh.plan_refresh(frame(spark, range(9)), train, test.limit(0), train, train.columns)
    assert emptied.refreshed and ids(emptied.test) == [5, 6, 7, 8] and emptied.train_added.count() == 0
    empty = refresh.plan_refresh(frame(spark, range(9)), train.limit(0), test.limit(0), train, train.columns)
    assert not empty.refreshed
    assert refresh.newer_than_mark(frame(spark, range(9)), test.limit(0)).count() == 0


def test_summary(spark):
    train, test, source = frame(spark, range(10)), frame(spark, range(10, 15)), frame(spark, range(20))
    assert refresh.refresh_summary(source, train, test).first().asDict() == {
        "refreshed": 1, "train_before": 10, "train_after": 15, "test_before": 5, "test_after": 5,
    }
    assert refresh.refresh_summary(train, train, test).first()["refreshed"] == 0


@pytest.fixture
def stored(spark):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    db = f"r_{tag}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'db')}'")
    t = {n: f"{db}.{n}" for n in ("source", "train", "test", "features")}
    tables.append(frame(spark, range(20)), t["source"])
    tables.append(frame(spark, range(10)), t["train"])
    tables.append(frame(spark, range(10, 15)), t["test"])
    tables.append(frame(spark, range(15)).select("id", "DateTime"), t["features"])
    return t


def state(spark, t):
    return tuple(ids(spark.table(t[n])) for n in ("train", "test", "features"))


def run(spark, t):
    return refresh.run_refresh(spark, t["source"], t["train"], t["test"], t["features"])


AFTER = (list(range(15)), list(range(15, 20)), list(range(20)))


def test_stored_refresh_runs_once(spark, stored):
    assert run(spark, stored) == 1
    assert state(spark, stored) == AFTER
    assert run(spark, stored) == 0
    assert state(spark, stored) == AFTER


@pytest.mark.parametrize("step", ["insert_select", "overwrite"])
def test_refresh_after_a_crash_adds_nothing_twice(spark, stored, monkeypatch, step):
    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(refresh, step, crash)
        with pytest.raises(RuntimeError):
            run(spark, stored)
    assert run(spark, stored) == 1
    assert state(spark, stored) == AFTER


def test_refresh_after_a_crash_that_emptied_the_test_table(spark, stored, monkeypatch):
    def crash(df, table):
        tables.overwrite(df.limit(0), table)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(refresh, "overwrite", crash)
        with pytest.raises(RuntimeError):
            run(spark, stored)
    assert spark.table(stored["test"]).count() == 0
    assert run(spark, stored) == 1
    assert state(spark, stored) == AFTER


def test_refresh_recovers_from_a_write_that_fails_half_way(spark, stored, monkeypatch):
    real = tables.overwrite

    def half(df, table):
        poison = F.when(F.col("id") == "18", F.raise_error(F.lit("lost"))).otherwise(F.col("Temperature"))
        real(df.withColumn("Temperature", poison), table)

    with monkeypatch.context() as m:
        m.setattr(refresh, "overwrite", half)
        with pytest.raises(Exception, match="lost"):
            run(spark, stored)
    assert ids(spark.table(stored["test"])) == list(range(10, 15))
    assert run(spark, stored) == 1
    assert state(spark, stored) == AFTER


def test_overwrite_keeps_the_definition(spark):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE o_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    name, path = f"o_{tag}.kept", scratch_path(spark, "kept")
    tables.create_keyed_table(frame(spark, range(20)), name, description="kept", path=path, buckets=4)
    tables.overwrite(spark.table(name).filter("id < '15'"), name)  # reads the table that it replaces
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert told["Type"] == "EXTERNAL" and told["Num Buckets"] == "4" and told["Comment"] == "kept" and path in told["Location"]
    assert "loadloom.key=id" in told["Table Properties"]
    stored = spark.read.parquet(tables.location(spark, name))
    assert ids(spark.table(name)) == sorted(i for i in range(20) if str(i) < "15") == ids(stored)
    tables.append(frame(spark, [99]), name)
    assert 99 in ids(spark.table(name)) and spark.table(name).count() == stored.count() + 1


STEPS = ("_new_version", "_stage", "_switch", "expire")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("buckets", [None, 3])
def test_a_failed_replacement_leaves_the_old_or_the_new_rows(spark, monkeypatch, step, after, buckets):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE f_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    name, real = f"f_{tag}.t", getattr(tables, step)
    tables.append(frame(spark, range(5)), name, buckets=buckets)
    tables.overwrite(frame(spark, range(5, 10)), name)
    reader = spark.table(name)

    def crash(*args):
        if after:
            real(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, step, crash)
        with pytest.raises(RuntimeError):
            tables.overwrite(frame(spark, range(10, 30)), name)
    switched = STEPS.index(step) > 2 or (step == "_switch" and after)
    assert ids(spark.table(name)) == list(range(10, 30) if switched else range(5, 10))
    assert ids(reader) == list(range(5, 10))  # its version is still there
    tables.overwrite(spark.table(name).limit(3), name)
    assert spark.table(name).count() == 3
    assert len(tables.versions(spark, name)) == 2
    root = tables._root(tables.location(spark, name))
    tables.drop(spark, name)
    assert not spark.catalog.tableExists(name) and tables._listed(spark, root) == []


def test_replacement_of_managed_formats_types_and_partitions(spark):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE g_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    spark.sql(f"CREATE TABLE g_{tag}.j (id STRING, `a b` INT) USING json")
    for n in range(4):
        tables.overwrite(spark.createDataFrame([(n, str(n))], "`a b` bigint, id string"), f"g_{tag}.j")
    assert [tuple(r) for r in spark.table(f"g_{tag}.j").collect()] == [("3", 3)]
    assert len(tables.versions(spark, f"g_{tag}.j")) == 2
    frame(spark, range(4)).write.partitionBy("id").saveAsTable(f"g_{tag}.p")
    with pytest.raises(ValueError, match="partitioned"):
        tables.overwrite(frame(spark, range(2)), f"g_{tag}.p")
    assert spark.table(f"g_{tag}.p").count() == 4


def test_unseen_rows_are_added_once_and_rows_without_a_key_of_their_own_refused(spark):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE u_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    name = f"u_{tag}.t"
    tables.append(frame(spark, range(3)), name)
    batch = frame(spark, [2, 3, 4, 5, 5, 5]).withColumn("id", F.when(F.col("id") != "4", F.col("id")))
    with pytest.raises(ValueError, match="not a key"):
        tables.append_unseen(batch, name)
    assert ids(spark.table(name)) == [0, 1, 2]
    good, bad = keys.divide_by_key(batch, ["id"])
    for _ in range(2):
        tables.append_unseen(good, name)
    assert ids(spark.table(name)) == [0, 1, 2, 3]
    assert sorted((r["id"] or "") for r in bad.collect()) == ["", "5", "5", "5"]


def test_refresh_refuses_a_batch_without_unique_keys(spark, stored):
    twice = frame(spark, [18])
    tables.append(twice, stored["source"])
    with pytest.raises(ValueError, match="not a key"):
        run(spark, stored)
    assert state(spark, stored) == (list(range(10)), list(range(10, 15)), list(range(15)))


def test_refresh_of_empty_tables_does_nothing(spark, stored):
    for name in ("train", "test"):
        tables.overwrite(frame(spark, range(1)).limit(0), stored[name])
    assert run(spark, stored) == 0


def test_insert_narrows_to_the_declared_types(spark):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE n_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    table = f"n_{tag}.features"
    tables.create_empty(spark, table, names.FEATURE_TABLE_SCHEMA)
    row = {"id": "1", "DateTime": datetime(2024, 1, 1)}
    row |= {c: 1.5 for c in names.WEATHER + names.FLOWS} | {c: 1.0 for c in names.INDICATORS}
    source = spark.createDataFrame([row]).select(*reversed(names.FEATURE_TABLE_SCHEMA.names))
    tables.insert_select(source, table, names.FEATURE_TABLE_SCHEMA.names)
    got = spark.table(table).first()
    assert got["DayOfWeek_1"] == 1 and got["Temperature"] == 1.5 and got["id"] == "1"
    with pytest.raises(ValueError, match="columns"):
        tables.insert_select(source, table, ["id"])


def test_keyed_table_checks_before_writing(spark):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE k_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    with pytest.raises(ValueError, match="not a key"):
        tables.create_keyed_table(frame(spark, [1, 1]), f"k_{tag}.bad")
    assert not spark.catalog.tableExists(f"k_{tag}.bad")
    tables.create_keyed_table(frame(spark, [1, 2]), f"k_{tag}.good", description="it's fine")
    properties = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES k_{tag}.good").collect()}
    assert properties["loadloom.key"] == "id"
    comment = spark.sql(f"DESCRIBE EXTENDED k_{tag}.good").filter("col_name = 'Comment'").first()["data_type"]
    assert comment == "it's fine"


def test_tables_bucketed_alike_are_looked_up_without_a_shuffle(spark, no_broadcast):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE b_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    base, features = f"b_{tag}.base", f"b_{tag}.features"
    tables.append(frame(spark, range(30)), base, buckets=4)
    tables.append(frame(spark, range(30, 40)), base)
    tables.create_keyed_table(frame(spark, range(5, 50), 2.0).withColumnRenamed("Temperature", "x"), features, buckets=4)
    lookup = Lookup(spark.table(features), ["x"], key_checked=True)
    out = look_up(spark.table(base), lookup)
    assert "Exchange" not in plan_of(out)
    assert out.count() == 40 and out.filter("x = 2").count() == 35
