import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators import changes, keys, lookup, skew
from loadloom.plans import training
from loadloom.registry.inputs import readings


@pytest.fixture
def some_are_hot(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)


@pytest.fixture
def skewed(spark):
    """A third of the rows have key 7, and some have none."""
    return spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 1000).alias("k"),
    )


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi", "inner"])
def test_salted_join_equals_the_plain_one(spark, skewed, no_broadcast, some_are_hot, how):
    right = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).unionAll(
        spark.sql("SELECT 7L, 70L")
    )
    assert list(skew.skew_of(skewed, "k").rows.values()) == [1002]
    salted = skew.skew_safe_join(skewed, right, "k", how)
    assert "_salt" in plan_of(salted)
    plain = skewed.join(right, "k", how)
    assert salted.columns == plain.columns
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))


def test_hot_key_is_spread_over_tasks(spark, skewed, no_broadcast, some_are_hot):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = spark.range(2000).select(F.col("id").alias("k"))
        joined = skew.skew_safe_join(skewed, right, "k", "inner").filter("k = 7")
        tasks = joined.groupBy(F.spark_partition_id()).count().count()
        assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("kind", ["string", "int", "date", "timestamp", "timestamp_ntz", "decimal(10,2)"])
def test_hot_keys_of_any_kind(spark, some_are_hot, kind):
    base = spark.range(900).select(F.when(F.col("id") < 300, 5).otherwise(F.col("id")).cast("int").alias("n"))
    value = {"date": F.date_from_unix_date("n"), "timestamp": F.timestamp_seconds("n")}.get(kind, F.col("n"))
    value = F.timestamp_seconds("n").cast(kind) if kind == "timestamp_ntz" else value.cast(kind)
    df = base.select(value.alias("k"))
    found = skew.skew_of(df, "k").rows
    assert len(found) == 1 and df.filter(F.xxhash64("k") == next(iter(found))).count() == 300


def test_equal_rows_of_a_hot_key_part(spark, no_broadcast, some_are_hot):
    wanted = spark.range(0, 6000, 1, 4).select(F.lit(7).cast("bigint").alias("k"))
    right = spark.range(2000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    plan = skew.skew_safe_join(wanted, right, "k", "left")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert plan.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.filter("v = 7").count() == 6000


def test_rows_without_a_key_part(spark, no_broadcast, some_are_hot):
    left = spark.range(0, 3000, 1, 4).select(F.col("id").alias("row"), F.when(F.col("id") < 0, 1).cast("bigint").alias("k"))
    joined = skew.skew_safe_join(left, spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v")), "k", "left")
    assert "_salt" in plan_of(joined) and joined.filter("v is null").count() == 3000


def test_composite_keys(spark, no_broadcast, some_are_hot):
    left = spark.range(3000).select(F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).alias("a"), F.lit(2).cast("bigint").alias("b"), "id")
    right = spark.range(3000).select(F.col("id").alias("a"), F.lit(2).cast("bigint").alias("b"), (F.col("id") * 10).alias("v"))
    got = lookup.look_up(left, lookup.Lookup(right, ["v"], key=["a", "b"]))
    assert got.filter("a = 1 and v = 10").count() == 1500 and got.filter("v is null").count() == 0
    assert keys.unseen_rows(left, right.filter("a > 10"), ["a", "b"]).count() == 1500


@pytest.mark.parametrize("threshold", ["-1", "20000", "10000000"])
def test_lookup_does_not_depend_on_the_size_estimate(spark, tmp_path, threshold):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    rows = rows.unionAll(spark.sql("SELECT 5L, 1L UNION ALL SELECT CAST(NULL AS BIGINT), 2L UNION ALL SELECT CAST(NULL AS BIGINT), 3L"))
    rows.write.parquet(str(tmp_path / "t"))
    spark.range(0, 3000, 2).select(F.when(F.col("id") != 4, F.col("id")).alias("k"), F.col("id")).write.parquet(str(tmp_path / "b"))
    table, base = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "b"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = lookup.look_up(base, lookup.Lookup(table, ["v"], key="k")).collect()
        assert len(got) == 1500 and all(r["v"] == r["k"] for r in got) and sum(r["k"] is None for r in got) == 1
        asked = base.unionByName(spark.sql("SELECT 5L AS k, 0L AS id"))
        with pytest.raises(Exception, match="requested and repeated"):
            lookup.look_up(asked, lookup.Lookup(table, ["v"], key="k")).collect()
        with pytest.raises(Exception, match="requested and repeated"):
            lookup.look_up_keys(asked.select("k"), table, "k", ["v"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookups_run_no_join_before_the_action(spark, sf, no_broadcast, monkeypatch):
    seen = []
    real = skew.skew_of
    monkeypatch.setattr(lookup, "skew_of", lambda df, key: seen.append(plan_of(df)) or real(df, key))
    base = readings(spark, sf)
    parts = [base.select("id", F.col(c).alias(f"x_{c}")) for c in (*names.WEATHER, names.FLOWS[0])]
    lookup.assemble(base.select("id", "DateTime"), [lookup.Lookup(p, [p.columns[1]]) for p in parts])
    assert len(seen) == 1 and "Join" not in seen[0]


def test_small_left_side_is_sent_to_the_scan(spark, tmp_path):
    spark.range(200_000).select(F.col("id").alias("k"), F.rand(1).alias("v")).write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    wanted = spark.sql("SELECT 5L AS k UNION ALL SELECT 5L UNION ALL SELECT -1L")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10000")
    try:
        assert skew.fits_broadcast(wanted) and not skew.fits_broadcast(big)
        out = lookup.look_up_keys(wanted, big, "k", ["v"])
        assert "LeftSemi" in plan_of(out)
        rows = sorted((r["k"], r["v"] is not None) for r in out.collect())
        assert rows == [(-1, False), (5, True), (5, True)]
        assert keys.unseen_rows(wanted, big, "k").count() == 1
        looked_up = lookup.look_up(wanted, lookup.Lookup(big, ["v"], key="k"))
        assert "LeftSemi" in plan_of(looked_up) and looked_up.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_keeps_every_base_row_once(spark, skewed):
    table = spark.sql("SELECT 7L AS k, 'x' AS a, 'y' AS b")
    out = lookup.look_up(skewed, lookup.Lookup(table, ["a"], key="k", as_names={"a": "name"}))
    assert out.count() == skewed.count()
    assert out.filter("name = 'x'").count() == skewed.filter("k = 7").count()


def test_lookup_table_with_a_repeated_key_is_refused(spark, skewed):
    table = spark.sql("SELECT 7L AS k, 'x' AS a UNION ALL SELECT 7L, 'z'")
    with pytest.raises(Exception, match="requested and repeated"):
        lookup.look_up(skewed, lookup.Lookup(table, ["a"], key="k")).collect()


def test_training_set_columns_and_no_python(spark, sf):
    base = readings(spark, sf).withColumn(names.STAMP, F.current_timestamp())
    features = readings(spark, sf).select("id", *names.FLOWS)
    out = training.training_frame(base, features)
    assert names.STAMP not in out.columns
    assert set(training.FEATURES) - set(names.CALENDAR) - set(names.INDICATORS) <= set(out.columns)
    plan = plan_of(out)
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_sql_function_arguments_bind_by_name(spark):
    function = lookup.SqlFunction("t_ratio", {"num": "DOUBLE", "den": "DOUBLE"}, "DOUBLE", "num / den").create(spark)
    df = spark.sql("SELECT 6.0D AS a, 3.0D AS b")
    assert df.select(function.bind({"den": "b", "num": "a"})).first()[0] == 2.0


def test_sql_function_can_be_kept_in_the_catalog(spark):
    function = lookup.SqlFunction("t_twice", {"x": "DOUBLE"}, "DOUBLE", "x * 2").create(spark, temporary=False)
    df = spark.sql("SELECT 6.0D AS a, CAST(NULL AS DOUBLE) AS b")
    assert tuple(df.select(function.bind({"x": "a"}), function.bind({"x": "b"})).first()) == (12.0, None)
    spark.sql("DROP FUNCTION t_twice")


def test_second_lookup_reuses_the_partitioning_of_the_first(spark, sf, no_broadcast):
    base = readings(spark, sf)
    one, two = base.select("id", *names.FLOWS), base.select("id", *names.WEATHER)
    lookups = [lookup.Lookup(one, names.FLOWS, key_checked=True), lookup.Lookup(two, names.WEATHER, key_checked=True)]
    out = lookup.assemble(base.select("id", "DateTime"), lookups)
    assert plan_of(out).count("Exchange hashpartitioning") == 3


def test_aligned_frames_keep_common_keys_only(spark):
    base = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), (None, 5.0)], "id string, y double")
    old = spark.createDataFrame([("a", 1.5), ("c", 3.0), (None, 1.0)], "id string, prediction double")
    new = spark.createDataFrame([("a", 0.5), ("b", 2.0), ("c", None)], "id string, prediction double")
    out = keys.align_on_key(base, {"old": old, "new": new}, "id", ["y"])
    assert {tuple(r) for r in out.collect()} == {("a", 1.0, 1.5, 0.5), ("c", None, 3.0, None)}
    assert plan_of(out).count("Exchange") == 1


def test_aligned_frames_refuse_a_repeated_key(spark):
    base = spark.createDataFrame([("a", 1.0)], "id string, y double")
    twice = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "id string, prediction double")
    with pytest.raises(Exception, match="repeated"):
        keys.align_on_key(base, {"old": twice}, "id", ["y"]).collect()


def test_unseen_rows(spark, no_broadcast):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "id string, v int")
    stored = spark.createDataFrame([("a", 9), ("a", 8)], "id string, v int")
    assert sorted(r["v"] for r in keys.unseen_rows(new, stored, "id").collect()) == [2, 3]
    assert keys.unseen_rows(stored, stored, "id").count() == 0


def test_change_set_kinds(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 4.0)], "id string, v double")
    new = spark.createDataFrame([("a", 1.0), ("b", None), ("c", None), ("e", 5.0)], "id string, v double")
    got = {tuple(r) for r in changes.change_set(old, new, ["v"]).select("id", "change", "old_v", "new_v").collect()}
    assert got == {("c", "update", 3.0, None), ("d", "delete", 4.0, None), ("e", "insert", None, 5.0)}
    assert changes.change_set(old, old, ["v"]).count() == 0


@pytest.mark.parametrize("rows", [[("a", 1.0), ("a", 1.0)], [(None, 1.0)]])
def test_change_set_refuses_what_is_no_key(spark, rows):
    bad = spark.createDataFrame(rows, "id string, v double")
    good = spark.createDataFrame([("a", 1.0)], "id string, v double")
    with pytest.raises(Exception, match="NULL or repeated"):
        changes.change_set(good, bad, ["v"]).collect()


def test_change_set_shuffles_each_side_once(spark, sf):
    frame = readings(spark, sf)
    plan = plan_of(changes.change_set(frame, frame, ["Humidity"]))
    assert plan.count("Exchange hashpartitioning") == 2 and "SinglePartition" not in plan


@pytest.fixture
def some_share_keys(spark):
    """A third of the rows have key 7, some have none, some share one with another row, and most have their own."""
    return spark.range(3000).select(
        F.col("id").alias("row"),
        F.lit("x").alias("a"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 2500).alias("k"),
        (F.col("id") % 2).alias("half"),
    )


@pytest.mark.parametrize("own", [["k"], ["half", "k"]])
@pytest.mark.parametrize("ways", [[], ["no_broadcast"], ["no_broadcast", "some_are_hot"]])
def test_rows_divided_by_key_are_all_there_whatever_the_join(request, some_share_keys, own, ways):
    for fixture in ways:
        request.getfixturevalue(fixture)
    good, bad = keys.divide_by_key(some_share_keys, own)
    assert ("_salt" in plan_of(good)) == ("some_are_hot" in ways)
    groups = {}
    for r in some_share_keys.collect():
        groups.setdefault(tuple(r[c] for c in own), []).append(r["row"])
    alone = sorted(rows[0] for key, rows in groups.items() if len(rows) == 1 and None not in key)
    assert good.columns == bad.columns == some_share_keys.columns
    assert 0 < len(alone) < 3000 and sorted(r["row"] for r in good.collect()) == alone
    assert sorted(r["row"] for r in bad.collect()) == sorted(set(range(3000)) - set(alone))


def test_no_row_moves_and_nothing_is_counted_again_if_few_keys_offend(some_share_keys):
    for part in keys.divide_by_key(some_share_keys, ["k"]):
        assert part.count() > 0 and "Exchange hashpartitioning" not in plan_of(part)


@pytest.mark.parametrize("ways", [[], ["no_broadcast"]])
def test_keys_that_are_no_numbers_or_zeros_are_counted_like_others(spark, request, ways):
    for fixture in ways:
        request.getfixturevalue(fixture)
    rows = [(float("nan"), 1), (float("nan"), 2), (0.0, 3), (-0.0, 4), (1.5, 5), (None, 6)]
    good, bad = keys.divide_by_key(spark.createDataFrame(rows, "k double, row int"), ["k"])
    assert [r["row"] for r in good.collect()] == [5]
    assert sorted(r["row"] for r in bad.collect()) == [1, 2, 3, 4, 6]


def test_rows_with_a_key_of_their_own_come_dealt_by_it(spark, some_share_keys, no_broadcast):
    good, _ = keys.divide_by_key(some_share_keys, ["k"])
    dealt = good.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "k")
    assert plan_of(dealt).count("Exchange hashpartitioning(k") == 2  # the rows and the offending keys


def test_columns_may_have_any_name(spark, no_broadcast, monkeypatch):
    from loadloom.operators import sampling, skew

    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    own = ("_salt", "_nth", "_copies", "_draw", "_bad_id")
    base = spark.range(60).selectExpr("cast(id % 3 as string) AS id", *[f"'{c}' AS {c}" for c in own])
    table = spark.range(3).selectExpr("cast(id as string) AS id", "id AS x", *[f"id AS `{c}x`" for c in own])
    out = lookup.look_up(base, lookup.Lookup(table, ["x"]))
    assert out.columns == [*base.columns, "x"] and out.filter("x = cast(id as int) AND _salt = '_salt' AND _copies = '_copies'").count() == 60
    assert skew.skew_safe_join(base, table, "id", "left_semi").columns == base.columns
    good, bad = keys.divide_by_key(base, ["id"])
    assert (good.count(), bad.count()) == (0, 60)
    assert sampling.sample_exactly(base, 10).columns == base.columns
    named = spark.range(3).selectExpr("cast(id as string) AS id", "id AS _nth")
    assert keys.guarded(named, ["id"], {"_nth": named["_nth"]}, "t").filter("_nth >= 0").count() == 3
