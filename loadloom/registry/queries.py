"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names
from loadloom.functions import (
    calendar_parts,
    epoch_key,
    fill,
    indicators,
    load_stamp,
    parse_time,
    step_after,
    utc_now,
)
from loadloom.operators import (
    arrow,
    columns,
    contracts,
    evaluate,
    keys,
    lookup,
    models,
    positions,
    prepare,
    ranking,
    routing,
    states,
    synthetic,
)
from loadloom.operators.changes import change_set
from loadloom.operators.sampling import sample_exactly
from loadloom.plans import prepare_data, refresh, serving, training
from loadloom.registry.inputs import (
    PAIRS,
    TEXT_SCHEMA,
    order_runs,
    readings,
    scored,
    table,
    text_readings,
)
from loadloom.session import scratch_path
from loadloom.sources import files, keyed_store, runlog, tables
from loadloom.streaming import keyed_sync

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TEST_FROM = datetime(2024, 1, 20)
TEST_UNTIL = datetime(2024, 1, 25)
FIRST_DAY = datetime(2024, 1, 5)


def plain(df: DataFrame, places: int = 6) -> DataFrame:
    """Integers as BIGINT, doubles rounded, for comparison with other engines' results."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, places) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(fn(spark, sf))

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return run


def _at(moment: datetime):
    micros = round(moment.replace(tzinfo=timezone.utc).timestamp() * 1_000_000)
    return F.timestamp_micros(F.lit(micros)).cast("timestamp_ntz")


# ---- time, names, keys -------------------------------------------------------------------------------------------


@query
def calendar_features(spark, sf):
    return readings(spark, sf).select("id", *[c.alias(n) for n, c in calendar_parts("DateTime").items()])


@query
def epoch_keys(spark, sf):
    return readings(spark, sf).select("id", epoch_key("DateTime").alias("epoch_key"))


@query
def parsed_times(spark, sf):
    text = readings(spark, sf).select("id", F.date_format("DateTime", "M/d/yyyy H:mm").alias("text"))
    return text.select("id", "text", parse_time("text", "M/d/yyyy H:mm").cast("timestamp_ntz").alias("DateTime"))


@query
def time_steps(spark, sf):
    return readings(spark, sf).select(
        "id", step_after("DateTime", F.col("diffuse_flows").cast("bigint")).alias("later")
    )


@query
def load_stamps(spark, sf):
    stamped = readings(spark, sf).select(load_stamp().alias(names.STAMP), utc_now().alias("now"))
    return stamped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(names.STAMP).alias("stamps"),
        F.count_distinct("now").alias("nows"),
    )


@query
def clean_column_names(spark, sf):
    base = readings(spark, sf)
    messy = base.select(
        "id",
        F.col("Wind_Speed").alias("Wind  Speed "),
        F.col("general_diffuse_flows").alias("general diffuse flows"),
        F.col("Zone_1_Power_Consumption").alias(" Zone 1 Power \t Consumption"),
    )
    return columns.clean_names(messy)


@query
def feature_columns(spark, sf):
    features, _ = columns.features_and_labels(
        columns.without(readings(spark, sf), [names.TIME, "not_there"]), [names.KEY, *names.WEATHER], names.TARGETS
    )
    return features


@query
def label_columns(spark, sf):
    base = readings(spark, sf)
    return columns.features_and_labels(base, names.WEATHER, [names.KEY, *names.TARGETS])[1]


@query
def renamed_columns(spark, sf):
    base = columns.to_double(table(spark, sf, "lineitem").select("l_linenumber", "l_quantity"), ["l_linenumber"])
    return columns.renamed(base, {"l_linenumber": "line", "l_quantity": "quantity"})


# ---- contract -----------------------------------------------------------------------------------------------------


@query
def contract_coerced(spark, sf):
    return contracts.coerce(text_readings(spark, sf), TEXT_SCHEMA, lenient=True)


@query
def contract_violations(spark, sf):
    return contracts.violations(text_readings(spark, sf), TEXT_SCHEMA, ["id"])


@query
def contract_columns(spark, sf):
    return contracts.column_report(text_readings(spark, sf), TEXT_SCHEMA)


@query
def key_violations(spark, sf):
    return keys.key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- preparation --------------------------------------------------------------------------------------------------


@query
def prep_profile(spark, sf):
    return prepare.fit(prepare.with_calendar(readings(spark, sf))).select("column", "mean", "scale")


@query
def prep_apply(spark, sf):
    return prepare_data.prepared(prepare_data.raw_readings(readings(spark, sf)))


@query
def prep_apply_scaled_calendar(spark, sf):
    raw = prepare_data.raw_readings(readings(spark, sf))
    return prepare_data.prepared(raw, keep=[names.KEY, names.TIME, *names.TARGETS], truncate_calendar=False).select(
        names.KEY, *names.CALENDAR
    )


@query
def prep_fit_on_train(spark, sf):
    raw = prepare_data.raw_readings(readings(spark, sf))
    split = prepare_data.prepared_split(raw, fit_on="train")
    return split.select(names.KEY, "split", *names.WEATHER, *names.FLOWS)


@query
def category_levels(spark, sf):
    base = prepare.with_calendar(readings(spark, sf))
    gaps = base.withColumn("DayOfWeek", F.when(F.col("Temperature").isNotNull(), F.col("DayOfWeek")))
    found = prepare.levels_of(gaps, ["DayOfWeek", "IsWeekend", "Month"])
    return found.select("column", F.array_join("levels", ",").alias("levels"))


@query
def filled_values(spark, sf):
    base = readings(spark, sf)
    mean = base.agg(F.avg("Temperature").alias("mean")).scalar()
    return base.select("id", fill("Temperature", mean).alias("by_mean"), fill("Temperature", -1.0).alias("by_constant"))


@query
def indicator_columns(spark, sf):
    base = table(spark, sf, "events").select("event_id", "event_type")
    drop_first = indicators("event_type", ["click", "error", "view"])
    unknown_zero = indicators("event_type", ["click", "error"], drop_first=False)
    return base.select(
        "event_id",
        *[c.alias(f"d_{n}") for n, c in drop_first.items()],
        *[c.alias(f"u_{n}") for n, c in unknown_zero.items()],
    )


# ---- order and split ----------------------------------------------------------------------------------------------


@query
def temporal_split(spark, sf):
    return ranking.split_summary(ranking.temporal_split(readings(spark, sf)))


@query
def temporal_split_rows(spark, sf):
    return ranking.temporal_split(readings(spark, sf).select("id", "DateTime")).select("id", "split")


@query
def temporal_split_ties(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ranking.temporal_split(orders, 0.25, "o_orderdate", "o_orderkey").select("o_orderkey", "split")


@query
def row_slice(spark, sf):
    return ranking.rows_between(readings(spark, sf), 1, 2).select("id", "DateTime", "Wind_Speed")


@query
def time_ordered(spark, sf):
    return ranking.in_time_order(readings(spark, sf).select("id", "DateTime"))


@query
def latest_rows(spark, sf):
    return ranking.latest(readings(spark, sf)).select("id", "DateTime")


@query
def earliest_rows(spark, sf):
    return ranking.earliest(readings(spark, sf)).select("id", "DateTime")


@query
def preview_rows(spark, sf):
    return readings(spark, sf).limit(5)


@query
def prepared_split(spark, sf):
    """Prepared rows per part: count, time range and the mean of every scaled measure."""
    split = prepare_data.prepared_split(prepare_data.raw_readings(readings(spark, sf)))
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(names.TIME).alias("first_time"),
        F.max(names.TIME).alias("last_time"),
        *[F.avg(c).alias(f"mean_{c}") for c in [*names.WEATHER, *names.FLOWS]],
        *[F.sum(c).alias(f"sum_{c}") for c in [*names.CALENDAR, *names.INDICATORS]],
    )


# ---- lookups and training sets ------------------------------------------------------------------------------------


def _flows(spark, sf) -> DataFrame:
    return readings(spark, sf).select(names.KEY, *names.FLOWS)


@query
def feature_lookup(spark, sf):
    base = readings(spark, sf).drop(*names.FLOWS)
    known = readings(spark, sf).filter(F.col("DateTime") < _at(TEST_UNTIL)).select(names.KEY, *names.FLOWS)
    return lookup.look_up(base, lookup.Lookup(known, names.FLOWS)).select(names.KEY, "Wind_Speed", *names.FLOWS)


@query
def two_table_lookup(spark, sf):
    source = readings(spark, sf)
    flows = source.filter(F.col("DateTime") < _at(TEST_UNTIL)).select(names.KEY, *names.FLOWS)
    weather = source.filter(F.col("DateTime") >= _at(FIRST_DAY)).select(names.KEY, *names.WEATHER)
    return lookup.assemble(
        source.select(names.KEY, names.TIME),
        [lookup.Lookup(flows, names.FLOWS), lookup.Lookup(weather, names.WEATHER)],
        [lookup.WEATHER_FEATURE],
        [names.TIME],
    )


@query
def customer_lookup(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    source = lookup.Lookup(
        table(spark, sf, "customer"),
        ["c_mktsegment", "c_acctbal"],
        key="c_custkey",
        base_key="o_custkey",
        as_names={"c_mktsegment": "segment", "c_acctbal": "balance"},
    )
    return lookup.look_up(orders, source)


@query
def key_list_lookup(spark, sf):
    wanted = table(spark, sf, "labels").select((F.col("doc_id") * 3).alias("doc_id"))
    documents = table(spark, sf, "documents")
    return lookup.look_up_keys(wanted, documents, "doc_id", ["lang", "n_chars"])


@query
def weather_interaction(spark, sf):
    return lookup.assemble(
        readings(spark, sf).select(names.KEY, *names.WEATHER), functions=[lookup.WEATHER_FEATURE]
    )


@query
def training_set(spark, sf):
    base = readings(spark, sf).withColumn(names.STAMP, load_stamp())
    return training.training_frame(base, _flows(spark, sf))


@query
def testing_set(spark, sf):
    return training.testing_frame(readings(spark, sf).withColumn(names.STAMP, load_stamp()))


# ---- refresh ------------------------------------------------------------------------------------------------------


def _refresh_inputs(spark, sf):
    source = readings(spark, sf)
    time = F.col("DateTime")
    train = source.filter((time >= _at(FIRST_DAY)) & (time < _at(TEST_FROM)))
    test = source.filter((time >= _at(TEST_FROM)) & (time < _at(TEST_UNTIL)))
    features = source.filter(time < _at(TEST_UNTIL)).select(names.KEY, names.TIME, *names.WEATHER, *names.FLOWS)
    return source, train, test, features


def _planned(spark, sf) -> refresh.Refresh:
    source, train, test, features = _refresh_inputs(spark, sf)
    return refresh.plan_refresh(source, train, test, features, features.columns)


@query
def high_water_mark(spark, sf):
    source, _, test, _ = _refresh_inputs(spark, sf)
    return refresh.newer_than_mark(source, test)


@query
def refresh_train(spark, sf):
    return _planned(spark, sf).train


@query
def refresh_test(spark, sf):
    return _planned(spark, sf).test


@query
def refresh_features(spark, sf):
    return _planned(spark, sf).features_added


@query
def refresh_late_rows(spark, sf):
    source, train, test, _ = _refresh_inputs(spark, sf)
    return refresh.late_rows(source, train, test).select(names.KEY, names.TIME)


@query
def refresh_summary(spark, sf):
    source, train, test, _ = _refresh_inputs(spark, sf)
    return refresh.refresh_summary(source, train, test)


@query
def unseen_keys(spark, sf):
    source = readings(spark, sf)
    new = source.filter(F.col("DateTime") >= _at(TEST_FROM))
    stored = source.filter(F.col("DateTime") < _at(TEST_UNTIL))
    return keys.unseen_rows(new, stored, names.KEY)


def _halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    """All readings, in two parts."""
    source = readings(spark, sf)
    return source.filter(F.col("DateTime") < _at(TEST_FROM)), source.filter(F.col("DateTime") >= _at(TEST_FROM))


@query
def union_by_position(spark, sf):
    train, test = _halves(spark, sf)
    return columns.stack_by_position(train.select("id", "Wind_Speed"), test.select("id", "Wind_Speed"))


@query
def union_by_name(spark, sf):
    train, test = _halves(spark, sf)
    return columns.stack_by_name(train.select("id", "Wind_Speed"), test.select("Humidity", "id"))


@query
def changed_rows(spark, sf):
    source = readings(spark, sf)
    old = source.filter(F.col("DateTime") < _at(TEST_UNTIL))
    raised = F.when(F.col("Wind_Speed") < 20, F.col("Temperature") + 1).otherwise(F.col("Temperature"))
    new = source.filter(F.col("DateTime") >= _at(FIRST_DAY)).withColumn("Temperature", raised)
    return change_set(old, new, ["Temperature", "Zone_1_Power_Consumption"])


@query
def stream_sync_state(spark, sf):
    schema = table(spark, sf, "events").schema
    target = scratch_path(spark, "sync")
    stream = keyed_sync.read_stream(spark, f"{sf}/events.parquet", schema)
    keyed_sync.sync(stream, target, "user_id", ["ts", "event_id"])
    return keyed_sync.read_state(spark, target, schema, "user_id", ["ts", "event_id"])


# ---- tables and files ---------------------------------------------------------------------------------------------


def _fresh_table(spark, label: str) -> tuple[str, str]:
    path = scratch_path(spark, label)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


def _released(spark, name: str, path: str) -> DataFrame:
    """The table's files, its name given back to the catalog."""
    path = tables.location(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return tables.scan(spark, path)


@query
def appended_table(spark, sf):
    train, test = _halves(spark, sf)
    name, path = _fresh_table(spark, "appended")
    tables.append(train, name, path)
    tables.append_unseen(test, name)
    tables.append_unseen(test, name)
    return _released(spark, name, path)


@query
def overwritten_table(spark, sf):
    """The later half first, then all rows in its place: a frame that reads the table which it replaces."""
    train, test = _halves(spark, sf)
    name, path = _fresh_table(spark, "overwritten")
    tables.append(test, name, path)
    tables.overwrite(spark.table(name).unionByName(train.select(*spark.table(name).columns)), name, path)
    return _released(spark, name, path)


@query
def replaced_versions(spark, sf):
    """A bucketed table replaced three times from itself: its rows, and how many versions are kept."""
    train, test = _halves(spark, sf)
    name, path = _fresh_table(spark, "replaced")
    tables.append(train, name, path, buckets=4)
    for step in range(3):
        rows = spark.table(name).filter(F.col("id").cast("bigint") % 3 != step)
        tables.overwrite(rows.unionByName(test.filter(F.col("id").cast("bigint") % 3 == step)), name)
    kept = len(tables.versions(spark, name))
    return _released(spark, name, path).select("id", "Wind_Speed", F.lit(kept).alias("versions"))


@query
def appended_by_key(spark, sf):
    """Line items added to some of them twice over; those without a key of their own are set apart."""
    line, own = table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    good, bad = keys.divide_by_key(line, own)
    # Checked and joined by key twice over: stored once, in as many buckets as a shuffle has parts, its rows move no more.
    once, at = _fresh_table(spark, "good")
    tables.append(good, once, at, own, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    good = spark.table(once)
    name, path = _fresh_table(spark, "lines")
    tables.append(good.filter("l_orderkey % 2 = 0"), name, path, own)
    for _ in range(2):
        tables.append_unseen(good, name, own)
    tables.drop(spark, once)
    stored = _released(spark, name, path).select(*own, F.lit(True).alias("stored"))
    return stored.unionAll(bad.select(*own, F.lit(False)))


@query
def inserted_features(spark, sf):
    rows = prepare_data.prepared(prepare_data.raw_readings(readings(spark, sf)))
    name, path = _fresh_table(spark, "features")
    tables.create_empty(spark, name, names.FEATURE_TABLE_SCHEMA, path)
    tables.insert_select(rows, name, names.FEATURE_TABLE_SCHEMA.names)
    stored = _released(spark, name, path)
    tables.temp_view(stored.withColumn(names.TIME, F.col(names.TIME).cast("timestamp_ntz")), "stored_features")
    return spark.table("stored_features")


@query
def keyed_table(spark, sf):
    name, path = _fresh_table(spark, "keyed")
    tables.create_keyed_table(_flows(spark, sf), name, description="flows by key", path=path)
    return _released(spark, name, path)


@query
def csv_readings(spark, sf):
    path = scratch_path(spark, "csv")
    readings(spark, sf).select(
        "id",
        F.date_format("DateTime", "M/d/yyyy H:mm").alias("DateTime"),
        F.col("Wind_Speed").alias("Wind Speed"),
        F.col("general_diffuse_flows").alias("general diffuse flows"),
    ).write.csv(path, header=True)
    schema = "id string, DateTime string, `Wind Speed` double, `general diffuse flows` double"
    back = files.read_readings_csv(spark, path, T.StructType.fromDDL(schema))
    return back.withColumn("DateTime", F.col("DateTime").cast("timestamp_ntz"))


@query
def json_records(spark, sf):
    return files.records(table(spark, sf, "events"), ["event_id", "user_id", "event_type"])


@query
def json_records_back(spark, sf):
    base = readings(spark, sf).select("id", *names.WEATHER)
    return files.from_records(files.records(base, base.columns), base.schema)


@query
def column_split_back(spark, sf):
    base = table(spark, sf, "events").select("event_id", "event_type", "value")
    lists = files.column_split(base, base.columns).select(F.array("values").alias("data"))
    return files.from_column_split(lists, base.columns, base.schema)


# ---- evaluation ---------------------------------------------------------------------------------------------------


def _prediction_tables(spark, sf):
    rows = scored(spark, sf)
    old = rows.filter(F.col("DateTime") < _at(TEST_UNTIL)).select("id", F.col("prediction_old").alias("prediction"))
    new = rows.filter(F.col("DateTime") >= _at(FIRST_DAY)).select("id", F.col("prediction_new").alias("prediction"))
    return rows.select("id", *names.TARGETS), old, new


@query
def joined_predictions(spark, sf):
    actuals, old, new = _prediction_tables(spark, sf)
    joined = keys.align_on_key(actuals, {"old": old, "new": new}, "id", ["Zone_1_Power_Consumption"])
    return evaluate.with_errors(joined, "Zone_1_Power_Consumption", ["prediction_old", "prediction_new"])


@query
def champion_challenger(spark, sf):
    return evaluate.champion_challenger_tables(*_prediction_tables(spark, sf))


@query
def champion_challenger_same_row(spark, sf):
    return evaluate.champion_challenger(scored(spark, sf))


@query
def metrics_per_target(spark, sf):
    return evaluate.metrics_per_target(scored(spark, sf), PAIRS)


@query
def metrics_uniform(spark, sf):
    return evaluate.metrics_uniform(scored(spark, sf), PAIRS)


@query
def axis_range(spark, sf):
    return evaluate.axis_range(scored(spark, sf), PAIRS)


@query
def actual_vs_predicted_long(spark, sf):
    return evaluate.long_pairs(scored(spark, sf), PAIRS)


def _importances(spark, sf) -> DataFrame:
    """Share of explained variance (squared correlation) of every measure with every target."""
    features = ["Humidity", "Wind_Speed", *names.FLOWS]
    base = readings(spark, sf)
    pairs = [(f, t) for f in features for t in names.TARGETS]
    aggs = [F.corr(f, t).alias(f"c{i}") for i, (f, t) in enumerate(pairs)]
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(t).alias("target"),
            (F.col(f"c{i}") * F.col(f"c{i}")).alias("importance"),
        )
        for i, (f, t) in enumerate(pairs)
    ]
    return base.agg(*aggs).select(F.inline(F.array(*rows)))


@query
def mean_importance(spark, sf):
    return evaluate.mean_importance(_importances(spark, sf))


@query
def top_features(spark, sf):
    return evaluate.top_features(evaluate.mean_importance(_importances(spark, sf)), 2)


# ---- routing, serving, runs ---------------------------------------------------------------------------------------


@query
def ab_assignment(spark, sf):
    return routing.assign(readings(spark, sf).select("id"))


@query
def ab_routed_prediction(spark, sf):
    rows = scored(spark, sf).select("id", "prediction_old", "prediction_new")
    return routing.route(rows, "prediction_old", "prediction_new")


@query
def scaled_prediction(spark, sf):
    return routing.rescale(scored(spark, sf).select("id", "prediction_new"), ["prediction_new"])


@query
def prediction_table(spark, sf):
    train, test = _halves(spark, sf)

    def score(df: DataFrame) -> DataFrame:
        return df.withColumn("predictions", F.array(*[F.col(t) * 0.5 for t in names.TARGETS]))

    return serving.prediction_table(train, test, score)


@query
def latest_run_by_tag(spark, sf):
    found = runlog.latest_run(order_runs(spark, sf), {"branch": "F"})
    return found.select("run_id", "experiment", "started", F.col("metrics")["price"].alias("price"))


@query
def experiments_by_tag(spark, sf):
    return runlog.search_experiments(order_runs(spark, sf), {"branch": "F"})


# ---- synthetic rows and samples -----------------------------------------------------------------------------------


@query
def moments(spark, sf):
    lines = table(spark, sf, "lineitem")
    return synthetic.moments(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query
def synthetic_grid(spark, sf):
    return synthetic.time_grid(readings(spark, sf))


@query
def synthetic_rows(spark, sf):
    return synthetic.continue_series(readings(spark, sf), [*names.WEATHER, *names.FLOWS, *names.TARGETS])


@query
def synthetic_batch(spark, sf):
    source = readings(spark, sf)
    test = source.filter((F.col("DateTime") >= _at(TEST_FROM)) & (F.col("DateTime") < _at(TEST_UNTIL)))
    return prepare_data.synthetic_batch(source.drop(names.KEY), test).drop(names.STAMP)


@query
def bootstrap_sample(spark, sf):
    return sample_exactly(readings(spark, sf), 1000)


# ---- models -------------------------------------------------------------------------------------------------------

SMALL_BOOSTING = models.Boosting(learning_rate=0.3, n_estimators=3, max_depth=3)
SMALL_FOREST = models.Forest(n_estimators=5, max_depth=4)


def _prepared_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    return prepare_data.prepared_parts(prepare_data.raw_readings(readings(spark, sf)))


@query
def gbt_metrics(spark, sf):
    train, test = _prepared_parts(spark, sf)
    features = train.select(names.KEY, *names.FLOWS)
    return training.train_and_judge(train, test, features, SMALL_BOOSTING).metrics


@query
def forest_metrics(spark, sf):
    train, test = _prepared_parts(spark, sf)
    fitted = models.fit_per_target(train, SMALL_FOREST)
    pairs = {t: (t, p) for t, p in zip(names.TARGETS, names.PREDICTED, strict=True)}
    return evaluate.metrics_per_target(fitted.score(test), pairs)


@query
def forest_importance(spark, sf):
    train, _ = _prepared_parts(spark, sf)
    fitted = models.fit_per_target(train, SMALL_FOREST, encode=names.INDICATORS)
    return evaluate.mean_importance(fitted.importances(train))


@query
def variant_comparison(spark, sf):
    train, test = _prepared_parts(spark, sf)
    variants = {
        "A": models.Boosting(learning_rate=0.3, n_estimators=2, max_depth=2),
        "B": models.Boosting(learning_rate=0.3, n_estimators=2, max_depth=4),
    }
    report = models.compare_variants(train, test, variants)
    return report.select("variant", F.col("parameters")["max_depth"].alias("max_depth"), "mse", "mae", "r2")


@query
def model_comparison(spark, sf):
    train, test = _prepared_parts(spark, sf)
    frame = training.training_frame(train, train.select(names.KEY, *names.FLOWS), key_checked=True)
    target, output = names.TARGETS[:1], names.PREDICTED[:1]
    old = models.fit_per_target(frame, models.Forest(1, 1), training.FEATURES, target, output)
    new = models.fit_per_target(frame, SMALL_FOREST, training.FEATURES, target, output)
    return training.compare_models(test, old, new)


@query
def batch_scored_keys(spark, sf):
    """Rows given by key, time and calendar columns only; the other inputs are looked up and computed."""
    train, test = _prepared_parts(spark, sf)
    features = test.select(names.KEY, *names.WEATHER, *names.FLOWS)
    frame = training.training_frame(train, train.select(names.KEY, *names.FLOWS), key_checked=True)
    fitted = models.fit_per_target(frame, SMALL_FOREST, training.FEATURES)
    given = test.drop(*names.WEATHER, *names.FLOWS, *names.TARGETS)
    source = lookup.Lookup(features, [*names.WEATHER, *names.FLOWS])
    return training.score_batch(fitted, given, [source], [lookup.WEATHER_FEATURE]).select(names.KEY, *names.PREDICTED)


@query
def ab_scored_rows(spark, sf):
    train, test = _prepared_parts(spark, sf)
    a = models.fit_per_target(train, models.Boosting(0.3, 2, 2))
    b = models.fit_per_target(train, models.Boosting(0.3, 2, 4))
    return routing.route_scored(test, a.score, b.score).select(names.KEY, "model", *names.PREDICTED)


# With one 0/1 input a tree of depth 1 predicts the mean of each group, and a tree of depth 0 the overall mean: results
# that SQL can check through training, scoring and judging alike.

ONE_SPLIT = models.Forest(n_estimators=1, max_depth=1, bootstrap=False)
NO_SPLIT = models.Forest(n_estimators=1, max_depth=0, bootstrap=False)
WEEKEND = ["IsWeekend_1"]


def _target_pairs() -> dict[str, tuple[str, str]]:
    return {t: (t, p) for t, p in zip(names.TARGETS, names.PREDICTED, strict=True)}


@query
def forest_group_means(spark, sf):
    train, test = _prepared_parts(spark, sf)
    fitted = models.fit_per_target(train, ONE_SPLIT, WEEKEND)
    return fitted.score(test).select(names.KEY, *names.PREDICTED)


@query
def boosted_group_metrics(spark, sf):
    train, test = _prepared_parts(spark, sf)
    fitted = models.fit_per_target(train, models.Boosting(0.5, 2, 1), WEEKEND)
    return evaluate.metrics_per_target(fitted.score(test), _target_pairs())


@query
def importance_of_one_input(spark, sf):
    train, _ = _prepared_parts(spark, sf)
    fitted = models.fit_per_target(train, ONE_SPLIT, WEEKEND)
    return evaluate.mean_importance(fitted.importances(train))


@query
def variant_group_metrics(spark, sf):
    variants = {"A": NO_SPLIT, "B": ONE_SPLIT}
    report = models.compare_variants(*_prepared_parts(spark, sf), variants, WEEKEND)
    return report.select("variant", F.col("parameters")["max_depth"].alias("max_depth"), "mse", "mae", "r2")


@query
def model_comparison_means(spark, sf):
    train, test = _prepared_parts(spark, sf)
    target, output = names.TARGETS[:1], names.PREDICTED[:1]
    old = models.fit_per_target(train, NO_SPLIT, WEEKEND, target, output)
    new = models.fit_per_target(train, ONE_SPLIT, WEEKEND, target, output)
    return training.compare_models(test, old, new)


@query
def ab_group_means(spark, sf):
    train, test = _prepared_parts(spark, sf)
    a = models.fit_per_target(train, ONE_SPLIT, WEEKEND)
    b = models.fit_per_target(train, ONE_SPLIT, ["DayOfWeek_1"])
    return routing.route_scored(test, a.score, b.score).select(names.KEY, "model", *names.PREDICTED)


@query
def prediction_table_means(spark, sf):
    train, test = _prepared_parts(spark, sf)
    return serving.prediction_table(train, test, models.fit_per_target(train, ONE_SPLIT, WEEKEND).score)


@query
def bootstrap_members(spark, sf):
    """Every drawn row, with all its values, is one of the table's."""
    base = readings(spark, sf).select(names.KEY, *names.TARGETS)
    drawn = sample_exactly(base, 1000)
    known = keys.unseen_rows(drawn, base, names.KEY).agg(F.count(F.lit(1)).alias("strangers"))
    whole = drawn.join(base, base.columns).agg(F.count(F.lit(1)).alias("rows"))
    return whole.select("rows", known.scalar().alias("strangers"))


@query
def synthetic_moments(spark, sf):
    """Whether the generated rows have the source's moments, within five standard errors."""
    source = readings(spark, sf)
    measures = [*names.WEATHER, *names.FLOWS, *names.TARGETS]
    rows = 5000
    made = synthetic.moments(synthetic.continue_series(source, measures, rows), measures)
    both = made.join(
        synthetic.moments(source, measures).withColumnsRenamed({"mean": "m", "deviation": "s"}), "column"
    )
    return both.select(
        "column",
        (F.abs(F.col("mean") - F.col("m")) <= 5 * F.col("s") / rows**0.5).alias("mean_fits"),
        (F.abs(F.col("deviation") / F.col("s") - 1) <= 5 / (2 * rows) ** 0.5).alias("deviation_fits"),
    )


# ---- repeated, missing and hot keys, ties, long numbers, stored state ------------------------------------------------


def _customers(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")


def _customer_of(orders: DataFrame, customers: DataFrame) -> DataFrame:
    source = lookup.Lookup(customers, ["c_mktsegment", "c_acctbal"], key="c_custkey", base_key="o_custkey")
    return lookup.look_up(orders.select("o_orderkey", "o_custkey"), source)


@query
def lookup_repeated_key_unused(spark, sf):
    """Keys that nobody asks for are repeated in the table."""
    customers = _customers(spark, sf)
    unused = customers.withColumn("c_custkey", -1 - F.col("c_custkey") % 10)
    return _customer_of(table(spark, sf, "orders"), customers.unionAll(unused))


@query
def lookup_null_keys(spark, sf):
    """Some rows have no key, and some rows of the table neither."""
    orders = table(spark, sf, "orders").withColumn("o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")))
    customers = _customers(spark, sf)
    return _customer_of(orders, customers.unionAll(customers.withColumn("c_custkey", F.lit(None).cast("bigint"))))


@query
def lookup_hot_key(spark, sf):
    """One customer has a third of the orders."""
    orders = table(spark, sf, "orders").withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")))
    return _customer_of(orders, _customers(spark, sf))


def _order_lines(spark, sf) -> DataFrame:
    """``lineitem`` with one row per order and line."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return lines.agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.count(F.lit(1)).alias("copies"))


@query
def composite_key_lookup(spark, sf):
    base = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    known = _order_lines(spark, sf).filter("l_orderkey % 5 <> 0")
    return lookup.look_up(base, lookup.Lookup(known, ["quantity", "copies"], key=["l_orderkey", "l_linenumber"]))


@query
def composite_key_changes(spark, sf):
    lines = _order_lines(spark, sf)
    old = lines.filter("l_orderkey % 5 <> 0")
    new = lines.filter("l_orderkey % 3 <> 0").withColumn("quantity", F.col("quantity") + (F.col("l_linenumber") == 1).cast("int"))
    return change_set(old, new, ["quantity"], ["l_orderkey", "l_linenumber"])


@query
def row_slice_ties(spark, sf):
    """Orders of one date are told apart by their key."""
    orders = table(spark, sf, "orders")
    return ranking.rows_between(orders, 100, 1100, "o_orderdate", "o_orderkey").select("o_orderkey", "o_orderdate")


@query
def latest_many_rows(spark, sf):
    orders = table(spark, sf, "orders")
    return ranking.latest(orders, 12_000, "o_orderdate", "o_orderkey").select("o_orderkey", "o_orderdate")


@query
def time_steps_far(spark, sf):
    """More steps than minutes fit a 32-bit number."""
    steps = F.col("event_id") + 250_000_000
    far = step_after(F.col("ts").cast("timestamp"), steps, 10)
    return table(spark, sf, "events").select("event_id", F.unix_micros(far).alias("micros"))


@query
def stored_refresh(spark, sf):
    """Train, test and feature keys after a stored refresh that ran twice."""
    source, train, test, features = _refresh_inputs(spark, sf)
    made = {part: _fresh_table(spark, part) for part in ("source", "train", "test", "features")}
    for part, rows in zip(made, (source, train, test, features), strict=True):
        tables.append(rows, *made[part])
    for _ in range(2):
        refresh.run_refresh(spark, *[name for name, _ in made.values()])
    out = None
    for part in ("train", "test", "features"):
        keys_of = _released(spark, *made[part]).select(F.lit(part).alias("part"), names.KEY)
        out = keys_of if out is None else out.unionAll(keys_of)
    spark.sql(f"DROP TABLE {made['source'][0]}")
    return out


@query
def ab_scored_null_keys(spark, sf):
    """Each row scored by its own model, rows without a key by B."""
    rows = readings(spark, sf).select(F.when(F.col("Humidity") >= 10, F.col("id")).alias("id"), "Humidity")
    score = lambda k: lambda df: df.withColumn("Prediction", F.col("Humidity") * k)
    return routing.route_scored(rows, score(1), score(-1), outputs=["Prediction"])


@query
def synthetic_independence(spark, sf):
    """Standardised values of generated columns: rows, and distinct values in each column and in all together."""
    source, measures = readings(spark, sf), [*names.WEATHER, *names.FLOWS]
    made = synthetic.continue_series(source.repartition(4), measures, 4000)
    found = {r["column"]: r for r in synthetic.moments(source, measures).collect()}
    drawn = [F.round((F.col(c) - found[c]["mean"]) / found[c]["deviation"], 11).alias("z") for c in measures]
    rows = made.select(F.posexplode(F.array(*drawn)).alias("place", "z"))
    each = rows.groupBy("place").agg(F.countDistinct("z").alias("n")).agg(F.sum("n").alias("per_column"))
    overall = rows.agg(F.count(F.lit(1)).alias("values"), F.countDistinct("z").alias("overall"))
    return overall.select("values", (each.scalar() - F.col("overall")).alias("shared"))


_LONG = T.StructType([T.StructField("number", T.LongType())])


def _long_texts(spark, sf) -> DataFrame:
    """Numbers as text beyond what a DOUBLE holds, some with a fraction."""
    number = (F.col("event_id") + 9_007_199_254_740_993).cast("string")
    ending = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, ".0").otherwise(".7")
    return table(spark, sf, "events").select("event_id", F.concat(number, ending).alias("number"))


@query
def contract_long_integers(spark, sf):
    return contracts.coerce(_long_texts(spark, sf), _LONG, lenient=True).select("event_id", "number")


@query
def contract_fractions(spark, sf):
    return contracts.violations(_long_texts(spark, sf), _LONG, ["event_id"])


@query
def text_category_fit(spark, sf):
    """Levels of a text category found by the fit, and the rows of each by the indicators it gives."""
    events = table(spark, sf, "events")
    profile = prepare.fixed(prepare.fit(events, ["value"], ["event_type"], domains=None))
    prepared = prepare.apply(events, profile, ["event_id"], ())
    marks = [c for c in prepared.columns if c.startswith("event_type_")]
    rows = F.array(*[F.struct(F.lit(c.removeprefix("event_type_")).alias("label"), F.col(c).alias("n")) for c in marks])
    sums = prepared.agg(*[F.sum(c).alias(c) for c in marks]).select(F.inline(rows))
    labels = profile.filter("column = 'event_type'").select(F.posexplode("labels").alias("place", "label"))
    return labels.join(sums, "label", "left").select("place", "label", "n")


def _synced(spark, sf, compacted: bool) -> DataFrame:
    """Events in several files and batches, those of one type deletions."""
    events = table(spark, sf, "events").withColumn("gone", F.col("event_type") == F.lit("purchase"))
    source, target = scratch_path(spark, "feed"), scratch_path(spark, "sync")
    version = ["ts", "event_id"]
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).repartition(2).write.mode("append").parquet(source)
        keyed_sync.sync(keyed_sync.read_stream(spark, source, events.schema, 1), target, "user_id", version, 8)
        if compacted and part < 2:
            keyed_sync.compact(spark, target, events.schema, "user_id", version, 8)
            keyed_sync.vacuum(spark, target)
    return keyed_sync.read_state(spark, target, events.schema, "user_id", version, "gone")


@query
def stream_sync_deletes(spark, sf):
    return _synced(spark, sf, False)


@query
def stream_sync_compacted(spark, sf):
    return _synced(spark, sf, True)


@query
def column_data_document(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    return files.column_document(events, events.columns, into="document")


@query
def column_data_document_back(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    wanted = T.StructType([f for f in events.schema.fields if f.name != "user_id"])
    return files.from_column_document(files.column_document(events, events.columns), wanted)


@query
def boosted_many_rounds(spark, sf):
    """More rounds than the checkpoint interval; with one 0/1 input the first already finds the group means."""
    train, test = _prepared_parts(spark, sf)
    fitted = models.fit_per_target(train, models.Boosting(0.5, 12, 1), WEEKEND)
    return evaluate.metrics_per_target(fitted.score(test), _target_pairs())


@query
def forest_best_split(spark, sf):
    """A tree of depth 1 over seven 0/1 inputs splits by the one that lowers the squared error most."""
    train, test = _prepared_parts(spark, sf)
    fitted = models.fit_per_target(train, ONE_SPLIT, names.INDICATORS)
    return fitted.score(test).select(names.KEY, *names.PREDICTED)


@query
def forest_best_split_importance(spark, sf):
    train, _ = _prepared_parts(spark, sf)
    fitted = models.fit_per_target(train, ONE_SPLIT, names.INDICATORS)
    return evaluate.mean_importance(fitted.importances(train)).filter("importance > 0")


@query
def logged_runs(spark, sf):
    """A run logged for each event type, read back."""
    path = scratch_path(spark, "runs")
    kinds = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    for row in kinds.collect():
        kind = row["event_type"]
        runlog.log_run(spark, path, kind, "by_type", {"kind": kind}, {"rows": row["n"]}, {"top": row["top"]})
    runs = runlog.read_runs(spark, path)
    found = runlog.search_runs(runs, {"kind": "click"}, "by_type").select("run_id", F.lit(True).alias("found"))
    return runs.join(found, "run_id", "left").select(
        "run_id", "experiment", F.col("params")["rows"].alias("rows"), F.col("metrics")["top"].alias("top"),
        F.coalesce("found", F.lit(False)).alias("found"),
    )


@query
def stored_parts(spark, sf):
    """Prepared train and test rows stored in two runs, with the stamps of each."""
    train, test = _prepared_parts(spark, sf)
    made = {part: _fresh_table(spark, part)[0] for part in ("train", "test")}
    for minute in (0, 1):
        prepare_data.store_parts(train, test, made["train"], made["test"], datetime(2024, 3, 1, 0, minute, tzinfo=timezone.utc))
    out = None
    for part, name in made.items():
        rows = spark.table(name).groupBy(names.KEY).agg(
            F.count(F.lit(1)).alias("copies"), F.countDistinct(names.STAMP).alias("stamps"), F.max("Zone_1_Power_Consumption").alias("zone")
        )
        rows = rows.select(F.lit(part).alias("part"), "*")
        out = rows if out is None else out.unionAll(rows)
    return out


# ---- versions, feeds, states --------------------------------------------------------------------------------------


def _older_and_newer(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Two states of the readings: rows gone, rows added, values raised in some days only."""
    source = readings(spark, sf)
    raised = F.when(F.col("Wind_Speed") < 20, F.col("Temperature") + 1).otherwise(F.col("Temperature"))
    new = source.filter(F.col("DateTime") >= _at(FIRST_DAY)).withColumn("Temperature", raised)
    return source.filter(F.col("DateTime") < _at(TEST_UNTIL)), new


@query
def changes_between_versions(spark, sf):
    """Two versions stored in shared folders; only folders that differ are read."""
    target, columns = scratch_path(spark, "versions"), ["Temperature", "Zone_1_Power_Consumption"]
    for rows in _older_and_newer(spark, sf):
        keyed_store.publish(rows.select(names.KEY, *columns), target, names.KEY, 16)
    return keyed_store.changes_between_versions(spark, target, 0, 1, columns)


@query
def changes_of_few_parts(spark, sf):
    """A few keys changed among many parts."""
    target, rows = scratch_path(spark, "versions"), readings(spark, sf).select(names.KEY, "Wind_Speed", "Humidity")
    few = F.col("id").cast("bigint") % 997 == 5
    keyed_store.publish(rows, target, names.KEY, 32)
    keyed_store.publish(rows.withColumn("Wind_Speed", F.when(few, -1.0).otherwise(F.col("Wind_Speed"))), target)
    return keyed_store.changes_between_versions(spark, target, 0, 1, ["Wind_Speed", "Humidity"])


@query
def version_feed_state(spark, sf):
    """The stored changes of two versions, taken in by a stream: the rows of the second."""
    target, out = scratch_path(spark, "versions"), scratch_path(spark, "feed_state")
    for number, rows in enumerate(_older_and_newer(spark, sf)):
        keyed_store.publish(rows.select(names.KEY, "Temperature", "Wind_Speed"), target, names.KEY, 16)
        keyed_store.store_changes(spark, target, number, ["Temperature", "Wind_Speed"])
        feed = keyed_store.read_changes(spark, target)
        keyed_sync.sync(feed, out, names.KEY, ["version"], 8)
    state = keyed_sync.read_state(spark, out, feed.schema, names.KEY, ["version"], "deleted")
    return state.select(names.KEY, "Temperature", "Wind_Speed")


@query
def filtered_append(spark, sf):
    """All readings appended twice to the earlier half; filters over the keys say which folders to look into."""
    train, _ = _halves(spark, sf)
    target = scratch_path(spark, "filtered")
    keyed_store.publish(train.drop(names.TIME), target, names.KEY, 8)
    for _ in range(2):
        keyed_store.append_unseen(readings(spark, sf).drop(names.TIME), target)
    keyed_store.fold(spark, target)
    return keyed_store.read(spark, target)


@query
def point_lookups(spark, sf):
    """Requested documents from parts that are pruned at run time."""
    target = scratch_path(spark, "points")
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    keyed_store.publish(documents, target, "doc_id", 16)
    wanted = table(spark, sf, "labels").select((F.col("doc_id") * 3).alias("doc_id"))
    return keyed_store.point_lookup(wanted, target, ["lang", "n_chars"])


def _fed(spark, sf, parts: int, step) -> tuple[str, T.StructType]:
    """Events in three files, each synced and then handed to ``step``."""
    events = table(spark, sf, "events").withColumn("gone", F.col("event_type") == F.lit("purchase"))
    source, target = scratch_path(spark, "feed"), scratch_path(spark, "sync")
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).repartition(2).write.mode("append").parquet(source)
        stream = keyed_sync.read_stream(spark, source, events.schema)
        keyed_sync.sync(stream, target, "user_id", ["ts", "event_id"], parts if part == 0 else None, "ts")
        step(target, events.schema)
    return target, events.schema


@query
def stream_sync_parts(spark, sf):
    """A table begun with 8 parts, compactions that ask for 10 refused and repeated without a number."""
    refused = []

    def step(target, schema):
        try:
            keyed_sync.compact(spark, target, schema, "user_id", ["ts", "event_id"], 10)
        except ValueError:
            refused.append(True)
        keyed_sync.compact(spark, target, schema, "user_id", ["ts", "event_id"])

    target, schema = _fed(spark, sf, 8, step)
    state = keyed_sync.read_state(spark, target, schema, "user_id", ["ts", "event_id"])
    return state.select("user_id", "event_id", "ts", F.lit(len(refused)).alias("refused"))


@query
def stream_sync_expired(spark, sf):
    """Deletions kept for three days of event time: rows, deletions still known, and rows that came too late."""
    key, version = "user_id", ["ts", "event_id"]

    def step(target, schema):
        keyed_sync.compact(spark, target, schema, key, version, None, "gone", "ts", timedelta(days=3))

    target, schema = _fed(spark, sf, 8, step)
    state = keyed_sync.read_state(spark, target, schema, key, version)
    late = keyed_sync.read_late(spark, target, schema)
    kind = F.when(F.col("gone"), "deleted").otherwise("row")
    return state.select(key, "event_id", "ts", kind.alias("kind")).unionAll(late.select(key, "event_id", "ts", F.lit("late")))


def _stored_state(spark, sf) -> DataFrame:
    """Statistics of the readings stored in three steps, the last of which finds nothing new."""
    rows = prepare.with_calendar(readings(spark, sf))
    name, path = _fresh_table(spark, "state")
    for upto in (TEST_FROM, datetime(2100, 1, 1), datetime(2100, 1, 1)):
        states.fold_new(spark, name, rows.filter(F.col(names.TIME) < _at(upto)), names.NUMERIC_FEATURES, names.CATEGORIES, names.TIME, path)
    return _released(spark, name, path)


@query
def stored_profile(spark, sf):
    return states.profile_of(_stored_state(spark, sf)).select("column", "mean", "scale")


@query
def stored_moments(spark, sf):
    state = _stored_state(spark, sf)
    moments = states.moments_of(state)
    return moments.join(state.select("column", "rows", "present", "low", "high"), "column")


@query
def merged_levels(spark, sf):
    """Levels of categories merged from three states."""
    rows = prepare.with_calendar(readings(spark, sf)).withColumn("kind", F.when(F.col("Humidity") > 3, F.col("id").substr(1, 1)))
    third = F.col("id").cast("bigint") % 3
    found = states.merged(*[states.state_of(rows.filter(third == n), [], ["DayOfWeek", "kind"]) for n in range(3)])
    return found.select("column", "rows", "present", F.array_join(F.coalesce(F.col("levels").cast("array<string>"), F.col("labels")), ",").alias("levels"))


@query
def observed_contract(spark, sf):
    """The column report counted by the write of the coerced rows."""
    rows, counts = contracts.reported(text_readings(spark, sf), TEXT_SCHEMA)
    contracts.coerce(rows, TEXT_SCHEMA, lenient=True).write.parquet(scratch_path(spark, "coerced"))
    return counts.report()


@query
def observed_split(spark, sf):
    """The split summary counted by the write of the split rows."""
    rows, counts = ranking.summarised_split(ranking.temporal_split(readings(spark, sf)))
    rows.write.partitionBy("split").parquet(scratch_path(spark, "split"))
    return counts.report()


@query
def chart_points(spark, sf):
    return evaluate.chart_points(scored(spark, sf), PAIRS, 50)


@query
def arrow_interaction(spark, sf):
    """The three-factor interaction as a Python function on Arrow arrays."""
    rows = readings(spark, sf).select(names.KEY, *names.WEATHER)
    return rows.withColumn(names.INTERACTION, ARROW_INTERACTION.bind(lookup.WEATHER_FEATURE.bindings))


@query
def wrapped_models_routed(spark, sf):
    """Rows scored by the wrapped model that their key goes to; each wrapper scales what it predicts."""
    rows = scored(spark, sf).select("id", "Humidity", "prediction_2")

    def wrapped(factor):
        return arrow.ModelWrapper(
            "scaled", str(factor), float, _scaled_sum, {"humidity": "double", "base": "double"}, ["Prediction"]
        )

    bound = {"humidity": "Humidity", "base": "prediction_2"}
    score = lambda factor: lambda df: wrapped(factor).score(df, bound)
    return routing.route_scored(rows, score(1.3), score(0.7), outputs=["Prediction"])


def _three_factors(a, b, c):
    import pyarrow.compute as pc

    return pc.multiply(pc.multiply(a, b), c)


def _scaled_sum(factor, columns):
    import pyarrow.compute as pc

    return [pc.multiply(pc.add(columns["humidity"], columns["base"]), factor)]


ARROW_INTERACTION = arrow.ArrowFunction(
    "loadloom_arrow_interaction", dict.fromkeys(("temperature", "humidity", "wind_speed"), "double"), "double", _three_factors
)


@query
def stored_order_slice(spark, sf):
    """Readings stored in time order; the rows at some positions, from the files that hold them."""
    path = scratch_path(spark, "in_order")
    ranking.in_time_order(readings(spark, sf).select("id", "DateTime", "Wind_Speed")).write.parquet(path)
    at = positions.positions_of(spark.read.parquet(path))
    return positions.rows_at(at, at.rows // 3, at.rows // 2)


@query
def position_draws(spark, sf):
    """As many draws as rows, by position in stored order: the rows drawn, and how often."""
    path = scratch_path(spark, "drawn_from")
    ranking.in_time_order(readings(spark, sf).select("id", "DateTime")).write.parquet(path)
    at = positions.positions_of(spark.read.parquet(path))
    return positions.draw(at, at.rows, seed=7).groupBy("id").agg(F.count(F.lit(1)).alias("times"))


@query
def stamped_rows(spark, sf):
    """Rows of a run with its load stamp, to the microsecond; the present time lies after it."""
    at = datetime(2024, 3, 1, 1, 2, 3, 456789, timezone.utc)
    rows = readings(spark, sf).select("id", load_stamp(at).cast("timestamp_ntz").alias(names.STAMP), utc_now().alias("now"))
    return rows.select("id", names.STAMP, (F.col("now") > F.col(names.STAMP)).alias("later"))
