"""The registered queries as plain SQL over the same tables, for an independent engine to check."""

from __future__ import annotations

from loadloom import names

BASE = """
base AS (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
readings AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS DateTime,
         CASE WHEN event_id % 17 <> 0 THEN value END AS Temperature,
         k AS Humidity, CAST(user_id AS DOUBLE) AS Wind_Speed,
         value * 0.5 AS general_diffuse_flows, CAST(event_id % 100 AS DOUBLE) AS diffuse_flows,
         1000 + 3 * value + 2 * k AS Zone_1_Power_Consumption,
         500 + value + user_id AS Zone_2_Power_Consumption,
         250 + k AS Zone_3_Power_Consumption
  FROM base)"""

SCORED = (
    BASE
    + """,
scored AS (
  SELECT *, Zone_1_Power_Consumption + CAST(id AS BIGINT) % 7 - 3 AS prediction_old,
         Zone_1_Power_Consumption + CAST(id AS BIGINT) % 5 - 2 AS prediction_new,
         Zone_2_Power_Consumption * 0.9 + 10 AS prediction_2,
         Zone_3_Power_Consumption + Temperature AS prediction_3
  FROM readings)"""
)

CALENDAR = (
    BASE
    + """,
calendar AS (
  SELECT *, hour(DateTime) AS Hour, day(DateTime) AS Day, month(DateTime) AS Month,
         isodow(DateTime) - 1 AS DayOfWeek, CASE WHEN isodow(DateTime) >= 6 THEN 1 ELSE 0 END AS IsWeekend
  FROM readings)"""
)

REFRESH = (
    BASE
    + """,
source AS (SELECT * FROM readings),
train AS (SELECT * FROM readings WHERE DateTime >= '2024-01-05' AND DateTime < '2024-01-20'),
test AS (SELECT * FROM readings WHERE DateTime >= '2024-01-20' AND DateTime < '2024-01-25'),
newer AS (SELECT * FROM source WHERE DateTime > (SELECT max(DateTime) FROM test))"""
)

READING_DOUBLES = [*names.WEATHER, *names.FLOWS, *names.TARGETS]


def _r(expression: str, name: str | None = None) -> str:
    """A double rounded as the queries round it."""
    return f"round({expression}, 6) + 0.0 AS {name or expression}"


def _readings(source: str, columns: list[str] = READING_DOUBLES, ctes: str = BASE) -> str:
    return f"WITH {ctes} SELECT id, DateTime, {', '.join(_r(c) for c in columns)} FROM {source}"


# Statistics of one column after filling: mean, deviation (1 if constant).
def _stats(source: str) -> str:
    parts = []
    for c in names.NUMERIC_FEATURES:
        parts.append(f"avg({c}) AS m_{c}")
    means = f"means AS (SELECT {', '.join(parts)} FROM {source})"
    parts = [
        f"CASE WHEN stddev_pop(coalesce({c}, m_{c})) > 0 THEN stddev_pop(coalesce({c}, m_{c})) ELSE 1 END AS s_{c}"
        for c in names.NUMERIC_FEATURES
    ]
    scales = f"scales AS (SELECT {', '.join(parts)} FROM {source}, means)"
    return f"{means},\n{scales}"


def _z(c: str) -> str:
    return f"(coalesce({c}, m_{c}) - m_{c}) / s_{c}"


def _cut(c: str) -> str:
    return f"CAST(trunc(round({_z(c)}, 9)) AS BIGINT)"


INDICATOR_SQL = [
    f"CAST(CASE WHEN DayOfWeek = {d} THEN 1 ELSE 0 END AS BIGINT) AS DayOfWeek_{d}" for d in range(1, 7)
] + ["CAST(IsWeekend AS BIGINT) AS IsWeekend_1"]

PREPARED = (
    CALENDAR
    + ",\n"
    + _stats("calendar")
    + ",\nprepared AS (SELECT id, DateTime, "
    + ", ".join(names.TARGETS)
    + ", "
    + ", ".join(f"{_z(c)} AS {c}" for c in [*names.WEATHER, *names.FLOWS])
    + ", "
    + ", ".join(f"{_cut(c)} AS {c}" for c in names.CALENDAR)
    + ", "
    + ", ".join(INDICATOR_SQL)
    + " FROM calendar, means, scales)"
)

SPLIT = """
ranked AS (SELECT *, row_number() OVER (ORDER BY DateTime, id) AS position, count(*) OVER () AS n FROM {source}),
split AS (SELECT *, CASE WHEN position <= n - ceil(0.2 * n) THEN 'train' ELSE 'test' END AS split FROM ranked)"""


def _per_target(source: str = "scored") -> str:
    parts = []
    for target, predicted in zip(names.TARGETS, ["prediction_new", "prediction_2", "prediction_3"], strict=True):
        parts.append(
            f"SELECT '{target}' AS target, {target} AS y, {predicted} AS p FROM {source}"
        )
    union = " UNION ALL ".join(parts)
    return f"""pairs AS ({union}),
residuals AS (
  SELECT target, count(*) AS n, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae, var_pop(y) AS v
  FROM pairs WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY target),
metrics AS (
  SELECT target, n, mse, mae, sqrt(mse) AS rmse,
         CASE WHEN v > 0 THEN 1 - mse / v WHEN mse = 0 THEN 1.0 ELSE 0.0 END AS r2
  FROM residuals)"""


IMPORTANCE = (
    BASE
    + ",\nimportances AS ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, '{t}' AS target, power(corr({f}, {t}), 2) AS importance FROM readings"
        for f in ["Humidity", "Wind_Speed", *names.FLOWS]
        for t in names.TARGETS
    )
    + "),\naveraged AS (SELECT feature, avg(importance) AS importance FROM importances GROUP BY feature)"
)

TEXT = (
    BASE
    + """,
text AS (
  SELECT id, CASE WHEN Humidity < 5 THEN 'n/a' ELSE CAST(Temperature AS VARCHAR) END AS Temperature,
         CASE WHEN Humidity >= 95 THEN 'noon' ELSE CAST(hour(DateTime) AS VARCHAR) END AS Hour,
         CASE WHEN Humidity <> 50 THEN Zone_1_Power_Consumption END AS Zone_1_Power_Consumption
  FROM readings)"""
)

ODD = "(strpos('0123456789abcdef', right(md5(id), 1)) - 1) % 2 = 1"


def _metric_row(source: str) -> str:
    y = "Zone_1_Power_Consumption"
    return f"""SELECT round(avg(abs({y} - prediction_old)), 6) + 0.0 AS mae_old,
       round(avg(abs({y} - prediction_new)), 6) + 0.0 AS mae_new,
       round(sqrt(avg(power({y} - prediction_old, 2))), 6) + 0.0 AS rmse_old,
       round(sqrt(avg(power({y} - prediction_new, 2))), 6) + 0.0 AS rmse_new,
       avg(abs({y} - prediction_new)) < avg(abs({y} - prediction_old)) AS promote
FROM {source}"""


JOINED = (
    SCORED
    + """,
joined AS (
  SELECT a.id, a.Zone_1_Power_Consumption, o.prediction_old, n.prediction_new
  FROM scored a
  JOIN (SELECT id, prediction_old FROM scored WHERE DateTime < '2024-01-25') o ON a.id = o.id
  JOIN (SELECT id, prediction_new FROM scored WHERE DateTime >= '2024-01-05') n ON a.id = n.id)"""
)

_INTERACTION = "Temperature * Humidity * Wind_Speed"

_CUSTOMER = (
    "SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, round(c.c_acctbal, 6) + 0.0 AS c_acctbal "
    "FROM (SELECT o_orderkey, {} AS o_custkey FROM orders) o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"
)
_LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, count(*) AS copies
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
_SYNCED = (
    "SELECT event_id, ts, user_id, event_type, round(value, 6) + 0.0 AS value, props FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) "
    "WHERE nth = 1 AND event_type <> 'purchase'"
)

ORACLES: dict[str, str] = {
    "calendar_features": f"WITH {CALENDAR} SELECT id, CAST(Hour AS BIGINT) AS Hour, CAST(Day AS BIGINT) AS Day, "
    "CAST(Month AS BIGINT) AS Month, CAST(DayOfWeek AS BIGINT) AS DayOfWeek, CAST(IsWeekend AS BIGINT) AS IsWeekend "
    "FROM calendar",
    "epoch_keys": f"WITH {BASE} SELECT id, CAST(CAST(floor(epoch(DateTime)) AS BIGINT) AS VARCHAR) AS epoch_key "
    "FROM readings",
    "parsed_times": f"WITH {BASE} SELECT id, strftime(DateTime, '%-m/%-d/%Y %-H:%M') AS text, "
    "date_trunc('minute', DateTime) AS DateTime FROM readings",
    "time_steps": f"WITH {BASE} SELECT id, DateTime + to_minutes(CAST(10 * diffuse_flows AS BIGINT)) AS later "
    "FROM readings",
    "load_stamps": "SELECT count(*) AS rows, CAST(1 AS BIGINT) AS stamps, CAST(1 AS BIGINT) AS nows FROM events",
    "clean_column_names": f"WITH {BASE} SELECT id, "
    + ", ".join(_r(c) for c in ["Wind_Speed", "general_diffuse_flows", "Zone_1_Power_Consumption"])
    + " FROM readings",
    "feature_columns": f"WITH {BASE} SELECT id, {', '.join(_r(c) for c in names.WEATHER)} FROM readings",
    "label_columns": f"WITH {BASE} SELECT id, {', '.join(_r(c) for c in names.TARGETS)} FROM readings",
    "renamed_columns": "SELECT CAST(l_linenumber AS DOUBLE) AS line, round(l_quantity, 6) + 0.0 AS quantity "
    "FROM lineitem",
    "contract_coerced": f"WITH {TEXT} SELECT id, round(TRY_CAST(Temperature AS DOUBLE), 6) + 0.0 AS Temperature, "
    "CAST(TRY_CAST(Hour AS DOUBLE) AS BIGINT) AS Hour, " + _r("Zone_1_Power_Consumption") + " FROM text",
    "contract_violations": f"""WITH {TEXT}
SELECT id, 'Temperature' AS "column", Temperature AS value FROM text
WHERE Temperature IS NOT NULL AND TRY_CAST(Temperature AS DOUBLE) IS NULL
UNION ALL SELECT id, 'Hour', Hour FROM text WHERE Hour IS NOT NULL AND TRY_CAST(Hour AS DOUBLE) IS NULL
UNION ALL SELECT id, 'Zone_1_Power_Consumption', NULL FROM text WHERE Zone_1_Power_Consumption IS NULL""",
    "contract_columns": f"""WITH {TEXT}
SELECT 'Temperature' AS "column", 'double' AS declared, true AS found, count(*) AS rows,
       count(Temperature) AS present,
       count(*) FILTER (Temperature IS NOT NULL AND TRY_CAST(Temperature AS DOUBLE) IS NULL) AS uncastable FROM text
UNION ALL SELECT 'Hour', 'int', true, count(*), count(Hour),
       count(*) FILTER (Hour IS NOT NULL AND TRY_CAST(Hour AS DOUBLE) IS NULL) FROM text
UNION ALL SELECT 'Zone_1_Power_Consumption', 'double', true, count(*), count(Zone_1_Power_Consumption), 0 FROM text""",
    "key_violations": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies "
    "FROM lineitem GROUP BY l_orderkey, l_linenumber "
    "HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL",
    "prep_profile": f"WITH {CALENDAR},\n{_stats('calendar')}\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_r('m_' + c, 'mean')}, {_r('s_' + c, 'scale')} FROM means, scales"
        for c in names.NUMERIC_FEATURES
    )
    + "".join(f" UNION ALL SELECT '{c}', NULL, NULL" for c in names.CATEGORIES),
    "prep_apply": f"WITH {PREPARED} SELECT id, DateTime, "
    + ", ".join(_r(c) for c in READING_DOUBLES)
    + ", "
    + ", ".join([*names.CALENDAR, *names.INDICATORS])
    + " FROM prepared",
    "prep_apply_scaled_calendar": f"WITH {CALENDAR},\n{_stats('calendar')} SELECT id, "
    + ", ".join(_r(_z(c), c) for c in names.CALENDAR)
    + " FROM calendar, means, scales",
    "prep_fit_on_train": f"WITH {CALENDAR},\n{SPLIT.format(source='calendar')},\n"
    "fitted AS (SELECT * FROM split WHERE split = 'train'),\n"
    + _stats("fitted")
    + " SELECT id, split, "
    + ", ".join(_r(_z(c), c) for c in [*names.WEATHER, *names.FLOWS])
    + " FROM split, means, scales",
    "category_levels": f"""WITH {CALENDAR},
found AS (
  SELECT DISTINCT 'DayOfWeek' AS "column", CASE WHEN Temperature IS NULL THEN -1 ELSE DayOfWeek END AS level FROM calendar
  UNION SELECT 'IsWeekend', IsWeekend FROM calendar UNION SELECT 'Month', Month FROM calendar)
SELECT "column", string_agg(CAST(level AS VARCHAR), ',' ORDER BY level) AS levels FROM found GROUP BY "column" """,
    "filled_values": f"WITH {BASE} SELECT id, "
    "round(coalesce(Temperature, (SELECT avg(Temperature) FROM readings)), 6) + 0.0 AS by_mean, "
    "round(coalesce(Temperature, -1.0), 6) + 0.0 AS by_constant FROM readings",
    "indicator_columns": "SELECT event_id, "
    + ", ".join(
        f"CAST(CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END AS BIGINT) AS {p}_event_type_{v}"
        for p, v in [("d", "error"), ("d", "view"), ("u", "click"), ("u", "error")]
    )
    + " FROM events",
    "temporal_split": f"WITH {BASE},\n{SPLIT.format(source='readings')} SELECT split, count(*) AS rows, "
    "min(DateTime) AS first_time, max(DateTime) AS last_time FROM split GROUP BY split",
    "temporal_split_rows": f"WITH {BASE},\n{SPLIT.format(source='readings')} SELECT id, split FROM split",
    "temporal_split_ties": "WITH ranked AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) "
    "AS position, count(*) OVER () AS n FROM orders) SELECT o_orderkey, "
    "CASE WHEN position <= n - ceil(0.25 * n) THEN 'train' ELSE 'test' END AS split FROM ranked",
    "row_slice": f"WITH {BASE} SELECT id, DateTime, {_r('Wind_Speed')} FROM readings "
    "ORDER BY DateTime, id LIMIT 1 OFFSET 1",
    "prepared_split": f"WITH {PREPARED},\n{SPLIT.format(source='prepared')} SELECT split, count(*) AS rows, "
    "min(DateTime) AS first_time, max(DateTime) AS last_time, "
    + ", ".join(_r(f"avg({c})", f"mean_{c}") for c in [*names.WEATHER, *names.FLOWS])
    + ", "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS sum_{c}" for c in [*names.CALENDAR, *names.INDICATORS])
    + " FROM split GROUP BY split",
    "time_ordered": f"WITH {BASE} SELECT id, DateTime FROM readings ORDER BY DateTime, id",
    "latest_rows": f"WITH {BASE} SELECT * FROM (SELECT id, DateTime FROM readings ORDER BY DateTime DESC, id DESC "
    "LIMIT 5) ORDER BY DateTime, id",
    "earliest_rows": f"WITH {BASE} SELECT id, DateTime FROM readings ORDER BY DateTime, id LIMIT 5",
    "feature_lookup": f"WITH {BASE} SELECT r.id, {_r('r.Wind_Speed', 'Wind_Speed')}, "
    + ", ".join(_r(f"f.{c}", c) for c in names.FLOWS)
    + " FROM readings r LEFT JOIN (SELECT * FROM readings WHERE DateTime < '2024-01-25') f ON r.id = f.id",
    "two_table_lookup": f"WITH {BASE} SELECT r.id, "
    + ", ".join(_r(f"f.{c}", c) for c in names.FLOWS)
    + ", "
    + ", ".join(_r(f"w.{c}", c) for c in names.WEATHER)
    + f", {_r('w.Temperature * w.Humidity * w.Wind_Speed', names.INTERACTION)} FROM readings r "
    "LEFT JOIN (SELECT * FROM readings WHERE DateTime < '2024-01-25') f ON r.id = f.id "
    "LEFT JOIN (SELECT * FROM readings WHERE DateTime >= '2024-01-05') w ON r.id = w.id",
    "customer_lookup": "SELECT o_orderkey, o_custkey, round(o_totalprice, 6) + 0.0 AS o_totalprice, "
    "c_mktsegment AS segment, round(c_acctbal, 6) + 0.0 AS balance "
    "FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "key_list_lookup": "SELECT w.doc_id, d.lang, d.n_chars FROM (SELECT doc_id * 3 AS doc_id FROM labels) w "
    "LEFT JOIN documents d ON w.doc_id = d.doc_id",
    "weather_interaction": f"WITH {BASE} SELECT id, {', '.join(_r(c) for c in names.WEATHER)}, "
    f"{_r(_INTERACTION, names.INTERACTION)} FROM readings",
    "training_set": f"WITH {BASE} SELECT r.id, r.DateTime, "
    + ", ".join(_r(f"r.{c}", c) for c in [*names.WEATHER, *names.TARGETS])
    + ", "
    + ", ".join(_r(f"f.{c}", c) for c in names.FLOWS)
    + f", {_r('r.Temperature * r.Humidity * r.Wind_Speed', names.INTERACTION)} "
    "FROM readings r LEFT JOIN readings f ON r.id = f.id",
    "testing_set": f"WITH {BASE} SELECT id, DateTime, {', '.join(_r(c) for c in READING_DOUBLES)}, "
    f"{_r(_INTERACTION, names.INTERACTION)} FROM readings",
    "high_water_mark": _readings("newer", ctes=REFRESH),
    "refresh_train": _readings("(SELECT * FROM train UNION ALL SELECT * FROM test)", ctes=REFRESH),
    "refresh_test": _readings("newer", ctes=REFRESH),
    "refresh_features": _readings("newer", [*names.WEATHER, *names.FLOWS], REFRESH),
    "refresh_late_rows": f"WITH {REFRESH} SELECT id, DateTime FROM source "
    "WHERE DateTime <= (SELECT max(DateTime) FROM test) "
    "AND id NOT IN (SELECT id FROM train UNION ALL SELECT id FROM test)",
    "refresh_summary": f"""WITH {REFRESH},
counts AS (
  SELECT (SELECT count(*) FROM train) AS tr, (SELECT count(*) FROM test) AS te, (SELECT count(*) FROM newer) AS nw)
SELECT CAST(CASE WHEN nw > 0 THEN 1 ELSE 0 END AS BIGINT) AS refreshed, tr AS train_before,
       tr + CASE WHEN nw > 0 THEN te ELSE 0 END AS train_after, te AS test_before,
       CASE WHEN nw > 0 THEN nw ELSE te END AS test_after FROM counts""",
    "unseen_keys": _readings("readings WHERE DateTime >= '2024-01-25'"),
    "union_by_position": f"WITH {BASE} SELECT id, {_r('Wind_Speed')} FROM readings",
    "union_by_name": f"WITH {BASE} SELECT id, {_r('Wind_Speed')}, CAST(NULL AS DOUBLE) AS Humidity FROM readings "
    f"WHERE DateTime < '2024-01-20' UNION ALL SELECT id, NULL, {_r('Humidity')} FROM readings "
    "WHERE DateTime >= '2024-01-20'",
    "changed_rows": f"""WITH {BASE},
older AS (SELECT * FROM readings WHERE DateTime < '2024-01-25'),
newer AS (
  SELECT id, CASE WHEN Wind_Speed < 20 THEN Temperature + 1 ELSE Temperature END AS Temperature,
         Zone_1_Power_Consumption
  FROM readings WHERE DateTime >= '2024-01-05'),
both_sides AS (
  SELECT coalesce(o.id, n.id) AS id,
         CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'delete'
              WHEN o.Temperature IS DISTINCT FROM n.Temperature
                OR o.Zone_1_Power_Consumption IS DISTINCT FROM n.Zone_1_Power_Consumption THEN 'update' END AS change,
         {_r('o.Temperature', 'old_Temperature')}, {_r('n.Temperature', 'new_Temperature')},
         {_r('o.Zone_1_Power_Consumption', 'old_Zone_1_Power_Consumption')},
         {_r('n.Zone_1_Power_Consumption', 'new_Zone_1_Power_Consumption')}
  FROM older o FULL JOIN newer n ON o.id = n.id)
SELECT * FROM both_sides WHERE change IS NOT NULL""",
    "stream_sync_state": "SELECT event_id, ts, user_id, event_type, round(value, 6) + 0.0 AS value, props FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) "
    "WHERE nth = 1",
    "appended_table": _readings("readings"),
    "overwritten_table": _readings("readings"),
    "replaced_versions": f"""WITH {BASE}, numbered AS (SELECT *, CAST(id AS BIGINT) % 3 AS rest FROM readings)
SELECT id, {_r('Wind_Speed')}, CAST(2 AS BIGINT) AS versions FROM numbered WHERE DateTime >= '2024-01-20'""",
    "appended_by_key": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) OVER (PARTITION BY "
    "l_orderkey, l_linenumber) = 1 AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AS stored FROM lineitem",
    "inserted_features": f"WITH {PREPARED} SELECT id, DateTime, "
    + ", ".join(_r(c) for c in [*names.WEATHER, *names.FLOWS])
    + f", {', '.join(names.INDICATORS)} FROM prepared",
    "keyed_table": f"WITH {BASE} SELECT id, {', '.join(_r(c) for c in names.FLOWS)} FROM readings",
    "csv_readings": f"WITH {BASE} SELECT id, date_trunc('minute', DateTime) AS DateTime, {_r('Wind_Speed')}, "
    f"{_r('general_diffuse_flows')} FROM readings",
    "json_records": "SELECT '{\"event_id\":' || event_id || ',\"user_id\":' || user_id || ',\"event_type\":\"' || "
    "event_type || '\"}' AS record FROM events",
    "json_records_back": f"WITH {BASE} SELECT id, {', '.join(_r(c) for c in names.WEATHER)} FROM readings",
    "column_split_back": "SELECT event_id, event_type, round(value, 6) + 0.0 AS value FROM events",
    "joined_predictions": f"WITH {JOINED} SELECT id, {_r('Zone_1_Power_Consumption')}, {_r('prediction_old')}, "
    f"{_r('prediction_new')}, {_r('abs(Zone_1_Power_Consumption - prediction_old)', 'error_old')}, "
    f"{_r('abs(Zone_1_Power_Consumption - prediction_new)', 'error_new')} FROM joined",
    "champion_challenger": f"WITH {JOINED} {_metric_row('joined')}",
    "champion_challenger_same_row": f"WITH {SCORED} {_metric_row('scored')}",
    "metrics_per_target": f"WITH {SCORED},\n{_per_target()} SELECT target, n AS rows, {_r('mse')}, {_r('rmse')}, "
    f"{_r('mae')}, {_r('r2')} FROM metrics",
    "metrics_uniform": f"WITH {SCORED},\n{_per_target()} SELECT {_r('avg(mse)', 'mse')}, {_r('avg(mae)', 'mae')}, "
    f"{_r('avg(r2)', 'r2')} FROM metrics",
    "axis_range": f"WITH {SCORED},\n{_per_target()} SELECT target, {_r('least(min(y), min(p))', 'low')}, "
    f"{_r('greatest(max(y), max(p))', 'high')} FROM pairs GROUP BY target",
    "actual_vs_predicted_long": f"WITH {SCORED} "
    + " UNION ALL ".join(
        f"SELECT DateTime, '{t}' AS target, {_r(t, 'actual')}, {_r(p, 'predicted')} FROM scored"
        for t, p in zip(names.TARGETS, ["prediction_new", "prediction_2", "prediction_3"], strict=True)
    ),
    "mean_importance": f"WITH {IMPORTANCE} SELECT feature, {_r('importance')} FROM averaged",
    "top_features": f"WITH {IMPORTANCE} SELECT feature, {_r('a.importance', 'importance')} FROM averaged a "
    "ORDER BY a.importance DESC, feature LIMIT 2",
    "ab_assignment": f"WITH {BASE} SELECT id, CASE WHEN {ODD} THEN 'Model A' ELSE 'Model B' END AS model FROM readings",
    "ab_routed_prediction": f"WITH {SCORED} SELECT id, "
    + _r(f"CASE WHEN {ODD} THEN prediction_old ELSE prediction_new END", "Prediction")
    + f", CASE WHEN {ODD} THEN 'Model A' ELSE 'Model B' END AS model FROM scored",
    "scaled_prediction": f"WITH {SCORED} SELECT id, {_r('prediction_new * 1.3', 'prediction_new')} FROM scored",
    "prediction_table": f"WITH {BASE} SELECT id, {', '.join(_r(c) for c in names.WEATHER)}, "
    + ", ".join(_r(f"{t} * 0.5", p) for t, p in zip(names.TARGETS, names.PREDICTED, strict=True))
    + " FROM readings",
    "latest_run_by_tag": "SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS experiment, "
    "o_orderdate AS started, round(o_totalprice, 6) + 0.0 AS price FROM orders WHERE o_orderstatus = 'F' "
    "ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 1",
    "experiments_by_tag": "SELECT o_orderpriority AS experiment, count(*) AS runs, max(o_orderdate) AS last_started "
    "FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority",
    "moments": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_r(f'avg({c})', 'mean')}, {_r(f'stddev_samp({c})', 'deviation')} FROM lineitem"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ),
    "synthetic_grid": f"WITH {BASE} SELECT i AS step, last + to_minutes(10 * i) AS DateTime "
    "FROM (SELECT max(DateTime) AS last FROM readings), range(1, 1009) r(i)",
}


def _group_means(column: str, prefix: str) -> str:
    means = ", ".join(f"avg({t}) AS {prefix}{i}" for i, t in enumerate(names.TARGETS, start=1))
    return f"{prefix}_means AS (SELECT {column}, {means} FROM split WHERE split = 'train' GROUP BY {column})"


MEANS = (
    f"{PREPARED},\n{SPLIT.format(source='prepared')},\n{_group_means('IsWeekend_1', 'w')},\n"
    f"{_group_means('DayOfWeek_1', 'd')},\n"
    + "overall AS (SELECT "
    + ", ".join(f"avg({t}) AS o{i}" for i, t in enumerate(names.TARGETS, start=1))
    + " FROM split WHERE split = 'train'),\n"
    "predicted AS (SELECT * FROM split JOIN w_means USING (IsWeekend_1) JOIN d_means USING (DayOfWeek_1), overall),\n"
    "judged AS (SELECT * FROM predicted WHERE split = 'test')"
)


def _mean_pairs(prefix: str, name: str) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{t}' AS target, {t} AS y, {prefix}{i} AS p FROM judged" for i, t in enumerate(names.TARGETS, start=1)
    )
    return f"""{name} AS (
  SELECT target, count(*) AS n, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
         1 - avg((y - p) * (y - p)) / var_pop(y) AS r2
  FROM ({union}) GROUP BY target)"""


# Each target's best 0/1 split of the train rows, and the group means it predicts.
BEST = (
    f"{PREPARED},\n{SPLIT.format(source='prepared')},\ngroups AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS target, '{f}' AS feature, {f} AS side, count(*) AS n, avg({t}) AS mean "
        f"FROM split WHERE split = 'train' GROUP BY {f}"
        for i, t in enumerate(names.TARGETS, start=1)
        for f in names.INDICATORS
    )
    + "),\nbest AS (SELECT target, feature FROM (SELECT target, feature, sum(n * mean * mean) AS gain FROM groups "
    "GROUP BY target, feature) QUALIFY row_number() OVER (PARTITION BY target ORDER BY gain DESC) = 1),\n"
    "chosen AS (SELECT g.* FROM groups g JOIN best b USING (target, feature)),\n"
    "sides AS (SELECT *, MAP {"
    + ", ".join(f"'{f}': {f}" for f in names.INDICATORS)
    + "} AS inputs FROM split WHERE split = 'test'),\njudged_best AS (SELECT id, "
    + ", ".join(f"max(CASE WHEN target = {i} THEN mean END) AS w{i}" for i in range(1, len(names.TARGETS) + 1))
    + " FROM sides JOIN chosen ON sides.inputs[chosen.feature] = chosen.side GROUP BY id)"
)

_W = ", ".join(_r(f"w{i}", p) for i, p in enumerate(names.PREDICTED, start=1))

ORACLES |= {
    "forest_group_means": f"WITH {MEANS} SELECT id, {_W} FROM judged",
    "boosted_group_metrics": f"WITH {MEANS},\n{_mean_pairs('w', 'm')} SELECT target, n AS rows, {_r('mse')}, "
    f"{_r('sqrt(mse)', 'rmse')}, {_r('mae')}, {_r('r2')} FROM m",
    "importance_of_one_input": "SELECT DISTINCT 'IsWeekend_1' AS feature, CAST(1 AS DOUBLE) AS importance FROM events",
    "variant_group_metrics": f"WITH {MEANS},\n{_mean_pairs('o', 'a')},\n{_mean_pairs('w', 'b')} "
    + " UNION ALL ".join(
        f"SELECT '{v.upper()}' AS variant, '{depth}' AS max_depth, {_r('avg(mse)', 'mse')}, {_r('avg(mae)', 'mae')}, "
        f"{_r('avg(r2)', 'r2')} FROM {v}"
        for v, depth in (("a", 0), ("b", 1))
    ),
    "model_comparison_means": f"WITH {MEANS},\n"
    f"pair AS (SELECT *, o1 AS prediction_old, w1 AS prediction_new FROM judged) {_metric_row('pair')}",
    "ab_group_means": f"WITH {MEANS} SELECT id, CASE WHEN {ODD} THEN 'Model A' ELSE 'Model B' END AS model, "
    + ", ".join(
        _r(f"CASE WHEN {ODD} THEN w{i} ELSE d{i} END", p) for i, p in enumerate(names.PREDICTED, start=1)
    )
    + " FROM judged",
    "prediction_table_means": f"WITH {MEANS} SELECT id, {', '.join(_r(c) for c in names.WEATHER)}, {_W} FROM predicted",
    "bootstrap_members": "SELECT CAST(1000 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS strangers FROM events LIMIT 1",
    "synthetic_moments": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", true AS mean_fits, true AS deviation_fits" for c in READING_DOUBLES
    ),
    # Repeated, missing and hot keys, ties, long numbers, stored state.
    "lookup_repeated_key_unused": _CUSTOMER.format("o_custkey"),
    "lookup_null_keys": _CUSTOMER.format("CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END"),
    "lookup_hot_key": _CUSTOMER.format("CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END"),
    "composite_key_lookup": f"""WITH {_LINES}
SELECT b.l_orderkey, CAST(b.l_linenumber AS BIGINT) AS l_linenumber, b.l_partkey, k.quantity, k.copies FROM lineitem b
LEFT JOIN (SELECT * FROM lines WHERE l_orderkey % 5 <> 0) k
ON b.l_orderkey = k.l_orderkey AND b.l_linenumber = k.l_linenumber""",
    "composite_key_changes": f"""WITH {_LINES},
older AS (SELECT * FROM lines WHERE l_orderkey % 5 <> 0),
newer AS (
  SELECT l_orderkey, l_linenumber, quantity + CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS quantity
  FROM lines WHERE l_orderkey % 3 <> 0)
SELECT * FROM (
  SELECT coalesce(o.l_orderkey, n.l_orderkey) AS l_orderkey,
         CAST(coalesce(o.l_linenumber, n.l_linenumber) AS BIGINT) AS l_linenumber,
         o.quantity AS old_quantity, n.quantity AS new_quantity,
         CASE WHEN o.l_orderkey IS NULL THEN 'insert' WHEN n.l_orderkey IS NULL THEN 'delete'
              WHEN o.quantity <> n.quantity THEN 'update' END AS change
  FROM older o FULL JOIN newer n ON o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber)
WHERE change IS NOT NULL""",
    "row_slice_ties": "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000 OFFSET 100",
    "latest_many_rows": "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 12000",
    "time_steps_far": "SELECT event_id, epoch_us(ts) + (event_id + 250000000) * 600000000 AS micros FROM events",
    "stored_refresh": f"""WITH {REFRESH}
SELECT 'train' AS part, id FROM (SELECT * FROM train UNION ALL SELECT * FROM test)
UNION ALL SELECT 'test', id FROM newer
UNION ALL SELECT 'features', id FROM (SELECT * FROM source WHERE DateTime < '2024-01-25' UNION ALL SELECT * FROM newer)""",
    "ab_scored_null_keys": f"""WITH {BASE},
keyed AS (SELECT CASE WHEN Humidity >= 10 THEN id END AS id, Humidity FROM readings)
SELECT id, {_r('Humidity')}, {_r(f'CASE WHEN id IS NOT NULL AND {ODD} THEN Humidity ELSE -Humidity END', 'Prediction')},
       CASE WHEN id IS NOT NULL AND {ODD} THEN 'Model A' ELSE 'Model B' END AS model FROM keyed""",
    "synthetic_independence": 'SELECT CAST(20000 AS BIGINT) AS "values", CAST(0 AS BIGINT) AS shared FROM events LIMIT 1',
    "contract_long_integers": "SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN event_id + 9007199254740993 END AS number FROM events",
    "contract_fractions": "SELECT event_id, 'number' AS \"column\", CAST(event_id + 9007199254740993 AS VARCHAR) || '.7' AS value "
    "FROM events WHERE event_id % 3 = 2",
    "text_category_fit": """WITH found AS (
  SELECT event_type AS label, count(*) AS rows, row_number() OVER (ORDER BY event_type) - 1 AS place FROM events
  WHERE event_type IS NOT NULL GROUP BY event_type)
SELECT place, label, CASE WHEN place > 0 THEN rows END AS n FROM found""",
    "stream_sync_deletes": _SYNCED,
    "stream_sync_compacted": _SYNCED,
    "column_data_document": """SELECT '{"columns":["event_id","user_id","event_type","props"],"data":[[' || event_id || ','
|| user_id || ',' || CAST(to_json(event_type) AS VARCHAR) || ',' || CAST(to_json(props) AS VARCHAR) || ']]}' AS document
FROM events""",
    "column_data_document_back": "SELECT event_id, event_type, props FROM events",
    "boosted_many_rounds": f"WITH {MEANS},\n{_mean_pairs('w', 'm')} SELECT target, n AS rows, {_r('mse')}, "
    f"{_r('sqrt(mse)', 'rmse')}, {_r('mae')}, {_r('r2')} FROM m",
    "forest_best_split": f"WITH {BEST} SELECT id, {_W} FROM judged_best",
    "forest_best_split_importance": f"WITH {BEST} SELECT feature, round(count(*) / {len(names.TARGETS)}.0, 6) + 0.0 "
    "AS importance FROM best GROUP BY feature",
    "logged_runs": "SELECT event_type AS run_id, 'by_type' AS experiment, CAST(count(*) AS VARCHAR) AS rows, "
    "round(max(value), 6) + 0.0 AS top, event_type = 'click' AS found FROM events GROUP BY event_type",
    "stored_parts": f"WITH {PREPARED},\n{SPLIT.format(source='prepared')} SELECT split AS part, id, "
    f"CAST(2 AS BIGINT) AS copies, CAST(2 AS BIGINT) AS stamps, {_r('Zone_1_Power_Consumption', 'zone')} FROM split",
}

_NEWER = """newer AS (
  SELECT *, CASE WHEN Wind_Speed < 20 THEN Temperature + 1 ELSE Temperature END AS raised FROM readings WHERE DateTime >= '2024-01-05')"""
_NUMBERS = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM calendar" for c in names.NUMERIC_FEATURES)
_LEVELS = "SELECT '{0}' AS \"column\", count(*) AS rows, count({1}) AS present, string_agg(DISTINCT {1}, ',' ORDER BY {1}) AS levels FROM kinds"
_CHART_PAIRS = " UNION ALL ".join(
    f"SELECT '{t}' AS target, '{series}' AS series, epoch_us(DateTime) AS m, DateTime AS t, CAST({c} AS DOUBLE) AS v FROM scored WHERE {c} IS NOT NULL"
    for t, p in zip(names.TARGETS, ["prediction_new", "prediction_2", "prediction_3"], strict=True)
    for series, c in (("actual", t), ("predicted", p))
)
ORACLES |= {
    "changes_between_versions": ORACLES["changed_rows"],
    "changes_of_few_parts": f"""WITH {BASE} SELECT id, 'update' AS change, {_r('Wind_Speed', 'old_Wind_Speed')}, CAST(-1 AS DOUBLE) AS new_Wind_Speed,
{_r('Humidity', 'old_Humidity')}, {_r('Humidity', 'new_Humidity')} FROM readings WHERE CAST(id AS BIGINT) % 997 = 5""",
    "version_feed_state": f"WITH {BASE}, {_NEWER} SELECT id, {_r('raised', 'Temperature')}, {_r('Wind_Speed')} FROM newer",
    "filtered_append": f"WITH {BASE} SELECT id, {', '.join(_r(c) for c in READING_DOUBLES)} FROM readings",
    "point_lookups": ORACLES["key_list_lookup"],
    "stream_sync_parts": "SELECT user_id, event_id, ts, CAST(3 AS BIGINT) AS refused FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "stream_sync_expired": """WITH e AS (SELECT *, event_type = 'purchase' AS gone FROM events),
w0 AS (SELECT max(ts) - INTERVAL 3 DAY AS w FROM e WHERE event_id % 3 = 0),
b1 AS (SELECT e.* FROM e, w0 WHERE event_id % 3 = 1 AND ts >= w),
w1 AS (SELECT greatest((SELECT w FROM w0), max(ts) - INTERVAL 3 DAY) AS w FROM b1),
b2 AS (SELECT e.* FROM e, w1 WHERE event_id % 3 = 2 AND ts >= w),
w2 AS (SELECT greatest((SELECT w FROM w1), max(ts) - INTERVAL 3 DAY) AS w FROM b2),
s0 AS (SELECT * FROM e WHERE event_id % 3 = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
k0 AS (SELECT s0.* FROM s0, w0 WHERE NOT (gone AND ts < w)),
s1 AS (SELECT * FROM (SELECT * FROM k0 UNION ALL SELECT * FROM b1) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
k1 AS (SELECT s1.* FROM s1, w1 WHERE NOT (gone AND ts < w)),
s2 AS (SELECT * FROM (SELECT * FROM k1 UNION ALL SELECT * FROM b2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id, ts, CASE WHEN gone THEN 'deleted' ELSE 'row' END AS kind FROM s2, w2 WHERE NOT (gone AND ts < w)
UNION ALL SELECT user_id, event_id, ts, 'late' FROM e, w0 WHERE event_id % 3 = 1 AND ts < w
UNION ALL SELECT user_id, event_id, ts, 'late' FROM e, w1 WHERE event_id % 3 = 2 AND ts < w""",
    "stored_profile": ORACLES["prep_profile"],
    "stored_moments": f"""WITH {CALENDAR}, numbers AS ({_NUMBERS})
SELECT "column", {_r('avg(x)', 'mean')}, {_r('stddev_samp(x)', 'deviation')}, count(*) AS rows, count(x) AS present,
{_r('min(x)', 'low')}, {_r('max(x)', 'high')} FROM numbers GROUP BY "column\"""",
    "merged_levels": f"""WITH {CALENDAR}, kinds AS (
  SELECT CAST(DayOfWeek AS VARCHAR) AS d, CASE WHEN Humidity > 3 THEN substr(id, 1, 1) END AS kind FROM calendar)
{_LEVELS.format('DayOfWeek', 'd')} UNION ALL {_LEVELS.format('kind', 'kind')}""",
    "observed_contract": ORACLES["contract_columns"],
    "observed_split": ORACLES["temporal_split"],
    "chart_points": f"""WITH {SCORED}, points AS ({_CHART_PAIRS}),
ends AS (SELECT min(epoch_us(DateTime)) AS a, max(epoch_us(DateTime)) AS b FROM scored),
placed AS (SELECT p.*, (m - a) // ((b - a) // 50 + 1) AS pixel FROM points p, ends)
SELECT target, series, CAST(pixel AS BIGINT) AS pixel, count(*) AS points,
  first(t ORDER BY t, v) AS first_time, round(first(v ORDER BY t, v), 6) + 0.0 AS first_value,
  last(t ORDER BY t, v) AS last_time, round(last(v ORDER BY t, v), 6) + 0.0 AS last_value,
  first(t ORDER BY v, t) AS low_time, round(first(v ORDER BY v, t), 6) + 0.0 AS low_value,
  first(t ORDER BY v DESC, t) AS high_time, round(first(v ORDER BY v DESC, t), 6) + 0.0 AS high_value
FROM placed GROUP BY target, series, pixel""",
    "arrow_interaction": ORACLES["weather_interaction"],
    "wrapped_models_routed": f"""WITH {SCORED} SELECT id, {_r('Humidity')}, {_r('prediction_2')},
{_r(f'(Humidity + prediction_2) * CASE WHEN {ODD} THEN 1.3 ELSE 0.7 END', 'Prediction')},
CASE WHEN {ODD} THEN 'Model A' ELSE 'Model B' END AS model FROM scored""",
    "stored_order_slice": f"""WITH {BASE}, placed AS (
  SELECT *, row_number() OVER (ORDER BY DateTime, id) - 1 AS place, count(*) OVER () AS n FROM readings)
SELECT id, DateTime, {_r('Wind_Speed')} FROM placed WHERE place >= n // 3 AND place < n // 2""",
    "position_draws": """WITH placed AS (SELECT CAST(event_id AS VARCHAR) AS id, row_number() OVER (ORDER BY ts, CAST(event_id AS VARCHAR)) - 1 AS place FROM events),
draws AS (SELECT CAST('0x' || right(md5('7/' || n), 15) AS BIGINT) % (SELECT count(*) FROM events) AS place FROM range((SELECT count(*) FROM events)) r(n))
SELECT id, count(*) AS times FROM draws JOIN placed USING (place) GROUP BY id""",
    "stamped_rows": f"SELECT CAST(event_id AS VARCHAR) AS id, TIMESTAMP '2024-03-01 01:02:03.456789' AS {names.STAMP}, true AS later FROM events",
}
_DRAWN = "sqrt(-2 * ln((CAST('0x' || left(md5('0/{0}/' || i), 13) AS BIGINT) + 1) / 4503599627370496.0)) * cos(CAST('0x' || right(md5('0/{0}/' || i), 13) AS BIGINT) / 4503599627370496.0 * 2 * pi())"
_GRID = f"""WITH {BASE}, m AS (SELECT max(DateTime) AS last, {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in READING_DOUBLES)} FROM readings)"""
ORACLES |= {
    "synthetic_rows": f"{_GRID} SELECT last + to_minutes(10 * i) AS DateTime, "
    + ", ".join(_r(f"{_DRAWN.format(c)} * s_{c} + m_{c}", c) for c in READING_DOUBLES)
    + " FROM m, range(1, 1009) r(i)",
}
# The same rows after the test set, prepared as the readings are: with their own key and statistics.
_MADE = ", ".join(f"{_DRAWN.format(c)} * s_{c} + m_{c} AS {c}" for c in READING_DOUBLES)
_BATCH = f"""{_GRID.removeprefix('WITH ')},
made AS (SELECT CAST(CAST(floor(epoch(DateTime)) AS BIGINT) AS VARCHAR) AS id, * FROM (
  SELECT (SELECT max(DateTime) FROM readings WHERE DateTime >= '2024-01-20' AND DateTime < '2024-01-25') + to_minutes(10 * i) AS DateTime, {_MADE}
  FROM m, range(1, 1009) r(i)))"""
ORACLES["synthetic_batch"] = ORACLES["prep_apply"].replace("FROM readings)", "FROM made)").replace(BASE, _BATCH)
