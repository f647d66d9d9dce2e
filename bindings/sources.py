"""Scans, sinks and the schema contract."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from bindings.base import H, KEY, P, ROUNDED_SCORES, RULES, SCORES, TARGET, TS, TYPES, VALUES, by_type, market, predictions, query, r, table
from hourloom.config import ColumnRule
from hourloom.functions.clock import day_text, hour_start, micros
from hourloom.operators.evaluation import regression_metrics
from hourloom.operators.tables import time_range, union_chunks
from hourloom.sources import files, schema, sinks
from hourloom.sources.workspace import fresh_folder

ALL = f"WITH {H} SELECT series_key, ts, {r(*VALUES)} FROM h"


def _text(df):
    return df.select(F.concat(F.date_format(TS, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")).alias("timestamp"), *[c for c in df.columns if c not in (KEY, TS)])


def land_raw_folder(spark, df, market_code="all"):
    folder = fresh_folder(spark, "raw")
    parts = {"prices": VALUES[:1], "load": VALUES[1:2], "gen_forecast": VALUES[2:]}
    for name, columns in parts.items():
        sinks.write_csv(_text(df.select(KEY, TS, *columns)), f"{folder}/{name}_{market_code}.csv")
    return folder


@query("scan_series_csv", ALL)
def scan_series_csv(spark, sf_dir):
    return files.read_raw_folder(spark, land_raw_folder(spark, market(spark, sf_dir)), "all")


@query("scan_legacy_csv", f"WITH {H} SELECT series_key, ts, {r(TARGET)} FROM h WHERE day_ahead_price IS NOT NULL")
def scan_legacy_csv(spark, sf_dir):
    shape = "dd.MM.yyyy HH:mm"
    end = F.timestamp_add("HOUR", F.lit(1), F.col(TS))
    cell = F.concat(F.date_format(TS, shape), F.lit(" - "), F.date_format(end, shape))
    price = F.coalesce(F.col(TARGET).cast("string"), F.lit("n/e"))
    path = fresh_folder(spark, "legacy") + ".csv"
    out = market(spark, sf_dir).select(cell.alias("MTU (UTC)"), price.alias("Day-ahead Price [EUR/MWh]"))
    out.write.option("header", True).option("sep", ";").csv(path)
    return files.read_legacy_csv(spark, path, "all")


def _payload(df, *fields):
    """One payload per series and day: parallel arrays in time order (at most 24 hours)."""
    per_day = df.groupBy(KEY, day_text(TS).alias("day")).agg(F.sort_array(F.collect_list(F.struct(TS, *fields))).alias("rows"))
    seconds = F.transform("rows", lambda x: (micros(x[TS]) / 1_000_000).cast("bigint"))
    return per_day.withColumn("unix_seconds", seconds)


def _land(spark, df, name):
    path = fresh_folder(spark, name)
    sinks.write_json(df, path)
    return path


@query("scan_payload_arrays", f"WITH {TYPES} SELECT series_key, ts, {r(TARGET)} FROM t")
def scan_payload_arrays(spark, sf_dir):
    payload = _payload(by_type(spark, sf_dir), TARGET).select(KEY, "unix_seconds", F.col("rows")[TARGET].alias("price"))
    return files.read_price_arrays(spark, _land(spark, payload, "arrays"))


@query("scan_payload_pairs", f"WITH {H} SELECT series_key, ts, {r(TARGET)} FROM h WHERE day_ahead_price IS NOT NULL")
def scan_payload_pairs(spark, sf_dir):
    def pair(x):
        return F.array((micros(x[TS]) / 1000).cast("double"), x[TARGET])

    payload = _payload(market(spark, sf_dir), TARGET).select(KEY, F.transform("rows", pair).alias("series"))
    payload = payload.withColumn("series", F.to_json("series"))
    path = fresh_folder(spark, "pairs")
    payload.select(F.concat(F.lit('{"series_key":"'), KEY, F.lit('","series":'), "series", F.lit("}"))).write.text(path)
    return files.read_pairs(spark, path)


def _kinds(names):
    return F.array(*[F.struct(F.lit(n).alias("name"), F.col("rows")[c].alias("data")) for n, c in names.items()]).alias("production_types")


@query(
    "payload_production_mix",
    f"""WITH {H} SELECT series_key, ts,
  {r("forecast_wind=coalesce(day_ahead_price, 0) + coalesce(forecast_load, 0)", "forecast_solar=coalesce(forecast_wind, 0)")} FROM h""",
)
def payload_production_mix(spark, sf_dir):
    names = {"Wind onshore": VALUES[0], "Wind offshore": VALUES[1], "Photovoltaics": VALUES[2], "Nuclear": VALUES[3]}
    payload = _payload(market(spark, sf_dir), *VALUES).select(KEY, "unix_seconds", _kinds(names))
    return files.production_mix(files.read_mix(spark, _land(spark, payload, "mix")))


@query(
    "payload_load_select",
    f"""WITH {H} SELECT 'named' AS series_key, ts, {r("forecast_load")} FROM h
UNION ALL SELECT 'summed', ts, {r("forecast_load=coalesce(day_ahead_price, 0) + coalesce(forecast_load, 0) + coalesce(forecast_wind, 0)")} FROM h""",
)
def payload_load_select(spark, sf_dir):
    day = _payload(market(spark, sf_dir), *VALUES)
    named = {"Nuclear": VALUES[0], "Residual load": VALUES[1], "Load": VALUES[2]}
    summed = {"Nuclear": VALUES[0], "Gas": VALUES[1], "Biomass": VALUES[2]}
    both = day.select(F.lit("named").alias(KEY), "unix_seconds", _kinds(named)).unionByName(
        day.select(F.lit("summed").alias(KEY), "unix_seconds", _kinds(summed))
    )
    return files.load_from_mix(files.read_mix(spark, _land(spark, both, "load")))


@query("chunk_union", ALL)
def chunk_union(spark, sf_dir):
    h = market(spark, sf_dir)
    days = h.agg(F.to_date(F.min(TS)).alias("a"), F.to_date(F.max(TS)).alias("b")).first()
    step = max(1, ((days.b - days.a).days + 3) // 3)
    begins = [days.a + timedelta(days=step * i) for i in range(3)]
    # neighbouring chunks share a day
    return union_chunks(time_range(h, str(a), str(a + timedelta(days=step))) for a in begins)


@query(
    "scan_parquet_range",
    f"""WITH {TYPES} SELECT series_key, ts, {r(*VALUES)} FROM t
WHERE ts >= TIMESTAMP '2024-01-04 23:00:00' AND ts < TIMESTAMP '2024-01-19 23:00:00'""",
)
def scan_parquet_range(spark, sf_dir):
    path = fresh_folder(spark, "cache")
    sinks.write_series(by_type(spark, sf_dir), path)
    return files.read_cached(spark, path, "2024-01-05", "2024-01-19", "Europe/Berlin").drop("ts_month")


SOURCE_LIMIT = 30.0


def _source(spark, sf_dir, *kinds):
    e = table(spark, sf_dir, "events")
    price = F.avg(F.when(F.col("event_type").isin(*kinds), F.col("value")))
    return e.groupBy(F.col("user_id").cast("string").alias(KEY), hour_start(TS).alias(TS)).agg(price.alias(TARGET))


_SOURCES = {"cache": ("purchase", "view", "click"), "local": ("purchase", "view", "click", "signup"), "api": ("purchase", "view", "click", "signup", "error")}


@query(
    "source_precedence",
    "WITH "
    + ", ".join(
        f"""s{i} AS (SELECT CAST(user_id AS VARCHAR) AS series_key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts,
  avg(value) FILTER (WHERE event_type IN ({", ".join(repr(k) for k in kinds)})) AS day_ahead_price, '{name}' AS source, {i} AS rank
  FROM events GROUP BY 1, 2)"""
        for i, (name, kinds) in enumerate(_SOURCES.items())
    )
    + f""", every AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2),
good AS (SELECT series_key, rank FROM every GROUP BY 1, 2
  HAVING 100.0 * count(*) FILTER (WHERE day_ahead_price IS NULL) / count(*) <= {SOURCE_LIMIT}),
best AS (SELECT series_key, min(rank) AS rank FROM good GROUP BY 1)
SELECT e.series_key, e.ts, {r(TARGET)}, e.source FROM every e JOIN best b ON e.series_key = b.series_key AND e.rank = b.rank""",
)
def source_precedence(spark, sf_dir):
    return files.first_acceptable([(name, _source(spark, sf_dir, *kinds)) for name, kinds in _SOURCES.items()], max_missing_pct=SOURCE_LIMIT)


@query(
    "latest_run",
    f"""WITH {TYPES}, runs AS (SELECT *, strftime(ts, '%Y-%m') || '-w' || CAST((day(ts) - 1) // 7 AS VARCHAR) AS run_id FROM t)
SELECT series_key, ts, {r(*VALUES)}, run_id FROM runs WHERE run_id = (SELECT max(run_id) FROM runs)""",
)
def latest_run(spark, sf_dir):
    week = F.concat(F.date_format(TS, "yyyy-MM"), F.lit("-w"), F.floor((F.dayofmonth(TS) - 1) / 7).cast("string"))
    path = fresh_folder(spark, "runs")
    by_type(spark, sf_dir).withColumn("run_id", week).write.partitionBy("run_id").parquet(path)
    return files.latest_run(spark, path)


@query("sink_parquet", f"WITH {TYPES} SELECT series_key, ts, {r(*VALUES)}, '2024-01' AS ts_month, 'run1' AS run_id FROM t")
def sink_parquet(spark, sf_dir):
    path = fresh_folder(spark, "sink")
    sinks.write_series(by_type(spark, sf_dir), path, "run1")
    return spark.read.parquet(path).withColumn("ts_month", F.col("ts_month").cast("string"))


@query("sink_csv", f"WITH {P} SELECT series_key, ts, {r('actual', 'predicted', 'residual')} FROM p")
def sink_csv(spark, sf_dir):
    path = fresh_folder(spark, "sink")
    p = predictions(spark, sf_dir)
    sinks.write_csv(p, path)
    return spark.read.option("header", True).schema(p.schema).csv(path)


@query(
    "sink_metrics_json",
    f"""WITH {P}, s AS (SELECT series_key, {SCORES} FROM p GROUP BY 1)
SELECT series_key, 'baseline' AS model, 'run1' AS run_id, {ROUNDED_SCORES} FROM s""",
)
def sink_metrics_json(spark, sf_dir):
    path = fresh_folder(spark, "metrics")
    sinks.write_metrics(regression_metrics(predictions(spark, sf_dir)), "baseline", "run1", path)
    record = spark.read.schema(
        f"{KEY} string, model string, run_id string, timestamp string, metrics struct<mae:double,rmse:double,smape:double,r2:double,n_samples:bigint>"
    ).json(path)
    return record.select(KEY, "model", "run_id", "metrics.*")


def _loose(spark, sf_dir):
    """The series with the price as text and the load as whole numbers."""
    t = by_type(spark, sf_dir)
    return t.withColumns({VALUES[0]: F.col(VALUES[0]).cast("string"), VALUES[1]: F.floor(VALUES[1])})


@query(
    "schema_enforce",
    f"WITH {TYPES} SELECT series_key, ts, {r(VALUES[0], f'{VALUES[1]}=CAST(floor({VALUES[1]}) AS DOUBLE)', *VALUES[2:])} FROM t",
)
def schema_enforce(spark, sf_dir):
    return schema.enforce_schema(_loose(spark, sf_dir), RULES)


@query(
    "schema_validate",
    f"""WITH {TYPES}, f(column_name, severity, expected, found) AS (VALUES
  ('day_ahead_price', 'warning', 'double', 'string'), ('forecast_load', 'warning', 'double', 'bigint'), ('actual_load', 'error', 'double', 'absent'))
SELECT series_key, column_name, severity, expected, found, count(*) AS n_rows FROM t CROSS JOIN f GROUP BY ALL""",
)
def schema_validate(spark, sf_dir):
    df = _loose(spark, sf_dir)
    found = schema.schema_findings(df, (*RULES, ColumnRule("actual_load", required=True)))
    literal = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("column_name", "severity", "expected", "found"), f, strict=True)]) for f in found])
    return df.groupBy(KEY).agg(F.count("*").alias("n_rows")).select(KEY, "n_rows", F.inline(literal))


@query("read_write_typed", f"WITH {TYPES} SELECT series_key, ts, {r(*VALUES)}, 'parquet' AS kind FROM t UNION ALL SELECT series_key, ts, {r(*VALUES)}, 'csv' FROM t")
def read_write_typed(spark, sf_dir):
    df = by_type(spark, sf_dir)
    parts = []
    for kind in ("parquet", "csv"):
        path = f"{fresh_folder(spark, 'typed')}.{kind}"
        files.write_typed(df, path, RULES)
        parts.append(files.read_typed(spark, path, RULES).withColumn("kind", F.lit(kind)))
    return parts[0].unionByName(parts[1])
