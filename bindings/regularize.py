"""Grids, resampling, fills, duplicates and time zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import H, KEY, TARGET, TS, USERS, VALUES, by_user, market, query, r, table
from bindings.tables import SPARSE, sparse_users
from hourloom.functions.clock import day_start, hour_start, plus_days
from hourloom.functions.zones import is_dst
from hourloom.operators import regularize as reg

ZONE = "Europe/Berlin"


def grid_sql(source: str, name: str = "g") -> str:
    """Every hour between the first and last stamp of each series, left-joined to the rows."""
    return f"""{name}_hours AS (SELECT series_key, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM {source} GROUP BY series_key),
{name} AS (SELECT k.series_key, k.ts, s.* EXCLUDE (series_key, ts) FROM {name}_hours k LEFT JOIN {source} s ON s.series_key = k.series_key AND s.ts = k.ts)"""


@query("hourly_grid", f"WITH {USERS}, {grid_sql('u')} SELECT series_key, ts, {r(TARGET)} FROM g")
def hourly_grid(spark, sf_dir):
    return reg.complete_hours(by_user(spark, sf_dir).select(KEY, TS, TARGET))


def _raw(spark, sf_dir):
    """Raw rows per event type; small values count as missing."""
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    return e.select("event_id", F.col("event_type").alias(KEY), TS, F.when(v >= 10, v).alias(TARGET), F.when(v < 60, v).alias(VALUES[1]))


_RAW = """raw AS (SELECT event_id, event_type AS series_key, ts, CASE WHEN value >= 10 THEN value END AS day_ahead_price,
  CASE WHEN value < 60 THEN value END AS forecast_load FROM events)"""
_HOUR = "CAST(date_trunc('hour', ts) AS TIMESTAMP)"


@query(
    "resample_first",
    f"""WITH {_RAW}, s AS (SELECT series_key, {_HOUR} AS ts, arg_min(day_ahead_price, ts) FILTER (WHERE day_ahead_price IS NOT NULL) AS day_ahead_price,
  arg_min(forecast_load, ts) FILTER (WHERE forecast_load IS NOT NULL) AS forecast_load FROM raw GROUP BY 1, 2), {grid_sql('s')}
SELECT series_key, ts, {r(*VALUES[:2])} FROM g""",
)
def resample_first(spark, sf_dir):
    return reg.resample_first(_raw(spark, sf_dir), VALUES[:2], tie="event_id")


@query(
    "resample_mean",
    f"""WITH {_RAW}, s AS (SELECT series_key, {_HOUR} AS ts, avg(day_ahead_price) AS day_ahead_price, avg(forecast_load) AS forecast_load
  FROM raw GROUP BY 1, 2), {grid_sql('s')} SELECT series_key, ts, {r(*VALUES[:2])} FROM g""",
)
def resample_mean(spark, sf_dir):
    return reg.resample_mean(_raw(spark, sf_dir), VALUES[:2])


def interpolation_sql(source: str, columns, limit: int = 6, name: str = "filled") -> str:
    """Linear fill of the first ``limit`` cells of every gap on a complete grid."""
    back = "PARTITION BY series_key ORDER BY ts ROWS UNBOUNDED PRECEDING"
    ahead = "PARTITION BY series_key ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    known = ", ".join(
        f"""last_value({c} IGNORE NULLS) OVER ({back}) AS pv_{c}, max(CASE WHEN {c} IS NOT NULL THEN rn END) OVER ({back}) AS ps_{c},
    first_value({c} IGNORE NULLS) OVER ({ahead}) AS nv_{c}, min(CASE WHEN {c} IS NOT NULL THEN rn END) OVER ({ahead}) AS ns_{c}"""
        for c in columns
    )
    lines = ", ".join(
        f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN rn - ps_{c} <= {limit}
    THEN coalesce(pv_{c} + (nv_{c} - pv_{c}) * (rn - ps_{c}) / (ns_{c} - ps_{c}), pv_{c}) END AS {c}"""
        for c in columns
    )
    return f"""{name}_n AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts) AS rn FROM {source}),
{name}_k AS (SELECT *, {known} FROM {name}_n), {name} AS (SELECT series_key, ts, {lines} FROM {name}_k)"""


@query(
    "interpolate_linear",
    f"WITH {SPARSE}, {grid_sql('x')}, {interpolation_sql('g', VALUES[:2])} SELECT series_key, ts, {r(*VALUES[:2])} FROM filled",
)
def interpolate_linear(spark, sf_dir):
    return reg.interpolate_hours(sparse_users(spark, sf_dir).select(KEY, TS, *VALUES[:2]), VALUES[:2], 6)


@query(
    "ffill_limit",
    f"""WITH {USERS}, {grid_sql('u')}, n AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts) AS rn FROM g),
k AS (SELECT *, max(CASE WHEN day_ahead_price IS NOT NULL THEN rn END) OVER w AS s, last_value(day_ahead_price IGNORE NULLS) OVER w AS v
  FROM n WINDOW w AS (PARTITION BY series_key ORDER BY ts ROWS UNBOUNDED PRECEDING))
SELECT series_key, ts, {r('day_ahead_price=CASE WHEN rn - s <= 2 THEN v END')} FROM k""",
)
def ffill_limit(spark, sf_dir):
    return reg.fill_forward_hours(by_user(spark, sf_dir).select(KEY, TS, TARGET), [TARGET], 2)


def _repeated(spark, sf_dir):
    """Every event stamped with its hour: most hours repeat."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias(KEY), hour_start(TS).alias(TS), F.col("value").alias(TARGET), "event_id")


_REPEATED = f"x AS (SELECT CAST(user_id AS VARCHAR) AS series_key, {_HOUR} AS ts, value AS day_ahead_price, event_id FROM events)"


@query("dedupe_mean", f"WITH {_REPEATED} SELECT series_key, ts, {r('day_ahead_price=avg(day_ahead_price)')} FROM x GROUP BY 1, 2")
def dedupe_mean(spark, sf_dir):
    return reg.handle_repeats(_repeated(spark, sf_dir), [TARGET], "average")


@query("dedupe_first", f"WITH {_REPEATED} SELECT series_key, ts, {r('day_ahead_price=arg_min(day_ahead_price, event_id)')}, min(event_id) AS event_id FROM x GROUP BY 1, 2")
def dedupe_first(spark, sf_dir):
    return reg.handle_repeats(_repeated(spark, sf_dir), [TARGET], "first", "event_id")


@query("dedupe_none", f"WITH {_REPEATED} SELECT series_key, ts, {r(TARGET)}, event_id FROM x QUALIFY count(*) OVER (PARTITION BY series_key, ts) = 1")
def dedupe_none(spark, sf_dir):
    return reg.dedupe_none(_repeated(spark, sf_dir))


# --- time zones: shift the tables' month over both changes of 2024 -------------

_SHIFTS = {"spring": 75, "autumn": 285}
_SPRING, _AUTUMN = "TIMESTAMP '2024-03-31 01:00:00'", "TIMESTAMP '2024-10-27 01:00:00'"


def _shifted(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", TS)
    parts = [e.select(F.lit(name).alias(KEY), "event_id", plus_days(hour_start(TS), n).alias(TS)) for name, n in _SHIFTS.items()]
    return parts[0].unionByName(parts[1])


_SHIFTED = "x AS (" + " UNION ALL ".join(f"SELECT '{name}' AS series_key, event_id, {_HOUR} + INTERVAL {n} DAY AS ts FROM events" for name, n in _SHIFTS.items()) + ")"
_SUMMER_UTC = f"(ts >= {_SPRING} AND ts < {_AUTUMN})"


@query(
    "localize_to_utc",
    f"""WITH {_SHIFTED}, f AS (SELECT *, min(event_id) OVER (PARTITION BY series_key, ts) AS first_id FROM x)
SELECT series_key, event_id, CASE
  WHEN ts >= TIMESTAMP '2024-03-31 02:00:00' AND ts < TIMESTAMP '2024-03-31 03:00:00' THEN {_SPRING}
  WHEN ts >= TIMESTAMP '2024-10-27 02:00:00' AND ts < TIMESTAMP '2024-10-27 03:00:00'
    THEN CASE WHEN event_id = first_id THEN ts - INTERVAL 2 HOUR ELSE ts - INTERVAL 1 HOUR END
  WHEN ts >= TIMESTAMP '2024-03-31 03:00:00' AND ts < TIMESTAMP '2024-10-27 02:00:00' THEN ts - INTERVAL 2 HOUR
  ELSE ts - INTERVAL 1 HOUR END AS ts FROM f""",
)
def localize_to_utc(spark, sf_dir):
    return reg.localize_to_utc(_shifted(spark, sf_dir), ZONE, "event_id")


@query("convert_timezone", f"WITH {_SHIFTED} SELECT series_key, event_id, ts, ts + CASE WHEN {_SUMMER_UTC} THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS local_ts FROM x")
def convert_timezone(spark, sf_dir):
    return reg.zone_column(_shifted(spark, sf_dir), ZONE)


@query(
    "zone_hourly_range",
    f"""WITH {_SHIFTED}, e AS (SELECT series_key, CAST(date_trunc('day', min(ts)) AS TIMESTAMP) AS a, CAST(date_trunc('day', max(ts)) AS TIMESTAMP) AS b FROM x GROUP BY 1),
u AS (SELECT series_key, a - CASE WHEN series_key = 'autumn' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS a,
  b - CASE WHEN series_key = 'spring' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS b FROM e),
g AS (SELECT series_key, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM u)
SELECT series_key, ts, ts + CASE WHEN {_SUMMER_UTC} THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS local_ts FROM g""",
)
def zone_hourly_range(spark, sf_dir):
    ends = _shifted(spark, sf_dir).groupBy(KEY).agg(day_start(F.min(TS)).alias("start"), day_start(F.max(TS)).alias("end"))
    return reg.zone_hours(ends, ZONE)


def _last_sunday(year: str, month: int) -> str:
    """SQL: last Sunday of a 31- or 30-day month."""
    end = f"make_date({year}, {month}, {30 if month == 9 else 31})"
    return f"({end} - CAST(dayofweek({end}) AS INTEGER))"


_YEARS = "y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"


def _autumn_day(year: str) -> str:
    return f"CASE WHEN {year} < 1996 THEN {_last_sunday(year, 9)} ELSE {_last_sunday(year, 10)} END"


@query(
    "dst_transition_days",
    f"""WITH {_YEARS} SELECT year, CAST({_last_sunday('year', 3)} AS VARCHAR) AS day FROM y
UNION ALL SELECT year, CAST({_autumn_day('year')} AS VARCHAR) FROM y""",
)
def dst_transition_days(spark, sf_dir):
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return reg.dst_change_days(years, ZONE).withColumn("day", F.col("day").cast("string"))


@query(
    "is_dst_active",
    f"""WITH o AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
SELECT o_orderkey, ts, CAST(ts >= CAST({_last_sunday('y', 3)} AS TIMESTAMP) + INTERVAL 1 HOUR AND ts < CAST({_autumn_day('y')} AS TIMESTAMP) + INTERVAL 1 HOUR AS INTEGER) AS is_dst FROM o""",
)
def is_dst_active(spark, sf_dir):
    at = F.timestamp_add("HOUR", F.col("o_orderkey") % 24, F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", at.alias(TS)).withColumn("is_dst", is_dst(TS, ZONE))


@query("sum_wind_sources", f"WITH {H} SELECT series_key, ts, {r('forecast_wind=coalesce(forecast_wind, 0.0) + coalesce(forecast_solar, 0.0)')} FROM h")
def sum_wind_sources(spark, sf_dir):
    parts = market(spark, sf_dir).select(KEY, TS, F.col(VALUES[2]).alias("onshore"), F.col(VALUES[3]).alias("offshore"))
    return reg.sum_sources(parts, ["onshore", "offshore"], VALUES[2])
