"""Projections, filters, joins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import COSTS, D, H, KEY, MODEL_LAG, P, PM, TARGET, TS, TYPES, USERS, VALUES, by_type, by_user, daily, market, predictions, query, r, table
from hourloom.config import FoldSpec
from hourloom.functions.clock import hour_start, micros
from hourloom.operators import tables
from hourloom.operators.baseline import assign_folds, cv_folds
from hourloom.operators.evaluation import daily_volatility, volatility_threshold
from hourloom.operators.quality import top_extremes
from hourloom.operators.regularize import hour_grid, reindex, trim_to_valid
from hourloom.operators.signals import hourly_signals, mask_signals, validity
from hourloom.plans.jobs import clean_dataset

ROWS = f"series_key, ts, {r(*VALUES)}"

# --- projections -------------------------------------------------------------


@query("select_expected", f"WITH {TYPES} SELECT series_key, ts, {r(*VALUES[:2])}, CAST(NULL AS DOUBLE) AS actual_load FROM t")
def select_expected(spark, sf_dir):
    return tables.select_expected(by_type(spark, sf_dir), (*VALUES[:2], "actual_load"))


@query("select_driver", f"WITH {TYPES} SELECT series_key, ts, {r('forecast_wind')} FROM t")
def select_driver(spark, sf_dir):
    return tables.select_driver(by_type(spark, sf_dir), "forecast_wind")


@query(
    "rename_columns",
    f"WITH {P} SELECT series_key, ts, {r('actual_price=actual', 'predicted_price=predicted', 'day_ahead_price=residual')} FROM p",
)
def rename_columns(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumnRenamed("residual", "spot_PRICE")
    return tables.rename_predictions(tables.rename_price(p))


@query("to_numeric_coerce", f"SELECT event_id, {r('value=CASE WHEN value >= 5 THEN value END')} FROM events")
def to_numeric_coerce(spark, sf_dir):
    v = F.col("value")
    padded = F.concat(F.lit(" "), v.cast("string"), F.lit(" "))
    loose = F.when(v < 5, "n/a").when(v < 10, padded).otherwise(v.cast("string"))
    return tables.to_numbers(table(spark, sf_dir, "events").select("event_id", loose.alias("value")), ["value"])


@query("clamp_invalid", f"WITH {H} SELECT series_key, ts, {r('forecast_load=CASE WHEN forecast_load - 5000 >= 0 THEN forecast_load - 5000 END')} FROM h")
def clamp_invalid(spark, sf_dir):
    shifted = market(spark, sf_dir).select(KEY, TS, (F.col("forecast_load") - 5000).alias("forecast_load"))
    return tables.clamp_invalid(shifted)


# --- filters -----------------------------------------------------------------


@query(
    "filter_time_range",
    f"WITH {USERS} SELECT {ROWS} FROM u WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'",
)
def filter_time_range(spark, sf_dir):
    return tables.time_range(by_user(spark, sf_dir), "2024-01-10", "2024-01-20")


@query("drop_null_target", f"WITH {H} SELECT {ROWS} FROM h WHERE day_ahead_price IS NOT NULL")
def drop_null_target(spark, sf_dir):
    return tables.drop_null_target(market(spark, sf_dir))


@query("drop_null_any", f"WITH {H} SELECT {ROWS} FROM h WHERE {' AND '.join(f'{c} IS NOT NULL' for c in VALUES)}")
def drop_null_any(spark, sf_dir):
    return tables.drop_null_any(market(spark, sf_dir))


def sparse_users(spark, sf_dir):
    """User series whose drivers are known only for some event types."""
    e = table(spark, sf_dir, "events")

    def mean(*kinds):
        return F.avg(F.when(F.col("event_type").isin(*kinds), F.col("value")))

    return e.groupBy(F.col("user_id").cast("string").alias(KEY), hour_start(TS).alias(TS)).agg(
        F.avg("value").alias(VALUES[0]), mean("view", "error").alias(VALUES[1]), mean("click").alias(VALUES[2]), mean("signup", "purchase").alias(VALUES[3])
    )


SPARSE = """x AS (
  SELECT CAST(user_id AS VARCHAR) AS series_key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, avg(value) AS day_ahead_price,
         avg(value) FILTER (WHERE event_type IN ('view', 'error')) AS forecast_load,
         avg(value) FILTER (WHERE event_type = 'click') AS forecast_wind,
         avg(value) FILTER (WHERE event_type IN ('signup', 'purchase')) AS forecast_solar
  FROM events GROUP BY 1, 2)"""


def trim_sql(source: str, prefix: str = "c") -> str:
    """Cut ``source`` column after column to the range where the column is known."""
    ctes, last = [], source
    for i, c in enumerate(VALUES[1:]):
        name = f"{prefix}{i}"
        ctes.append(
            f"""{name} AS (SELECT s.* FROM {last} s JOIN (
  SELECT series_key, coalesce(min(ts) FILTER (WHERE {c} IS NOT NULL), min(ts)) AS a, coalesce(max(ts) FILTER (WHERE {c} IS NOT NULL), max(ts)) AS b
  FROM {last} GROUP BY 1) k ON s.series_key = k.series_key AND s.ts BETWEEN k.a AND k.b)"""
        )
        last = name
    return ", ".join(ctes)


@query("trim_valid_range", f"WITH {SPARSE}, {trim_sql('x')} SELECT {ROWS} FROM c2")
def trim_valid_range(spark, sf_dir):
    return trim_to_valid(sparse_users(spark, sf_dir), VALUES[1:])


def ffill_rows_sql(source: str, limit: int) -> str:
    """Row-distance forward fill of all value columns of a CTE that has ``rn``."""
    known = ", ".join(f"max(CASE WHEN {c} IS NOT NULL THEN rn END) OVER w AS k_{c}, last_value({c} IGNORE NULLS) OVER w AS v_{c}" for c in VALUES)
    filled = ", ".join(f"CASE WHEN rn - k_{c} <= {limit} THEN v_{c} END AS {c}" for c in VALUES)
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts) AS rn FROM {source}),
known AS (SELECT *, {known} FROM numbered WINDOW w AS (PARTITION BY series_key ORDER BY ts ROWS UNBOUNDED PRECEDING)),
filled AS (SELECT series_key, ts, {filled} FROM known)"""


@query("clean_dataset", f"WITH {SPARSE.replace('avg(value) AS day_ahead_price', 'avg(value) FILTER (WHERE event_type <> ' + chr(39) + 'error' + chr(39) + ') AS day_ahead_price')}, {ffill_rows_sql('x', 2)} SELECT {ROWS} FROM filled WHERE day_ahead_price IS NOT NULL")
def clean(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    price = e.groupBy(F.col("user_id").cast("string").alias(KEY), hour_start(TS).alias(TS)).agg(
        F.avg(F.when(F.col("event_type") != "error", F.col("value"))).alias(TARGET)
    )
    rows = sparse_users(spark, sf_dir).drop(TARGET).join(price, [KEY, TS])
    return clean_dataset(rows.select(KEY, TS, *VALUES), list(VALUES))


# --- joins -------------------------------------------------------------------


def _source(spark, sf_dir, kind, column):
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == kind)
    return e.groupBy(F.col("user_id").cast("string").alias(KEY), hour_start(TS).alias(TS)).agg(F.avg("value").alias(column))


_JOINED = (("purchase", VALUES[0]), ("view", VALUES[1]), ("click", VALUES[2]))


@query(
    "outer_join_sources",
    "WITH "
    + ", ".join(
        f"""s{i} AS (SELECT CAST(user_id AS VARCHAR) AS series_key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, avg(value) AS {c}
  FROM events WHERE event_type = '{kind}' GROUP BY 1, 2)"""
        for i, (kind, c) in enumerate(_JOINED)
    )
    + f" SELECT series_key, ts, {r(*VALUES[:3])} FROM s0 FULL JOIN s1 USING (series_key, ts) FULL JOIN s2 USING (series_key, ts)",
)
def outer_join_sources(spark, sf_dir):
    return tables.outer_join_sources([_source(spark, sf_dir, kind, c) for kind, c in _JOINED])


@query(
    "left_join_market_price",
    f"""WITH {P} SELECT p.series_key, p.ts, {r('predicted_price=p.predicted', 'market_price=t.forecast_load / 100.0')}
FROM p LEFT JOIN t ON p.series_key = t.series_key AND p.ts = t.ts AND t.forecast_load > 4000""",
)
def left_join_market_price(spark, sf_dir):
    p = predictions(spark, sf_dir).select(KEY, TS, F.col("predicted").alias("predicted_price"))
    prices = by_type(spark, sf_dir).filter("forecast_load > 4000").withColumn("price", F.col("forecast_load") / 100.0)
    return tables.left_join_market_price(p, prices)


@query(
    "inner_join_models",
    f"""WITH {PM} SELECT p.series_key, p.ts, {r('actual=p.actual', 'baseline_predicted=p.predicted', 'model_predicted=m.predicted')}
FROM p JOIN m USING (series_key, ts)""",
)
def inner_join_models(spark, sf_dir):
    return tables.inner_join_models(predictions(spark, sf_dir), predictions(spark, sf_dir, MODEL_LAG))


@query(
    "semi_join_days",
    f"""WITH {P}, days AS (SELECT series_key, CAST(ts AS DATE) AS day, stddev_samp(actual) AS sd FROM p GROUP BY 1, 2),
k AS (SELECT series_key, quantile_cont(sd, 0.75) AS threshold FROM days GROUP BY 1)
SELECT p.series_key, p.ts, {r('actual', 'predicted', 'residual')} FROM p JOIN days d ON d.series_key = p.series_key AND d.day = CAST(p.ts AS DATE)
  JOIN k ON k.series_key = p.series_key WHERE d.sd > k.threshold""",
)
def semi_join_days(spark, sf_dir):
    p = predictions(spark, sf_dir)
    days = daily_volatility(p).join(volatility_threshold(p), KEY).filter("daily_std > threshold")
    return tables.semi_join_days(p, days)


@query(
    "reindex_left_join",
    f"""WITH {TYPES}, grid AS (SELECT series_key, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts
  FROM (SELECT series_key, min(ts) - INTERVAL 3 HOUR AS a, max(ts) + INTERVAL 5 HOUR AS b FROM t GROUP BY 1))
SELECT g.series_key, g.ts, {r(*VALUES)} FROM grid g LEFT JOIN t ON g.series_key = t.series_key AND g.ts = t.ts""",
)
def reindex_left_join(spark, sf_dir):
    t = by_type(spark, sf_dir)
    hour = 3_600_000_000
    bounds = t.groupBy(KEY).agg((F.min(micros(TS)) - 3 * hour).alias("_first"), (F.max(micros(TS)) + 5 * hour).alias("_last"))
    return reindex(t, hour_grid(bounds))


FOLDS = FoldSpec(train_days=365, test_days=7, gap_days=1, n_splits=10)


def folds_sql(spec: FoldSpec = FOLDS) -> str:
    """Fold dates of the daily series; folds without train or test rows are dropped before numbering."""
    return f"""bounds AS (SELECT series_key, min(ts) AS a, max(ts) AS b, date_diff('day', min(ts), max(ts)) AS total FROM d GROUP BY 1),
sized AS (SELECT *, least({spec.train_days}, total // 2) AS train, total - least({spec.train_days}, total // 2) - {spec.test_days} AS free FROM bounds),
planned AS (SELECT *, i, a + to_days(CAST(i * greatest(free // {spec.n_splits - 1}, {spec.test_days}) AS INTEGER)) AS train_start
  FROM sized, (SELECT CAST(unnest(generate_series(0, {spec.n_splits - 1})) AS INTEGER) AS i)),
dated AS (SELECT series_key, i AS plan, train_start, train_start + to_days(CAST(train AS INTEGER)) AS train_end,
    train_start + to_days(CAST(train + {spec.gap_days} AS INTEGER)) AS test_start,
    train_start + to_days(CAST(train + {spec.gap_days + spec.test_days} AS INTEGER)) AS test_end, b FROM planned
  WHERE train_start + to_days(CAST(train + {spec.gap_days + spec.test_days} AS INTEGER)) <= b),
counted AS (SELECT f.series_key, f.plan, count(*) FILTER (WHERE d.ts >= train_start AND d.ts < train_end) AS train_rows,
    count(*) FILTER (WHERE d.ts >= test_start AND d.ts < test_end) AS test_rows
  FROM dated f JOIN d ON d.series_key = f.series_key GROUP BY 1, 2),
folds AS (SELECT f.series_key, CAST(row_number() OVER (PARTITION BY f.series_key ORDER BY f.plan) - 1 AS INTEGER) AS split,
    train_start, train_end, test_start, test_end, train_rows, test_rows
  FROM dated f JOIN counted c ON c.series_key = f.series_key AND c.plan = f.plan WHERE train_rows > 0 AND test_rows > 0)"""


@query(
    "fold_range_join",
    f"""WITH {D}, {folds_sql()}
SELECT d.series_key, d.ts, {r(TARGET)}, f.split, 'train' AS role FROM d JOIN folds f ON d.series_key = f.series_key AND d.ts >= f.train_start AND d.ts < f.train_end
UNION ALL
SELECT d.series_key, d.ts, {r(TARGET)}, f.split, 'test' FROM d JOIN folds f ON d.series_key = f.series_key AND d.ts >= f.test_start AND d.ts < f.test_end""",
)
def fold_range_join(spark, sf_dir):
    d = daily(spark, sf_dir)
    return assign_folds(d.select(KEY, TS, TARGET), cv_folds(d, FOLDS))


@query(
    "mask_apply",
    f"""WITH {P}, s AS (SELECT series_key, ts, predicted AS price, predicted - {COSTS.marginal_cost} AS css,
  predicted BETWEEN {COSTS.floor_price} AND {COSTS.cap_price} AS valid FROM p)
SELECT series_key, ts, CASE WHEN NOT valid THEN 'INVALID' WHEN css > 0 THEN 'DISPATCH' ELSE 'OFF' END AS margin_signal,
  {r('dispatch_pnl=CASE WHEN NOT valid THEN 0.0 ELSE greatest(css, 0.0) END')} FROM s""",
)
def mask_apply(spark, sf_dir):
    p = predictions(spark, sf_dir).select(KEY, TS, F.col("predicted").alias("predicted_price"))
    out = mask_signals(hourly_signals(p, COSTS), validity(p, COSTS).filter("not valid"))
    return out.select(KEY, TS, "margin_signal", "dispatch_pnl")


# --- sorts, limits, sets -----------------------------------------------------


@query("sort_series", f"WITH {TYPES} SELECT {ROWS} FROM t ORDER BY series_key, ts")
def sort_series(spark, sf_dir):
    return tables.sort_series(by_type(spark, sf_dir))


@query(
    "topk_extreme",
    f"""WITH {USERS} SELECT series_key, ts, {r(TARGET)}, CAST(row_number() OVER w AS INTEGER) AS rank FROM u
WINDOW w AS (PARTITION BY series_key ORDER BY day_ahead_price DESC, ts) QUALIFY row_number() OVER w <= 3""",
)
def topk_extreme(spark, sf_dir):
    cells = by_user(spark, sf_dir).select(KEY, TS, F.lit(TARGET).alias("column"), F.col(TARGET).alias("value"))
    return top_extremes(cells, TARGET).select(KEY, TS, F.col("value").alias(TARGET), "rank")


@query("head_n", f"WITH {USERS} SELECT {ROWS} FROM u ORDER BY day_ahead_price DESC, series_key, ts LIMIT 5")
def head_n(spark, sf_dir):
    return tables.head_rows(by_user(spark, sf_dir), 5, F.desc(TARGET), KEY, TS)


@query("tail_n", f"WITH {TYPES} SELECT {ROWS} FROM t QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY ts DESC) <= 168")
def tail_n(spark, sf_dir):
    return tables.last_rows(by_type(spark, sf_dir))


@query(
    "union_splits",
    f"""WITH {P} SELECT series_key, ts, {r('actual', 'predicted')}, CASE WHEN ts < TIMESTAMP '2024-01-25' THEN 'train' ELSE 'validation' END AS split FROM p""",
)
def union_splits(spark, sf_dir):
    p = predictions(spark, sf_dir).drop("residual")
    return tables.union_splits({"train": p.filter("ts < '2024-01-25'"), "validation": p.filter("ts >= '2024-01-25'")})


@query("distinct_rows", f"WITH {USERS} SELECT DISTINCT series_key, ts FROM u")
def distinct_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return tables.distinct_rows(e.select(F.col("user_id").cast("string").alias(KEY), hour_start(TS).alias(TS)))


@query("index_intersection", f"WITH {PM} SELECT series_key, ts FROM p INTERSECT SELECT series_key, ts FROM m")
def index_intersection(spark, sf_dir):
    return tables.common_stamps(predictions(spark, sf_dir), predictions(spark, sf_dir, MODEL_LAG))
