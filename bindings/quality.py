"""Quality checks on five series with missing values, repeats, gaps and extremes."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import KEY, LIMITS, RULES, TARGET, TS, TYPES, VALUES, by_type, query, r
from hourloom.operators import quality as q


def rows(spark, sf_dir):
    """Small prices and large loads are missing, and hour 7 is there twice."""
    t = by_type(spark, sf_dir).withColumns(
        {VALUES[0]: F.when(F.col(VALUES[0]) >= 3, F.col(VALUES[0])), VALUES[1]: F.when(F.col(VALUES[1]) <= 16000, F.col(VALUES[1]))}
    )
    return t.unionByName(t.filter(F.hour(TS) == 7))


Y = f"""{TYPES}, y0 AS (SELECT * REPLACE (CASE WHEN day_ahead_price >= 3 THEN day_ahead_price END AS day_ahead_price,
  CASE WHEN forecast_load <= 16000 THEN forecast_load END AS forecast_load) FROM t),
y AS (SELECT * FROM y0 UNION ALL SELECT * FROM y0 WHERE hour(ts) = 7)"""


def flat(results):
    return results.select(
        KEY, "name", "passed", F.size("errors").alias("error_count"), F.size("warnings").alias("warning_count"), F.explode_outer("metrics").alias("metric", "value")
    )


def _sum(parts):
    return " + ".join(f"CAST(coalesce({p}, false) AS INTEGER)" for p in parts) if parts else "0"


class Check:
    """SQL of one check: per-series statistics, then errors, warnings and metrics over them."""

    def __init__(self, name, ctes, source, errors, warnings, metrics):
        self.name, self.ctes, self.source, self.metrics = name, ctes, source, metrics
        self.errors = f"CAST({errors} AS INTEGER)"
        self.warnings = f"CAST({warnings} AS INTEGER)"

    def head(self):
        return f"series_key, '{self.name}' AS name, {self.errors} = 0 AS passed, {self.errors} AS error_count, {self.warnings} AS warning_count"

    def metric_rows(self):
        out = []
        for m, e in self.metrics.items():
            out.append(f"SELECT {self.head()}, '{m}' AS metric, {r(f'value=CAST({e} AS DOUBLE)')} FROM {self.source} WHERE ({e}) IS NOT NULL")
        return f"WITH {Y}, {self.ctes} " + " UNION ALL ".join(out)


_RULES = {c.name: c for c in RULES}

COMPLETENESS = Check(
    "Completeness Check",
    "s1 AS (SELECT series_key, " + ", ".join(f"100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) AS p_{c}" for c in VALUES) + " FROM y GROUP BY 1)",
    "s1",
    _sum([f"p_{c} > {1.0 if _RULES[c].required else 10.0}" for c in VALUES]),
    _sum([f"p_{c} > 0 AND p_{c} <= {1.0 if _RULES[c].required else 10.0}" for c in VALUES]),
    {f"{c}_missing_pct": f"p_{c}" for c in VALUES},
)
DUPLICATES = Check(
    "Duplicate Check",
    "s2 AS (SELECT series_key, count(*) - count(DISTINCT ts) AS extra FROM y GROUP BY 1)",
    "s2",
    _sum(["extra > 0"]),
    _sum(["extra > 0"]),
    {"duplicate_count": "extra"},
)
RANGE = Check(
    "Range Check",
    "s3 AS (SELECT series_key, "
    + ", ".join(
        f"count(*) FILTER (WHERE {c} < {_RULES[c].low} OR {c} > {_RULES[c].high}) AS o_{c}, count({c}) AS k_{c}, min({c}) AS a_{c}, max({c}) AS b_{c}" for c in VALUES
    )
    + " FROM y GROUP BY 1)",
    "s3",
    _sum([f"o_{c} > 0 AND 100.0 * o_{c} / k_{c} > 0.1" for c in VALUES]),
    _sum([f"o_{c} > 0 AND 100.0 * o_{c} / k_{c} <= 0.1" for c in VALUES]),
    {k: v for c in VALUES for k, v in {f"{c}_out_of_range_pct": f"100.0 * o_{c} / k_{c}", f"{c}_min": f"a_{c}", f"{c}_max": f"b_{c}"}.items()},
)
TEMPORAL = Check(
    "Temporal Check",
    """g4 AS (SELECT series_key, date_diff('second', lag(ts) OVER (PARTITION BY series_key ORDER BY ts), ts) / 3600.0 AS gap FROM y),
s4 AS (SELECT series_key, count(*) AS n, count(*) FILTER (WHERE gap > 1) AS gaps, max(gap) AS widest, count(*) FILTER (WHERE gap <> 1) AS irregular FROM g4 GROUP BY 1)""",
    "s4",
    _sum(["n >= 2 AND widest > 2"]),
    _sum(["gaps > 0", "irregular > n * 0.01"]),
    {"max_gap_hours": "widest", "gap_count": "gaps", "irregular_intervals": "irregular"},
)
CONTINUITY = Check(
    "Hourly Continuity Check",
    """d5 AS (SELECT series_key, CAST(ts AS DATE) AS day, count(*) AS n FROM y GROUP BY 1, 2),
s5 AS (SELECT series_key, count(*) AS days, count(*) FILTER (WHERE n = 23) AS d23, count(*) FILTER (WHERE n = 24) AS d24,
  count(*) FILTER (WHERE n = 25) AS d25, count(*) FILTER (WHERE n NOT IN (23, 24, 25)) AS other FROM d5 GROUP BY 1)""",
    "s5",
    _sum(["other > days * 0.05"]),
    "least(5, other)",
    {"days_with_24h": "d24", "days_with_23h": "d23", "days_with_25h": "d25", "days_with_other": "other"},
)
_DRIVERS = VALUES[1:]
ALIGNMENT = Check(
    "Alignment Check",
    "s6 AS (SELECT series_key, "
    + ", ".join(f"100.0 * count(*) FILTER (WHERE {TARGET} IS NOT NULL AND {c} IS NULL) / count({TARGET}) AS m_{c}" for c in _DRIVERS)
    + f", 100.0 * count(*) FILTER (WHERE {' AND '.join(f'{c} IS NOT NULL' for c in VALUES)}) / count(*) AS whole FROM y GROUP BY 1)",
    "s6",
    "0",
    _sum([*[f"m_{c} > 5" for c in _DRIVERS], "whole < 90"]),
    {**{f"{c}_misaligned_pct": f"m_{c}" for c in _DRIVERS}, "fully_aligned_pct": "whole"},
)


def _z(c):
    return f"abs(({c} - avg({c}) OVER w) / nullif(stddev_samp({c}) OVER w, 0))"


OUTLIERS = Check(
    "Outlier Check",
    "z7 AS (SELECT series_key, ts, "
    + ", ".join(f"{c}, {_z(c)} > {LIMITS.price_zscore if c == TARGET else LIMITS.driver_zscore} AS z_{c}" for c in VALUES)
    + " FROM y WINDOW w AS (PARTITION BY series_key)), s7 AS (SELECT series_key, "
    + ", ".join(f"count(*) FILTER (WHERE z_{c}) AS z_{c}, count({c}) AS k_{c}" for c in VALUES)
    + " FROM z7 GROUP BY 1)",
    "s7",
    "0",
    f"2 * {_sum([f'z_{TARGET} > 0'])} + " + _sum([f"z_{c} > k_{c} * 0.01" for c in _DRIVERS]),
    {"price_outlier_count": f"z_{TARGET}", **{f"{c}_outlier_count": f"z_{c}" for c in _DRIVERS}},
)
ALL_CHECKS = (COMPLETENESS, DUPLICATES, RANGE, TEMPORAL, CONTINUITY, ALIGNMENT, OUTLIERS)


def _stats(df):
    return q.profile(df, RULES)


@query("qa_completeness", COMPLETENESS.metric_rows())
def qa_completeness(spark, sf_dir):
    return flat(q.completeness(_stats(rows(spark, sf_dir)), VALUES, RULES, LIMITS))


@query("qa_duplicates", DUPLICATES.metric_rows())
def qa_duplicates(spark, sf_dir):
    return flat(q.duplicates(rows(spark, sf_dir), LIMITS))


@query("qa_range", RANGE.metric_rows())
def qa_range(spark, sf_dir):
    return flat(q.value_range(_stats(rows(spark, sf_dir)), VALUES, RULES, LIMITS))


@query("qa_temporal", TEMPORAL.metric_rows())
def qa_temporal(spark, sf_dir):
    return flat(q.temporal(q.hour_gaps(q.stamps(rows(spark, sf_dir))), limits=LIMITS))


@query(
    "qa_gap_list",
    f"""WITH g AS (SELECT CAST(user_id AS VARCHAR) AS series_key, ts AS gap_end,
  (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 3600000000.0 AS gap_hours FROM events)
SELECT series_key, gap_end, {r('gap_hours')} FROM g WHERE gap_hours > 1""",
)
def qa_gap_list(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return q.gap_list(e.select(F.col("user_id").cast("string").alias(KEY), TS))


@query("qa_hourly_continuity", CONTINUITY.metric_rows())
def qa_hourly_continuity(spark, sf_dir):
    return flat(q.continuity(q.stamps(rows(spark, sf_dir)), LIMITS))


@query("qa_alignment", ALIGNMENT.metric_rows())
def qa_alignment(spark, sf_dir):
    return flat(q.alignment(_stats(rows(spark, sf_dir)), VALUES, limits=LIMITS))


@query("qa_outliers", OUTLIERS.metric_rows())
def qa_outliers(spark, sf_dir):
    y = rows(spark, sf_dir)
    return flat(q.outliers(y, _stats(y), VALUES, limits=LIMITS))


_ALL = f"WITH {Y}, {', '.join(c.ctes for c in ALL_CHECKS)}, checks AS (" + " UNION ALL ".join(f"SELECT {c.head()} FROM {c.source}" for c in ALL_CHECKS) + ")"


def all_checks(spark, sf_dir):
    return q.run_checks(rows(spark, sf_dir), RULES, LIMITS)


@query("qa_run_all", f"{_ALL} SELECT * FROM checks")
def qa_run_all(spark, sf_dir):
    return q.per_check(all_checks(spark, sf_dir))


@query(
    "qa_gate",
    f"""{_ALL}, failed AS (SELECT DISTINCT name FROM checks WHERE NOT passed)
SELECT c.series_key, c.name, c.passed, true AS gate_closed FROM checks c JOIN failed f USING (name)""",
)
def qa_gate(spark, sf_dir):
    """The check rows the gate names when it closes, for every series."""
    results = all_checks(spark, sf_dir)
    try:
        q.evaluate_gate(results)
        closed_by = []
    except q.QAGateFailure as failure:
        closed_by = failure.failed_checks
    named = results.filter(F.col("name").isin(*closed_by)) if closed_by else results
    return named.select(KEY, "name", "passed", F.lit(bool(closed_by)).alias("gate_closed"))


@query(
    "qa_summary",
    f"""{_ALL} SELECT series_key, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
  CAST(sum(warning_count) AS BIGINT) AS warnings, CAST(sum(error_count) AS BIGINT) AS errors, bool_and(passed) AS all_passed FROM checks GROUP BY 1""",
)
def qa_summary(spark, sf_dir):
    return q.summarize(all_checks(spark, sf_dir))
