"""Readers, writers, the contract, and choosing among sources."""

import json

import pytest
from pyspark.sql import functions as F

from hourloom.config import DRIVERS, KEY, MARKET_CODE, TARGET, TS, ColumnRule, JobSpec
from hourloom.plans import jobs
from hourloom.sources import files, schema, sinks, workspace
from tests.helpers import START, at, column, series

VALUES = (TARGET, *DRIVERS)


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_series_csv_offsets_and_bad_numbers(spark, tmp_path):
    path = _write(
        tmp_path / "p.csv",
        "timestamp,day_ahead_price\n2024-01-01 00:00:00+00:00,1.5\n2024-01-01T02:00:00+01:00,oops\n2024-01-01 02:00,3\n2024-01-01 01:30:00-01:30,4\n2024-01-02,NaN\n",
    )
    got = {(r[TS], r[TARGET]) for r in files.read_series_csv(spark, path, [TARGET]).collect()}
    assert got == {(START, 1.5), (at(1), None), (at(2), 3.0), (at(3), 4.0), (at(24), None)}


def test_missing_files_are_named(spark, tmp_path):
    (tmp_path / f"prices_{MARKET_CODE}.csv").write_text("timestamp,day_ahead_price\n")
    with pytest.raises(files.SourceMissing, match="load_DE_LU.csv"):
        files.read_raw_folder(spark, str(tmp_path))
    with pytest.raises(files.SourceMissing):
        files.read_series_csv(spark, str(tmp_path / "none.csv"), [TARGET])


LEGACY = {
    "title": 'Day-ahead Prices for DE-LU\n"MTU (CET/CEST)";"Day-ahead Price [EUR/MWh]"\n"01.01.2024 00:00 - 01.01.2024 01:00";"10.5"\n"01.01.2024 01:00 - 01.01.2024 02:00";"-"\n',
    "comma": "Date,Volume,EUR/MWh\n01.01.2024 00:00,7,10.5\n1.1.2024 01:00,8,n/e\n",
    "tab": "Time\tPrice\n01/01/2024 00:00\t10.5\nnot a time\tn/e\n",
    "iso": "Market time|price|x\n2024-01-01 00:00:00|10.5|1\n",
}


@pytest.mark.parametrize("kind", LEGACY)
def test_legacy_exports(spark, tmp_path, kind):
    rows = files.read_legacy_csv(spark, _write(tmp_path / f"{kind}.csv", LEGACY[kind])).collect()
    assert [(r[KEY], r[TS], r[TARGET]) for r in rows] == [(MARKET_CODE, START, 10.5)]


def test_legacy_stamps_in_all_forms(spark, tmp_path):
    forms = ["2024-01-01 00:00:00+01:00", "1.2.2024 5:00", "03/02/2024 06:00", "2024/01/05 06:00", "01-02-2024 07:00", "01.02.2024 08:00:30 - 01.02.2024 09:00", "02.02.2024"]
    body = "\n".join(f"{t};{i}" for i, t in enumerate(forms)) + "\nnot read;n/e\n"
    got = {r[TARGET]: str(r[TS]) for r in files.read_legacy_csv(spark, _write(tmp_path / "f.csv", "MTU;Price\n" + body)).collect()}
    assert got == {0: "2023-12-31 23:00:00", 1: "2024-02-01 05:00:00", 2: "2024-02-03 06:00:00", 3: "2024-01-05 06:00:00", 4: "2024-02-01 07:00:00", 5: "2024-02-01 08:00:30", 6: "2024-02-02 00:00:00"}
    with pytest.raises(Exception, match="unreadable stamp 32nd"):
        files.read_legacy_csv(spark, _write(tmp_path / "g.csv", "MTU;Price\n32nd;1\n")).collect()


def test_overlapping_chunks_keep_the_first(spark):
    from hourloom.operators.tables import union_chunks
    from tests.helpers import series

    a, b = series(spark, [(0, 1.0), (1, 2.0)], ["v"]), series(spark, [(1, 9.0), (2, 3.0)], ["v"])
    assert sorted(r["v"] for r in union_chunks([a, b]).collect()) == [1.0, 2.0, 3.0]


def test_writing_a_run_again_replaces_all_months(spark, tmp_path):
    from hourloom.sources import sinks
    from tests.helpers import at, series

    rows = series(spark, [(0, 1.0), (24 * 40, 2.0)], ["v"])
    sinks.write_series(rows, str(tmp_path), "r1")
    sinks.write_series(rows, str(tmp_path), "r2")
    sinks.write_series(rows.filter(rows[TS] < at(24)), str(tmp_path), "r1")
    assert {r["run_id"]: r["count"] for r in spark.read.parquet(str(tmp_path)).groupBy("run_id").count().collect()} == {"r1": 1, "r2": 2}


def test_legacy_without_price_column(spark, tmp_path):
    with pytest.raises(files.SourceMissing, match="no price column"):
        files.read_legacy_csv(spark, _write(tmp_path / "x.csv", "time,value\n01.01.2024 00:00,1\n"))


SECONDS = 1704067200


def test_payloads(spark, tmp_path):
    arrays = _write(tmp_path / "a.json", json.dumps({KEY: "m", "unix_seconds": [SECONDS, SECONDS + 3600], "price": [1.0, None]}))
    assert [(r[TS], r[TARGET]) for r in files.read_price_arrays(spark, arrays).orderBy(TS).collect()] == [(START, 1.0), (at(1), None)]
    pairs = _write(tmp_path / "b.json", json.dumps({KEY: "m", "series": [[SECONDS * 1000, 2.5], [SECONDS * 1000 + 3_600_000, None]]}))
    assert [(r[TS], r[TARGET]) for r in files.read_pairs(spark, pairs).collect()] == [(START, 2.5)]


def _mix(tmp_path, kinds):
    return _write(tmp_path / "m.json", json.dumps({KEY: "m", "unix_seconds": [SECONDS, SECONDS + 900], "production_types": kinds}))


def test_production_mix(spark, tmp_path):
    kinds = [
        {"name": "Wind offshore", "data": [1.0, None]},
        {"name": "WIND onshore", "data": [2.0, 3.0]},
        {"name": "Solar", "data": [None, 5.0]},
        {"name": "Photovoltaic roof", "data": [1.0, 1.0]},
        {"name": "Nuclear", "data": None},
    ]
    out = files.production_mix(files.read_mix(spark, _mix(tmp_path, kinds))).orderBy(TS).collect()
    assert [(r["forecast_wind"], r["forecast_solar"]) for r in out] == [(3.0, 1.0), (3.0, 6.0)]


def test_load_is_the_first_named_type_or_the_sum(spark, tmp_path):
    kinds = [{"name": "Gas", "data": [1.0, 2.0]}, {"name": "Last", "data": [7.0, None]}, {"name": "Load", "data": [9.0, 9.0]}]
    named = files.load_from_mix(files.read_mix(spark, _mix(tmp_path, kinds)))
    assert column(named, "forecast_load") == [7.0, None]
    summed = files.load_from_mix(files.read_mix(spark, _mix(tmp_path, [*kinds[:1], {"name": "Coal", "data": [None, 4.0]}, {"name": "X", "data": None}])))
    assert column(summed, "forecast_load") == [1.0, 6.0]


def test_cache_range_prunes_months(spark, tmp_path):
    df = series(spark, [(h, float(h)) for h in range(24 * 100)], [TARGET])
    path = str(tmp_path / "cache")
    sinks.write_series(df, path)
    cut = files.read_cached(spark, path, "2024-02-03", "2024-02-04")
    assert cut.count() == 48
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_month" in plan and "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_first_acceptable_source_per_series(spark):
    full = series(spark, [(h, 1.0) for h in range(4)], [TARGET], "a").unionByName(series(spark, [(h, None) for h in range(4)], [TARGET], "b"))
    other = series(spark, [(h, 2.0) for h in range(4)], [TARGET], "a").unionByName(series(spark, [(h, 2.0) for h in range(4)], [TARGET], "b"))
    got = {(r[KEY], r["source"]) for r in files.first_acceptable([("cache", full), ("local", other)]).collect()}
    assert got == {("a", "cache"), ("b", "local")}


def test_first_available_source(spark, tmp_path):
    _write(tmp_path / "p.csv", "timestamp,day_ahead_price\n2024-01-01,1\n")
    readers = [
        ("cache", lambda: spark.read.parquet(str(tmp_path / "none"))),
        ("local", lambda: files.read_series_csv(spark, str(tmp_path / "p.csv"), [TARGET])),
    ]
    name, df = files.first_available(readers)
    assert name == "local" and df.count() == 1
    with pytest.raises(files.SourceMissing, match="cache"):
        files.first_available(readers[:1])


def test_latest_run_reads_one_folder(spark, tmp_path):
    rows = series(spark, [(h, float(h)) for h in range(3)], [TARGET])
    path = str(tmp_path / "runs")
    for run in ("r1", "r3", "r2"):
        sinks.write_series(rows, path, run)
    out = files.latest_run(spark, path)
    assert {r["run_id"] for r in out.collect()} == {"r3"} and out.inputFiles() and all("run_id=r3" in f for f in out.inputFiles())
    name, table = files.load_features(spark, None, path)
    assert name == "cache" and table.count() == 3
    assert files.load_features(spark, lambda: rows, path)[0] == "local"
    with pytest.raises(files.SourceMissing):
        files.load_features(spark, None, str(tmp_path / "none"))



def test_schema(spark):
    loose = series(spark, [(0, "50.5", 40000, 1.0, 2.0)], [f"{TARGET} string", "forecast_load int", *DRIVERS[1:]])
    assert schema.enforce_schema(loose).select(TARGET, "forecast_load").dtypes == [(TARGET, "double"), ("forecast_load", "double")]
    assert schema.schema_findings(loose)[:2] == [(TARGET, "warning", "double", "string"), ("forecast_load", "warning", "double", "int")]
    with pytest.raises(schema.SchemaError, match="forecast_solar"):
        schema.enforce_schema(loose.drop("forecast_solar"))
    with pytest.raises(schema.SchemaError):
        schema.validate_schema(loose.drop(TARGET))
    integral = (ColumnRule("forecast_load", "bigint"),)
    assert schema.schema_findings(loose, integral) == [] and schema.enforce_schema(loose, integral).columns == loose.columns
    frame = schema.findings_frame(spark, schema.schema_findings(loose))
    assert frame.count() == 2 and frame.columns == ["column", "severity", "expected", "found"]


def test_typed_files(spark, tmp_path):
    df = series(spark, [(0, 1.0, 2.0, 3.0, 4.0)], VALUES)
    for suffix in ("parquet", "csv"):
        path = str(tmp_path / f"x.{suffix}")
        assert files.write_typed(df, path) == []
        assert files.read_typed(spark, path).collect() == df.collect()
    with pytest.raises(ValueError, match="unsupported"):
        files.read_typed(spark, "x.json")


class _Session:
    """Just enough of a session to ask where the shared folder is."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.sql.warehouse.dir": "/warehouse/"} | ({} if folder is None else {"spark.checkpoint.dir": folder})
        self.sparkContext = self
        self.master, self.applicationId = master, "app"

    def getConf(self):
        return self.conf


def test_workspace_uses_the_checkpoint_folder():
    assert workspace.shared_root(_Session("spark://x", "s3a://shared/checkpoints/")) == "s3a://shared/checkpoints"
    assert workspace.fresh_folder(_Session("spark://x", "/shared"), "a").startswith("/shared/hourloom/app/a-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(_Session("spark://x"))
    assert workspace.shared_root(_Session("local[2]")) == "/warehouse/_work"


def test_settled_tables_keep_their_schema(spark):
    df = spark.range(5).withColumn("split", F.col("id") % 2)
    kept = workspace.settle(df, "numbers", ("split",))
    assert dict(kept.dtypes) == dict(df.dtypes) and kept.count() == 5
    assert any(workspace.shared_root(spark) in f for f in kept.inputFiles())


def test_normalisation(spark):
    raw = series(spark, [(1, 10.0, 0), (1, 20.0, 1), (4, 5.0, 2)], ["Price", "nr bigint"])
    out = jobs.normalize_prices(raw, "Europe/Berlin", "nr")
    assert [(r[TS], r[TARGET]) for r in out.orderBy(TS).collect()] == [(at(0), 15.0), (at(1), None), (at(2), None), (at(3), 5.0)]
    drivers = jobs.normalize_drivers(series(spark, [(0, -5.0, 1.0), (1, 5.0, 2.0)], DRIVERS[:2]))
    assert column(drivers, "forecast_load") == [None, 5.0] and column(drivers, "forecast_solar") == [None, None]


def test_local_features(spark, tmp_path):
    def csv(name, columns, value):
        lines = ["timestamp," + ",".join(columns)] + [f"{at(h)}," + ",".join(value(h, c) for c in columns) for h in range(300)]
        _write(tmp_path / f"{name}_{MARKET_CODE}.csv", "\n".join(lines) + "\n")

    csv("prices", (TARGET,), lambda h, c: "" if h in (10, 11) or h > 290 else str(h))
    csv("load", DRIVERS[:1], lambda h, c: "" if h < 5 else "1000")
    csv("gen_forecast", DRIVERS[1:], lambda h, c: "100")
    out = jobs.local_features(spark, str(tmp_path), JobSpec())
    prices = column(out, TARGET)
    assert prices[0] == 5.0 and prices[5:7] == [10.0, 11.0] and len(prices) == 297 - 5
    assert "roll_168h_std_day_ahead_price" in out.columns and "hour_x_dow" in out.columns
