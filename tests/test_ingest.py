"""The ingest job: which source serves, what is written, when a run counts."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hourloom.config import DRIVERS, KEY, TARGET, TS, JobSpec, QualityLimits
from hourloom.plans import ingest
from hourloom.plans.ingest import Source, Span
from hourloom.sources.files import SourceMissing
from hourloom.sources.workspace import remove_folder, settle, shared_root, work_scope
from tests.helpers import series

SPAN = Span("2024-01-01", "2024-01-02")
SPEC = JobSpec(limits=QualityLimits(critical_missing_pct=5.0))


def prices(spark, level, hours=48, missing=(), key="a"):
    return series(spark, [(h, None if h in missing else level + h) for h in range(hours)], [TARGET], key)


def drivers(spark, hours=48):
    return series(spark, [(h, -5.0 if h == 3 else 100.0 + h, 10.0, 1.0) for h in range(hours)], DRIVERS)


def absent():
    raise SourceMissing("not there")


def run(spark, folder, price_sources, run_id="r1", span=SPAN, **kw):
    return ingest.run_ingest(spark, str(folder), price_sources, [Source("local", lambda: drivers(spark), raw=True)], span, run_id, SPEC, **kw)


def test_three_tables_are_written_read_back_and_published(spark, tmp_path):
    done = run(spark, tmp_path, [Source("missing", absent), Source("local", lambda: prices(spark, 10.0).filter(F.hour(TS) != 7), raw=True)])
    assert done.prices.count() == 48 and done.prices.filter(F.col(TARGET).isNull()).count() == 2
    assert {r["source"] for r in done.drivers.collect()} == {"local"}
    row = done.combined.filter(F.hour(TS) == 3).orderBy(TS).first()
    assert row["forecast_load"] is None and row[TARGET] == 13.0
    for table in ingest.TABLES:
        assert ingest.published_table(spark, str(tmp_path), table).count() == 48
    assert ingest.newest_run(spark, str(tmp_path), "combined", SPAN) == "r1"


def test_a_run_without_manifest_does_not_count(spark, tmp_path):
    run(spark, tmp_path, [Source("local", lambda: prices(spark, 10.0, 48), raw=True)])
    ingest.write_series(prices(spark, 99.0), f"{tmp_path}/prices", "r9")
    assert ingest.newest_run(spark, str(tmp_path), "prices") == "r1"
    with pytest.raises(SourceMissing):
        ingest.newest_run(spark, str(tmp_path), "weather")
    with pytest.raises(SourceMissing):
        ingest.newest_run(spark, str(tmp_path / "elsewhere"), "prices")


def test_the_cache_serves_only_spans_it_covers_and_is_complete_for(spark, tmp_path):
    run(spark, tmp_path, [Source("local", lambda: prices(spark, 10.0), raw=True)])
    again = run(spark, tmp_path, [Source("local", lambda: prices(spark, 500.0), raw=True)], "r2", Span("2024-01-02", "2024-01-02"))
    assert {r["source"] for r in again.prices.collect()} == {"cache"} and again.prices.count() == 24
    fresh = run(spark, tmp_path, [Source("local", lambda: prices(spark, 500.0), raw=True)], "r3", refresh=True)
    assert {r["source"] for r in fresh.prices.collect()} == {"local"} and fresh.prices.agg(F.min(TARGET)).first()[0] == 500.0
    wider = run(spark, tmp_path, [Source("local", lambda: prices(spark, 700.0, 72), raw=True)], "r4", Span("2024-01-01", "2024-01-03"))
    assert {r["source"] for r in wider.prices.collect()} == {"local"} and wider.prices.count() == 72


def test_falls_back_by_series_and_at_last_on_a_stale_run(spark, tmp_path):
    both = lambda: prices(spark, 10.0, missing=range(20)).unionByName(prices(spark, 20.0, key="b"))
    done = run(spark, tmp_path, [Source("first", both, raw=True), Source("second", lambda: prices(spark, 70.0), raw=True)])
    served = {(r[KEY], r["source"]) for r in done.prices.select(KEY, "source").distinct().collect()}
    assert served == {("a", "second"), ("b", "first")}
    old = run(spark, tmp_path, [Source("missing", absent)], "r2", Span("2024-02-01", "2024-02-03"))
    assert {r["source"] for r in old.prices.collect()} == {"stale"} and old.prices.count() == 96


def test_nothing_acceptable(spark, tmp_path):
    with pytest.raises(SourceMissing, match="no source available"):
        ingest.resolve([Source("x", absent)], lambda df: df, SPAN, TARGET)
    with pytest.raises(SourceMissing, match="missing"):
        run(spark, tmp_path, [Source("local", lambda: prices(spark, 1.0, missing=range(48)), raw=True)])
    with pytest.raises(SourceMissing):
        ingest.newest_run(spark, str(tmp_path), "prices")


def _work_folders(spark):
    root = Path(shared_root(spark)) / "hourloom"
    return {p for p in root.glob("*/*") if p.is_dir()}


def test_no_work_table_outlives_the_job(spark, tmp_path):
    before = _work_folders(spark)
    done = run(spark, tmp_path, [Source("local", lambda: prices(spark, 10.0), raw=True)])
    assert _work_folders(spark) == before and done.combined.count() == 48
    with pytest.raises(SourceMissing):
        run(spark, tmp_path / "other", [Source("local", lambda: prices(spark, 1.0, missing=range(48)), raw=True)])
    assert _work_folders(spark) == before


def test_scopes_own_what_is_made_inside(spark):
    kept = settle(spark.range(3).toDF("x"), "kept")
    with work_scope() as outer:
        settle(spark.range(3).toDF("x"), "outer")
        with work_scope() as inner:
            mine = settle(spark.range(4).toDF("x"), "inner")
            assert mine.count() == 4 and len(inner) == 1
        assert len(outer) == 1 and not Path(inner[0]).exists() and Path(outer[0]).exists()
    assert not Path(outer[0]).exists() and kept.count() == 3
    remove_folder(outer[0])
    remove_folder("nosuchstore://somewhere/x")
