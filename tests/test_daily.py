"""Day-grain marts rebuilt where feeds changed equal the marts of a full build."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from growthlens.catalog import Warehouse
from growthlens.operators import weekly
from growthlens.plans import daily
from growthlens.sources.io import current_path, overwrite_roundtrip
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(spark, SF_SMALL)


@pytest.fixture(scope="module")
def feeds(warehouse, tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    return {f: overwrite_roundtrip(getattr(warehouse, f).coalesce(1), str(root / f)) for f in daily.FEED_DAYS}


def everything(df):
    return sorted(rows(df, *sorted(df.columns)), key=str)


def same_as_full(spark, feeds, root, names=tuple(daily.MART_FEEDS)):
    for name in names:
        got, want = daily.days(spark, root, name), daily._mart(name, feeds, {})
        assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in want.schema}
        assert everything(got) == everything(want), name


def files_of(spark, root, name):
    folder = current_path(spark, f"{root}/{name}")
    return {os.path.relpath(f, folder): os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/month=*/*.parquet")}


def test_fingerprints_do_not_depend_on_order_but_on_every_value(spark):
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    data = [(day, "a", None, 1.0), (day, None, "a", 2.0), (day, "a", None, 1.0), (other, "b", "c", None), (None, "x", "y", 0.5)]
    schema = "date date, a string, b string, v double"

    def prints(table, partitions=1):
        return sorted(rows(daily.day_fingerprints(spark.createDataFrame(table, schema).repartition(partitions), "date")), key=str)

    assert prints(data) == prints(data[::-1], 4)
    assert len(prints(data)) == 3
    swapped = [(day, None, "a", 1.0), (day, "a", None, 2.0), *data[2:]]  # the same values, NULLs elsewhere
    doubled = [data[0], data[0], data[2], *data[3:]]
    for changed in (swapped, doubled, data[1:], [*data, data[4]]):
        assert prints(changed) != prints(data)
    stamped = spark.createDataFrame(data, schema).withColumn("loaded_at", F.lit("now"))
    assert sorted(rows(daily.day_fingerprints(stamped, "date")), key=str) == prints(data)
    assert prints([]) == []


def test_only_months_of_changed_days_are_written(spark, feeds, tmp_path):
    root = str(tmp_path / "marts")
    assert set(daily.rebuild(feeds, root).values()) == {None}
    same_as_full(spark, feeds, root)
    assert all(found == [] for found in daily.rebuild(feeds, root).values())

    day = daily.days(spark, root, "mart_referral").agg(F.max("date")).first()[0]
    late = {**feeds, "stg_ga4": feeds["stg_ga4"].withColumn("sessions", F.when(F.col("date") == day, F.col("sessions") + 5).otherwise(F.col("sessions")))}
    before = {name: files_of(spark, root, name) for name in daily.MART_FEEDS}
    found = daily.rebuild(late, root)
    assert found == {"mart_acquisition": [], "mart_activation": [], "mart_revenue": [], "mart_referral": [day]}
    after = {name: files_of(spark, root, name) for name in daily.MART_FEEDS}
    month = f"month={day.replace(day=1)}"
    for name in daily.MART_FEEDS:
        moved = {f for f in before[name].keys() ^ after[name].keys()} | {f for f in before[name].keys() & after[name].keys() if before[name][f] != after[name][f]}
        assert all(f.startswith(month) for f in moved)
        assert bool(moved) == (name == "mart_referral")
    same_as_full(spark, late, root)


def test_days_that_come_and_go_whole_months_and_null_days(spark, feeds, tmp_path):
    root, names = str(tmp_path / "marts"), ("mart_acquisition", "mart_revenue")
    meta = feeds["stg_meta_ads"]
    old = meta.where(F.dayofmonth("date") == 4).withColumn("date", F.lit("1999-12-31").cast("date"))
    dateless = meta.limit(3).withColumn("date", F.lit(None).cast("date"))
    strange = {**feeds, "stg_meta_ads": meta.where(F.dayofmonth("date") != 5).unionByName(old)}
    for stg in (strange, feeds, {**feeds, "stg_meta_ads": meta.unionByName(dateless)}, strange):
        daily.rebuild(stg, root, names)
        same_as_full(spark, stg, root, names)


def test_other_parameters_rebuild_everything(spark, feeds, tmp_path):
    root = str(tmp_path / "marts")
    daily.rebuild(feeds, root, ["mart_revenue"])
    assert daily.rebuild(feeds, root, ["mart_revenue"], monthly_price=31) == {"mart_revenue": None}
    assert everything(daily.days(spark, root, "mart_revenue")) == everything(daily._mart("mart_revenue", feeds, {"monthly_price": 31}))


def test_empty_feeds_give_empty_marts_that_fill_later(spark, feeds, tmp_path):
    root = str(tmp_path / "marts")
    daily.rebuild({f: df.limit(0) for f, df in feeds.items()}, root, ["mart_activation"])
    assert daily.days(spark, root, "mart_activation").count() == 0
    daily.rebuild(feeds, root, ["mart_activation"])
    same_as_full(spark, feeds, root, ["mart_activation"])


def test_a_failed_rebuild_is_made_up_for(spark, feeds, tmp_path, monkeypatch):
    root, names = str(tmp_path / "marts"), ["mart_referral"]
    early = {**feeds, "stg_gsc": feeds["stg_gsc"].where(F.dayofmonth("date") != 6)}
    daily.rebuild(early, root, names)
    with monkeypatch.context() as m:
        m.setattr(daily, "_replace_days", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            daily.rebuild(feeds, root, names)
    daily.rebuild(feeds, root, names)
    same_as_full(spark, feeds, root, names)


def test_a_week_reads_its_months_and_pushes_its_days(spark, warehouse, feeds, tmp_path):
    root = str(tmp_path / "marts")
    daily.rebuild(feeds, root, ["mart_acquisition", "mart_activation", "mart_referral"])
    as_of = dt.date(2024, 3, 6)
    got = daily.weekly_delta_of_stored(spark, root, as_of)
    want = weekly.weekly_delta(warehouse.mart_acquisition, warehouse.mart_activation, warehouse.mart_referral, as_of)
    assert everything(got) == everything(want)
    week = daily.days(spark, root, "mart_acquisition", dt.date(2024, 2, 26), dt.date(2024, 3, 10))
    week.collect()
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "GreaterThanOrEqual(date,2024-02-26)" in plan
    assert len(week.inputFiles()) >= 1
    read = {f.split("month=")[1][:10] for (f,) in rows(week.select(F.input_file_name()).distinct())}
    assert read == {"2024-02-01", "2024-03-01"}


def test_files_are_sorted_by_day_and_channel(spark, feeds, tmp_path):
    root = str(tmp_path / "marts")
    daily.rebuild(feeds, root, ["mart_acquisition"])
    for path in glob.glob(f"{current_path(spark, root + '/mart_acquisition')}/month=*/*.parquet"):
        stored = rows(spark.read.parquet(path), "date", "channel")
        assert stored == sorted(stored)
