"""Data checks, serving order and the full-replace load."""

import datetime as dt

import pytest

from growthlens.catalog import Warehouse
from growthlens.operators import checks, serving
from growthlens.sources.io import overwrite_roundtrip, publish_table, read_table, write_table
from tests.conftest import SF_MEDIUM, SF_SMALL, rows

J = lambda d: dt.date(2024, 1, d)


def test_checks_on_bad_rows(spark):
    acq = spark.createDataFrame(
        [
            (J(1), "meta", 10.0, 2.0, 1.0),
            (J(1), "tiktok", 10.0, -1.0, 1.0),
            (None, None, None, None, -2.0),
        ],
        "date date, channel string, total_spend double, cac double, roas double",
    )
    ret = spark.createDataFrame([(J(1), 3, 1.5), (J(1), 3, 1.0)], "cohort_date date, cohort_size bigint, retention_rate double")
    selected = [c for c in checks.default_checks() if c.model in ("mart_acquisition", "mart_retention")]
    out = checks.run_checks({"mart_acquisition": acq, "mart_retention": ret}, checks=selected)
    got = {(r["model"], r["column_name"], r["test"]): (r["failures"], r["passed"]) for r in out.collect()}
    assert got[("mart_acquisition", "date", "not_null")] == (1, False)
    assert got[("mart_acquisition", "cac", "not_null")] == (1, False)
    assert got[("mart_acquisition", "channel", "accepted_values")] == (1, False)  # NULL is not judged
    assert got[("mart_acquisition", "cac", "assert_cac_positive")] == (1, False)
    assert got[("mart_acquisition", "roas", "assert_roas_positive")] == (1, False)
    assert got[("mart_retention", "retention_rate", "assert_retention_rate_valid")] == (1, False)
    assert got[("mart_retention", "cohort_size", "not_null")] == (0, True)


def test_twenty_checks_on_testdata(spark):
    out = Warehouse(spark, SF_MEDIUM).data_checks
    got = rows(out, "model", "column_name", "test", "failures")
    assert len(got) == 20
    failing = [g for g in got if g[3] != 0]
    # one day of Meta ads has no conversions -> its CAC is NULL
    assert failing == [("mart_acquisition", "cac", "not_null", 12)]


def test_serving_order(spark):
    wh = Warehouse(spark, SF_SMALL)
    got = rows(serving.ordered("mart_acquisition", wh.mart_acquisition), "date", "channel")
    assert got == sorted(got, key=lambda r: (-r[0].toordinal(), r[1]))
    assert got[0][1] == "google"


def test_overwrite_replaces_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(3, "c")], "k int, v string")
    write_table(first, path)
    back = overwrite_roundtrip(second, path)
    assert rows(back) == [(3, "c")]
    assert rows(read_table(spark, path)) == [(3, "c")]


def test_partitioned_overwrite_replaces_everything_by_default(spark, tmp_path):
    path = str(tmp_path / "p")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, d string"), path, partition_by=["d"])
    write_table(spark.createDataFrame([(3, "b")], "k int, d string"), path, partition_by=["d"])
    assert sorted(rows(read_table(spark, path), "k", "d")) == [(3, "b")]


def test_partition_replacing_load_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, d string"), path, partition_by=["d"])
    write_table(
        spark.createDataFrame([(3, "b")], "k int, d string"), path, partition_by=["d"], replace_partitions_only=True
    )
    assert sorted(rows(read_table(spark, path), "k", "d")) == [(1, "a"), (3, "b")]


def test_load_feed_stamps_every_row_once(spark, tmp_path):
    import datetime as _dt

    from growthlens.sources.io import load_feed
    from growthlens.sources.testdata_feeds import posthog_raw

    raw = posthog_raw(spark, SF_SMALL)
    stored = load_feed(raw, str(tmp_path / "feed"))
    assert stored.columns == raw.columns
    stamps = [r[0] for r in stored.select("loaded_at").distinct().collect()]
    assert len(stamps) == 1
    _dt.datetime.fromisoformat(stamps[0])  # ISO text
    assert stored.count() == raw.count()


def test_shared_dir_comes_from_the_session(spark):
    from growthlens.session import shared_dir

    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    got = shared_dir(spark)
    if configured:
        assert got == configured.rstrip("/")
    else:  # local session without the setting: a private folder, registered as the checkpoint dir
        assert spark.sparkContext.getCheckpointDir()


def test_failing_rows_of_a_check(spark):
    wh = Warehouse(spark, SF_MEDIUM)
    cac_not_null = next(c for c in checks.default_checks() if c.model == "mart_acquisition" and c.column == "cac")
    bad = checks.failing_rows(wh.mart_acquisition, cac_not_null)
    got = rows(bad, "channel", "total_conversions", "cac")
    assert got and all(r[1] == 0 and r[2] is None for r in got)
    roas = next(c for c in checks.default_checks() if c.test == "assert_roas_positive")
    assert checks.failing_rows(wh.mart_acquisition, roas).count() == 0


def test_failed_overwrite_leaves_the_old_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    with pytest.raises(Exception, match="broken load"):
        write_table(spark.range(4).select(F.when(F.col("id") > 1, F.raise_error(F.lit("broken load"))).otherwise(F.col("id")).cast("long").alias("id")), path)
    assert read_table(spark, path).count() == 3
    # two loads at once: each returned frame keeps the rows it wrote
    one, two = overwrite_roundtrip(spark.range(5), path), overwrite_roundtrip(spark.range(7), path)
    assert (one.count(), two.count(), read_table(spark, path).count()) == (5, 7, 7)


def test_checks_may_be_none_or_empty(spark):
    wh = Warehouse(spark, SF_SMALL)
    assert checks.run_checks({"mart_referral": wh.mart_referral}, checks=[]).count() == 0


@pytest.mark.parametrize("name", sorted(__import__("growthlens.operators.serving", fromlist=["x"]).SORT_KEYS))
def test_presentation_order(spark, name):
    from growthlens.operators import serving

    wh = Warehouse(spark, SF_SMALL)
    keys = serving.SORT_KEYS[name]
    got = rows(serving.ordered(name, getattr(wh, name)), *[k for k, _ in keys])
    want = list(got)
    for i, (_, ascending) in reversed(list(enumerate(keys))):
        want.sort(key=lambda r: r[i], reverse=not ascending)
    assert got == want and len(got) > 1


def test_violated_assertion_stops_the_build(spark, tmp_path):
    from pyspark.sql import functions as F

    from growthlens.plans import build_warehouse
    from growthlens.sources.testdata_feeds import feeds_from_testdata

    feeds = dict(feeds_from_testdata(spark, SF_SMALL))
    feeds["google_ads_raw"] = feeds["google_ads_raw"].withColumn("cost", F.lit(-5.0))
    with pytest.raises(ValueError, match="assert_cac_positive"):
        build_warehouse(spark, feeds, root=str(tmp_path / "wh"), fail_on_checks=True)


def test_one_order_value_for_every_roas(spark):
    wh, more = Warehouse(spark, SF_SMALL), Warehouse(spark, SF_SMALL, avg_order_value=100)
    for name in ("mart_acquisition", "mart_revenue", "channel_cac"):
        a = {r[:2] if len(r) > 2 else r[:1]: r[-1] for r in rows(getattr(wh, name), *([c for c in ("date", "channel") if c in getattr(wh, name).columns] + ["roas"]))}
        b = {r[:2] if len(r) > 2 else r[:1]: r[-1] for r in rows(getattr(more, name), *([c for c in ("date", "channel") if c in getattr(more, name).columns] + ["roas"]))}
        assert all(b[k] == (None if v is None else pytest.approx(2 * v)) for k, v in a.items())


def test_named_table_follows_the_newest_committed_load(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    publish_table(spark, "named_load", path)
    assert rows(spark.table("named_load")) == [(1, "a")]
    write_table(spark.createDataFrame([(2, "b"), (3, "c")], "id int, v string"), path)
    assert rows(spark.table("named_load")) == [(1, "a")]  # readers see the new load once it is published
    publish_table(spark, "named_load", path)
    assert sorted(rows(spark.table("named_load"))) == [(2, "b"), (3, "c")]


def test_build_publishes_its_tables(spark, tmp_path):
    from growthlens.plans import build_warehouse
    from growthlens.sources import feeds_from_testdata

    build_warehouse(spark, feeds_from_testdata(spark, SF_SMALL), root=str(tmp_path), database="default")
    want = Warehouse(spark, SF_SMALL).mart_activation
    assert sorted(rows(spark.table("default.mart_activation")), key=str) == sorted(rows(want), key=str)
    assert spark.catalog.tableExists("default.weekly_kpis") and spark.catalog.tableExists("default.funnel_daily")
