"""All-or-nothing loads and rollups kept by increments."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fundlens.catalog import NAV_ROWS
from fundlens.operators import aggregates as agg
from fundlens.session import scratch_path
from fundlens.sources import files as fs
from fundlens.sources import publish as pub
from fundlens.streaming import rollup as roll


def days(seed, funds=5, n=200):
    rng = random.Random(seed)
    d0 = dt.date(2023, 11, 20)
    return [(f, d0 + dt.timedelta(days=i), rng.uniform(1, 9), Decimal(rng.randrange(10**6)) / 100, Decimal(rng.randrange(-9000, 9000)) / 10**6,
             None if rng.random() < 0.05 else Decimal(rng.randrange(900)) / 10**6, rng.randrange(2))
            for f in range(funds) for i in range(n) if rng.random() < 0.8]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_merged_states_give_the_rollup(spark):
    nav = spark.createDataFrame(days(1), NAV_ROWS)
    parts = [agg.rollup_states(nav.where(F.dayofyear("nav_date") % 3 == i)) for i in range(3)]
    merged = agg.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(agg.finish_states(merged)) == rows(agg.monthly_rollup(nav))
    assert rows(agg.finish_states(agg.merge_states(merged))) == rows(agg.monthly_rollup(nav))


def test_rollup_follows_increments_retries_and_redelivery(spark, monkeypatch):
    root = scratch_path(spark, "test-rollup")
    nav = spark.createDataFrame(days(2), NAV_ROWS)
    args = dict(landing=f"{root}/landing/*", root=f"{root}/t", schema=NAV_ROWS, checkpoint=f"{root}/_c")
    months = [(2023, 11), (2023, 12), (2024, 1)]
    for k, (y, m) in enumerate(months):
        wave = nav.where((F.year("nav_date") == y) & (F.month("nav_date") == m) | (F.dayofmonth("nav_date") == k + 3))
        text = fs.as_text(wave)
        if k == 1:
            bad = text.limit(3).withColumn("aum", F.lit("?"))
            text = text.unionByName(bad)
            # the batch breaks after its facts are written; the next run takes it up again
            real = agg.rollup_states
            fs.write_table(text, f"{root}/landing/w{k}", fmt="csv")
            monkeypatch.setattr(roll.agg, "rollup_states", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(Exception):
                roll.ingest_with_rollup(spark, **args)
            monkeypatch.setattr(roll.agg, "rollup_states", real)
            assert roll.ingest_with_rollup(spark, **args).quarantined == 3
            roll.compact(spark, f"{root}/t", NAV_ROWS)
            continue
        fs.write_table(text, f"{root}/landing/w{k}", fmt="csv")
        roll.ingest_with_rollup(spark, **args)
    assert roll.ingest_with_rollup(spark, **args) == (0, 0)
    taken = nav.where("nav_date < '2024-02-01' OR dayofmonth(nav_date) IN (3, 4, 5)")
    assert rows(roll.current_rollup(spark, f"{root}/t", NAV_ROWS)) == rows(agg.monthly_rollup(taken))


def test_no_rows_taken_in(spark):
    root = scratch_path(spark, "test-rollup-empty")
    assert roll.current_rollup(spark, root, NAV_ROWS).count() == 0
    assert roll.compact(spark, root, NAV_ROWS) is None


def test_a_broken_run_changes_nothing(spark):
    root = scratch_path(spark, "test-publish")
    fund, facts = spark.range(1, 6).withColumnRenamed("id", "fund_id"), spark.range(20).select((F.col("id") % 5 + 1).alias("fund_id"), "id")
    with pytest.raises(LookupError):
        pub.read_current(spark, root, "trades")
    got = pub.load_all(spark, {"trades": facts, "fund_master": fund, "extra": spark.range(3)}, root).first().asDict()
    assert got == {"fund_master_count": 5, "trades_count": 20, "extra_count": 3}
    for broken in ({"fund_master": fund, "trades": facts.withColumn("id", F.raise_error(F.lit("x")).cast("long"))},
                   {"fund_master": fund.where("fund_id < 3"), "trades": facts}):
        with pytest.raises(pub.NotPublished):
            pub.load_all(spark, broken, root)
        assert pub.manifests(spark, root) == [1]
        assert pub.read_current(spark, root, "trades").count() == 20 and pub.read_current(spark, root, "fund_master").count() == 5
    pub.load_all(spark, {"trades": facts.where("id < 0")}, root)
    assert pub.read_current(spark, root, "trades").count() == 0 and pub.read_current(spark, root, "extra").count() == 3
    assert pub.read_current(spark, root, "trades", 1).count() == 20
    assert len(pub.retire(spark, root, keep=2)) == 2                   # the two broken runs
    pub.load_all(spark, {"extra": spark.range(4)}, root)
    pub.retire(spark, root, keep=1)
    assert {n: pub.read_current(spark, root, n).count() for n in ("fund_master", "trades", "extra")} == {"fund_master": 5, "trades": 0, "extra": 4}


def test_two_runs_cannot_take_one_number(spark, monkeypatch):
    root = scratch_path(spark, "test-publish-race")
    pub.publish(spark, root, "a", pub.stage(spark, {"t": spark.range(2)}, root, "a"))
    monkeypatch.setattr(pub, "manifests", lambda *a: [])                # the other run read the list before
    with pytest.raises(pub.NotPublished):
        pub.publish(spark, root, "b", pub.stage(spark, {"t": spark.range(9)}, root, "b"))
    monkeypatch.undo()
    assert pub.read_current(spark, root, "t").count() == 2


def test_a_landed_file_is_read_once(spark, tmp_path, monkeypatch):
    """The landed files are gone after they were taken over; the load still has all rows."""
    import shutil
    nav = spark.createDataFrame([("F1", "2024-01-02", "1.5"), ("F1", "soon", "2"), ("F2", "2024-01-03", None)],
                                "fund_id string, nav_date string, aum string")
    for name in fs.LOAD_ORDER:
        schema = fs.SCHEMAS[name]
        rows_ = spark.createDataFrame([("F1",), ("F2",)], "fund_id string") if name == "fund_master" else nav if name == "nav_daily" else nav.limit(0)
        text = rows_.select(*[F.col(f.name) if f.name in rows_.columns else F.lit("1" if not f.nullable else None).cast("string").alias(f.name)
                              for f in schema.fields])
        text.write.option("header", True).csv(f"{tmp_path}/landing/{fs.FILE_NAMES[name]}")
    real = fs.conform
    monkeypatch.setattr(fs, "conform", lambda raw, schema, *a: (shutil.rmtree(f"{tmp_path}/landing/{[fs.FILE_NAMES[n] for n in fs.LOAD_ORDER if fs.SCHEMAS[n] is schema][0]}"),
                                                                real(raw, schema, *a))[1])
    got = fs.ingest_files(spark, f"{tmp_path}/landing", f"{tmp_path}/tables").first()
    assert got["status"] == "Succeeded" and got["nav_daily_count"] == got["source_nav_daily_count"] >= 1
    assert spark.read.parquet(f"{tmp_path}/tables/_quarantine/nav_daily").count() + got["nav_daily_count"] == 3
