"""Run ledger, idempotent reruns, retention and the month-closing gate on a private warehouse."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from scorewright import two_card
from scorewright.plans import ledger as L
from scorewright.plans.job import JobConfig, closes_month, run_archive
from scorewright.plans.publish import Layout, Zones
from scorewright.plans.retention import list_partitions, retain
from scorewright.sources.features import indicators

SF = "/root/testdata/sf0.001"


def _layout():
    tag = uuid.uuid4().hex[:8]
    return Layout(zones=Zones(f"t{tag}_ops", f"t{tag}_stg", f"t{tag}_prod"))


def _cfg(layout, archive, **kw):
    return JobConfig(as_of=dt.date(2001, 8, 4), archive=archive, env="dev", run_ts="2001-08-04 06:00:00",
                     layout=layout, **kw)


def test_rerun_is_skipped_then_idempotent(spark):
    lay = _layout()
    feats = indicators(spark, SF)
    first = run_archive(spark, feats, _cfg(lay, 20010728), two_card())
    assert first["status"] == "published"
    again = run_archive(spark, feats, _cfg(lay, 20010728), two_card())
    assert again["status"].startswith("skipped")
    weekly = lay.qualified("prod", lay.weekly.name)
    n1 = spark.table(weekly).count()
    # forced rerun: the partition is replaced, not appended
    assert run_archive(spark, feats, _cfg(lay, 20010728, force=True), two_card())["status"] == "published"
    assert spark.table(weekly).count() == n1 == first["rows"]["staging"]


def test_retention_keeps_newest_and_archives_victims(spark):
    lay = _layout()
    feats = indicators(spark, SF)
    for a in (20010707, 20010714, 20010721, 20010728):
        assert run_archive(spark, feats, _cfg(lay, a, tables=("slim", "weekly")), two_card())["status"] == "published"
    slim = lay.qualified("prod", lay.slim.name)
    assert list_partitions(spark, slim) == [20010721, 20010728]           # dev profile keeps 2
    assert list_partitions(spark, slim + "_purge") == [20010707, 20010714]
    assert retain(spark, slim, 5) == []


def test_month_closing_gate(spark):
    assert closes_month(spark, 20010728) and not closes_month(spark, 20010721)
    lay = _layout()
    feats = indicators(spark, SF)
    run_archive(spark, feats, _cfg(lay, 20010721, tables=("monthly",)), two_card())
    monthly = lay.qualified("prod", lay.monthly.name)
    assert not spark.catalog.tableExists(monthly) or spark.table(monthly).count() == 0


def test_freshness_gate_stops_stale_runs(spark):
    lay = _layout()
    feats = indicators(spark, SF)
    cfg = JobConfig(as_of=dt.date(2001, 9, 1), archive=20010901, layout=lay)
    assert run_archive(spark, feats, cfg, two_card())["status"].startswith("stopped")


def test_pending_archives_anti_join(spark):
    cand = spark.createDataFrame([(1,), (2,), (3,), (3,)], "archive int")
    ledger = spark.createDataFrame([(2, "job", 1, dt.datetime(2020, 1, 1))], L.LEDGER_SCHEMA)
    assert sorted(r.archive for r in L.pending(cand, ledger).collect()) == [1, 3]


def test_text_round_trip_keeps_quotes_latin1_and_separator(spark, tmp_path):
    from scorewright.plans.layout import RAW, schema
    from scorewright.sources.raw_text import land_text, read_text
    row = {c: None for c in RAW}
    row.update(infocheck_id='a"b', pers_id="x|y", distrito="ÑEMBY", score_pos=5, flow_pos="N", edad=30)
    df = spark.createDataFrame([tuple(row[c] for c in RAW)], schema(RAW))
    back = read_text(spark, land_text(df, str(tmp_path / "land"))).first()
    assert (back.infocheck_id, back.pers_id, back.distrito, back.score_pos, back.edad) == ('a"b', "x|y", "ÑEMBY", 5, 30)
    assert back.informconf_id is None


def test_freshness_probe_prunes_to_one_partition(spark, tmp_path):
    from scorewright.plans.freshness import freshness
    path = str(tmp_path / "indicators_weekly")
    spark.createDataFrame([("2001-07-30", 20010701), ("2001-06-28", 20010601)], "fecha_obs string, archive int") \
        .write.partitionBy("archive").parquet(path)
    probe = spark.read.parquet(path)
    df = freshness(probe, dt.date(2001, 8, 1), 4, archive=20010701)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(archive" in plan and "= 20010701" in plan
    row = df.first()
    assert row.age_days == 2 and row.fresh
    assert not freshness(probe, dt.date(2001, 8, 1), 4, archive=20010601).first().fresh


def test_first_of_month_run_uses_probe(spark, tmp_path):
    path = str(tmp_path / "probe")
    spark.createDataFrame([("2001-08-01", 20010801)], "fecha_obs string, archive int") \
        .write.partitionBy("archive").parquet(path)
    lay = _layout()
    cfg = JobConfig(as_of=dt.date(2001, 8, 3), first=True, env="dev", run_ts="2001-08-03 06:00:00",
                    layout=lay, tables=("slim",))
    out = run_archive(spark, indicators(spark, SF), cfg, two_card(), probe=spark.read.parquet(path))
    assert out["archive"] == 20010801 and out["status"] == "published"


def test_run_with_text_landing_matches_direct_run(spark):
    feats = indicators(spark, SF)
    direct, landed = _layout(), _layout()
    run_archive(spark, feats, _cfg(direct, 20010728, tables=("current",)), two_card())
    run_archive(spark, feats, _cfg(landed, 20010728, tables=("current",), land_text=True), two_card())
    a = spark.table(direct.qualified("prod", direct.current.name))
    b = spark.table(landed.qualified("prod", landed.current.name))
    assert a.count() == b.count() == 1500
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    raw = spark.table(landed.qualified("ops", landed.raw))
    assert raw.count() == 1500 and len(raw.columns) == 57


def _files(folder):
    import os
    return sorted(os.listdir(folder.replace("file:", "")))


def _purge_counts(spark, purge):
    return sorted((r.archive, r["count"]) for r in spark.table(purge).groupBy("archive", "run").count().collect())


def test_purge_keeps_every_replaced_snapshot_without_copying(spark):
    """Folders are handed over by metadata, and one archive handed over twice keeps both snapshots."""
    from scorewright.plans.retention import partition_location, run_of, table_location
    lay = _layout()
    feats = indicators(spark, SF).cache()
    slim, current = (lay.qualified("prod", t.name) for t in (lay.slim, lay.current))
    folders, sizes = {}, {}

    def run(archive, where, **kw):
        df = feats.where(where)
        sizes[archive] = sizes.get(archive, []) + [df.count()]
        run_archive(spark, df, _cfg(lay, archive, tables=("current", "slim"), precedence=False, **kw), two_card())
        folders[table_location(spark, current)] = _files(table_location(spark, current))

    run(20010707, "edad < 30")
    old = partition_location(spark, slim, 20010707)
    run(20010714, "edad < 40")
    run(20010714, "edad >= 40", force=True)          # replaced partition and snapshot
    run(20010721, "edad < 50")                       # retires 20010707 (dev keeps 2)
    assert list_partitions(spark, slim) == [20010714, 20010721]
    first, (second, third), fourth = sizes[20010707][0], sizes[20010714], sizes[20010721][0]
    assert len({first, second, third, fourth}) == 4
    assert _purge_counts(spark, slim + "_purge") == sorted([(20010707, first), (20010714, second)])
    assert spark.table(slim + "_purge").where("archive = 20010707").select("run").first()[0] == run_of(old)
    assert _purge_counts(spark, current + "_purge") == sorted([(20010714, first), (20010714, second), (20010721, third)])
    # a retired archive published and retired once more
    run(20010707, "edad < 60", force=True)
    run(20010728, "edad < 70")
    assert _purge_counts(spark, slim + "_purge") == sorted(
        [(20010707, first), (20010707, sizes[20010707][1]), (20010714, second), (20010714, third)])
    for folder, files in folders.items():            # no published folder was written again
        assert _files(folder) == files
    assert spark.table(current).count() == sizes[20010728][0]
    feats.unpersist()


def test_failing_write_leaves_the_tables_as_they_were(spark):
    import pytest
    from scorewright.plans.publish import publish_current, publish_partition, write_staging
    lay = _layout()
    run_archive(spark, indicators(spark, SF), _cfg(lay, 20010728, tables=("current", "slim")), two_card())
    staging = spark.table(lay.qualified("staging", lay.staging))
    bad = staging.withColumn("fecha_obs", F.when(F.col("edad") > 50, F.raise_error(F.lit("broken row")))
                             .otherwise(F.col("fecha_obs")))
    for publish in (lambda: publish_current(spark, lay, bad, 20010804),
                    lambda: publish_partition(spark, lay, lay.slim, bad, 20010728, ""),
                    lambda: write_staging(spark, lay, bad)):
        with pytest.raises(Exception, match="broken row"):
            publish()
    for table in (lay.qualified("prod", lay.current.name), lay.qualified("prod", lay.slim.name),
                  lay.qualified("staging", lay.staging)):
        assert spark.table(table).count() == 1500
        assert not spark.catalog.tableExists(table + "_purge")


def test_default_today_stops_old_features(spark):
    out = run_archive(spark, indicators(spark, SF), JobConfig(env="dev", layout=_layout()), two_card())
    assert out["status"].startswith("stopped")


def test_skipped_run_asks_the_ledger_before_it_reads(spark):
    lay = _layout()
    run_archive(spark, indicators(spark, SF), _cfg(lay, 20010728, tables=("slim",)), two_card())
    unreadable = indicators(spark, SF).withColumn("fecha_obs", F.raise_error(F.lit("read")).cast("string"))
    assert run_archive(spark, unreadable, _cfg(lay, 20010728), two_card())["status"].startswith("skipped")


def test_backfill_counts_rows_without_archive_and_runs_once(spark):
    from scorewright.plans.job import backfill
    from scorewright.sources.features import indicators_with_archive
    lay = _layout()
    feats = indicators_with_archive(spark, SF).where("archive >= 20010601")
    feats = feats.withColumn("archive", F.when(F.col("edad") > 80, None).otherwise(F.col("archive")))
    undated = feats.where("archive IS NULL").count()
    cfg = _cfg(lay, 20010728, tables=("slim",))
    assert backfill(spark, feats, cfg, keep={"slim": None})["undated_rows"] == undated > 0
    slim = spark.table(lay.qualified("prod", lay.slim.name))
    ledger = spark.table(lay.qualified("ops", "run_ledger"))
    n, entries = slim.count(), ledger.count()
    assert n == feats.count() - undated
    backfill(spark, feats, cfg, keep={"slim": None})
    spark.catalog.refreshTable(lay.qualified("ops", "run_ledger"))
    assert spark.table(lay.qualified("prod", lay.slim.name)).count() == n
    assert spark.table(lay.qualified("ops", "run_ledger")).count() == entries


def test_rejects_reach_the_ledger(spark):
    lay = _layout()
    feats = indicators(spark, SF).withColumn("tc_max_dias_atraso_u6m", F.lit("12d"))
    out = run_archive(spark, feats, _cfg(lay, 20010728, tables=("slim",)), two_card())
    assert out["rejected"]["tc_max_dias_atraso_u6m"] == 1500 and out["rejected"]["fecha_obs"] == 0
    ledger = spark.table(lay.qualified("ops", "run_ledger"))
    assert ledger.where("table_name = 'rejected tc_max_dias_atraso_u6m'").first()["rows"] == 1500


def test_queries_leave_settings_and_no_more_databases(spark):
    from scorewright.plans.catalog import QUERIES
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "60000")
    try:
        QUERIES["publish_slim"](spark, SF).count()
        databases = {d.name for d in spark.catalog.listDatabases()}
        assert QUERIES["publish_slim"](spark, SF).count() == 1500
        assert {d.name for d in spark.catalog.listDatabases()} == databases
        assert spark.conf.get(key) == "60000"
    finally:
        spark.conf.set(key, "8000")


def test_compat_join_with_a_hot_and_a_null_key(spark):
    from collections import Counter
    from scorewright.operators.keys import score_join_compat
    from scorewright.operators.score import score_append
    card = two_card()
    feats = indicators(spark, SF)
    hot = F.col("edad") % 3 == 0                       # a third of all rows under one key, and one key all null
    for k in card.keys:
        kind = feats.schema[k].dataType
        feats = feats.withColumn(k, F.when(hot, F.lit("7").cast(kind)).when(F.col("edad") == 16, None).otherwise(F.col(k)))
    own = [tuple(r) for r in score_append(feats, card).select(*card.keys, "edad", "score_pos", "flow_pos").collect()]
    results = {}
    for r in own:
        results.setdefault(r[:4], Counter())[r[5:]] += 1
    expect = Counter()
    for r in own:
        for result, n in results[r[:4]].items():
            expect[r[:5] + result] += n
    for check in (True, False):
        got = (score_join_compat(feats, card, check_unique=check)
               .groupBy(*card.keys, "edad", "score_pos", "flow_pos").count().collect())
        assert Counter({tuple(r)[:-1]: r["count"] for r in got}) == expect


def test_backfill_monthly_takes_only_closing_archives(spark):
    from scorewright.functions.calendar import month_closing
    from scorewright.plans.job import backfill
    from scorewright.sources.features import indicators_with_archive
    lay = _layout()
    feats = indicators_with_archive(spark, SF)
    cfg = JobConfig(as_of=dt.date(2001, 8, 4), env="prod", run_ts="2001-08-04 06:00:00", layout=lay,
                    tables=("monthly",), token_key="test-secret")
    backfill(spark, feats, cfg, keep={"monthly": None})
    monthly = spark.table(lay.qualified("prod", lay.monthly.name))
    expect = feats.where(month_closing(F.to_date(F.col("archive").cast("string"), "yyyyMMdd")))
    assert monthly.count() == expect.count() > 0
    got = sorted(r.archive for r in monthly.select("archive").distinct().collect())
    assert got == sorted(r.archive for r in expect.select("archive").distinct().collect())
    assert monthly.where("infocheck_id LIKE 'C%'").count() == 0          # keys are tokens


def test_prod_needs_a_token_secret(spark):
    import pytest
    cfg = JobConfig(as_of=dt.date(2001, 8, 4), archive=20010728, env="prod", layout=_layout())
    with pytest.raises(ValueError):
        run_archive(spark, indicators(spark, SF), cfg, two_card())
