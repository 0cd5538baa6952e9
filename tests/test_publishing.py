"""Damaged text, stored features, table versions, orphans, second sessions, and what must not show in a plan."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from scorewright import two_card
from scorewright.functions.tokens import secret, token
from scorewright.operators.score import score, score_append, source_projection
from scorewright.plans import ledger as L
from scorewright.plans import retention as R
from scorewright.plans import versions as V
from scorewright.plans.freshness import stored_freshness
from scorewright.plans.job import JobConfig, backfill, run_archive
from scorewright.plans.layout import RAW, RAW_SCHEMA
from scorewright.plans.orphans import orphan_runs, remove_orphans
from scorewright.plans.publish import Layout, Zones
from scorewright.sources import jdbc
from scorewright.sources.feature_store import FeatureStore
from scorewright.sources.features import indicators, indicators_with_archive
from scorewright.sources.raw_text import DIALECTS, damaged_lines, land_text, read_text

SF = "/root/testdata/sf0.001"


def _layout():
    tag = uuid.uuid4().hex[:8]
    return Layout(zones=Zones(f"t{tag}_ops", f"t{tag}_stg", f"t{tag}_prod"))


def _cfg(layout, archive, **kw):
    return JobConfig(**{"as_of": dt.date(2001, 8, 4), "archive": archive, "run_ts": "2001-08-04 06:00:00", "layout": layout,
                        "precedence": False, **kw})


def _rows(n):
    row = {c: None for c in RAW}
    return [tuple({**row, "infocheck_id": f"c{i}", "pers_id": "ÑANDÚ", "edad": 30 + i, "score_pos": i, "flow_pos": "A",
                   "fecha_obs": "2001-08-03"}[c] for c in RAW) for i in range(n)]


def _landing(spark, folder, dialect, damaged):
    path = land_text(spark.createDataFrame(_rows(40), RAW_SCHEMA), f"{folder}/land", dialect)
    with open(f"{folder}/land/more.csv", "w", encoding=DIALECTS[dialect]["encoding"]) as out:
        out.write("\n".join(["|".join(RAW), *damaged, ""]))
    return path


# too few fields, too many, a word where a number belongs
DAMAGED = ["short|line", "|".join(["1"] * 60), "|".join(["k1", "k2", "k3", "no number", *[""] * 53])]


@pytest.mark.parametrize("dialect", ["quoted", "plain"])
def test_damaged_lines_are_put_aside(spark, tmp_path, dialect):
    path = _landing(spark, tmp_path, dialect, DAMAGED)
    lay = _layout()
    out = run_archive(spark, None, _cfg(lay, 20010804, dialect=dialect, max_bad_share=0.1, tables=("slim",)), two_card(), landed=path)
    assert out["status"] == "published" and out["rows"]["bad lines"] == 3 and out["rows"]["staging"] == 40
    slim = spark.table(lay.qualified("prod", lay.slim.name))
    assert sorted(r.infocheck_id for r in slim.collect()) == sorted(f"c{i}" for i in range(40))
    assert {r.pers_id for r in slim.collect()} == {"ÑANDÚ"}
    bad = spark.table(lay.qualified("ops", lay.rejects.name)).where("archive = 20010804").collect()
    assert sorted(r.bad_line for r in bad) == sorted(DAMAGED)
    assert {os.path.basename(r.bad_file) for r in bad} == {"more.csv"}
    ledger = spark.table(lay.qualified("ops", "run_ledger"))
    assert ledger.where("table_name = 'bad lines'").first()["rows"] == 3
    assert spark.table(lay.qualified("ops", lay.raw)).count() == 43          # the text table reads on


def test_too_many_damaged_lines_stop_the_run(spark, tmp_path):
    path = _landing(spark, tmp_path, "plain", DAMAGED)
    lay = _layout()
    cfg = _cfg(lay, 20010804, dialect="plain", tables=("slim",))              # 3 of 43 is above one in a hundred
    out = run_archive(spark, None, cfg, two_card(), landed=path)
    assert out["status"] == "stopped: 3 of 43 text lines damaged"
    assert spark.table(lay.qualified("ops", lay.rejects.name)).count() == 3
    assert not spark.catalog.tableExists(lay.qualified("prod", lay.slim.name))
    assert not L.is_done(spark, lay.qualified("ops", "run_ledger"), 20010804)
    # mended and run again: no line is left in the reject table of a good run
    clean = land_text(spark.createDataFrame(_rows(40), RAW_SCHEMA), f"{tmp_path}/clean", "plain")
    assert run_archive(spark, None, cfg, two_card(), landed=clean)["rows"]["bad lines"] == 0


def test_landed_text_passes_the_gate_by_its_own_dates(spark, tmp_path):
    path = land_text(spark.createDataFrame(_rows(5), RAW_SCHEMA), f"{tmp_path}/land")
    fresh = _cfg(_layout(), 20010804, precedence=True, tables=("slim",))
    assert run_archive(spark, None, fresh, two_card(), landed=path)["status"] == "published"
    late = _cfg(_layout(), 20010811, precedence=True, as_of=dt.date(2001, 8, 11))
    assert run_archive(spark, None, late, two_card(), landed=path)["status"] == "stopped: features 8 days old"
    with pytest.raises(ValueError):
        run_archive(spark, None, fresh, two_card())


def test_plain_text_keeps_quotes_as_they_are(spark, tmp_path):
    row = dict.fromkeys(RAW) | {"infocheck_id": '"a" b', "pers_id": 'x"', "edad": 1}
    path = land_text(spark.createDataFrame([tuple(row[c] for c in RAW)], RAW_SCHEMA), f"{tmp_path}/land", "plain")
    r = read_text(spark, path, dialect="plain").first()
    assert (r.infocheck_id, r.pers_id, r.edad, r.bad_line) == ('"a" b', 'x"', 1, None)
    assert damaged_lines(spark, path, dialect="plain").count() == 0


# ------------------------------------------------------------------ stored features

def test_freshness_comes_from_the_footers_of_one_partition(spark, tmp_path):
    rows = [("2001-07-30", 20010728, "a"), ("2001-07-29", 20010728, "b"), (None, 20010728, "c"), ("bad", 20010728, "d"), ("2001-08-02", 20010804, "e")]
    store = FeatureStore(f"{tmp_path}/f").write(spark.createDataFrame(rows, "fecha_obs string, archive int, k string"))
    probe = store.last_observation(spark, 20010728)
    plan = probe._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(obs_date)]" in plan
    assert "PartitionFilters: [isnotnull(archive" in plan and "20010728" in plan
    assert store.last_date(spark, 20010728) == dt.date(2001, 7, 30) and store.last_date(spark) == dt.date(2001, 8, 2)
    assert store.last_date(spark, 19990101) is None
    r = stored_freshness(spark, store, dt.date(2001, 8, 1), 4, 20010728).first()
    assert (r.age_days, r.fresh) == (2, True)
    assert sorted(r.k for r in store.read(spark, 20010728).collect()) == ["a", "b", "c", "d"]
    assert store.read(spark).columns == ["fecha_obs", "k", "archive"]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""          # the caller's session keeps its reader


def test_feature_table_without_the_date_column_is_parsed(spark, tmp_path):
    spark.createDataFrame([("2001-07-30", 1), ("x", 1), ("2001-08-30", 2)], "fecha_obs string, archive int").write.partitionBy("archive").parquet(f"{tmp_path}/f")
    store = FeatureStore(f"{tmp_path}/f")
    assert store.last_date(spark, 1) == dt.date(2001, 7, 30) and store.last_date(spark) == dt.date(2001, 8, 30)
    empty = FeatureStore(f"{tmp_path}/e").write(spark.createDataFrame([], "fecha_obs string, k string"))
    assert empty.last_date(spark) is None


def test_run_from_a_store_equals_a_run_from_the_view(spark, tmp_path):
    feats = indicators(spark, SF)
    store = FeatureStore(f"{tmp_path}/f").write(feats)
    tables = []
    for source in (feats, store):
        lay = _layout()
        assert run_archive(spark, source, _cfg(lay, 20010804, tables=("current",)), two_card())["status"] == "published"
        tables.append(spark.table(lay.qualified("prod", lay.current.name)))
    assert tables[0].exceptAll(tables[1]).count() == tables[1].exceptAll(tables[0]).count() == 0


# ------------------------------------------------------------------ versions, orphans, sessions

def _by_stamp(df):
    return {(r.archive, r.time_stamp): r["count"] for r in df.groupBy("archive", "time_stamp").count().collect()}


def test_broken_switch_leaves_one_version_and_is_put_in_order(spark, monkeypatch):
    lay = _layout()
    feats = indicators_with_archive(spark, SF).where("archive >= 20010601").cache()
    slim = lay.qualified("prod", lay.slim.name)
    keep = {"slim": None}
    backfill(spark, feats, _cfg(lay, None, tables=("slim",)), keep=keep)
    first = _by_stamp(spark.table(V.view_name(slim)))
    plain, commit = R.follow, V.commit

    def half(spark, table, before, after, base):
        plain(spark, table, before, {**before, **dict(sorted(after.items())[:3])}, base)
        raise RuntimeError("lost")

    # before the pointer: readers of the view keep the old version
    monkeypatch.setattr(V, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        backfill(spark, feats, _cfg(lay, None, tables=("slim",), run_ts="2001-08-05 00:00:00", force=True), keep=keep)
    assert _by_stamp(spark.table(V.view_name(slim))) == first
    monkeypatch.setattr(V, "commit", commit)
    # after it, between two partitions of the plain table: they see the whole new one
    monkeypatch.setattr(R, "follow", half)
    with pytest.raises(RuntimeError, match="lost"):
        backfill(spark, feats, _cfg(lay, None, tables=("slim",), run_ts="2001-08-06 00:00:00", force=True), keep=keep)
    assert {t for _, t in _by_stamp(spark.table(V.view_name(slim)))} == {"2001-08-06 00:00:00"}
    spark.catalog.refreshTable(slim)
    assert len({t for _, t in _by_stamp(spark.table(slim))}) == 2                # the plain table lags
    monkeypatch.setattr(R, "follow", plain)
    run_archive(spark, feats.drop("archive"), _cfg(lay, 20010811, env="prod", token_key="s", tables=("slim",)), two_card())
    want = {(a, "2001-08-06 00:00:00"): n for (a, _), n in first.items()} | {(20010811, "2001-08-04 06:00:00"): feats.count()}
    assert _by_stamp(spark.table(slim)) == _by_stamp(spark.table(V.view_name(slim))) == want
    feats.unpersist()


def test_retention_is_part_of_the_version(spark):
    lay = _layout()
    feats = indicators(spark, SF).where("edad < 40")
    slim = lay.qualified("prod", lay.slim.name)
    for a in (20010707, 20010714, 20010721, 20010728):
        run_archive(spark, feats, _cfg(lay, a, tables=("slim",)), two_card())
    assert sorted(V.entries(spark, slim)) == R.list_partitions(spark, slim) == [20010721, 20010728]      # dev keeps 2
    assert V.newest(spark, slim) == V.property_of(spark, slim) == 4
    kept = {int(p["version"]) for p in V.partition_specs(spark, V.versions_table(slim))}
    assert kept == {2, 3, 4}
    assert sorted(V.entries(spark, slim, 3)) == [20010714, 20010721]


def test_table_without_versions_is_taken_over(spark):
    """Tables filled by earlier releases have partitions and no version."""
    lay = _layout()
    feats = indicators(spark, SF).where("edad < 40")
    slim = lay.qualified("prod", lay.slim.name)
    for a in (20010707, 20010714):
        run_archive(spark, feats, _cfg(lay, a, tables=("slim",)), two_card())
    spark.sql(f"DROP VIEW {V.view_name(slim)}")
    spark.sql(f"DROP TABLE {V.versions_table(slim)}")
    run_archive(spark, feats, _cfg(lay, 20010721, tables=("slim",)), two_card())
    assert sorted(V.entries(spark, slim)) == R.list_partitions(spark, slim) == [20010714, 20010721]
    assert R.list_partitions(spark, slim + "_purge") == [20010707]


def test_orphans_are_found_and_only_they_are_removed(spark):
    lay = _layout()
    feats = indicators(spark, SF)
    for a in (20010714, 20010721, 20010728):
        run_archive(spark, feats.where("edad < 40"), _cfg(lay, a, tables=("current", "slim", "weekly")), two_card())
    remove_orphans(spark, lay, 0.0)                                        # replaced staging folders
    assert orphan_runs(spark, lay).count() == 0
    lost = f"{lay.location(spark, 'prod', lay.weekly.name)}/runs/{R.new_run()}"
    spark.range(3).write.parquet(f"{lost}/archive=20010804")
    half = f"{lay.location(spark, 'prod', lay.current.name)}/runs/{R.new_run()}".replace("file:", "")
    os.makedirs(f"{half}/_temporary/0")                                     # broken off before its first file
    assert sorted(r.table_name for r in orphan_runs(spark, lay).collect()) == ["scored_current", "scored_weekly"]
    assert remove_orphans(spark, lay) == []                                  # younger than a week: may be running
    assert len(remove_orphans(spark, lay, 0.0)) == 2 and not os.path.exists(half)
    for spec in (lay.current, lay.slim, lay.weekly):
        for name in (spec.name, spec.name + "_purge", spec.name + "_published"):
            assert spark.table(lay.qualified("prod", name)).count() > 0


def test_another_session_sees_the_new_snapshot(spark):
    lay = _layout()
    feats = indicators(spark, SF)
    current, slim = (lay.qualified("prod", t.name) for t in (lay.current, lay.slim))
    other = spark.newSession()
    for a, part in ((20010721, "edad < 40"), (20010728, "edad >= 40"), (20010804, "edad IS NULL")):
        run_archive(spark, feats.where(part), _cfg(lay, a, tables=("current", "slim")), two_card())
        n = feats.where(part).count()
        for session in (spark, other):
            assert session.table(V.view_name(current)).count() == n
            assert session.table(V.view_name(slim)).where(F.col("archive") == a).count() == n
    plan = other.table(V.view_name(slim)).where("archive = 20010804")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "version" in plan


# ------------------------------------------------------------------ plans

def test_secret_shows_in_no_plan(spark):
    key = "very-secret-key"
    df = spark.range(3).select(F.col("id").cast("string").alias("a")).select(token("a", "d", secret(spark, key), 2).alias("t"))
    df.collect()
    assert key not in df._jdf.queryExecution().toString()
    import hashlib

    def once(v):
        return hashlib.sha256(f"{key}|d|{v}".encode()).hexdigest()
    assert [r.t for r in df.collect()] == [once(once(str(i))) for i in range(3)]


def test_batch_unit_runs_no_job_while_the_query_is_built(spark):
    feats = indicators(spark, SF)
    spark.sparkContext.setJobGroup("build", "build")
    try:
        df = score(feats, two_card(), keys=list(two_card().keys), auto_units=True)
        df.explain()
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("build") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert df.count() == 1500


def test_counts_come_with_the_writes(spark):
    """Ledger entries of a run equal what the tables hold, and no job reads a table back for them."""
    lay = _layout()
    out = run_archive(spark, indicators(spark, SF), _cfg(lay, 20010728, tables=("current", "slim", "weekly")), two_card())
    ledger = {r.table_name: r["rows"] for r in spark.table(lay.qualified("ops", "run_ledger")).collect()}
    for spec in (lay.current, lay.slim, lay.weekly):
        assert ledger[spec.name] == out["rows"][spec.name] == spark.table(lay.qualified("prod", spec.name)).count() == 1500
    assert ledger["job"] == ledger["staging"] == 1500 and ledger["rejected fecha_obs"] == 0


def test_backfill_records_rejects_per_archive(spark):
    lay = _layout()
    feats = indicators_with_archive(spark, SF).where("archive >= 20010701")
    feats = feats.withColumn("tc_max_dias_atraso_u6m", F.when(F.col("archive") == 20010707, "12d").otherwise("1"))
    backfill(spark, feats, _cfg(lay, None, tables=("slim", "monthly")), keep={"slim": None, "monthly": None})
    ledger = spark.table(lay.qualified("ops", "run_ledger"))
    got = {r.archive: r["rows"] for r in ledger.where("table_name = 'rejected tc_max_dias_atraso_u6m'").collect()}
    want = {r.archive: r["count"] if r.archive == 20010707 else 0 for r in feats.groupBy("archive").count().collect()}
    assert got == want
    assert {r.archive for r in ledger.where("table_name = 'scored_monthly'").collect()} == {20010728}


def test_ledger_names_are_escaped(spark, tmp_path):
    name = f"default.ledger_{uuid.uuid4().hex[:8]}"
    L.ensure_ledger(spark, name, f"{tmp_path}/it's here")
    L.record(spark, name, {1: {"o'clock": 2, "job": None}, 2: {"job": 5}})
    assert {(r.archive, r.table_name, r["rows"]) for r in spark.table(name).collect()} == {(1, "o'clock", 2), (1, "job", None), (2, "job", 5)}


# ------------------------------------------------------------------ JDBC

def test_slices_take_every_row_once(spark):
    values = [None, None, -5, 0, *range(100), *[50] * 500, 10 ** 12]
    df = spark.createDataFrame([(v,) for v in values], "`a\"b` long")
    bounds = jdbc.equi_depth_bounds(df, '`a"b`', 8)
    assert bounds == sorted(set(bounds)) and 50 in bounds and len(bounds) <= 7
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        sizes = [df.where(p.replace('""', '"').replace('"a"b"', '`a"b`')).count() for p in jdbc.slice_predicates('a"b', bounds)]
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")
    assert sum(sizes) == len(values) and min(sizes) > 0
    assert jdbc.slice_predicates("k", []) == ["1 = 1"]
    assert jdbc.slice_predicates("k", [5, 9]) == ['("k" < 5 OR "k" IS NULL)', '("k" >= 5 AND "k" < 9)', '"k" >= 9']
    assert jdbc.equi_depth_bounds(df.limit(0), '`a"b`', 4) == [] == jdbc.equi_depth_bounds(df, '`a"b`', 1)


def test_jdbc_read_pushes_columns_slices_and_options():
    asked = {}

    class Reader:
        def jdbc(self, url, table, **kw):
            asked.update(url=url, table=table, **kw)
            return self

        def select(self, *cols):
            asked["select"] = cols
            return self

    class Session:
        read = Reader()

    card = two_card()
    jdbc.read_features_jdbc(Session(), "jdbc:x", "ops.indicators", card, "k", [3, 8], {"user": "u"}, fetch_size=7)
    assert asked["url"] == "jdbc:x" and asked["properties"] == {"fetchsize": "7", "user": "u"}
    assert asked["table"].startswith('(SELECT "') and asked["table"].endswith(', "k" FROM ops.indicators) features')
    assert len(asked["predicates"]) == 3 and list(asked["select"]) == card.source_columns()


def test_scores_from_landed_rows_equal_direct_ones(spark, tmp_path):
    scored = score_append(source_projection(indicators(spark, SF), two_card()), two_card())
    for dialect in DIALECTS:
        back = read_text(spark, land_text(scored, f"{tmp_path}/{dialect}", dialect), dialect=dialect).drop("bad_line", "bad_file")
        assert back.exceptAll(scored).count() == scored.exceptAll(back).count() == 0
