"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All of them read the driver tables through the application view (one row per
order), i.e. their work grows with the tables.  Publishing queries write real
tables under the session's shared folder and return what was published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime as dt
import re
from dataclasses import replace

from scorewright.functions.calendar import archive_date, archive_int, first_of_month, month_closing, run_date
from scorewright.functions.columns import round9
from scorewright.functions.tokens import secret, token
from scorewright.plans import ledger as L
from scorewright.plans.freshness import freshness as freshness_gate, stored_freshness
from scorewright.plans.job import JobConfig, backfill, run_archive
from scorewright.plans.layout import TOKENIZED
from scorewright.plans.orphans import orphan_runs
from scorewright.plans.publish import Layout, Zones, ensure_zones
from scorewright.plans.retention import new_run
from scorewright.plans.versions import view_name
from scorewright.session import remove_folder, scratch_path, shared_root
from scorewright.sources.feature_store import FeatureStore
from scorewright.sources.features import indicators_with_archive
from scorewright.sources.raw_text import DIALECTS, land_text, read_text, register_text_table
from scorewright.models.two_card import two_card
from scorewright.operators.normalize import rejects
from scorewright.operators.keys import duplicate_keys, score_join_compat
from scorewright.operators.score import score, score_append, source_projection, working_frame
from scorewright.sources.features import indicators, indicators_dup

CARD = two_card()
KEYS = list(CARD.keys)
IMPUTED = [i.column for i in CARD.imputes]
CAPPED = [c.column for c in CARD.caps]


def _upto(spark: SparkSession, sf_dir: str, step: str, auto_units: bool = False) -> DataFrame:
    return working_frame(source_projection(indicators(spark, sf_dir), CARD), CARD,
                         auto_units=auto_units, upto=step)


def feature_scan(spark, sf_dir):
    return source_projection(indicators(spark, sf_dir), CARD)


def knockout(spark, sf_dir):
    return _upto(spark, sf_dir, "knockout").select(*KEYS, "flow_x")


def normalize(spark, sf_dir):
    return _upto(spark, sf_dir, "normalize").select(*KEYS, "ich_fecha_ult_cons_priv", "tc_max_dias_atraso_u6m")


def consult_age(spark, sf_dir):
    return _upto(spark, sf_dir, "consult_age").select(*KEYS, "flag_mnx", "fecha_ult_cons_privdia")


def consult_age_auto(spark, sf_dir):
    return _upto(spark, sf_dir, "consult_age", auto_units=True).select(*KEYS, "fecha_ult_cons_privdia")


def impute(spark, sf_dir):
    return _upto(spark, sf_dir, "impute").select(*KEYS, "scorecard", *IMPUTED)


def cap(spark, sf_dir):
    return _upto(spark, sf_dir, "cap").select(*KEYS, "scorecard", *CAPPED)


def flags(spark, sf_dir):
    return _upto(spark, sf_dir, "derive").select(
        *KEYS, "flag_mnx", "casado", "flag_judiciales", "flag_saldo_vencido_ult_gt0",
        "situacion_bancaria_woe", "ich_cons_cant_total_recod")


def district_weight(spark, sf_dir):
    return _upto(spark, sf_dir, "lookup").select(*KEYS, "scorecard", "distrito", "distrito_woe")


def logodds(spark, sf_dir):
    return _upto(spark, sf_dir, "linear").select(*KEYS, "scorecard", round9(F.col("logodds")).alias("logodds"))


def score_points(spark, sf_dir):
    return _upto(spark, sf_dir, "scale").select(*KEYS, "flow_x", "score_pos")


def score_keys(spark, sf_dir):
    return score(indicators(spark, sf_dir), CARD, keys=KEYS)


def band(spark, sf_dir):
    scored = score(indicators(spark, sf_dir), CARD, keys=KEYS)
    return scored.groupBy("flow_pos").agg(F.count(F.lit(1)).alias("n_rows"),
                                          F.min("score_pos").alias("min_score"),
                                          F.max("score_pos").alias("max_score"))


def band_summary(spark, sf_dir):
    """Flagship: rows and mean score per band over the whole population."""
    scored = score(indicators(spark, sf_dir), CARD, keys=KEYS)
    return scored.groupBy("flow_pos").agg(F.count(F.lit(1)).alias("n_rows"),
                                          round9(F.avg("score_pos")).alias("mean_score"))


def score_append_q(spark, sf_dir):
    return score_append(source_projection(indicators(spark, sf_dir), CARD), CARD)


def score_join_compat_q(spark, sf_dir):
    return score_join_compat(source_projection(indicators_dup(spark, sf_dir), CARD), CARD)


def duplicate_keys_q(spark, sf_dir):
    return duplicate_keys(indicators_dup(spark, sf_dir), KEYS)


# --------------------------------------------------------------------------- publishing

RUN_TS = "2001-08-04 06:00:00"        # fixed load stamp so reruns and checks are repeatable
TOKEN_KEY = "scorewright-test-key"    # tests only; a deployment passes its own secret
FRESHNESS_AS_OF = dt.date(2001, 8, 4)


def _isolated_layout(spark: SparkSession, query: str) -> Layout:
    """The query's own databases and folders in this application; its next call starts them afresh."""
    tag = "sw_" + re.sub(r"[^a-z0-9]", "_", spark.sparkContext.applicationId.lower()) + f"_{query}"
    zones = Zones(f"{tag}_ops", f"{tag}_staging", f"{tag}_prod")
    root = f"{shared_root(spark)}/scorewright/queries/{tag}"
    for db in (zones.ops, zones.staging, zones.prod):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    remove_folder(spark, root)
    return Layout(zones=zones, table_root=root)


def _last_observation(features: DataFrame) -> dt.date:
    return freshness_gate(features, FRESHNESS_AS_OF).first()["last_obs"]


def _published(result: dict) -> dict:
    if result["status"] != "published":
        raise RuntimeError(result)
    return result


def _store(spark: SparkSession, lay: Layout, features: DataFrame, name: str = "features") -> FeatureStore:
    """The features as a stored table of the query's own, as jobs read them."""
    return FeatureStore(lay.location(spark, "ops", name)).write(features)


def _run(spark: SparkSession, sf_dir: str, query: str, tables: tuple[str, ...], lay: Layout | None = None) -> Layout:
    """One weekly run over the whole view, on the day of its last observation."""
    lay = lay or _isolated_layout(spark, query)
    store = _store(spark, lay, indicators(spark, sf_dir))
    cfg = JobConfig(as_of=store.last_date(spark), env="prod", run_ts=RUN_TS, token_key=TOKEN_KEY, tables=tables, layout=lay)
    _published(run_archive(spark, store, cfg, CARD))
    return lay


def stage_snapshot(spark, sf_dir):
    lay = _run(spark, sf_dir, "stage_snapshot", ())
    return spark.table(lay.qualified("staging", lay.staging))


def publish_current_q(spark, sf_dir):
    lay = _run(spark, sf_dir, "publish_current", ("current",))
    return spark.table(lay.qualified("prod", lay.current.name))


def publish_slim_q(spark, sf_dir):
    lay = _run(spark, sf_dir, "publish_slim", ("slim",))
    return spark.table(lay.qualified("prod", lay.slim.name))


def publish_weekly_q(spark, sf_dir):
    lay = _run(spark, sf_dir, "publish_weekly", ("weekly",))
    return spark.table(lay.qualified("prod", lay.weekly.name))


def publish_monthly_q(spark, sf_dir):
    lay = _run(spark, sf_dir, "publish_monthly", ("monthly",))
    return spark.table(lay.qualified("prod", lay.monthly.name))


def csv_roundtrip(spark, sf_dir):
    scored = score_append(source_projection(indicators(spark, sf_dir), CARD), CARD)
    return read_text(spark, land_text(scored, scratch_path(spark, "landing") + "/data/archive=0"), strict=True)


def _tokens(spark, sf_dir, passes):
    view = indicators(spark, sf_dir)
    key = secret(spark, TOKEN_KEY)
    toks = [token(c, d, key, passes).alias(f"{c}_token") for c, d in TOKENIZED.items()]
    return view.select(*KEYS, *toks)


def tokenize(spark, sf_dir):
    return _tokens(spark, sf_dir, 1)


def tokenize_twice(spark, sf_dir):
    return _tokens(spark, sf_dir, 2)


def archive_calendar(spark, sf_dir):
    days = (indicators(spark, sf_dir).select(F.try_to_date("fecha_obs", "yyyy-MM-dd").alias("obs_date"))
            .where(F.col("obs_date").isNotNull()).distinct())
    return days.select("obs_date",
                       archive_int(run_date(F.col("obs_date"))).alias("archive"),
                       archive_int(first_of_month(F.col("obs_date"))).alias("first_archive"))


def month_closing_q(spark, sf_dir):
    archives = indicators_with_archive(spark, sf_dir, CARD).select("archive").distinct()
    return archives.select("archive", month_closing(archive_date(F.col("archive"))).alias("closes_month"))


def freshness_q(spark, sf_dir):
    return freshness_gate(indicators(spark, sf_dir), FRESHNESS_AS_OF, 4)


def pending_archives(spark, sf_dir):
    """Archives in the data without a ledger entry; the ledger holds the archives before 1998."""
    lay = _isolated_layout(spark, "pending_archives")
    ensure_zones(spark, lay)
    ledger = L.ensure_ledger(spark, lay.qualified("ops", "run_ledger"), lay.location(spark, "ops", "run_ledger"))
    candidates = indicators_with_archive(spark, sf_dir, CARD).select("archive")
    (candidates.where(F.col("archive") < 19980101).distinct()
     .select("archive", F.lit("job").alias("table_name"), F.lit(None).cast("long").alias("rows"),
             F.to_timestamp(F.lit(RUN_TS)).alias("run_ts"))
     .write.insertInto(ledger))
    return L.pending(candidates, spark.table(ledger))


def _backfill(spark, sf_dir, query, tables, keep):
    lay = _isolated_layout(spark, query)
    cfg = JobConfig(as_of=FRESHNESS_AS_OF, env="prod", run_ts=RUN_TS, token_key=TOKEN_KEY, tables=tables, layout=lay)
    backfill(spark, indicators_with_archive(spark, sf_dir, CARD), cfg, CARD, keep=keep)
    return lay


def backfill_slim(spark, sf_dir):
    lay = _backfill(spark, sf_dir, "backfill_slim", ("slim",), {"slim": None})
    return spark.table(lay.qualified("prod", lay.slim.name))


def retention_q(spark, sf_dir):
    lay = _backfill(spark, sf_dir, "retention", ("weekly",), {"weekly": 12})
    return spark.table(lay.qualified("prod", lay.weekly.name)).select(*KEYS, "score_pos", "flow_pos", "archive")


def rejects_q(spark, sf_dir):
    return rejects(indicators(spark, sf_dir), CARD)


def gated_run(spark, sf_dir):
    """Rows of the slim table after a run four days past the last observation (too late) and one three days past it."""
    lay = _isolated_layout(spark, "gated_run")
    features = indicators(spark, sf_dir)
    last = _last_observation(features)
    slim = lay.qualified("prod", lay.slim.name)
    found = []
    for case, days in (("stale", 4), ("fresh", 3)):
        cfg = JobConfig(as_of=last + dt.timedelta(days=days), env="prod", run_ts=RUN_TS, tables=("slim",), layout=lay)
        run_archive(spark, features, cfg, CARD)
        n = spark.table(slim).count() if spark.catalog.tableExists(slim) else 0
        found.append(f"('{case}', {n}L)")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(found)} AS t(gate, slim_rows)")


def backfill_pending(spark, sf_dir):
    """Rows and ledger entries per archive after the same back-fill was called twice."""
    lay = _isolated_layout(spark, "backfill_pending")
    cfg = JobConfig(as_of=FRESHNESS_AS_OF, env="prod", run_ts=RUN_TS, tables=("slim",), layout=lay)
    for _ in range(2):
        backfill(spark, indicators_with_archive(spark, sf_dir, CARD), cfg, CARD, keep={"slim": None})
    rows = spark.table(lay.qualified("prod", lay.slim.name)).groupBy("archive").agg(F.count(F.lit(1)).alias("slim_rows"))
    ledger = (spark.table(lay.qualified("ops", "run_ledger")).where("table_name = 'job'")
              .groupBy("archive").agg(F.count(F.lit(1)).alias("ledger_entries")))
    return rows.join(ledger, "archive", "full")


def _replaced_runs(spark, sf_dir, query, table):
    """Three runs with different rows: one archive, the next one, and that one again by force."""
    lay = _isolated_layout(spark, query)
    features = indicators(spark, sf_dir)
    for archive, part, force in ((20010707, "edad < 40", False), (20010714, "edad >= 40", False),
                                 (20010714, "edad IS NULL", True)):
        cfg = JobConfig(as_of=FRESHNESS_AS_OF, archive=archive, env="prod", run_ts=RUN_TS, token_key=TOKEN_KEY,
                        precedence=False, force=force, tables=(table,), layout=lay)
        run_archive(spark, features.where(part), cfg, CARD)
    return spark.table(lay.qualified("prod", getattr(lay, table).name + "_purge"))


def purge_current(spark, sf_dir):
    """Every replaced row of the current table once, under the archive of the run that replaced it."""
    return _replaced_runs(spark, sf_dir, "purge_current", "current").select(
        *KEYS, "edad", "score_pos", "flow_pos", "archv", "archive")


def purge_weekly(spark, sf_dir):
    """Rows of the weekly partition that the forced run replaced."""
    return _replaced_runs(spark, sf_dir, "purge_weekly", "weekly").select(
        *KEYS, "edad", "score_pos", "flow_pos", "archv", "archive")


def raw_table_roundtrip(spark, sf_dir):
    """The text table after two full refreshes: only the second landing's rows."""
    ensure_zones(spark, lay := _isolated_layout(spark, "raw_table_roundtrip"))
    scored = score_append(source_projection(indicators(spark, sf_dir), CARD), CARD)
    table = lay.qualified("ops", lay.raw)
    for archive, df in ((20010707, scored.where("edad < 40")), (20010714, scored)):
        path = lay.location(spark, "ops", lay.raw) + f"/data/archive={archive}"
        register_text_table(spark, table, land_text(df, path))
    return spark.table(table)


def publish_monthly_double(spark, sf_dir):
    """The monthly table under a layout that tokenizes it twice."""
    lay = _isolated_layout(spark, "publish_monthly_double")
    lay = replace(lay, monthly=replace(lay.monthly, token_passes=2))
    _run(spark, sf_dir, "publish_monthly_double", ("monthly",), lay)
    return spark.table(lay.qualified("prod", lay.monthly.name))


def raw_rejects(spark, sf_dir):
    """A damaged text folder published: its good rows (slim table), and the reject table's lines.

    The folder holds the scored rows in the plain dialect, and beside them a cut line for every application of age 20, 40, 60 or 80."""
    lay = _isolated_layout(spark, "raw_rejects")
    ensure_zones(spark, lay)
    features = indicators(spark, sf_dir)
    path = land_text(score_append(source_projection(features, CARD), CARD), lay.location(spark, "ops", lay.raw) + "/data/archive=20010804", "plain")
    cut = features.where("edad IN (20, 40, 60, 80)").select(F.lit("cut").alias("damaged"), "informconf_id", F.lit("not a number").alias("file"))
    cut.write.mode("append").options(**DIALECTS["plain"]).csv(path)
    cfg = JobConfig(as_of=FRESHNESS_AS_OF, archive=20010804, env="prod", run_ts=RUN_TS, token_key=TOKEN_KEY, tables=("slim",),
                    precedence=False, dialect="plain", max_bad_share=0.2, layout=lay)
    _published(run_archive(spark, None, cfg, CARD, landed=path))
    good = spark.table(lay.qualified("prod", lay.slim.name)).select(*KEYS, "score_pos", "flow_pos", "archive", F.lit(None).cast("string").alias("bad_line"))
    bad = spark.table(lay.qualified("ops", lay.rejects.name))
    return good.unionByName(bad.select("infocheck_id", "bad_line", "archive"), allowMissingColumns=True)


def freshness_partition(spark, sf_dir):
    """The gate over one archive of a stored feature table: the last archive of 1997."""
    store = _store(spark, _isolated_layout(spark, "freshness_partition"), indicators_with_archive(spark, sf_dir, CARD))
    last = store.read(spark).where("archive < 19980101").agg(F.max("archive").alias("a")).first()["a"]
    return stored_freshness(spark, store, dt.date(1998, 1, 2), 4, last)


def first_of_month_run(spark, sf_dir):
    """A first-of-month run: the probe reads the run's archive of the weekly feature table, scoring the base table."""
    lay = _isolated_layout(spark, "first_of_month_run")
    features = indicators(spark, sf_dir)
    weekly = _store(spark, lay, features.where("edad = 30").withColumn("fecha_obs", F.lit("2001-08-01")).withColumn("archive", F.lit(20010801))
                    .unionByName(features.where("edad = 31").withColumn("archive", F.lit(20010701))), "weekly_features")
    cfg = JobConfig(as_of=dt.date(2001, 8, 3), first=True, env="prod", run_ts=RUN_TS, tables=("slim",), layout=lay)
    _published(run_archive(spark, features, cfg, CARD, probe=weekly))
    return spark.table(lay.qualified("prod", lay.slim.name))


def run_metrics(spark, sf_dir):
    """Ledger entries of one run over all rows and of a back-fill of every archive."""
    lay = _run(spark, sf_dir, "run_metrics", ("current", "slim"))
    one = spark.table(lay.qualified("ops", "run_ledger")).withColumn("run", F.lit("archive"))
    many = spark.table(_backfill(spark, sf_dir, "run_metrics_all", ("slim", "monthly"), {"slim": None, "monthly": None})
                       .qualified("ops", "run_ledger")).withColumn("run", F.lit("backfill"))
    return one.unionByName(many).select("run", "archive", "table_name", "rows")


class _Broken(RuntimeError):
    pass


def published_version(spark, sf_dir):
    """Rows per archive that readers see after a forced back-fill broke off between two partitions of the table."""
    from scorewright.plans import retention as R
    lay = _backfill(spark, sf_dir, "published_version", ("slim",), {"slim": None})
    cfg = JobConfig(as_of=FRESHNESS_AS_OF, env="prod", run_ts="2001-08-05 06:00:00", token_key=TOKEN_KEY, tables=("slim",), layout=lay, force=True)
    table, plain = lay.qualified("prod", lay.slim.name), R.follow

    def breaks(spark, table, before, after, base):
        half = dict(sorted(after.items())[:len(after) // 2])
        plain(spark, table, before, {**before, **half}, base)
        raise _Broken(table)
    R.follow = breaks
    try:
        backfill(spark, indicators_with_archive(spark, sf_dir, CARD), cfg, CARD, keep={"slim": None})
    except _Broken:
        pass
    finally:
        R.follow = plain
    return (spark.table(view_name(table)).groupBy("archive", "time_stamp").agg(F.count(F.lit(1)).alias("n_rows")))


def orphan_runs_q(spark, sf_dir):
    """Rows of run folders that nothing refers to, after two runs and one that broke off before its switch: its own, and
    the staging rows that the second run replaced."""
    lay = _isolated_layout(spark, "orphan_runs")
    features = indicators(spark, sf_dir)
    cfg = JobConfig(as_of=FRESHNESS_AS_OF, archive=20010728, env="prod", run_ts=RUN_TS, token_key=TOKEN_KEY, precedence=False,
                    tables=("current", "slim"), layout=lay)
    _published(run_archive(spark, features, cfg, CARD))
    _published(run_archive(spark, features.where("edad < 40"), replace(cfg, archive=20010804), CARD))
    lost = spark.table(lay.qualified("staging", lay.staging)).select(*lay.slim.columns)
    lost.write.parquet(f"{lay.location(spark, 'prod', lay.slim.name)}/runs/{new_run()}/archive=20010811")
    found = [(r["table_name"], r["folder"]) for r in orphan_runs(spark, lay).collect()]
    parts = [spark.read.parquet(folder).select(F.lit(name).alias("table_name"), F.lit(1).alias("x")) for name, folder in found]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("table_name").agg(F.count("x").alias("orphan_rows"))


def second_session(spark, sf_dir):
    """What a session that had read the current and the weekly table before a publish reads after it."""
    lay = _isolated_layout(spark, "second_session")
    other = spark.newSession()
    features = indicators(spark, sf_dir)
    views = {t.name: view_name(lay.qualified("prod", t.name)) for t in (lay.current, lay.weekly)}
    seen = None
    for archive, part in ((20010728, "edad < 40"), (20010804, "edad >= 40")):
        cfg = JobConfig(as_of=FRESHNESS_AS_OF, archive=archive, env="prod", run_ts=RUN_TS, token_key=TOKEN_KEY, precedence=False,
                        tables=("current", "weekly"), layout=lay)
        _published(run_archive(spark, features.where(part), cfg, CARD))
        frames = [other.table(v).select(F.lit(t).alias("table_name"), "archv", "score_pos", "flow_pos") for t, v in views.items()]
        seen = frames[0].unionByName(frames[1]).groupBy("table_name", "archv", "flow_pos").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("score_pos").alias("points"))
        seen.collect()
    return seen


QUERIES = {
    "feature_scan": feature_scan,
    "knockout": knockout,
    "normalize": normalize,
    "consult_age": consult_age,
    "consult_age_auto": consult_age_auto,
    "impute": impute,
    "cap": cap,
    "flags": flags,
    "district_weight": district_weight,
    "logodds": logodds,
    "score": score_points,
    "score_keys": score_keys,
    "band": band,
    "band_summary": band_summary,
    "score_append": score_append_q,
    "score_join_compat": score_join_compat_q,
    "duplicate_keys": duplicate_keys_q,
    "csv_roundtrip": csv_roundtrip,
    "stage_snapshot": stage_snapshot,
    "publish_current": publish_current_q,
    "publish_slim": publish_slim_q,
    "publish_weekly": publish_weekly_q,
    "publish_monthly": publish_monthly_q,
    "tokenize": tokenize,
    "tokenize_twice": tokenize_twice,
    "archive_calendar": archive_calendar,
    "month_closing": month_closing_q,
    "freshness": freshness_q,
    "pending_archives": pending_archives,
    "backfill_slim": backfill_slim,
    "retention": retention_q,
    "rejects": rejects_q,
    "gated_run": gated_run,
    "backfill_pending": backfill_pending,
    "purge_current": purge_current,
    "purge_weekly": purge_weekly,
    "raw_table_roundtrip": raw_table_roundtrip,
    "publish_monthly_double": publish_monthly_double,
    "raw_rejects": raw_rejects,
    "freshness_partition": freshness_partition,
    "first_of_month_run": first_of_month_run,
    "run_metrics": run_metrics,
    "published_version": published_version,
    "orphan_runs": orphan_runs_q,
    "second_session": second_session,
}
