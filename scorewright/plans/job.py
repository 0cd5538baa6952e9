"""The weekly job (A1, CAL1-CAL5, E1, S3-S11, R1-R6) and back-fills, as one driver program.

``run_archive`` for one archive:

    already in ledger? -> freshness gate -> score (narrow, one stage)
    -> [land as text and read back, damaged lines put aside] -> staging (written once, read back)
    -> current (keep replaced rows, overwrite) -> slim -> weekly -> monthly if the
    archive closes its month, each with its retention as one version -> ledger

Rows, rejected values and damaged lines are counted by ``Observation`` while they are written.

Every step is a Spark action on tables in the shared folder; a rerun points one archive
partition at a new folder, so it is idempotent, and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scorewright.functions.calendar import archive_date, archive_int, month_closing, run_date
from scorewright.models.two_card import two_card
from scorewright.operators.score import score_append, source_projection
from scorewright.plans import ledger as L
from scorewright.plans.freshness import freshness, stored_freshness
from scorewright.plans.layout import RAW
from scorewright.plans.publish import (Layout, TableSpec, ensure_table, ensure_zones, publish_current, publish_partition, publish_partitions,
                                       staged, write_staging)
from scorewright.operators.normalize import reject_counts
from scorewright.session import engine_settings
from scorewright.sources.feature_store import FeatureStore
from scorewright.sources.raw_text import BAD_LINE, damaged_lines, land_text, read_text, register_text_table
from scorewright.spec import Scorecard

# Partitions kept per table (slim, weekly, monthly) in each profile.
RETENTION = {"dev": (2, 2, 3), "prod": (60, 12, 60)}


@dataclass(frozen=True)
class JobConfig:
    as_of: dt.date | None = None           # "today" of the run; None = today (UTC)
    env: str = "dev"
    archive: int | None = None             # default: latest run weekday on or before as_of
    first: bool = False                    # first-of-month run: archive YYYYMM01
    weekday: str = "Saturday"
    precedence: bool = True                # freshness gate on/off
    max_age_days: int = 4
    run_ts: str | None = None              # fixed load stamp for repeatable reruns
    token_key: str = ""                    # deployment secret for key tokens
    land_text: bool = False                # also land the scored rows as delimited text
    dialect: str = "quoted"                # of landed text: quoted or plain
    max_bad_share: float = 0.01            # share of damaged text lines above which the run stops
    force: bool = False                    # run even when the ledger has the archive
    tables: tuple[str, ...] = ("current", "slim", "weekly", "monthly")
    layout: Layout = field(default_factory=Layout)

    def __post_init__(self) -> None:
        if self.archive is not None and self.first:
            raise ValueError("archive and first exclude each other")
        if self.env not in RETENTION:
            raise ValueError(f"unknown env {self.env!r}: one of {sorted(RETENTION)}")
        if self.archive is not None:
            dt.datetime.strptime(str(self.archive), "%Y%m%d")

    def resolved_archive(self, spark: SparkSession, as_of: dt.date) -> int:
        if self.archive is not None:
            return int(self.archive)
        day = F.lit(as_of)
        expr = F.trunc(day, "MM") if self.first else run_date(day, self.weekday)
        return int(spark.range(1).select(archive_int(expr).alias("a")).first()["a"])

    def profile_layout(self) -> Layout:
        slim_n, weekly_n, monthly_n = RETENTION[self.env]
        lay = self.layout
        return replace(lay, slim=replace(lay.slim, keep=slim_n), weekly=replace(lay.weekly, keep=weekly_n),
                       monthly=replace(lay.monthly, keep=monthly_n))


def _check_secret(cfg: JobConfig) -> None:
    """Tokens of public ids under an empty key are reversible by dictionary: prod needs a secret."""
    if cfg.env == "prod" and not cfg.token_key and {"weekly", "monthly"} & set(cfg.tables):
        raise ValueError("env='prod' publishes tokenized keys: set JobConfig.token_key to the deployment secret")


def closes_month(spark: SparkSession, archive: int) -> bool:
    d = F.to_date(F.lit(str(archive)), "yyyyMMdd")
    return bool(spark.range(1).select(month_closing(d).alias("c")).first()["c"])


def _ledger_table(spark: SparkSession, layout: Layout) -> str:
    ensure_zones(spark, layout)
    name = layout.qualified("ops", "run_ledger")
    return L.ensure_ledger(spark, name, layout.location(spark, "ops", "run_ledger"))


def score_for_publish(features: DataFrame, card: Scorecard) -> DataFrame:
    """Entry B: raw feature columns with score_pos and flow_pos appended (no self-join)."""
    return score_append(source_projection(features, card), card)


def run_archive(spark: SparkSession, features: DataFrame | FeatureStore | None, cfg: JobConfig, card: Scorecard | None = None,
                probe: DataFrame | FeatureStore | None = None, landed: str | None = None) -> dict:
    """``probe``: what the freshness gate reads (default: ``features``; a :class:`FeatureStore` answers from file footers).
    For a first-of-month run it is filtered to the run's archive partition (partition pruning); scoring reads ``features``
    all the same.  ``landed``: folder of scored text that another job left, published instead of ``features``."""
    _check_secret(cfg)
    if (features is None) == (landed is None):
        raise ValueError("either features or a landed folder is published")
    with engine_settings(spark):
        return _run_archive(spark, features, cfg, card or two_card(), probe, landed)


def _gate(spark: SparkSession, source: DataFrame | FeatureStore, as_of: dt.date, cfg: JobConfig, archive: int | None) -> str | None:
    """Why the run stops; None when the features are fresh."""
    if isinstance(source, FeatureStore):
        gate = stored_freshness(spark, source, as_of, cfg.max_age_days, archive).first()
    else:
        gate = freshness(source, as_of, cfg.max_age_days, archive=archive).first()
    if gate["last_obs"] is None:
        return "stopped: no observations"
    return None if gate["fresh"] else f"stopped: features {gate['age_days']} days old"


def _staging_metrics(card: Scorecard, seen: Observation, df: DataFrame) -> DataFrame:
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[n.alias(c) for c, n in reject_counts(card).items()])


def _put_aside(spark: SparkSession, layout: Layout, path: str, cfg: JobConfig, archive: int) -> None:
    """The damaged lines of a landed folder, with their file, as partition ``archive`` of the reject table."""
    bad = damaged_lines(spark, path, dialect=cfg.dialect).withColumn("time_stamp", F.lit(_run_ts(cfg)))
    publish_partition(spark, layout, layout.rejects, bad, archive, "")


def _run_archive(spark: SparkSession, features: DataFrame | FeatureStore | None, cfg: JobConfig, card: Scorecard,
                 probe: DataFrame | FeatureStore | None, landed: str | None) -> dict:
    layout = cfg.profile_layout()
    as_of = cfg.as_of or dt.datetime.now(dt.timezone.utc).date()
    archive = cfg.resolved_archive(spark, as_of)
    ledger = _ledger_table(spark, layout)
    if not cfg.force and L.is_done(spark, ledger, archive):
        return {"archive": archive, "status": "skipped: already run"}
    if cfg.precedence:
        source = probe if probe is not None else features if features is not None else read_text(spark, landed, dialect=cfg.dialect)
        stopped = _gate(spark, source, as_of, cfg, archive if probe is not None and cfg.first else None)
        if stopped:
            return {"archive": archive, "status": stopped}

    if isinstance(features, FeatureStore):
        features = features.read(spark)
    scored = score_for_publish(features, card) if landed is None else None
    ensure_zones(spark, layout)
    if cfg.land_text and landed is None:
        landed = layout.location(spark, "ops", layout.raw) + f"/data/archive={archive}"
        land_text(scored, landed, cfg.dialect)
    lines = Observation()
    if landed is not None:
        # (re)create the external text table over the landed folder and read that back, damaged lines apart
        register_text_table(spark, layout.qualified("ops", layout.raw), landed, dialect=cfg.dialect)
        read = read_text(spark, landed, dialect=cfg.dialect).observe(
            lines, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(BAD_LINE).isNotNull()).alias("bad"))
        scored = read.where(F.col(BAD_LINE).isNull())
    seen = Observation()
    staging = write_staging(spark, layout, _staging_metrics(card, seen, staged(scored.select(*RAW), archive, _run_ts(cfg))))
    rejected = dict(seen.get)
    counts = {"staging": rejected.pop("rows")}
    if landed is not None:
        counts["bad lines"] = lines.get["bad"]
        if counts["bad lines"]:
            _put_aside(spark, layout, landed, cfg, archive)
            if counts["bad lines"] > cfg.max_bad_share * lines.get["lines"]:
                return {"archive": archive, "status": f"stopped: {counts['bad lines']} of {lines.get['lines']} text lines damaged"}
    if "current" in cfg.tables:
        publish_current(spark, layout, staging, archive, seen := Observation())
        counts[layout.current.name] = seen.get["rows"]
    kinds: list[TableSpec] = []
    if "slim" in cfg.tables:
        kinds.append(layout.slim)
    if "weekly" in cfg.tables:
        kinds.append(layout.weekly)
    if "monthly" in cfg.tables:
        ensure_table(spark, layout, layout.monthly, staging.schema)      # there to be read even before a closing archive
        if closes_month(spark, archive):
            kinds.append(layout.monthly)
    dropped = {}
    for spec in kinds:
        dropped[spec.name] = publish_partition(spark, layout, spec, staging, archive, cfg.token_key, seen := Observation())
        counts[spec.name] = seen.get["rows"]
    L.record(spark, ledger, {archive: _entries(rejected, counts)})
    return {"archive": archive, "status": "published", "rows": counts, "dropped": dropped, "rejected": rejected}


def _entries(rejected: dict[str, int], counts: dict[str, int]) -> dict[str, int]:
    """Ledger entries of one archive; ``job`` comes last and marks it done."""
    return {**{f"rejected {c}": n for c, n in rejected.items()}, **counts, "job": counts["staging"]}


def _run_ts(cfg: JobConfig) -> str:
    return cfg.run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def backfill(spark: SparkSession, features_with_archive: DataFrame, cfg: JobConfig,
             card: Scorecard | None = None, keep: dict[str, int | None] | None = None) -> dict:
    """Publish many archives at once: each row carries its own ``archive``.  One scoring pass,
    one staging write, one pass over four staging columns for the counts of every archive, one partitioned write per
    table with its retention.

    Archives the ledger holds are left out unless ``cfg.force``.  Rows without an archive reach
    staging and are counted in the result (``undated_rows``); no table takes them.
    """
    _check_secret(cfg)
    with engine_settings(spark):
        return _backfill(spark, features_with_archive, cfg, card or two_card(), keep or {})


def _backfill(spark: SparkSession, features_with_archive: DataFrame, cfg: JobConfig, card: Scorecard,
              keep: dict[str, int | None]) -> dict:
    layout = cfg.profile_layout()
    ledger = _ledger_table(spark, layout)
    features = features_with_archive.select(*card.source_columns(), "archive")
    if not cfg.force:
        features = features.join(L.done(spark.table(ledger)), "archive", "left_anti")
    scored = score_append(features, card)
    staging_df = staged(scored, F.col("archive"), _run_ts(cfg)).withColumn("archive", F.col("archv"))
    staging = write_staging(spark, layout, staging_df)
    # one row an archive (metadata-sized: one a week): rows, rejects, and whether it closes its month
    seen = staging.groupBy("archive").agg(F.count(F.lit(1)).alias("rows"), *[n.alias(c) for c, n in reject_counts(card).items()])
    found = seen.withColumn("closes", month_closing(archive_date(F.col("archive")))).collect()
    dated = {r["archive"]: r for r in found if r["archive"] is not None}
    out: dict = {"undated_rows": sum(r["rows"] for r in found if r["archive"] is None)}
    published: dict[int, dict[str, int]] = {a: {"staging": r["rows"]} for a, r in dated.items()}
    for name in ("slim", "weekly", "monthly"):
        if name not in cfg.tables:
            continue
        spec: TableSpec = getattr(layout, name)
        if name in keep:
            spec = replace(spec, keep=keep[name])
        archives = [a for a, r in dated.items() if name != "monthly" or r["closes"]]
        src = staging if name != "monthly" else staging.where(month_closing(archive_date(F.col("archive"))))
        dropped = publish_partitions(spark, layout, spec, src, archives, cfg.token_key)
        out[name] = {"table": layout.qualified("prod", spec.name), "dropped": dropped}
        for a in archives:
            published[a][spec.name] = dated[a]["rows"]
    L.record(spark, ledger, {a: _entries({c: dated[a][c] for c in reject_counts(card)}, counts) for a, counts in published.items()})
    out["rows"] = published
    return out
