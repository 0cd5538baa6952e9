"""Session helpers: the settings the engine relies on, and the shared scratch root."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the scoring semantics depend on.  Dates are compared in UTC so a
# day is always 86 400 s (no daylight-saving hour), and ANSI mode stays on:
# every text-to-number or text-to-date conversion goes through try_* forms.
# The scorecard compiles to ~100 CASE expressions; fused into one whole-stage
# method they exceed HotSpot's 8000-byte JIT limit and would run interpreted.
# With hugeMethodLimit=8000 Spark keeps such stages out of whole-stage codegen
# and evaluates them with split (JIT-compiled) projection methods instead.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "scorewright",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.  On a cluster, use the deployment's session
    and call :func:`apply_engine_conf` on it instead."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


@contextmanager
def engine_settings(spark: SparkSession):
    """The engine's settings for the length of a job; the caller's come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in ENGINE_CONF}
    apply_engine_conf(spark)
    try:
        yield spark
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, landed files and checkpoints.

    Read ``spark.checkpoint.dir`` from the session (on a cluster it names a
    folder every executor can reach), else the checkpoint folder set on the
    SparkContext.  A session that names neither uses a folder beside the tables
    of ``spark.sql.warehouse.dir``, which the deployment owns; no machine-local
    temporary folder is ever made here.  Either way the SparkContext's
    checkpoint directory is made to point there, so ``DataFrame.checkpoint()``
    works.  (``spark.checkpoint.dir`` itself is a core setting that cannot be
    changed at runtime, so it is only read.)
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared root (never reused)."""
    return f"{shared_root(spark)}/scorewright/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the engine's own scratch area (``<shared root>/scorewright``) through its file system."""
    if not path.startswith(f"{shared_root(spark)}/scorewright/"):
        raise ValueError(f"not a scratch folder: {path}")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
