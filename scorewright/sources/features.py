"""Synthetic ``indicators`` feature view: one application row per order.

The driver tables carry no credit features, so each feature is a deterministic
integer recipe over the order key ``k`` and customer key ``ck``, plus three
per-order lineitem aggregates (number of lines, distinct suppliers, total
quantity).  Only integer arithmetic and exact binary fractions are used, so
every engine computes the same values.

Plan at scale: lineitem is aggregated per order (partial aggregate per task,
one shuffle on ``l_orderkey``); orders is hash-partitioned on the same key and
joins that result without another exchange; customer joins on ``o_custkey`` and
is broadcast only when AQE measures it under the broadcast threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.models.two_card import two_card
from scorewright.functions.columns import literal_array_sql
from scorewright.operators.lookup import lookup_rows
from scorewright.sources.tables import read_table
from scorewright.spec import Scorecard

# Fixed recipe parameters of the test view.
RARE_KNOCKOUT_STRIDES = (3, 7, 11, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59)
BAND_LETTERS = "ABCDEFGHIJKLMNX"

INT_COLUMNS = {"tipo_doc_id", "scorecard", "edad", "estado_civil", "ips_flag_actividad",
               "inf_cons_ult_dias_ccredito", "inf_cons_ult_dias_sf", "situacion_bancaria",
               "tc_primera_act"}
DOUBLE_COLUMNS = {"g_max_venc_ten_36", "tc_prom_pmin_limcr_m1"}
TEXT_COLUMNS = {"infocheck_id", "informconf_id", "pers_id", "distrito", "ich_fecha_ult_cons_priv",
                "max_flow", "tc_max_dias_atraso_u6m", "fecha_obs"}
TOTALS = ("inf_mor_cant_total", "inf_dem_cant_total")
TELCO_PARTS = {"inf_mor_cant_total_telco": "inf_mor_cant_total",
               "inf_dem_cant_total_telco": "inf_dem_cant_total"}


def column_type(name: str) -> str:
    if name in INT_COLUMNS:
        return "int"
    if name in DOUBLE_COLUMNS:
        return "double"
    if name in TEXT_COLUMNS:
        return "string"
    return "bigint"


def district_names(card: Scorecard) -> list[str]:
    """Names of scorecard 1 in code-point order (index = ck % count)."""
    lk = card.lookups[0]
    return sorted(name for sc, name, _ in lookup_rows(lk.table, lk.key) if sc == 1.0)


def cap_modulus(card: Scorecard, column: str) -> int:
    cap = next(c for c in card.caps if c.column == column)
    return int(math.floor(max(a.value for a in cap.arms))) + 4


def rare_knockout_columns(card: Scorecard) -> list[str]:
    return [c for c in card.knockout_inputs if c not in TOTALS and c not in TELCO_PARTS]


def feature_sql(card: Scorecard) -> dict[str, str]:
    """Spark SQL expression per view column over ``k``, ``ck``, ``nation``, ``od`` (order date),
    ``n_lines``, ``n_supp``, ``qty``."""
    cols: dict[str, str] = {
        "infocheck_id": "CASE WHEN k % 1009 = 0 THEN NULL ELSE concat('C', CAST(k AS STRING)) END",
        "informconf_id": "concat('I', CAST(ck AS STRING))",
        "pers_id": "CAST(ck AS STRING)",
        "tipo_doc_id": "nation % 3",
    }
    for i, (name, stride) in enumerate(zip(rare_knockout_columns(card), RARE_KNOCKOUT_STRIDES)):
        cols[name] = (f"CASE WHEN (k + {i}) % 13 = 0 THEN NULL "
                      f"WHEN (k * {stride} + {i}) % 101 = {5 * i} THEN 1 ELSE 0 END")
    total = ("CASE WHEN k % 19 = 0 THEN NULL WHEN k % 211 = 0 THEN 3 WHEN k % 89 = 0 THEN 2 "
             "WHEN k % 23 = 0 THEN 1 ELSE 0 END")
    for t in TOTALS:
        cols[t] = total
    for part in TELCO_PARTS:
        cols[part] = f"CASE WHEN k % 2 = 0 THEN {total} ELSE 0 END"
    cols["scorecard"] = "CASE WHEN k % 20 = 0 THEN NULL WHEN k % 41 = 0 THEN 2 ELSE k % 2 END"
    names = district_names(card)
    cols["distrito"] = (f"CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN 'NOWHERE' "
                        f"ELSE element_at({literal_array_sql(names)}, CAST(ck % {len(names)} AS INT) + 1) END")
    cols["edad"] = "CASE WHEN k % 17 = 0 THEN NULL ELSE 15 + k % 70 END"
    cols["estado_civil"] = "CASE WHEN k % 23 = 0 THEN NULL ELSE k % 10 - 1 END"
    cols["ich_fecha_ult_cons_priv"] = ("CASE WHEN k % 7 = 0 THEN '0' WHEN k % 37 = 0 THEN NULL ELSE "
                                       "date_format(date_sub(CAST(od AS DATE), CAST(k % 2000 AS INT)), "
                                       "'yyyy-MM-dd') END")
    cols["fecha_obs"] = "CASE WHEN k % 503 = 0 THEN NULL ELSE date_format(CAST(od AS DATE), 'yyyy-MM-dd') END"
    cols["max_flow"] = (f"CASE WHEN k % 11 = 0 THEN NULL ELSE "
                        f"element_at({literal_array_sql(BAND_LETTERS)}, CAST(k % 15 AS INT) + 1) END")
    cols["p_saldo_vencido_ult_act"] = "CAST(qty AS BIGINT) * 50000"
    cols["inf_cons_cant_u1m"] = "n_lines"
    cols["inf_cant_dist_afi_u6m"] = "n_supp"
    cols["tc_max_dias_atraso_u6m"] = ("CASE WHEN k % 5 = 0 THEN 'N/A' WHEN k % 499 = 0 THEN 'abc' "
                                      "ELSE CAST(k % 100 AS STRING) END")
    cols["g_max_venc_ten_36"] = "CAST(k % 5 AS DOUBLE) / 4.0D * 1.5D"
    cols["tc_prom_pmin_limcr_m1"] = "CAST(k % 9 AS DOUBLE) / 16.0D"
    cols["situacion_bancaria"] = "CASE WHEN k % 43 = 0 THEN NULL ELSE k % 4 END"
    order = card.source_columns()
    for j, name in enumerate(order, start=1):
        if name not in cols:
            m = cap_modulus(card, name)
            cols[name] = f"CASE WHEN (k + {j}) % 13 = 0 THEN NULL ELSE (k * {2 * j + 1}) % {m} - 1 END"
    return {name: f"CAST({cols[name]} AS {column_type(name).upper()})" for name in order}


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Hash-partition orders on the join key with the configured partition count: at scale the
    # per-order join is a sort-merge join that needs exactly this partitioning (the lineitem
    # aggregate already has it), and on small inputs it keeps the CPU-heavy scoring that follows
    # from running in a single task (an explicit count is not coalesced away by AQE).
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = (read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
              .repartition(n_parts, "o_orderkey"))
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    lineitem = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_quantity")
    # No repartition before this aggregate on purpose: the distinct count plans as a partial
    # aggregate by (l_orderkey, l_suppkey) before any shuffle, so even an order holding a third of
    # all lines reaches the exchanges pre-aggregated.
    per_order = (lineitem.groupBy("l_orderkey")
                 .agg(F.count(F.lit(1)).alias("n_lines"),
                      F.countDistinct("l_suppkey").alias("n_supp"),
                      F.sum("l_quantity").alias("qty")))
    return (orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
            .join(customer, orders.o_custkey == customer.c_custkey, "left"))


def _keyed(base: DataFrame) -> DataFrame:
    return base.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("ck"),
                       F.col("c_nationkey").alias("nation"), F.col("o_orderdate").alias("od"),
                       "n_lines", "n_supp", "qty")


def _view(base: DataFrame, card: Scorecard) -> DataFrame:
    return _keyed(base).selectExpr(*[f"{e} AS `{n}`" for n, e in feature_sql(card).items()])


def indicators(spark: SparkSession, sf_dir: str, card: Scorecard | None = None) -> DataFrame:
    """The 55-column feature view (keys, knock-out counts, model inputs), one row per order."""
    return _view(order_base(spark, sf_dir), card or two_card())


def indicators_dup(spark: SparkSession, sf_dir: str, card: Scorecard | None = None) -> DataFrame:
    """The view plus a second copy of the rows with k % 100 = 0 (duplicate-key cases)."""
    base = order_base(spark, sf_dir)
    return _view(base.unionByName(base.where(F.col("o_orderkey") % 100 == 0)), card or two_card())


def indicators_with_archive(spark: SparkSession, sf_dir: str, card: Scorecard | None = None) -> DataFrame:
    """The view plus ``archive`` = last Saturday on or before the order date, as YYYYMMDD int."""
    from scorewright.functions.calendar import archive_int, run_date
    keyed = _keyed(order_base(spark, sf_dir))
    archive = archive_int(run_date(F.col("od").cast("date")))
    return keyed.select("*", archive.alias("archive")).selectExpr(
        *[f"{e} AS `{n}`" for n, e in feature_sql(card or two_card()).items()], "archive")
