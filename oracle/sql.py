"""DuckDB oracle SQL, written by hand from the published model (not generated from the engine's spec).

Every string is standalone ANSI-ish SQL over the driver views (orders, customer,
lineitem, ...).  The shared pieces are CTE fragments concatenated in Python:

    VIEW      -> ``indicators`` (one application row per order, FIXTURES recipe)
    SCORING   -> ko, num, norm, age, sel, imp, cap, der, dw (district VALUES), lin, sc, bnd

Doubles are compared through ``round(x, 9)``; constants are typed ``::DOUBLE``
(a bare decimal literal is DECIMAL in DuckDB).
"""

from __future__ import annotations

import csv
from pathlib import Path

DATA = Path(__file__).resolve().parent.parent / "scorewright" / "data" / "district_weight.csv"

KEYS = "infocheck_id, informconf_id, pers_id, tipo_doc_id"
FIXED_RUN_TS = "2001-08-04 06:00:00"
TOKEN_KEY = "scorewright-test-key"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _district_rows() -> list[tuple[int, str, str]]:
    lines = [ln for ln in DATA.read_text(encoding="utf-8").splitlines() if not ln.startswith("#")]
    return [(int(r["scorecard"]), r["distrito"], r["weight"]) for r in csv.DictReader(lines)]


def _district_list_sql() -> str:
    names = sorted(n for sc, n, _ in _district_rows() if sc == 1)
    return "[" + ", ".join(_q(n) for n in names) + "]", len(names)


def _district_values_sql() -> str:
    rows = ", ".join(f"({sc}::DOUBLE, {_q(n)}, {w}::DOUBLE)" for sc, n, w in _district_rows())
    return f"dw(dw_sc, dw_name, dw_w) AS (VALUES {rows})"


# --------------------------------------------------------------------------- view

RARE = [("inf_conv_cant_abiertas", 3), ("inf_dem_cant_total_cable", 7), ("inf_dem_cant_total_ccredito", 11),
        ("inf_dem_cant_total_comercio", 17), ("inf_dem_cant_total_sf", 19), ("inf_dem_cant_total_spub", 23),
        ("inf_inc_cant_abiertas", 29), ("inf_inhib_cant_abiertas", 31), ("inf_mor_cant_total_cable", 37),
        ("inf_mor_cant_total_ccredito", 41), ("inf_mor_cant_total_sf", 43), ("inf_mor_cant_total_spub", 47),
        ("inf_qui_cant_abiertas", 53), ("inf_rem_cant_abiertas", 59)]

# (position among the 55 source columns, name, modulus, type) of the generic features
GENERIC = [(24, "ich_ch_re_cant_i_fond", 5, "BIGINT"), (25, "ich_cons_cant_total", 59, "BIGINT"),
           (26, "ich_cons_cant_banco_admin", 7, "BIGINT"), (31, "ips_flag_actividad", 5, "INTEGER"),
           (35, "inf_cant_dist_afi_ccred_u3m", 9, "BIGINT"), (36, "inf_cant_dist_afi_telco_u12m", 6, "BIGINT"),
           (37, "inf_cons_cant_telco_u1m", 5, "BIGINT"), (38, "inf_cons_cant_total_telco", 11, "BIGINT"),
           (40, "inf_cons_ult_dias_ccredito", 1040, "INTEGER"), (41, "inf_cons_ult_dias_sf", 991, "INTEGER"),
           (42, "inf_morce_cant_31_45_abiertas", 6, "BIGINT"), (43, "inf_morce_cant_46_60_abiertas", 5, "BIGINT"),
           (44, "inf_morce_cant_61_90_abiertas", 5, "BIGINT"), (45, "inf_morce_cant_abiertas", 5, "BIGINT"),
           (46, "p_cant_atraso", 9, "BIGINT"), (48, "p_sdot_monto_gt75_m1", 6, "BIGINT"),
           (50, "tc_close_total", 11, "BIGINT"), (52, "tc_primera_act", 67, "INTEGER"),
           (54, "tc_svenc_sdot_gt0_u12m", 6, "BIGINT")]


ARCHIVE_OF_OD = ("CAST(strftime(CAST(od AS DATE) - CAST((dayofweek(od) + 1) % 7 AS INTEGER), '%Y%m%d') "
                 "AS INTEGER)")


def _view_sql(dup: bool = False, with_archive: bool = False) -> str:
    names, n_names = _district_list_sql()
    total = "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 211 = 0 THEN 3 WHEN k % 89 = 0 THEN 2 WHEN k % 23 = 0 THEN 1 ELSE 0 END"
    cols = {
        "infocheck_id": "CASE WHEN k % 1009 = 0 THEN NULL ELSE 'C' || CAST(k AS VARCHAR) END",
        "informconf_id": "'I' || CAST(ck AS VARCHAR)",
        "pers_id": "CAST(ck AS VARCHAR)",
        "tipo_doc_id": "CAST(nation % 3 AS INTEGER)",
    }
    for i, (name, s) in enumerate(RARE):
        cols[name] = (f"CAST(CASE WHEN (k + {i}) % 13 = 0 THEN NULL WHEN (k * {s} + {i}) % 101 = {5 * i} "
                      f"THEN 1 ELSE 0 END AS BIGINT)")
    cols["inf_mor_cant_total"] = f"CAST({total} AS BIGINT)"
    cols["inf_dem_cant_total"] = f"CAST({total} AS BIGINT)"
    cols["inf_mor_cant_total_telco"] = f"CAST(CASE WHEN k % 2 = 0 THEN {total} ELSE 0 END AS BIGINT)"
    cols["inf_dem_cant_total_telco"] = f"CAST(CASE WHEN k % 2 = 0 THEN {total} ELSE 0 END AS BIGINT)"
    cols["scorecard"] = "CAST(CASE WHEN k % 20 = 0 THEN NULL WHEN k % 41 = 0 THEN 2 ELSE k % 2 END AS INTEGER)"
    cols["distrito"] = (f"CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN 'NOWHERE' "
                        f"ELSE ({names})[CAST(ck % {n_names} AS INTEGER) + 1] END")
    cols["edad"] = "CAST(CASE WHEN k % 17 = 0 THEN NULL ELSE 15 + k % 70 END AS INTEGER)"
    cols["estado_civil"] = "CAST(CASE WHEN k % 23 = 0 THEN NULL ELSE k % 10 - 1 END AS INTEGER)"
    cols["ich_fecha_ult_cons_priv"] = ("CASE WHEN k % 7 = 0 THEN '0' WHEN k % 37 = 0 THEN NULL "
                                       "ELSE strftime(CAST(od AS DATE) - CAST(k % 2000 AS INTEGER), '%Y-%m-%d') END")
    cols["fecha_obs"] = "CASE WHEN k % 503 = 0 THEN NULL ELSE strftime(CAST(od AS DATE), '%Y-%m-%d') END"
    cols["max_flow"] = "CASE WHEN k % 11 = 0 THEN NULL ELSE ('ABCDEFGHIJKLMNX')[CAST(k % 15 AS INTEGER) + 1] END"
    cols["p_saldo_vencido_ult_act"] = "CAST(qty AS BIGINT) * 50000"
    cols["inf_cons_cant_u1m"] = "CAST(n_lines AS BIGINT)"
    cols["inf_cant_dist_afi_u6m"] = "CAST(n_supp AS BIGINT)"
    cols["tc_max_dias_atraso_u6m"] = ("CASE WHEN k % 5 = 0 THEN 'N/A' WHEN k % 499 = 0 THEN 'abc' "
                                      "ELSE CAST(k % 100 AS VARCHAR) END")
    cols["g_max_venc_ten_36"] = "CAST(k % 5 AS DOUBLE) / 4.0::DOUBLE * 1.5::DOUBLE"
    cols["tc_prom_pmin_limcr_m1"] = "CAST(k % 9 AS DOUBLE) / 16.0::DOUBLE"
    cols["situacion_bancaria"] = "CAST(CASE WHEN k % 43 = 0 THEN NULL ELSE k % 4 END AS INTEGER)"
    for j, name, m, typ in GENERIC:
        cols[name] = f"CAST(CASE WHEN (k + {j}) % 13 = 0 THEN NULL ELSE (k * {2 * j + 1}) % {m} - 1 END AS {typ})"
    if with_archive:
        cols["archive"] = ARCHIVE_OF_OD
    select = ",\n    ".join(f"{e} AS {n}" for n, e in cols.items())
    orders = "orders" if not dup else "(SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 100 = 0)"
    return f"""per_order AS (
  SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_supp, sum(l_quantity) AS qty
  FROM lineitem GROUP BY l_orderkey
), base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, c.c_nationkey AS nation, o.o_orderdate AS od,
         p.n_lines, p.n_supp, p.qty
  FROM {orders} o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
), indicators AS (
  SELECT
    {select}
  FROM base
)"""


VIEW_COLUMNS = ("infocheck_id, informconf_id, pers_id, tipo_doc_id, inf_conv_cant_abiertas, inf_dem_cant_total, "
                "inf_dem_cant_total_cable, inf_dem_cant_total_ccredito, inf_dem_cant_total_comercio, "
                "inf_dem_cant_total_sf, inf_dem_cant_total_spub, inf_dem_cant_total_telco, inf_inc_cant_abiertas, "
                "inf_inhib_cant_abiertas, inf_mor_cant_total, inf_mor_cant_total_cable, inf_mor_cant_total_ccredito, "
                "inf_mor_cant_total_sf, inf_mor_cant_total_spub, inf_mor_cant_total_telco, inf_qui_cant_abiertas, "
                "inf_rem_cant_abiertas, scorecard, ich_ch_re_cant_i_fond, ich_cons_cant_total, "
                "ich_cons_cant_banco_admin, distrito, edad, estado_civil, ich_fecha_ult_cons_priv, "
                "ips_flag_actividad, max_flow, g_max_venc_ten_36, inf_cant_dist_afi_u6m, "
                "inf_cant_dist_afi_ccred_u3m, inf_cant_dist_afi_telco_u12m, inf_cons_cant_telco_u1m, "
                "inf_cons_cant_total_telco, inf_cons_cant_u1m, inf_cons_ult_dias_ccredito, inf_cons_ult_dias_sf, "
                "inf_morce_cant_31_45_abiertas, inf_morce_cant_46_60_abiertas, inf_morce_cant_61_90_abiertas, "
                "inf_morce_cant_abiertas, p_cant_atraso, p_saldo_vencido_ult_act, p_sdot_monto_gt75_m1, "
                "situacion_bancaria, tc_close_total, tc_max_dias_atraso_u6m, tc_primera_act, tc_prom_pmin_limcr_m1, "
                "tc_svenc_sdot_gt0_u12m, fecha_obs")

NUMERIC = [c.strip() for c in VIEW_COLUMNS.split(",")
           if c.strip() not in ("infocheck_id", "informconf_id", "pers_id", "tipo_doc_id", "distrito",
                                "ich_fecha_ult_cons_priv", "max_flow", "tc_max_dias_atraso_u6m", "fecha_obs")]

# --------------------------------------------------------------------------- scoring

KNOCKOUT_SQL = """CASE WHEN
      coalesce(nullif(inf_mor_cant_total_sf::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_mor_cant_total_ccredito::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_dem_cant_total::DOUBLE, 'NaN'::DOUBLE), 0) >= 3
   OR coalesce(nullif(inf_dem_cant_total_sf::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_dem_cant_total_comercio::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_dem_cant_total_ccredito::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_inhib_cant_abiertas::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_inc_cant_abiertas::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_rem_cant_abiertas::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_conv_cant_abiertas::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_qui_cant_abiertas::DOUBLE, 'NaN'::DOUBLE), 0) >= 1
   OR coalesce(nullif(inf_mor_cant_total::DOUBLE, 'NaN'::DOUBLE), 0) >= 3
   OR coalesce(nullif(inf_mor_cant_total::DOUBLE, 'NaN'::DOUBLE), 0) - coalesce(nullif(inf_mor_cant_total_telco::DOUBLE, 'NaN'::DOUBLE), 0)
      - coalesce(nullif(inf_mor_cant_total_cable::DOUBLE, 'NaN'::DOUBLE), 0) - coalesce(nullif(inf_mor_cant_total_spub::DOUBLE, 'NaN'::DOUBLE), 0) >= 2
   OR coalesce(nullif(inf_dem_cant_total::DOUBLE, 'NaN'::DOUBLE), 0) - coalesce(nullif(inf_dem_cant_total_telco::DOUBLE, 'NaN'::DOUBLE), 0)
      - coalesce(nullif(inf_dem_cant_total_cable::DOUBLE, 'NaN'::DOUBLE), 0) - coalesce(nullif(inf_dem_cant_total_spub::DOUBLE, 'NaN'::DOUBLE), 0) >= 2
   OR coalesce(nullif(inf_mor_cant_total::DOUBLE, 'NaN'::DOUBLE), 0) + coalesce(nullif(inf_dem_cant_total::DOUBLE, 'NaN'::DOUBLE), 0)
      - coalesce(nullif(inf_mor_cant_total_telco::DOUBLE, 'NaN'::DOUBLE), 0) - coalesce(nullif(inf_mor_cant_total_cable::DOUBLE, 'NaN'::DOUBLE), 0)
      - coalesce(nullif(inf_mor_cant_total_spub::DOUBLE, 'NaN'::DOUBLE), 0) - coalesce(nullif(inf_dem_cant_total_telco::DOUBLE, 'NaN'::DOUBLE), 0)
      - coalesce(nullif(inf_dem_cant_total_cable::DOUBLE, 'NaN'::DOUBLE), 0) - coalesce(nullif(inf_dem_cant_total_spub::DOUBLE, 'NaN'::DOUBLE), 0) >= 2
   OR coalesce(nullif(inf_mor_cant_total::DOUBLE, 'NaN'::DOUBLE), 0) + coalesce(nullif(inf_dem_cant_total::DOUBLE, 'NaN'::DOUBLE), 0) >= 3
  THEN 1 ELSE 0 END"""


def _age_expr(auto: bool) -> str:
    diff = ("CAST(date_diff('second', try_strptime(ich_fecha_ult_cons_priv, '%Y-%m-%d'), "
            "try_strptime(fecha_obs, '%Y-%m-%d')) AS DOUBLE)")
    if auto:
        diff = f"{diff} / (SELECT unit FROM age_unit)"
    return f"CASE WHEN ich_fecha_ult_cons_priv IS NULL THEN 115974872::DOUBLE ELSE {diff} END"


AGE_UNIT_CTE = """age_unit AS (
  SELECT CASE WHEN m IS NULL OR m < 60 THEN 1.0::DOUBLE WHEN m < 3600 THEN 60.0::DOUBLE
              WHEN m < 86400 THEN 3600.0::DOUBLE ELSE 86400.0::DOUBLE END AS unit
  FROM (SELECT min(abs(CAST(date_diff('second', try_strptime(ich_fecha_ult_cons_priv, '%Y-%m-%d'),
                                 try_strptime(fecha_obs, '%Y-%m-%d')) AS DOUBLE))) AS m FROM norm)
)"""


def _cap(col: str, lo, hi1, hi0=None) -> str:
    if hi0 is None:
        return f"CASE WHEN {col} < {lo} THEN {lo} WHEN {col} > {hi1} THEN {hi1} ELSE {col} END AS {col}"
    return (f"CASE WHEN {col} < {lo} THEN {lo} WHEN scorecard = 1 AND {col} > {hi1} THEN {hi1} "
            f"WHEN scorecard = 0 AND {col} > {hi0} THEN {hi0} ELSE {col} END AS {col}")


CAP_LIST = [
    _cap("ich_ch_re_cant_i_fond", 0, 1), _cap("ich_cons_cant_total", 0, 55),
    _cap("ich_cons_cant_banco_admin", 0, 1, 3),
    "CASE WHEN edad < 18 THEN 18 WHEN scorecard = 1 AND edad > 72 THEN 72 "
    "WHEN scorecard = 0 AND edad > 78 THEN 78 ELSE edad END AS edad",
    "CASE WHEN estado_civil < 0 THEN 0 WHEN estado_civil < 7 THEN 7 ELSE estado_civil END AS estado_civil",
    _cap("ips_flag_actividad", 0, 1), _cap("g_max_venc_ten_36", 0, 1), _cap("inf_cant_dist_afi_ccred_u3m", 0, 5),
    _cap("inf_cant_dist_afi_telco_u12m", 0, 2), _cap("inf_cant_dist_afi_u6m", 0, 21, 14),
    _cap("inf_cons_cant_telco_u1m", 0, 1), _cap("inf_cons_cant_total_telco", 0, 7), _cap("inf_cons_cant_u1m", 0, 6),
    _cap("inf_cons_ult_dias_ccredito", 0, 975, 1036), _cap("inf_cons_ult_dias_sf", 0, 736, 987),
    _cap("inf_conv_cant_abiertas", 0, 1), _cap("inf_dem_cant_total", 0, 1), _cap("inf_inc_cant_abiertas", 0, 1),
    _cap("inf_inhib_cant_abiertas", 0, 1), _cap("inf_morce_cant_31_45_abiertas", 0, 2),
    _cap("inf_morce_cant_46_60_abiertas", 0, 1), _cap("inf_morce_cant_61_90_abiertas", 0, 1),
    _cap("inf_morce_cant_abiertas", 0, 1), _cap("inf_qui_cant_abiertas", 0, 1), _cap("inf_rem_cant_abiertas", 0, 1),
    _cap("p_cant_atraso", 0, 5), _cap("p_saldo_vencido_ult_act", 0, 6372816), _cap("p_sdot_monto_gt75_m1", 0, 2),
    _cap("situacion_bancaria", 1, 2), _cap("tc_close_total", 0, 7), _cap("tc_max_dias_atraso_u6m", 0, 85),
    _cap("tc_primera_act", 0, 63), _cap("tc_prom_pmin_limcr_m1", 0, "0.3715::DOUBLE"),
    _cap("tc_svenc_sdot_gt0_u12m", 0, 2),
]
CAPPED = [c.rsplit(" AS ", 1)[1] for c in CAP_LIST]

IMPUTE_LIST = [
    "coalesce(CASE WHEN isnan(ich_ch_re_cant_i_fond) THEN NULL ELSE ich_ch_re_cant_i_fond END, 0) AS ich_ch_re_cant_i_fond",
    "coalesce(CASE WHEN isnan(ich_cons_cant_total) THEN NULL ELSE ich_cons_cant_total END, 11) AS ich_cons_cant_total",
    "CASE WHEN scorecard = 1 THEN coalesce(CASE WHEN isnan(ich_cons_cant_banco_admin) THEN NULL ELSE ich_cons_cant_banco_admin END, 0) "
    "ELSE coalesce(CASE WHEN isnan(ich_cons_cant_banco_admin) THEN NULL ELSE ich_cons_cant_banco_admin END, 2) END AS ich_cons_cant_banco_admin",
    "CASE WHEN scorecard = 1 THEN coalesce(distrito, 'HERNANDARIAS') "
    "ELSE coalesce(distrito, 'MBOCAYATY DEL GUAIRA') END AS distrito",
    "coalesce(CASE WHEN isnan(edad) THEN NULL ELSE edad END, 37) AS edad", "coalesce(CASE WHEN isnan(estado_civil) THEN NULL ELSE estado_civil END, 7) AS estado_civil",
    "coalesce(CASE WHEN isnan(ips_flag_actividad) THEN NULL ELSE ips_flag_actividad END, 0) AS ips_flag_actividad", "coalesce(CASE WHEN isnan(g_max_venc_ten_36) THEN NULL ELSE g_max_venc_ten_36 END, 0) AS g_max_venc_ten_36",
    "coalesce(CASE WHEN isnan(inf_cant_dist_afi_ccred_u3m) THEN NULL ELSE inf_cant_dist_afi_ccred_u3m END, 5) AS inf_cant_dist_afi_ccred_u3m",
    "coalesce(CASE WHEN isnan(inf_cant_dist_afi_telco_u12m) THEN NULL ELSE inf_cant_dist_afi_telco_u12m END, 0) AS inf_cant_dist_afi_telco_u12m",
    "coalesce(CASE WHEN isnan(inf_cant_dist_afi_u6m) THEN NULL ELSE inf_cant_dist_afi_u6m END, 0) AS inf_cant_dist_afi_u6m",
    "coalesce(CASE WHEN isnan(inf_cons_cant_telco_u1m) THEN NULL ELSE inf_cons_cant_telco_u1m END, 0) AS inf_cons_cant_telco_u1m",
    "coalesce(CASE WHEN isnan(inf_cons_cant_total_telco) THEN NULL ELSE inf_cons_cant_total_telco END, 0) AS inf_cons_cant_total_telco",
    "coalesce(CASE WHEN isnan(inf_cons_cant_u1m) THEN NULL ELSE inf_cons_cant_u1m END, 0) AS inf_cons_cant_u1m",
    "CASE WHEN scorecard = 1 THEN coalesce(CASE WHEN isnan(inf_cons_ult_dias_ccredito) THEN NULL ELSE inf_cons_ult_dias_ccredito END, 833) "
    "ELSE coalesce(CASE WHEN isnan(inf_cons_ult_dias_ccredito) THEN NULL ELSE inf_cons_ult_dias_ccredito END, 848) END AS inf_cons_ult_dias_ccredito",
    "CASE WHEN scorecard = 1 THEN coalesce(CASE WHEN isnan(inf_cons_ult_dias_sf) THEN NULL ELSE inf_cons_ult_dias_sf END, 21) "
    "ELSE coalesce(CASE WHEN isnan(inf_cons_ult_dias_sf) THEN NULL ELSE inf_cons_ult_dias_sf END, 162) END AS inf_cons_ult_dias_sf",
    "coalesce(CASE WHEN isnan(inf_conv_cant_abiertas) THEN NULL ELSE inf_conv_cant_abiertas END, 0) AS inf_conv_cant_abiertas",
    "coalesce(CASE WHEN isnan(inf_dem_cant_total) THEN NULL ELSE inf_dem_cant_total END, 0) AS inf_dem_cant_total",
    "coalesce(CASE WHEN isnan(inf_inc_cant_abiertas) THEN NULL ELSE inf_inc_cant_abiertas END, 0) AS inf_inc_cant_abiertas",
    "coalesce(CASE WHEN isnan(inf_inhib_cant_abiertas) THEN NULL ELSE inf_inhib_cant_abiertas END, 0) AS inf_inhib_cant_abiertas",
    "coalesce(CASE WHEN isnan(inf_morce_cant_31_45_abiertas) THEN NULL ELSE inf_morce_cant_31_45_abiertas END, 0) AS inf_morce_cant_31_45_abiertas",
    "coalesce(CASE WHEN isnan(inf_morce_cant_46_60_abiertas) THEN NULL ELSE inf_morce_cant_46_60_abiertas END, 0) AS inf_morce_cant_46_60_abiertas",
    "coalesce(CASE WHEN isnan(inf_morce_cant_61_90_abiertas) THEN NULL ELSE inf_morce_cant_61_90_abiertas END, 0) AS inf_morce_cant_61_90_abiertas",
    "coalesce(CASE WHEN isnan(inf_morce_cant_abiertas) THEN NULL ELSE inf_morce_cant_abiertas END, 0) AS inf_morce_cant_abiertas",
    "coalesce(CASE WHEN isnan(inf_qui_cant_abiertas) THEN NULL ELSE inf_qui_cant_abiertas END, 0) AS inf_qui_cant_abiertas",
    "coalesce(CASE WHEN isnan(inf_rem_cant_abiertas) THEN NULL ELSE inf_rem_cant_abiertas END, 0) AS inf_rem_cant_abiertas",
    "coalesce(CASE WHEN isnan(p_cant_atraso) THEN NULL ELSE p_cant_atraso END, 0) AS p_cant_atraso",
    "coalesce(CASE WHEN isnan(p_saldo_vencido_ult_act) THEN NULL ELSE p_saldo_vencido_ult_act END, 0) AS p_saldo_vencido_ult_act",
    "coalesce(CASE WHEN isnan(p_sdot_monto_gt75_m1) THEN NULL ELSE p_sdot_monto_gt75_m1 END, 0) AS p_sdot_monto_gt75_m1",
    "coalesce(CASE WHEN isnan(situacion_bancaria) THEN NULL ELSE situacion_bancaria END, 2) AS situacion_bancaria",
    "coalesce(CASE WHEN isnan(tc_close_total) THEN NULL ELSE tc_close_total END, 5) AS tc_close_total",
    "coalesce(CASE WHEN isnan(tc_max_dias_atraso_u6m) THEN NULL ELSE tc_max_dias_atraso_u6m END, 2) AS tc_max_dias_atraso_u6m",
    "coalesce(CASE WHEN isnan(tc_primera_act) THEN NULL ELSE tc_primera_act END, 60) AS tc_primera_act",
    "coalesce(CASE WHEN isnan(tc_prom_pmin_limcr_m1) THEN NULL ELSE tc_prom_pmin_limcr_m1 END, 0) AS tc_prom_pmin_limcr_m1",
    "coalesce(CASE WHEN isnan(tc_svenc_sdot_gt0_u12m) THEN NULL ELSE tc_svenc_sdot_gt0_u12m END, 0) AS tc_svenc_sdot_gt0_u12m",
]
IMPUTED = [c.rsplit(" AS ", 1)[1] for c in IMPUTE_LIST]

LOGODDS_SQL = """CASE
  WHEN scorecard = 1 THEN
    0.11877::DOUBLE + 0.208842::DOUBLE * flag_mnx + 0.07803::DOUBLE * g_max_venc_ten_36
    + 0.013473::DOUBLE * inf_cant_dist_afi_u6m + -0.022072::DOUBLE * ich_cons_cant_banco_admin
    + 0.243027::DOUBLE * inf_morce_cant_61_90_abiertas + 0.161477::DOUBLE * inf_morce_cant_31_45_abiertas
    + 0.19876::DOUBLE * inf_morce_cant_46_60_abiertas + 0.002054::DOUBLE * tc_max_dias_atraso_u6m
    + -0.001317::DOUBLE * tc_primera_act + 0.041465::DOUBLE * p_sdot_monto_gt75_m1
    + -0.000058756::DOUBLE * inf_cons_ult_dias_ccredito + 0.352326::DOUBLE * tc_prom_pmin_limcr_m1
    + 0.012349::DOUBLE * p_cant_atraso + -0.001048::DOUBLE * situacion_bancaria_woe
    + 0.033786::DOUBLE * inf_cant_dist_afi_ccred_u3m + -0.000165::DOUBLE * inf_cons_ult_dias_sf
    + -0.00154::DOUBLE * edad + 0.054837::DOUBLE * tc_svenc_sdot_gt0_u12m
    + 0.416607::DOUBLE * flag_judiciales + 0.393459::DOUBLE * distrito_woe
    + 0.097004::DOUBLE * ich_ch_re_cant_i_fond + 0.111114::DOUBLE * flag_saldo_vencido_ult_gt0
    + 0.004891::DOUBLE * inf_cons_cant_total_telco + -0.008784::DOUBLE * tc_close_total
    + 0.011588::DOUBLE * ips_flag_actividad
  WHEN scorecard = 0 THEN
    0.216635::DOUBLE + 0.030149::DOUBLE * inf_cant_dist_afi_u6m + 0.487934::DOUBLE * inf_morce_cant_abiertas
    + -0.002178::DOUBLE * edad + -0.005569::DOUBLE * ich_cons_cant_total_recod
    + 0.067513::DOUBLE * flag_mnx + 0.028268::DOUBLE * inf_cons_cant_u1m
    + 0.626119::DOUBLE * flag_judiciales + -0.000669::DOUBLE * distrito_woe
    + 0.0000000004646968::DOUBLE * fecha_ult_cons_privdia + 0.024178::DOUBLE * inf_cant_dist_afi_telco_u12m
    + -0.000082265::DOUBLE * inf_cons_ult_dias_sf + -0.000050311::DOUBLE * inf_cons_ult_dias_ccredito
    + -0.027242::DOUBLE * casado + -0.023956::DOUBLE * ich_cons_cant_banco_admin
    + 0.065592::DOUBLE * inf_morce_cant_61_90_abiertas + 0.024107::DOUBLE * inf_cons_cant_telco_u1m
END"""

BAND_SQL = """CASE
  WHEN score_pos > 805 AND score_pos <= 999 THEN 'A' WHEN score_pos > 781 AND score_pos <= 805 THEN 'B'
  WHEN score_pos > 763 AND score_pos <= 781 THEN 'C' WHEN score_pos > 749 AND score_pos <= 763 THEN 'D'
  WHEN score_pos > 733 AND score_pos <= 749 THEN 'E' WHEN score_pos > 719 AND score_pos <= 733 THEN 'F'
  WHEN score_pos > 708 AND score_pos <= 719 THEN 'G' WHEN score_pos > 696 AND score_pos <= 708 THEN 'H'
  WHEN score_pos > 684 AND score_pos <= 696 THEN 'I' WHEN score_pos > 664 AND score_pos <= 684 THEN 'J'
  WHEN score_pos > 606 AND score_pos <= 664 THEN 'K' WHEN score_pos > 527 AND score_pos <= 606 THEN 'L'
  WHEN score_pos > 432 AND score_pos <= 527 THEN 'M' WHEN score_pos > 0 AND score_pos <= 432 THEN 'N'
  WHEN score_pos = -1 THEN 'X' END"""


def scoring_ctes(source: str = "indicators", auto_units: bool = False) -> str:
    num_cast = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)
    parts = [
        f"raw AS (SELECT *, row_number() OVER () AS rid FROM {source})",
        f"ko AS (SELECT *, {KNOCKOUT_SQL} AS flow_x FROM raw)",
        f"num AS (SELECT * REPLACE ({num_cast}) FROM ko)",
        "norm AS (SELECT * REPLACE (nullif(ich_fecha_ult_cons_priv, '0') AS ich_fecha_ult_cons_priv, "
        "TRY_CAST(nullif(tc_max_dias_atraso_u6m, 'N/A') AS DOUBLE) AS tc_max_dias_atraso_u6m) FROM num)",
    ]
    if auto_units:
        parts.append(AGE_UNIT_CTE)
    parts += [
        "age AS (SELECT *, CASE WHEN coalesce(max_flow, '') IN ('M', 'N', 'X') THEN 1 ELSE 0 END AS flag_mnx, "
        f"{_age_expr(auto_units)} AS fecha_ult_cons_privdia FROM norm)",
        "sel AS (SELECT * REPLACE (coalesce(CASE WHEN isnan(scorecard) THEN NULL ELSE scorecard END, 0::DOUBLE) "
        "AS scorecard) FROM age)",
        f"imp AS (SELECT * REPLACE ({', '.join(IMPUTE_LIST)}) FROM sel)",
        f"cap AS (SELECT * REPLACE ({', '.join(CAP_LIST)}) FROM imp)",
        """der AS (SELECT *,
    CASE WHEN estado_civil = 2 THEN 1 ELSE 0 END AS casado,
    CASE WHEN coalesce(inf_dem_cant_total, 0) > 0 OR coalesce(inf_conv_cant_abiertas, 0) > 0
           OR coalesce(inf_qui_cant_abiertas, 0) > 0 OR coalesce(inf_rem_cant_abiertas, 0) > 0
           OR coalesce(inf_inhib_cant_abiertas, 0) > 0 OR coalesce(inf_inc_cant_abiertas, 0) > 0
         THEN 1 ELSE 0 END AS flag_judiciales,
    CASE WHEN p_saldo_vencido_ult_act > 0 THEN 1 ELSE 0 END AS flag_saldo_vencido_ult_gt0,
    CASE WHEN situacion_bancaria = 1 THEN 2.035253892::DOUBLE
         WHEN situacion_bancaria = 2 THEN -173.2934237::DOUBLE ELSE 0::DOUBLE END AS situacion_bancaria_woe,
    CASE WHEN ich_cons_cant_total = 0 THEN 3::DOUBLE ELSE ich_cons_cant_total END AS ich_cons_cant_total_recod
  FROM cap)""",
        _district_values_sql(),
        """lk AS (SELECT der.*, CASE WHEN der.scorecard = 1 THEN coalesce(dw.dw_w, 0::DOUBLE)
                               WHEN der.scorecard = 0 THEN coalesce(dw.dw_w, 42.09::DOUBLE) END AS distrito_woe
  FROM der LEFT JOIN dw ON dw.dw_sc = der.scorecard AND dw.dw_name = der.distrito)""",
        f"lin AS (SELECT *, {LOGODDS_SQL} AS logodds FROM lk)",
        """sc AS (SELECT *, CAST(CASE WHEN flow_x = 1 THEN -1 ELSE
       CASE WHEN g2 > 999 THEN 999 WHEN g2 < 1 THEN 1 ELSE g2 END END AS INTEGER) AS score_pos
  FROM (SELECT *, round_even(2.018442623::DOUBLE * round_even(1::DOUBLE / (1::DOUBLE + exp(logodds)) * 1000::DOUBLE, 0)
                             + -179.6413934::DOUBLE, 0) AS g2 FROM lin))""",
        f"bnd AS (SELECT *, {BAND_SQL} AS flow_pos FROM sc)",
    ]
    return ",\n".join(parts)


SCORED_CTE = "scored AS (SELECT raw.* EXCLUDE (rid), bnd.score_pos, bnd.flow_pos FROM raw JOIN bnd USING (rid))"


def with_scoring(select: str, dup: bool = False, auto_units: bool = False, with_archive: bool = False) -> str:
    return (f"WITH {_view_sql(dup, with_archive)},\n{scoring_ctes(auto_units=auto_units)},\n{SCORED_CTE}\n"
            f"{select}")


def with_view(select: str, dup: bool = False, with_archive: bool = False) -> str:
    return f"WITH {_view_sql(dup, with_archive)}\n{select}"


RAW57 = VIEW_COLUMNS + ", score_pos, flow_pos"
STAGING60 = VIEW_COLUMNS.replace("estado_civil,", "estado_civil, CAST(NULL AS VARCHAR) AS sexo,") + \
    ", score_pos, flow_pos"


def _tok(col: str, domain: str, passes: int = 1) -> str:
    e = col
    for _ in range(passes):
        e = f"CASE WHEN {e} IS NULL THEN NULL ELSE sha256(concat_ws('|', {_q(TOKEN_KEY)}, {_q(domain)}, {e})) END"
    return e


NUMERIC_DOMAIN, PERSON_DOMAIN = "numeric_id", "person_id"
