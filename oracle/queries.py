"""Oracle SQL per registered query (DuckDB, same column names as the Spark results)."""

from __future__ import annotations

from oracle.sql import (CAPPED, IMPUTED, KEYS, RAW57, VIEW_COLUMNS, with_scoring, with_view)

ORACLE: dict[str, str] = {
    "feature_scan": with_view(f"SELECT {VIEW_COLUMNS} FROM indicators"),
    "knockout": with_scoring(f"SELECT {KEYS}, flow_x FROM ko"),
    "normalize": with_scoring(f"SELECT {KEYS}, ich_fecha_ult_cons_priv, tc_max_dias_atraso_u6m FROM norm"),
    "consult_age": with_scoring(f"SELECT {KEYS}, flag_mnx, fecha_ult_cons_privdia FROM age"),
    "consult_age_auto": with_scoring(f"SELECT {KEYS}, fecha_ult_cons_privdia FROM age", auto_units=True),
    "impute": with_scoring(f"SELECT {KEYS}, scorecard, {', '.join(IMPUTED)} FROM imp"),
    "cap": with_scoring(f"SELECT {KEYS}, scorecard, {', '.join(CAPPED)} FROM cap"),
    "flags": with_scoring(f"SELECT {KEYS}, flag_mnx, casado, flag_judiciales, flag_saldo_vencido_ult_gt0, "
                          "situacion_bancaria_woe, ich_cons_cant_total_recod FROM der"),
    "district_weight": with_scoring(f"SELECT {KEYS}, scorecard, distrito, distrito_woe FROM lk"),
    "logodds": with_scoring(f"SELECT {KEYS}, scorecard, round(logodds, 9) AS logodds FROM lin"),
    "score": with_scoring(f"SELECT {KEYS}, flow_x, score_pos FROM sc"),
    "score_keys": with_scoring(f"SELECT {KEYS}, score_pos, flow_pos FROM bnd"),
    "band": with_scoring("SELECT flow_pos, count(*) AS n_rows, min(score_pos) AS min_score, "
                         "max(score_pos) AS max_score FROM bnd GROUP BY flow_pos"),
    "band_summary": with_scoring("SELECT flow_pos, count(*) AS n_rows, round(avg(score_pos), 9) AS mean_score "
                                 "FROM bnd GROUP BY flow_pos"),
    "score_append": with_scoring(f"SELECT raw.* EXCLUDE (rid), bnd.score_pos, bnd.flow_pos "
                                 f"FROM raw JOIN bnd USING (rid)"),
    "score_join_compat": with_scoring(
        f"SELECT raw.* EXCLUDE (rid), r.score_pos, r.flow_pos FROM raw LEFT JOIN "
        f"(SELECT {KEYS}, score_pos, flow_pos FROM bnd) r "
        "ON raw.infocheck_id IS NOT DISTINCT FROM r.infocheck_id "
        "AND raw.informconf_id IS NOT DISTINCT FROM r.informconf_id "
        "AND raw.pers_id IS NOT DISTINCT FROM r.pers_id AND raw.tipo_doc_id IS NOT DISTINCT FROM r.tipo_doc_id",
        dup=True),
    "duplicate_keys": with_view(f"SELECT {KEYS}, count(*) AS n_rows FROM indicators GROUP BY {KEYS} "
                                "HAVING count(*) > 1", dup=True),
}

# --------------------------------------------------------------------------- publishing

from oracle.sql import FIXED_RUN_TS, NUMERIC_DOMAIN, PERSON_DOMAIN, STAGING60, _tok  # noqa: E402

RUN_ARCHIVE = ("(SELECT CAST(strftime(d - CAST((dayofweek(d) + 1) % 7 AS INTEGER), '%Y%m%d') AS INTEGER) "
               "FROM (SELECT CAST(max(try_strptime(fecha_obs, '%Y-%m-%d')) AS DATE) AS d FROM indicators))")
STAMP = f"'{FIXED_RUN_TS}' AS time_stamp"


def _staging(archv: str, tokens: int = 0) -> str:
    cols = STAGING60
    if tokens:
        for c, dom in (("infocheck_id", NUMERIC_DOMAIN), ("informconf_id", NUMERIC_DOMAIN),
                       ("pers_id", PERSON_DOMAIN)):
            cols = cols.replace(f"{c},", f"{_tok(c, dom, tokens)} AS {c},", 1)
    return f"{cols}, CAST({archv} AS INTEGER) AS archv, {STAMP}"


SLIM = ("infocheck_id, informconf_id, pers_id, tipo_doc_id, edad, max_flow, CAST(NULL AS VARCHAR) AS sexo, "
        "fecha_obs, score_pos, flow_pos")
CLOSES = "month(CAST(strptime(CAST({a} AS VARCHAR), '%Y%m%d') AS DATE)) != " \
         "month(CAST(strptime(CAST({a} AS VARCHAR), '%Y%m%d') AS DATE) + 7)"
DAY = "CAST(try_strptime(fecha_obs, '%Y-%m-%d') AS DATE)"

ORACLE.update({
    "csv_roundtrip": with_scoring(f"SELECT {RAW57} FROM scored"),
    "stage_snapshot": with_scoring(f"SELECT {_staging(RUN_ARCHIVE)} FROM scored"),
    "publish_current": with_scoring(f"SELECT {_staging(RUN_ARCHIVE)} FROM scored"),
    "publish_slim": with_scoring(f"SELECT {SLIM}, CAST({RUN_ARCHIVE} AS INTEGER) AS archv, {STAMP}, "
                                 f"CAST({RUN_ARCHIVE} AS INTEGER) AS archive FROM scored"),
    "publish_weekly": with_scoring(f"SELECT {_staging(RUN_ARCHIVE, 1)}, CAST({RUN_ARCHIVE} AS INTEGER) AS archive "
                                   "FROM scored"),
    "publish_monthly": with_scoring(f"SELECT {_staging(RUN_ARCHIVE, 1)}, CAST({RUN_ARCHIVE} AS INTEGER) AS archive "
                                    f"FROM scored WHERE {CLOSES.format(a=RUN_ARCHIVE)}"),
    "tokenize": with_view(f"SELECT {KEYS}, {_tok('infocheck_id', NUMERIC_DOMAIN)} AS infocheck_id_token, "
                          f"{_tok('informconf_id', NUMERIC_DOMAIN)} AS informconf_id_token, "
                          f"{_tok('pers_id', PERSON_DOMAIN)} AS pers_id_token FROM indicators"),
    "tokenize_twice": with_view(f"SELECT {KEYS}, {_tok('infocheck_id', NUMERIC_DOMAIN, 2)} AS infocheck_id_token, "
                                f"{_tok('informconf_id', NUMERIC_DOMAIN, 2)} AS informconf_id_token, "
                                f"{_tok('pers_id', PERSON_DOMAIN, 2)} AS pers_id_token FROM indicators"),
    "archive_calendar": with_view(
        "SELECT DISTINCT d AS obs_date, "
        "CAST(strftime(d - CAST((dayofweek(d) + 1) % 7 AS INTEGER), '%Y%m%d') AS INTEGER) AS archive, "
        "CAST(strftime(d, '%Y%m01') AS INTEGER) AS first_archive "
        f"FROM (SELECT {DAY} AS d FROM indicators) WHERE d IS NOT NULL"),
    "month_closing": with_view(f"SELECT DISTINCT archive, {CLOSES.format(a='archive')} AS closes_month "
                               "FROM indicators", with_archive=True),
    "freshness": with_view(
        f"SELECT last_obs, CAST(date_diff('day', last_obs, DATE '2001-08-04') AS INTEGER) AS age_days, "
        f"coalesce(date_diff('day', last_obs, DATE '2001-08-04') < 4, false) AS fresh "
        f"FROM (SELECT max({DAY}) AS last_obs FROM indicators)"),
    "pending_archives": with_view("SELECT DISTINCT archive FROM indicators WHERE archive >= 19980101",
                                  with_archive=True),
    "backfill_slim": with_scoring(f"SELECT {SLIM}, archive AS archv, {STAMP}, archive FROM scored",
                                  with_archive=True),
    "retention": with_scoring(
        f"SELECT {_tok('infocheck_id', NUMERIC_DOMAIN)} AS infocheck_id, "
        f"{_tok('informconf_id', NUMERIC_DOMAIN)} AS informconf_id, {_tok('pers_id', PERSON_DOMAIN)} AS pers_id, "
        "tipo_doc_id, score_pos, flow_pos, archive FROM scored "
        "WHERE archive IN (SELECT DISTINCT archive FROM scored ORDER BY archive DESC LIMIT 12)",
        with_archive=True),
})

PURGED = "tipo_doc_id, edad, score_pos, flow_pos"
ORACLE.update({
    "rejects": with_view(
        "SELECT 'tc_max_dias_atraso_u6m' AS \"column\", CAST(count(*) FILTER (WHERE tc_max_dias_atraso_u6m != 'N/A' "
        "AND TRY_CAST(tc_max_dias_atraso_u6m AS DOUBLE) IS NULL) AS BIGINT) AS rejected_rows FROM indicators "
        "UNION ALL SELECT 'ich_fecha_ult_cons_priv', count(*) FILTER (WHERE ich_fecha_ult_cons_priv != '0' "
        "AND try_strptime(ich_fecha_ult_cons_priv, '%Y-%m-%d') IS NULL) FROM indicators "
        "UNION ALL SELECT 'fecha_obs', count(*) FILTER (WHERE fecha_obs IS NOT NULL "
        "AND try_strptime(fecha_obs, '%Y-%m-%d') IS NULL) FROM indicators"),
    "gated_run": with_view("SELECT 'stale' AS gate, CAST(0 AS BIGINT) AS slim_rows "
                           "UNION ALL SELECT 'fresh', count(*) FROM indicators"),
    "backfill_pending": with_view("SELECT archive, count(*) AS slim_rows, CAST(1 AS BIGINT) AS ledger_entries "
                                  "FROM indicators GROUP BY archive", with_archive=True),
    "purge_current": with_scoring(
        f"SELECT {KEYS}, edad, score_pos, flow_pos, CAST(20010707 AS INTEGER) AS archv, "
        "CAST(20010714 AS INTEGER) AS archive FROM scored WHERE edad < 40 "
        f"UNION ALL SELECT {KEYS}, edad, score_pos, flow_pos, 20010714, 20010714 FROM scored WHERE edad >= 40"),
    "purge_weekly": with_scoring(
        f"SELECT {_tok('infocheck_id', NUMERIC_DOMAIN)} AS infocheck_id, "
        f"{_tok('informconf_id', NUMERIC_DOMAIN)} AS informconf_id, {_tok('pers_id', PERSON_DOMAIN)} AS pers_id, "
        f"{PURGED}, CAST(20010714 AS INTEGER) AS archv, CAST(20010714 AS INTEGER) AS archive "
        "FROM scored WHERE edad >= 40"),
    "raw_table_roundtrip": with_scoring(f"SELECT {RAW57} FROM scored"),
})

REJECTED = {
    "tc_max_dias_atraso_u6m": "tc_max_dias_atraso_u6m != 'N/A' AND TRY_CAST(tc_max_dias_atraso_u6m AS DOUBLE) IS NULL",
    "ich_fecha_ult_cons_priv": "ich_fecha_ult_cons_priv != '0' AND try_strptime(ich_fecha_ult_cons_priv, '%Y-%m-%d') IS NULL",
    "fecha_obs": "fecha_obs IS NOT NULL AND try_strptime(fecha_obs, '%Y-%m-%d') IS NULL",
}


def _ledger(run: str, group: str, tables: dict[str, str]) -> str:
    """Ledger entries per archive: rejects, rows of each table (``tables``: name -> condition), then the job."""
    rows = [(f"rejected {c}", f"count(*) FILTER (WHERE {cond})", "true") for c, cond in REJECTED.items()]
    rows += [(name, "count(*)", cond) for name, cond in {"staging": "true", **tables, "job": "true"}.items()]
    return " UNION ALL ".join(
        f"SELECT '{run}' AS run, archive, '{name}' AS table_name, {n} AS rows FROM {group} WHERE {cond} GROUP BY archive" for name, n, cond in rows)


ORACLE.update({
    "publish_monthly_double": with_scoring(f"SELECT {_staging(RUN_ARCHIVE, 2)}, CAST({RUN_ARCHIVE} AS INTEGER) AS archive "
                                           f"FROM scored WHERE {CLOSES.format(a=RUN_ARCHIVE)}"),
    "raw_rejects": with_scoring(
        f"SELECT {KEYS}, score_pos, flow_pos, CAST(20010804 AS INTEGER) AS archive, CAST(NULL AS VARCHAR) AS bad_line FROM scored "
        "UNION ALL SELECT 'cut', NULL, NULL, NULL, NULL, NULL, 20010804, 'cut|' || informconf_id || '|not a number' "
        "FROM scored WHERE edad IN (20, 40, 60, 80)"),
    "freshness_partition": with_view(
        "SELECT last_obs, CAST(date_diff('day', last_obs, DATE '1998-01-02') AS INTEGER) AS age_days, "
        "coalesce(date_diff('day', last_obs, DATE '1998-01-02') BETWEEN 0 AND 3, false) AS fresh "
        f"FROM (SELECT max({DAY}) AS last_obs FROM indicators WHERE archive = (SELECT max(archive) FROM indicators WHERE archive < 19980101))",
        with_archive=True),
    "first_of_month_run": with_scoring(f"SELECT {SLIM}, CAST(20010801 AS INTEGER) AS archv, {STAMP}, CAST(20010801 AS INTEGER) AS archive FROM scored"),
    "run_metrics": with_view(
        "SELECT run, CAST(archive AS INTEGER) AS archive, table_name, CAST(rows AS BIGINT) AS rows FROM ("
        + _ledger("archive", f"(SELECT * EXCLUDE (archive), {RUN_ARCHIVE} AS archive FROM indicators)", {"scored_current": "true", "scored_slim": "true"})
        + " UNION ALL " + _ledger("backfill", "indicators", {"scored_slim": "true", "scored_monthly": CLOSES.format(a="archive")}) + ")",
        with_archive=True),
    "published_version": with_view("SELECT archive, '2001-08-05 06:00:00' AS time_stamp, count(*) AS n_rows FROM indicators GROUP BY archive",
                                   with_archive=True),
    "orphan_runs": with_view("SELECT 'scored_slim' AS table_name, count(*) AS orphan_rows FROM indicators WHERE edad < 40 "
                             "UNION ALL SELECT 'scored_staging', count(*) FROM indicators"),
    "second_session": with_scoring(
        "SELECT t AS table_name, archv, flow_pos, count(*) AS n_rows, CAST(sum(score_pos) AS BIGINT) AS points FROM ("
        "SELECT 'scored_current' AS t, CAST(20010804 AS INTEGER) AS archv, score_pos, flow_pos FROM scored WHERE edad >= 40 "
        "UNION ALL SELECT 'scored_weekly', CASE WHEN edad < 40 THEN 20010728 ELSE 20010804 END, score_pos, flow_pos FROM scored "
        "WHERE edad IS NOT NULL) GROUP BY ALL"),
})
