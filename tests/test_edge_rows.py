"""Edge rows: one row per boundary of every scoring step (FIXTURES section 3)."""

from __future__ import annotations

import pytest

from scorewright import two_card, score, working_frame
from scorewright.models.two_card import KNOCKOUT
from scorewright.operators.keys import score_join_compat
from scorewright.operators.score import source_projection
from scorewright.operators.scale import band_letter
from tests.helpers import by_id, rows

CARD = two_card()


def work(spark, *overrides, upto="band"):
    return by_id(working_frame(source_projection(rows(spark, *overrides), CARD), CARD, upto=upto))


def test_all_null_row_gets_constants(spark):
    r = work(spark, {"id": "n"})["n"]
    assert r["scorecard"] == 0 and r["flow_x"] == 0
    assert r["ich_cons_cant_total"] == 11 and r["edad"] == 37 and r["situacion_bancaria"] == 2
    assert r["ich_cons_cant_banco_admin"] == 2 and r["distrito"] == "MBOCAYATY DEL GUAIRA"
    assert r["inf_cons_ult_dias_ccredito"] == 848 and r["inf_cons_ult_dias_sf"] == 162
    assert r["tc_close_total"] == 5 and r["tc_primera_act"] == 60 and r["tc_max_dias_atraso_u6m"] == 2
    assert r["fecha_ult_cons_privdia"] == 115974872
    assert r["score_pos"] is not None and r["flow_pos"] is not None


def test_scorecard_one_defaults(spark):
    r = work(spark, {"id": "s1", "scorecard": 1}, upto="impute")["s1"]
    assert r["ich_cons_cant_banco_admin"] == 0 and r["distrito"] == "HERNANDARIAS"
    assert r["inf_cons_ult_dias_ccredito"] == 833 and r["inf_cons_ult_dias_sf"] == 21


def test_scorecard_two(spark):
    out = work(spark, {"id": "plain", "scorecard": 2}, {"id": "ko", "scorecard": 2, "inf_qui_cant_abiertas": 1})
    assert out["plain"]["logodds"] is None and out["plain"]["score_pos"] is None
    assert out["plain"]["flow_pos"] is None and out["plain"]["distrito_woe"] is None
    assert out["ko"]["score_pos"] == -1 and out["ko"]["flow_pos"] == "X"


@pytest.mark.parametrize("test_index", range(len(KNOCKOUT)))
def test_each_knockout_fires_at_threshold(spark, test_index):
    t = KNOCKOUT[test_index]
    n = int(t.at_least)
    below = {c: 0 for c in t.plus}
    at = {c: 0 for c in t.plus}
    below[t.plus[0]] = n - 1
    at[t.plus[0]] = n
    if n == 3 and t.plus[0].endswith("_total"):
        # neutralise the subtraction rules, which would fire on the total alone at 2
        below[t.plus[0] + "_telco"] = n - 1
        at[t.plus[0] + "_telco"] = n
    out = work(spark, {"id": "below", **below}, {"id": "at", **at}, upto="knockout")
    assert out["below"]["flow_x"] == 0
    assert out["at"]["flow_x"] == 1


def test_knockout_subtraction_rules(spark):
    out = work(spark,
               {"id": "a", "inf_mor_cant_total": 2, "inf_mor_cant_total_telco": 1},      # 2-1 = 1 -> no
               {"id": "b", "inf_mor_cant_total": 2},                                      # 2 -> yes
               {"id": "c", "inf_mor_cant_total": 2, "inf_mor_cant_total_telco": 2},      # 0; totals 2 -> no
               upto="knockout")
    assert (out["a"]["flow_x"], out["b"]["flow_x"], out["c"]["flow_x"]) == (0, 1, 0)


@pytest.mark.parametrize("sc,value,expect", [
    (0, 17, 18), (0, 18, 18), (0, 78, 78), (0, 79, 78),
    (1, 17, 18), (1, 72, 72), (1, 73, 72), (2, 99, 99),
])
def test_age_cap_per_scorecard(spark, sc, value, expect):
    r = work(spark, {"id": "x", "scorecard": sc, "edad": value}, upto="cap")["x"]
    assert r["edad"] == expect


def test_caps_two_sided(spark):
    out = work(spark, {"id": "lo", "p_saldo_vencido_ult_act": -1, "tc_prom_pmin_limcr_m1": -0.5},
               {"id": "hi", "p_saldo_vencido_ult_act": 6372817, "tc_prom_pmin_limcr_m1": 0.5},
               {"id": "in", "p_saldo_vencido_ult_act": 6372816, "tc_prom_pmin_limcr_m1": 0.3715}, upto="cap")
    assert out["lo"]["p_saldo_vencido_ult_act"] == 0 and out["lo"]["tc_prom_pmin_limcr_m1"] == 0
    assert out["hi"]["p_saldo_vencido_ult_act"] == 6372816 and out["hi"]["tc_prom_pmin_limcr_m1"] == 0.3715
    assert out["in"]["p_saldo_vencido_ult_act"] == 6372816


def test_marital_status_as_built_and_fixed(spark):
    vals = {"m1": -1, "m2": 2, "m7": 7, "m9": 9}
    out = work(spark, *[{"id": k, "estado_civil": v} for k, v in vals.items()], upto="derive")
    assert [out[k]["estado_civil"] for k in vals] == [0, 7, 7, 9]
    assert all(out[k]["casado"] == 0 for k in vals)
    fixed = two_card(marital_fixed=True)
    df = working_frame(source_projection(rows(spark, {"id": "m2", "estado_civil": 2}), fixed), fixed, upto="derive")
    r = by_id(df)["m2"]
    assert r["estado_civil"] == 2 and r["casado"] == 1


def test_situacion_bancaria_weight(spark):
    out = work(spark, {"id": "1", "situacion_bancaria": 1}, {"id": "2", "situacion_bancaria": 2}, upto="derive")
    assert out["1"]["situacion_bancaria_woe"] == 2.035253892
    assert out["2"]["situacion_bancaria_woe"] == -173.2934237


def test_district_weights(spark):
    out = work(spark,
               {"id": "u1", "scorecard": 1, "distrito": "NOWHERE"},
               {"id": "u0", "scorecard": 0, "distrito": "NOWHERE"},
               {"id": "low", "scorecard": 0, "distrito": "asuncion"},
               {"id": "enie", "scorecard": 1, "distrito": "ÑEMBY"},
               {"id": "otros", "scorecard": 0, "distrito": "otros"},
               {"id": "only1", "scorecard": 0, "distrito": "BAHIA NEGRA"},
               upto="lookup")
    assert out["u1"]["distrito_woe"] == 0.0 and out["u0"]["distrito_woe"] == 42.09
    assert out["low"]["distrito_woe"] == 42.09
    assert out["enie"]["distrito_woe"] == 0.324318429662
    assert out["only1"]["distrito_woe"] == 42.09
    assert out["otros"]["distrito_woe"] != 42.09


def test_consult_age_seconds(spark):
    out = work(spark,
               {"id": "zero", "ich_fecha_ult_cons_priv": "0", "fecha_obs": "2020-01-10"},
               {"id": "null", "fecha_obs": "2020-01-10"},
               {"id": "same", "ich_fecha_ult_cons_priv": "2020-01-10", "fecha_obs": "2020-01-10"},
               {"id": "day", "ich_fecha_ult_cons_priv": "2020-01-09", "fecha_obs": "2020-01-10"},
               upto="consult_age")
    assert [out[k]["fecha_ult_cons_privdia"] for k in ("zero", "null", "same", "day")] == \
        [115974872, 115974872, 0, 86400]


def test_consult_age_auto_units_days_when_no_same_day(spark):
    df = rows(spark, {"id": "a", "ich_fecha_ult_cons_priv": "2020-01-08", "fecha_obs": "2020-01-10"},
              {"id": "b", "ich_fecha_ult_cons_priv": "2020-01-09", "fecha_obs": "2020-01-10"})
    out = by_id(working_frame(source_projection(df, CARD), CARD, auto_units=True, upto="consult_age"))
    assert out["a"]["fecha_ult_cons_privdia"] == 2 and out["b"]["fecha_ult_cons_privdia"] == 1


def test_missing_observation_date(spark):
    out = work(spark, {"id": "s0", "scorecard": 0, "ich_fecha_ult_cons_priv": "2020-01-01"},
               {"id": "s1", "scorecard": 1, "ich_fecha_ult_cons_priv": "2020-01-01"})
    assert out["s0"]["score_pos"] is None and out["s0"]["flow_pos"] is None
    assert out["s1"]["score_pos"] is not None


def test_delay_text(spark):
    vals = {"na": "N/A", "abc": "abc", "12": "12", "neg": "-3", "99": "99"}
    out = work(spark, *[{"id": k, "tc_max_dias_atraso_u6m": v} for k, v in vals.items()], upto="cap")
    assert [out[k]["tc_max_dias_atraso_u6m"] for k in vals] == [2, 2, 12, 0, 85]


def test_rint_rounds_halves_to_even(spark):
    got = spark.range(1).selectExpr("rint(0.5D) a", "rint(1.5D) b", "rint(2.5D) c").first()
    assert (got.a, got.b, got.c) == (0.0, 2.0, 2.0)


@pytest.mark.parametrize("s,letter", [(1, "N"), (432, "N"), (433, "M"), (527, "M"), (528, "L"), (606, "L"),
                                      (607, "K"), (664, "K"), (665, "J"), (805, "B"), (806, "A"), (999, "A"),
                                      (-1, "X"), (0, None)])
def test_band_edges(s, letter):
    assert band_letter(CARD, s) == letter


def test_band_lookup_matches_rule(spark):
    from scorewright.operators.scale import band
    df = spark.range(-5, 1005).selectExpr("CAST(id AS INT) AS score_pos")
    got = {r.score_pos: r.flow_pos for r in band(df, CARD).collect()}
    for s, letter in got.items():
        expect = band_letter(CARD, s) if -1 <= s <= 999 else None
        assert letter == expect, s
    assert spark.createDataFrame([(None,)], "score_pos int").transform(lambda d: band(d, CARD)).first()[1] is None


def test_compat_join_null_keys_and_fanout(spark):
    df = rows(spark, {"id": "dup"}, {"id": "dup"}, {"id": "dup"}, {"id": "solo"})
    df = df.withColumn("infocheck_id", df.infocheck_id)  # keys: infocheck_id + three nulls
    out = score_join_compat(source_projection(df, CARD), CARD)
    counts = {r["infocheck_id"]: r["count"] for r in out.groupBy("infocheck_id").count().collect()}
    assert counts == {"dup": 9, "solo": 1}


def test_score_keys_shape(spark):
    out = score(rows(spark, {"id": "a"}), CARD, keys=list(CARD.keys))
    assert out.columns == list(CARD.keys) + ["score_pos", "flow_pos"]


def test_consult_age_ignores_session_time_zone(spark):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Asuncion")
    try:
        out = work(spark, {"id": "dst", "ich_fecha_ult_cons_priv": "2020-09-01", "fecha_obs": "2020-11-01"},
                   upto="consult_age")
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    assert out["dst"]["fecha_ult_cons_privdia"] == 61 * 86400


def test_nan_counts_as_missing_like_r(spark):
    out = work(spark, {"id": "nan", "g_max_venc_ten_36": float("nan"), "tc_max_dias_atraso_u6m": "NaN"},
               upto="impute")
    assert out["nan"]["g_max_venc_ten_36"] == 0.0
    assert out["nan"]["tc_max_dias_atraso_u6m"] == 2.0


def test_nan_suffixes_and_partial_dates(spark):
    from scorewright.models.two_card import two_card
    from scorewright.operators.score import working_frame
    from pyspark.sql import functions as F
    nan = float("nan")
    df = rows(spark, {"id": 1, "tc_max_dias_atraso_u6m": "12d"}, {"id": 2, "tc_max_dias_atraso_u6m": "12f", "fecha_obs": "2019"},
              {"id": 3, "tc_max_dias_atraso_u6m": " 12.5 "}, {"id": 4, "fecha_obs": "2019-05"})
    df = df.withColumn("inf_mor_cant_total_sf", F.lit(nan))
    got = {r["infocheck_id"]: r for r in working_frame(df, two_card(), upto="normalize").collect()}
    assert all(r["flow_x"] == 0 for r in got.values())
    assert [got[k]["tc_max_dias_atraso_u6m"] for k in "123"] == [None, None, 12.5]


def test_job_parameters_exclude_each_other():
    from scorewright.plans.job import JobConfig
    for bad in ({"archive": 20010728, "first": True}, {"env": "test"}, {"archive": 20011399}):
        with pytest.raises(ValueError):
            JobConfig(as_of=None, **bad)
