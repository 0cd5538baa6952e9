"""The published two-variant points scorecard, written as data.

Everything below the "Fixed values" marker must equal the published model;
it is model content (names, thresholds, constants, weights), not logic.
The district weights live in ``scorewright/data/district_weight.csv``.
"""

from __future__ import annotations

from scorewright.spec import (AnyPositiveFlag, Band, Cap, CapArm, CompareFlag, Impute, InSetFlag,
                              KnockoutTest, LinearModel, Lookup, Recode, Scaling, Scorecard,
                              SecondsBetween, Sentinel, Term)

# ---------------------------------------------------------------------------
# Fixed values (must equal the published model)
# ---------------------------------------------------------------------------

KEYS = ("infocheck_id", "informconf_id", "pers_id", "tipo_doc_id")

KNOCKOUT_INPUTS = (
    "inf_conv_cant_abiertas", "inf_dem_cant_total", "inf_dem_cant_total_cable",
    "inf_dem_cant_total_ccredito", "inf_dem_cant_total_comercio",
    "inf_dem_cant_total_sf", "inf_dem_cant_total_spub", "inf_dem_cant_total_telco",
    "inf_inc_cant_abiertas", "inf_inhib_cant_abiertas", "inf_mor_cant_total",
    "inf_mor_cant_total_cable", "inf_mor_cant_total_ccredito",
    "inf_mor_cant_total_sf", "inf_mor_cant_total_spub", "inf_mor_cant_total_telco",
    "inf_qui_cant_abiertas", "inf_rem_cant_abiertas",
)

MODEL_INPUTS = KNOCKOUT_INPUTS + (
    "scorecard",
    "ich_ch_re_cant_i_fond", "ich_cons_cant_total", "ich_cons_cant_banco_admin",
    "distrito", "edad", "estado_civil", "ich_fecha_ult_cons_priv",
    "ips_flag_actividad", "max_flow", "g_max_venc_ten_36", "inf_cant_dist_afi_u6m",
    "inf_cant_dist_afi_ccred_u3m", "inf_cant_dist_afi_telco_u12m",
    "inf_cons_cant_telco_u1m", "inf_cons_cant_total_telco", "inf_cons_cant_u1m",
    "inf_cons_ult_dias_ccredito", "inf_cons_ult_dias_sf",
    "inf_morce_cant_31_45_abiertas", "inf_morce_cant_46_60_abiertas",
    "inf_morce_cant_61_90_abiertas", "inf_morce_cant_abiertas",
    "inf_qui_cant_abiertas", "p_cant_atraso", "p_saldo_vencido_ult_act",
    "p_sdot_monto_gt75_m1", "situacion_bancaria", "tc_close_total",
    "tc_max_dias_atraso_u6m", "tc_primera_act", "tc_prom_pmin_limcr_m1",
    "tc_svenc_sdot_gt0_u12m", "fecha_obs",
)

TEXT_COLUMNS = ("distrito", "ich_fecha_ult_cons_priv", "max_flow", "tc_max_dias_atraso_u6m", "fecha_obs")

KNOCKOUT = (
    KnockoutTest(("inf_mor_cant_total_sf",), 1),
    KnockoutTest(("inf_mor_cant_total_ccredito",), 1),
    KnockoutTest(("inf_dem_cant_total",), 3),
    KnockoutTest(("inf_dem_cant_total_sf",), 1),
    KnockoutTest(("inf_dem_cant_total_comercio",), 1),
    KnockoutTest(("inf_dem_cant_total_ccredito",), 1),
    KnockoutTest(("inf_inhib_cant_abiertas",), 1),
    KnockoutTest(("inf_inc_cant_abiertas",), 1),
    KnockoutTest(("inf_rem_cant_abiertas",), 1),
    KnockoutTest(("inf_conv_cant_abiertas",), 1),
    KnockoutTest(("inf_qui_cant_abiertas",), 1),
    KnockoutTest(("inf_mor_cant_total",), 3),
    KnockoutTest(("inf_mor_cant_total",), 2,
                 ("inf_mor_cant_total_telco", "inf_mor_cant_total_cable", "inf_mor_cant_total_spub")),
    KnockoutTest(("inf_dem_cant_total",), 2,
                 ("inf_dem_cant_total_telco", "inf_dem_cant_total_cable", "inf_dem_cant_total_spub")),
    KnockoutTest(("inf_mor_cant_total", "inf_dem_cant_total"), 2,
                 ("inf_mor_cant_total_telco", "inf_mor_cant_total_cable", "inf_mor_cant_total_spub",
                  "inf_dem_cant_total_telco", "inf_dem_cant_total_cable", "inf_dem_cant_total_spub")),
    KnockoutTest(("inf_mor_cant_total", "inf_dem_cant_total"), 3),
)

SENTINELS = (
    Sentinel("ich_fecha_ult_cons_priv", "0"),
    Sentinel("tc_max_dias_atraso_u6m", "N/A"),
)

NUMERIC_TEXT = ("tc_max_dias_atraso_u6m",)

CONSULT_AGE = SecondsBetween("fecha_ult_cons_privdia", end="fecha_obs",
                             start="ich_fecha_ult_cons_priv", missing=115974872.0)

PREVIOUS_BAND_FLAG = InSetFlag("flag_mnx", "max_flow", ("M", "N", "X"))

SELECTOR, SELECTOR_DEFAULT = "scorecard", 0

IMPUTES = (
    Impute("ich_ch_re_cant_i_fond", 0),
    Impute("ich_cons_cant_total", 11),
    Impute("ich_cons_cant_banco_admin", 2, ((1, 0),)),
    Impute("distrito", "MBOCAYATY DEL GUAIRA", ((1, "HERNANDARIAS"),)),
    Impute("edad", 37),
    Impute("estado_civil", 7),
    Impute("ips_flag_actividad", 0),
    Impute("g_max_venc_ten_36", 0),
    Impute("inf_cant_dist_afi_ccred_u3m", 5),
    Impute("inf_cant_dist_afi_telco_u12m", 0),
    Impute("inf_cant_dist_afi_u6m", 0),
    Impute("inf_cons_cant_telco_u1m", 0),
    Impute("inf_cons_cant_total_telco", 0),
    Impute("inf_cons_cant_u1m", 0),
    Impute("inf_cons_ult_dias_ccredito", 848, ((1, 833),)),
    Impute("inf_cons_ult_dias_sf", 162, ((1, 21),)),
    Impute("inf_conv_cant_abiertas", 0),
    Impute("inf_dem_cant_total", 0),
    Impute("inf_inc_cant_abiertas", 0),
    Impute("inf_inhib_cant_abiertas", 0),
    Impute("inf_morce_cant_31_45_abiertas", 0),
    Impute("inf_morce_cant_46_60_abiertas", 0),
    Impute("inf_morce_cant_61_90_abiertas", 0),
    Impute("inf_morce_cant_abiertas", 0),
    Impute("inf_qui_cant_abiertas", 0),
    Impute("inf_rem_cant_abiertas", 0),
    Impute("p_cant_atraso", 0),
    Impute("p_saldo_vencido_ult_act", 0),
    Impute("p_sdot_monto_gt75_m1", 0),
    Impute("situacion_bancaria", 2),
    Impute("tc_close_total", 5),
    Impute("tc_max_dias_atraso_u6m", 2),
    Impute("tc_primera_act", 60),
    Impute("tc_prom_pmin_limcr_m1", 0),
    Impute("tc_svenc_sdot_gt0_u12m", 0),
)


def _clip(column: str, lo: float, hi: float) -> Cap:
    return Cap(column, (CapArm("<", lo, lo), CapArm(">", hi, hi)))


def _clip_by_card(column: str, lo: float, hi1: float, hi0: float) -> Cap:
    return Cap(column, (CapArm("<", lo, lo), CapArm(">", hi1, hi1, 1), CapArm(">", hi0, hi0, 0)))


# Marital status as published: the second arm is "< 7 -> 7", so 0..6 all become 7.
MARITAL_AS_BUILT = Cap("estado_civil", (CapArm("<", 0, 0), CapArm("<", 7, 7)))
# The evident intent (every sibling cap uses ">"); opt in with Scorecard.with_caps(MARITAL_FIXED).
MARITAL_FIXED = Cap("estado_civil", (CapArm("<", 0, 0), CapArm(">", 7, 7)))

CAPS = (
    _clip("ich_ch_re_cant_i_fond", 0, 1),
    _clip("ich_cons_cant_total", 0, 55),
    _clip_by_card("ich_cons_cant_banco_admin", 0, 1, 3),
    Cap("edad", (CapArm("<", 18, 18), CapArm(">", 72, 72, 1), CapArm(">", 78, 78, 0))),
    MARITAL_AS_BUILT,
    _clip("ips_flag_actividad", 0, 1),
    _clip("g_max_venc_ten_36", 0, 1),
    _clip("inf_cant_dist_afi_ccred_u3m", 0, 5),
    _clip("inf_cant_dist_afi_telco_u12m", 0, 2),
    _clip_by_card("inf_cant_dist_afi_u6m", 0, 21, 14),
    _clip("inf_cons_cant_telco_u1m", 0, 1),
    _clip("inf_cons_cant_total_telco", 0, 7),
    _clip("inf_cons_cant_u1m", 0, 6),
    _clip_by_card("inf_cons_ult_dias_ccredito", 0, 975, 1036),
    _clip_by_card("inf_cons_ult_dias_sf", 0, 736, 987),
    _clip("inf_conv_cant_abiertas", 0, 1),
    _clip("inf_dem_cant_total", 0, 1),
    _clip("inf_inc_cant_abiertas", 0, 1),
    _clip("inf_inhib_cant_abiertas", 0, 1),
    _clip("inf_morce_cant_31_45_abiertas", 0, 2),
    _clip("inf_morce_cant_46_60_abiertas", 0, 1),
    _clip("inf_morce_cant_61_90_abiertas", 0, 1),
    _clip("inf_morce_cant_abiertas", 0, 1),
    _clip("inf_qui_cant_abiertas", 0, 1),
    _clip("inf_rem_cant_abiertas", 0, 1),
    _clip("p_cant_atraso", 0, 5),
    _clip("p_saldo_vencido_ult_act", 0, 6372816),
    _clip("p_sdot_monto_gt75_m1", 0, 2),
    _clip("situacion_bancaria", 1, 2),
    _clip("tc_close_total", 0, 7),
    _clip("tc_max_dias_atraso_u6m", 0, 85),
    _clip("tc_primera_act", 0, 63),
    _clip("tc_prom_pmin_limcr_m1", 0, 0.3715),
    _clip("tc_svenc_sdot_gt0_u12m", 0, 2),
)

DERIVED = (
    CompareFlag("casado", "estado_civil", "==", 2),
    AnyPositiveFlag("flag_judiciales", ("inf_dem_cant_total", "inf_conv_cant_abiertas",
                                        "inf_qui_cant_abiertas", "inf_rem_cant_abiertas",
                                        "inf_inhib_cant_abiertas", "inf_inc_cant_abiertas")),
    CompareFlag("flag_saldo_vencido_ult_gt0", "p_saldo_vencido_ult_act", ">", 0),
    Recode("situacion_bancaria_woe", "situacion_bancaria", ((1, 2.035253892), (2, -173.2934237)), 0.0),
    Recode("ich_cons_cant_total_recod", "ich_cons_cant_total", ((0, 3),), None),
)

LOOKUPS = (
    Lookup("distrito_woe", "distrito", "district_weight.csv", ((1, 0.0), (0, 42.09))),
)

MODELS = (
    LinearModel(1, 0.11877, (
        Term("flag_mnx", 0.208842),
        Term("g_max_venc_ten_36", 0.07803),
        Term("inf_cant_dist_afi_u6m", 0.013473),
        Term("ich_cons_cant_banco_admin", -0.022072),
        Term("inf_morce_cant_61_90_abiertas", 0.243027),
        Term("inf_morce_cant_31_45_abiertas", 0.161477),
        Term("inf_morce_cant_46_60_abiertas", 0.19876),
        Term("tc_max_dias_atraso_u6m", 0.002054),
        Term("tc_primera_act", -0.001317),
        Term("p_sdot_monto_gt75_m1", 0.041465),
        Term("inf_cons_ult_dias_ccredito", -0.000058756),
        Term("tc_prom_pmin_limcr_m1", 0.352326),
        Term("p_cant_atraso", 0.012349),
        Term("situacion_bancaria_woe", -0.001048),
        Term("inf_cant_dist_afi_ccred_u3m", 0.033786),
        Term("inf_cons_ult_dias_sf", -0.000165),
        Term("edad", -0.00154),
        Term("tc_svenc_sdot_gt0_u12m", 0.054837),
        Term("flag_judiciales", 0.416607),
        Term("distrito_woe", 0.393459),
        Term("ich_ch_re_cant_i_fond", 0.097004),
        Term("flag_saldo_vencido_ult_gt0", 0.111114),
        Term("inf_cons_cant_total_telco", 0.004891),
        Term("tc_close_total", -0.008784),
        Term("ips_flag_actividad", 0.011588),
    )),
    LinearModel(0, 0.216635, (
        Term("inf_cant_dist_afi_u6m", 0.030149),
        Term("inf_morce_cant_abiertas", 0.487934),
        Term("edad", -0.002178),
        Term("ich_cons_cant_total_recod", -0.005569),
        Term("flag_mnx", 0.067513),
        Term("inf_cons_cant_u1m", 0.028268),
        Term("flag_judiciales", 0.626119),
        Term("distrito_woe", -0.000669),
        Term("fecha_ult_cons_privdia", 0.0000000004646968),
        Term("inf_cant_dist_afi_telco_u12m", 0.024178),
        Term("inf_cons_ult_dias_sf", -0.000082265),
        Term("inf_cons_ult_dias_ccredito", -0.000050311),
        Term("casado", -0.027242),
        Term("ich_cons_cant_banco_admin", -0.023956),
        Term("inf_morce_cant_61_90_abiertas", 0.065592),
        Term("inf_cons_cant_telco_u1m", 0.024107),
    )),
)

SCALING = Scaling(points=1000.0, slope=2.018442623, offset=-179.6413934, lo=1, hi=999, knockout_score=-1)

BANDS = (
    Band("A", 805, 999),
    Band("B", 781, 805),
    Band("C", 763, 781),
    Band("D", 749, 763),
    Band("E", 733, 749),
    Band("F", 719, 733),
    Band("G", 708, 719),
    Band("H", 696, 708),
    Band("I", 684, 696),
    Band("J", 664, 684),
    Band("K", 606, 664),
    Band("L", 527, 606),
    Band("M", 432, 527),
    Band("N", 0, 432),
)
KNOCKOUT_BAND = "X"

PERSONAL_INPUTS = ("edad", "estado_civil", "distrito")

# ---------------------------------------------------------------------------


def two_card(marital_fixed: bool = False) -> Scorecard:
    card = Scorecard(
        name="two_card",
        keys=KEYS,
        knockout_inputs=KNOCKOUT_INPUTS,
        inputs=MODEL_INPUTS,
        text_columns=TEXT_COLUMNS,
        knockout=KNOCKOUT,
        sentinels=SENTINELS,
        numeric_text=NUMERIC_TEXT,
        consult_age=CONSULT_AGE,
        selector=SELECTOR,
        selector_default=SELECTOR_DEFAULT,
        imputes=IMPUTES,
        caps=CAPS,
        flags_before_impute=(PREVIOUS_BAND_FLAG,),
        derived=DERIVED,
        lookups=LOOKUPS,
        models=MODELS,
        scaling=SCALING,
        bands=BANDS,
        knockout_band=KNOCKOUT_BAND,
        personal_inputs=PERSONAL_INPUTS,
    )
    return card.with_caps(MARITAL_FIXED) if marital_fixed else card
