"""Column layouts of the published tables (derived from the published DDL and INSERT lists)."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType)

from scorewright.models.two_card import two_card

_CARD = two_card()
SOURCE = _CARD.source_columns()                      # 55: keys + knock-out counts + model inputs
RAW = SOURCE + ["score_pos", "flow_pos"]             # 57: the landed / raw table
STAGING = (SOURCE[:SOURCE.index("estado_civil") + 1] + ["sexo"] + SOURCE[SOURCE.index("estado_civil") + 1:]
           + ["score_pos", "flow_pos", "archv", "time_stamp"])                      # 60
SLIM = ["infocheck_id", "informconf_id", "pers_id", "tipo_doc_id", "edad", "max_flow", "sexo",
        "fecha_obs", "score_pos", "flow_pos", "archv", "time_stamp"]                 # 12
TOKENIZED = {"infocheck_id": "numeric_id", "informconf_id": "numeric_id",
             "pers_id": "person_id"}   # token domain of each key column

_INT = {"tipo_doc_id", "scorecard", "edad", "estado_civil", "ips_flag_actividad", "inf_cons_ult_dias_ccredito",
        "inf_cons_ult_dias_sf", "situacion_bancaria", "tc_primera_act", "score_pos", "archv"}
_DOUBLE = {"g_max_venc_ten_36", "tc_prom_pmin_limcr_m1"}
_STRING = {"infocheck_id", "informconf_id", "pers_id", "distrito", "ich_fecha_ult_cons_priv", "max_flow",
           "tc_max_dias_atraso_u6m", "fecha_obs", "flow_pos", "sexo", "time_stamp"}


def _type(name: str):
    if name in _INT:
        return IntegerType()
    if name in _DOUBLE:
        return DoubleType()
    if name in _STRING:
        return StringType()
    return LongType()


def schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, _type(c), True) for c in columns])


RAW_SCHEMA = schema(RAW)
