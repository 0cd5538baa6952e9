"""Land scored rows as ``|``-delimited text (header, empty = null, Latin-1) and read them
back with the fixed 57-column schema.

Two dialects.  ``QUOTED`` (the default) keeps RFC 4180 quoting (``"`` doubled) on both sides, so a value holding the
separator, a quote or a line break survives the round trip.  ``PLAIN`` is the text table's own form: no quoting, one line
a row.  Empty strings are written empty and read back as null.  Letters outside the charset are errors of the write.

A damaged line (too few or too many fields, text where a number belongs) ends no run: :func:`read_text` keeps it, whole,
in ``bad_line`` beside ``bad_file``, and :func:`scorewright.plans.job.run_archive` counts such lines while it stages the
good rows, puts them into the reject table, and stops when their share exceeds its limit.  The registered table reads on over
them, as the published one does: fields that cannot be read are null.

Paths must be in a shared folder (see :func:`scorewright.session.shared_root`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scorewright.plans.layout import RAW, RAW_SCHEMA

_COMMON = {"sep": "|", "header": "true", "nullValue": "", "emptyValue": "", "encoding": "ISO-8859-1"}
QUOTED = {**_COMMON, "quote": '"', "escape": '"', "multiLine": "true"}
PLAIN = {**_COMMON, "quote": "", "escape": "\x00"}          # the reader has no "no escape": a character that text lacks
DIALECTS = {"quoted": QUOTED, "plain": PLAIN}
BAD_LINE, BAD_FILE = "bad_line", "bad_file"


def land_text(df: DataFrame, path: str, dialect: str = "quoted") -> str:
    """Write (replacing) one landing directory, e.g. ``.../data/archive=<a>``."""
    options = DIALECTS[dialect]
    charset = options["encoding"]
    kinds = dict(df.dtypes)
    # encode() raises on a letter the charset lacks; the CSV writer would put a question mark in its place
    checked = [F.decode(F.encode(F.col(c), charset), charset).alias(c) if kinds[c] == "string" else F.col(c) for c in RAW]
    df.select(*checked).write.mode("overwrite").options(**options).csv(path)
    return path


def read_text(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, dialect: str = "quoted", strict: bool = False) -> DataFrame:
    """The columns of ``schema``, then ``bad_line`` (null for a sound row) and ``bad_file``.  ``strict``: the columns alone,
    and a damaged line is an error."""
    reader = spark.read.options(**DIALECTS[dialect])
    if strict:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    wide = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    rows = reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).csv(path)
    return rows.select(*schema.names, BAD_LINE, F.when(F.col(BAD_LINE).isNotNull(), F.col("_metadata.file_path")).alias(BAD_FILE))


def damaged_lines(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, dialect: str = "quoted") -> DataFrame:
    """The damaged lines of a landed folder: their file, their first field as it was read, how many fields hold a value that
    could be read, the whole line.  The reader converts only fields that are asked for and judges a line by them, so the
    condition on that count makes this the same judgement as that of a read of all columns, whatever is selected later."""
    rows = read_text(spark, path, schema, dialect)
    read = sum((F.col(c).isNotNull().cast("int") for c in schema.names), F.lit(0))
    return rows.where(F.col(BAD_LINE).isNotNull() & (read >= 0)).select(BAD_FILE, schema.names[0], read.alias("fields_read"), BAD_LINE)


def register_text_table(spark: SparkSession, table: str, path: str, schema: StructType = RAW_SCHEMA, dialect: str = "quoted") -> None:
    """External text table over a landing directory (drop and recreate: a full refresh)."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="csv", schema=schema, **DIALECTS[dialect], mode="PERMISSIVE")
