"""Shared helpers of the text operators: words, word hashes, Arrow mapping, stored intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from scorewright.session import scratch_path

ROWS = 256                      # documents handled at once inside a task
COPIES = 4096                   # equal rows written out at once
CACHE_ENTRIES = 500_000         # entries of a per-task cache before it starts anew
BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (``bytes.split`` cuts at exactly these characters)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WordHash(dict):
    """word -> 64-bit hash; the same in every process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PIECE = 1 << 20                # bytes hashed at once
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((int(BASE), pow(int(BASE), -1, 1 << 64))):
            table = np.full(max(n, 2 * len(_powers[k])), base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of every word of ``raw``: a polynomial of its bytes, from one running sum over the text."""
    if len(raw) > _PIECE:
        at, out = 0, []
        while at < len(raw):
            end = min(len(raw), at + _PIECE)
            while end < len(raw) and not _SPACE[raw[end]]:
                end += 1
            out.append(_hash_piece(raw[at:end]))
            at = end
        return np.concatenate(out)
    return _hash_piece(raw)


def _hash_piece(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    gap = np.ones(len(b) + 2, bool)
    gap[1:-1] = _SPACE[b]
    start, end = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    power, inverse = _power_tables(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:len(b)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])


def text_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def sorted_set(h: np.ndarray) -> np.ndarray:
    s = np.sort(h)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser, so that the order of the hashes says nothing about their input."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int, base: np.uint64 = BASE) -> np.ndarray:
    """64-bit hash of every run of ``n`` word hashes (empty when there are fewer)."""
    if len(h) < n:
        return h[:0]
    m = len(h) - n + 1
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out = out * base + h[j:j + m]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def map_batches(df: DataFrame, schema: str, start: Callable[[], Callable[[dict], dict | None]],
                rows: int = ROWS) -> DataFrame:
    """``mapInArrow`` in slices of ``rows`` rows.  ``start()`` runs once a task and returns a function
    from a dict of column lists to a dict of output columns (None: no rows); a ``finish`` attribute of it is called
    at the end of the task and may return more rows."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows).to_pydict())
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)
        out = fn.finish() if hasattr(fn, "finish") else None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage and survives lost executors."""
    rows = store_at(df, scratch_path(df.sparkSession, f"llm-{name}"))
    free_shuffles(df.sparkSession)
    return rows


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of finished jobs when the driver collects its garbage, which a driver that plans
    little may not do for hours; asking for it here keeps the disks of the executors free of them."""
    spark.sparkContext._jvm.System.gc()


def store_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a scratch folder that the caller removes (``remove_folder``) when nothing reads it any more."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def each_copy(df: DataFrame, n: str, name: str) -> DataFrame:
    """A row that stands for ``n`` equal ones comes ``n`` times, numbered in ``name`` from 0.  Counts above ``COPIES`` are cut
    into chunks, which are dealt to all tasks before they are expanded: no task writes out a hot row alone."""
    last = F.col(n).cast("long") - 1
    few = df.where(F.col(n) <= COPIES).withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), last)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))       # a fixed number: these few bytes grow by COPIES
    chunks = (df.where(F.col(n) > COPIES).withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES).cast("long"))))
              .repartition(tasks, F.xxhash64(F.col(name))))
    many = chunks.withColumn(name, F.explode(F.sequence(F.col(name), F.least(F.col(name) + (COPIES - 1), last))))
    return few.unionByName(many)


def row_key(*columns) -> Column:
    """128 bits of the columns' values, nulls told apart from empty strings: names a row by its content."""
    parts = [F.when(F.col(c).isNull(), F.lit("-;")).otherwise(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"),
                                                                       F.col(c).cast("string"), F.lit(";"))) for c in columns]
    return F.md5(F.concat(*parts).cast("binary"))


def sample_rate(total: int, bound: int) -> float:
    """Share of rows that keeps a hash sample near ``bound`` rows."""
    return min(1.0, bound / max(1, total))


def hash_sample(df: DataFrame, column: str, rate: float) -> DataFrame:
    """Rows whose hashed id falls in the lowest ``rate`` of the hash range; the same rows every time."""
    if rate >= 1:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(column), F.lit(17)), F.lit(1 << 20)) < int(rate * (1 << 20)))
