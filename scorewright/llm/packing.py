"""Operator 10: conflict-constrained best-fit packing.

Documents become pieces of at most ``capacity`` words.  Pieces go, longest first, into the tightest open bin that may
take them.  Open bins are kept ordered by residual; each carries bitmaps of its sources and of its clusters of equal
texts.  The search starts at the first residual that is large enough and goes on to the next larger one until the
bitmaps allow the piece: at most ``per_source`` documents of one source and one of a cluster of equal texts.

Defined results: null and empty texts have no words and get one piece of length 0, which occupies no bin (bin null); a null
source is a source of its own; repeated rows are packed one by one (equal texts never share a bin); an empty table
gives an empty result.  All pieces of one document but the last fill a bin each.  Rows of equal content are told apart by
a number only, so the same rows give the same bins however the input is partitioned.

``clusters`` may name wider classes (``doc_id, cluster``: near copies, say); of an id's several the least counts, and ids
that it does not name, null ones included, keep the class of their text.

Scale: equal rows are counted before any shuffle, then dealt to packing groups by a hash of their content and number, never by
source or cluster alone, so a hot source or cluster is spread evenly; the number of groups follows the row count, so that one
group stays near ``group_rows`` small rows (id, length, source, cluster: no texts).
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import arrow_schema, each_copy, map_batches, store, words

CAPACITY, PER_SOURCE, GROUP_ROWS = 2048, 4, 4096


def pack(lengths: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> list[int]:
    """Bin number of every piece (best fit decreasing); a piece longer than ``capacity`` is an error."""
    if lengths and max(lengths) > capacity:
        raise ValueError("a piece is longer than a bin")
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    cluster_bit = {c: 1 << i for i, c in enumerate(dict.fromkeys(clusters))}
    bins: list[tuple[int, int]] = []                # open bins as (residual, bin), ordered
    taken_sources: list[list[int]] = []             # per bin: bitmap k has the sources held more than k times
    taken_clusters: list[int] = []
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        size, s, c = lengths[i], source_bit[sources[i]], cluster_bit[clusters[i]]
        at = bisect_left(bins, (size, -1))
        while at < len(bins):                       # successors, tightest first
            b = bins[at][1]
            if not taken_sources[b][-1] & s and not taken_clusters[b] & c:
                break
            at += 1
        if at < len(bins):
            left, b = bins.pop(at)
        else:
            left, b = capacity, len(taken_clusters)
            taken_sources.append([0] * per_source)
            taken_clusters.append(0)
        taken_clusters[b] |= c
        planes = taken_sources[b]
        planes[next(k for k in range(per_source) if not planes[k] & s)] |= s
        if left > size:
            insort(bins, (left - size, b))
        out[i] = b
    return out


def measure(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id, n_words, source, cluster``; a cluster is the hash pair of an equal text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                    F.col(source_col).cast("string").alias("source"),
                    F.xxhash64(text).alias("cluster"), F.crc32(text.cast("binary")).alias("check"))
    return map_batches(src, "doc_id long, n_words long, source string, cluster long, check long", lambda: lambda r: {
        "doc_id": r["doc_id"], "n_words": [len(words(t)) for t in r["text"]], "source": r["source"],
        "cluster": r["cluster"], "check": r["check"]})


def best_fit_packing(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     capacity: int = CAPACITY, per_source: int = PER_SOURCE,
                     group_rows: int = GROUP_ROWS, clusters: DataFrame | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, first_word, n_words, source, cluster, pack_group, bin, bin_offset``."""
    content = ["doc_id", "n_words", "source", "cluster", "check"]
    rows = measure(df, id_col, text_col, source_col).groupBy(*content).agg(F.count(F.lit(1)).alias("n"))
    if clusters is not None:
        wider = (clusters.where("doc_id IS NOT NULL AND cluster IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                 .agg(F.min(F.col("cluster").cast("long")).alias("wider")))
        rows = rows.join(wider, "doc_id", "left").select(                # -1: no checksum of a text
            "doc_id", "n_words", "source", F.coalesce("wider", "cluster").alias("cluster"),
            F.when(F.col("wider").isNull(), F.col("check")).otherwise(F.lit(-1)).alias("check"), "n")
        rows = rows.groupBy(*content).agg(F.sum("n").alias("n"))         # texts of one length under one id
    rows = store(rows, "pack")
    groups = max(1, -(-(rows.agg(F.sum("n")).first()[0] or 0) // group_rows))
    dealt = each_copy(rows, "n", "row").drop("n").withColumn(
        "pack_group", F.pmod(F.xxhash64(*content, "row"), F.lit(groups)).cast("int"))

    schema = ("doc_id long, piece long, first_word long, n_words long, source string, cluster long, "
              "pack_group int, bin long, bin_offset long")
    target = arrow_schema(schema)

    def packed(rows: pa.Table) -> pa.Table:
        r = rows.to_pydict()
        order = sorted(range(rows.num_rows), key=lambda i: (
            r["n_words"][i], r["cluster"][i], r["check"][i], r["doc_id"][i] is None, r["doc_id"][i] or 0,
            r["source"][i] is None, r["source"][i] or "", r["row"][i]))
        full = {i: max((r["n_words"][i] - 1) // capacity, 0) for i in order}          # pieces that fill a bin alone
        rest = [i for i in order if r["n_words"][i]]
        bins = pack([r["n_words"][i] - full[i] * capacity for i in rest], [r["source"][i] for i in rest],
                    [(r["cluster"][i], r["check"][i]) for i in rest], capacity, per_source)
        used, made = {}, max(bins, default=-1) + 1
        out: list[tuple] = []
        for i, b in zip(rest, bins, strict=True):
            for k in range(full[i]):
                out.append((i, k, k * capacity, capacity, made, 0))
                made += 1
            size = r["n_words"][i] - full[i] * capacity
            out.append((i, full[i], full[i] * capacity, size, b, used.get(b, 0)))
            used[b] = used.get(b, 0) + size
        out += [(i, 0, 0, 0, None, None) for i in order if not r["n_words"][i]]
        cols = list(zip(*out, strict=True)) if out else [[]] * 6
        take = {c: [r[c][i] for i in cols[0]] for c in ("doc_id", "source", "cluster", "pack_group")}
        named = {**take, "piece": cols[1], "first_word": cols[2], "n_words": cols[3], "bin": cols[4], "bin_offset": cols[5]}
        return pa.Table.from_arrays([pa.array(named[f.name], f.type) for f in target], schema=target)

    return dealt.groupBy("pack_group").applyInArrow(packed, schema)
