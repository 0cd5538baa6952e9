"""Operator 4: repeated-phrase removal with Aho-Corasick automata.

A window is ``size`` consecutive words of a document.  Words covered by a window whose words also start earlier (smaller
id, or earlier in the same document) are removed; windows are judged on the input.

1. Equal word sequences are found by digest; all but the least id's copy are covered by that copy.
2. Every window has an anchor, its least ``anchor``-word phrase by hash, so equal windows have equal anchors.  Anchors
   that occur once cannot lie in a repeated window; the others mark the regions of text that may repeat.
3. Regions are dealt out by anchor (a hot anchor to several cells, by document).  There each window that recurs is
   confirmed on its words, with its first place; cells of one anchor are merged by a grouped minimum.
4. Each cell compiles the confirmed windows to an Aho-Corasick automaton over its own word alphabet and streams its
   regions through it; every hit that is not the first place covers its words.

Defined results: null and empty texts have no words and lose none; texts shorter than a window lose none; rows that
share an id are one document for the order, so neither is earlier than the other at the same place; rows with a null
id come after all others and among themselves count as one document; an empty table gives no rows; other columns are
ignored.

Scale: what moves is one hash for each anchor (about 2 in 14 words), and the texts of regions that repeat.  Cells hold at
most about ``cell_rows`` regions; nothing is capped.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import arrow_schema, map_batches, ngram_hashes, signed, store, text_bytes, word_hashes, words

SIZE, ANCHOR, CELL_ROWS, SHARD_ROWS = 20, 8, 1000, 4000
SPAN = "doc_id long, row_key long, start int, end int"
LAST = (1 << 63) - 1            # order of rows without an id


def window_anchors(grams: np.ndarray, size: int, anchor: int) -> np.ndarray:
    """Hash of the anchor of every window of ``size`` words, from the hashes of all ``anchor``-word phrases."""
    wide = size - anchor + 1                       # anchors of a window
    if len(grams) < wide:
        return grams[:0]
    out, have = grams, 1
    while 2 * have <= wide:                        # sliding minimum by doubling
        out = np.minimum(out[:len(out) - have], out[have:])
        have *= 2
    rest = wide - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(values)]])


def row_key(h: np.ndarray) -> int:
    """With the id, tells rows with different words apart; ``h`` are the hashes of its words."""
    return xxhash.xxh3_64_intdigest(h.tobytes()) >> 1


def row_key_column(text):
    """``row_key`` of a text column."""
    @F.pandas_udf("long")
    def key(texts: pd.Series) -> pd.Series:
        return pd.Series([row_key(word_hashes(text_bytes(t))) for t in texts], dtype="int64")
    return key(text)


def whole(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, n_words, d1, d2, kept_sha256``: word sequence digest and the result if nothing is removed."""
    def start():
        def run(r: dict) -> dict:
            out: dict = {c: [] for c in ("row_key", "n_words", "d1", "d2", "kept_sha256")}
            for t in r["text"]:
                w = words(t)
                joined = b" ".join(w)
                sha = hashlib.sha256(joined).hexdigest()
                out["row_key"].append(row_key(word_hashes(joined)))
                out["n_words"].append(len(w))
                out["d1"].append(int(sha[:15], 16))
                out["d2"].append(int(sha[15:30], 16))
                out["kept_sha256"].append(sha)
            return {"doc_id": r["doc_id"], **out}
        return run
    return map_batches(docs, "doc_id long, row_key long, n_words long, d1 long, d2 long, kept_sha256 string", start)


def anchors(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    """``anchor, doc_id, at, n``: one row for each run of windows with the same anchor; ``n`` is 2 where the phrase
    stands in the document again (perhaps in the same run), else 1."""
    def start():
        def run(r: dict) -> dict | None:
            hs, ids, ats, ns = [], [], [], []
            for i, t in zip(r["doc_id"], r["text"], strict=True):
                grams = ngram_hashes(word_hashes(text_bytes(t)), anchor)
                a = window_anchors(grams, size, anchor)
                if len(a):
                    begin, _ = runs(a)
                    hs.append(a[begin])
                    ids.append(np.full(len(begin), i, np.int64))
                    ats.append(begin)
                    s = np.sort(grams)
                    twice = s[1:][s[1:] == s[:-1]]
                    ns.append(1 + np.isin(a[begin], twice) if len(twice) else np.ones(len(begin), np.int8))
            if not hs:
                return None
            return {"anchor": signed(np.concatenate(hs)), "doc_id": np.concatenate(ids), "at": np.concatenate(ats).astype(np.int32),
                    "n": np.concatenate(ns).astype(np.int8)}
        return run
    return map_batches(docs, "anchor long, doc_id long, at int, n tinyint", start)


def regions(marked: DataFrame, size: int, anchor: int) -> DataFrame:
    """``anchor, cells, doc_id, row_key, at, region``: the words that the windows of each marked run cover.  ``marked``
    has ``doc_id, text, marks`` (array of ``at, anchor, cells`` of the id)."""
    def start():
        def run(r: dict) -> dict:
            out: dict = {c: [] for c in ("anchor", "cells", "doc_id", "row_key", "at", "region")}
            for i, t, marks in zip(r["doc_id"], r["text"], r["marks"], strict=True):
                w, h = words(t), word_hashes(text_bytes(t))
                a = window_anchors(ngram_hashes(h, anchor), size, anchor)
                if not len(a):
                    continue
                begin, end = runs(a)
                named, key = signed(a[begin]), row_key(h)
                for m in marks:
                    k = int(np.searchsorted(begin, m["at"]))
                    if k < len(begin) and begin[k] == m["at"] and named[k] == m["anchor"]:
                        out["anchor"].append(m["anchor"])
                        out["cells"].append(m["cells"])
                        out["doc_id"].append(i)
                        out["row_key"].append(key)
                        out["at"].append(m["at"])
                        out["region"].append(b" ".join(w[m["at"]:int(end[k]) + size - 1]).decode("utf-8", "surrogatepass"))
            return out
        return run
    return map_batches(marked, "anchor long, cells int, doc_id long, row_key long, at int, region string", start)


def confirm(table: pa.Table, size: int) -> dict:
    """Of each cell's windows: key, number of places and the first of them."""
    r = table.to_pydict()
    found: dict[tuple, list] = {}
    for a, cell, i, at, text in sorted(zip(r["anchor"], r["cell"], r["doc_id"], r["at"], r["region"], strict=True), key=lambda x: x[2:4]):
        w = text.split(" ")
        for k in range(len(w) - size + 1):
            key = (a, cell, " ".join(w[k:k + size]))
            if key in found:
                found[key][0] += 1
            else:
                found[key] = [1, i, at + k]
    return found


def window_key(window: str) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(window.encode("utf-8", "surrogatepass"))
    hi, lo = d >> 64, d & ((1 << 64) - 1)
    return (hi - (1 << 64) if hi >> 63 else hi), (lo - (1 << 64) if lo >> 63 else lo)


class Automaton:
    """Aho-Corasick over word sequences: each word of the patterns is one character of a private alphabet."""

    def __init__(self, patterns: dict[str, tuple]):
        self.alphabet: dict[str, str] = {}
        self.machine = ahocorasick.Automaton()
        for window, value in patterns.items():
            self.machine.add_word("".join(map(self._letter, window.split(" "))), value)
        self.machine.make_automaton()

    def _letter(self, word: str) -> str:
        letter = self.alphabet.get(word)
        if letter is None:
            k = len(self.alphabet) + 1
            letter = self.alphabet[word] = chr(k if k < 0xD800 else k + 0x800)
        return letter

    def hits(self, tokens: list[str]):
        """(index of the last word, value) of every occurrence of every pattern."""
        get = self.alphabet.get
        return self.machine.iter("".join([get(w, "\0") for w in tokens]))


def covered(table: pa.Table, firsts: dict | None, size: int) -> list[tuple[int, int, int, int]]:
    """``doc_id, row_key, start, end`` of word runs to remove: the regions of each cell streamed through its automaton.
    ``firsts`` has the first place of each recurring window by cell and key; without it the cells are whole and are
    confirmed here."""
    r = table.to_pydict()
    by: dict[tuple, list[int]] = {}
    for k, key in enumerate(zip(r["anchor"], r["cell"], strict=True)):
        by.setdefault(key, []).append(k)
    recur: dict[tuple, dict] = {}
    if firsts is None:
        for (a, c, window), (n, i, at) in confirm(table, size).items():
            if n > 1:
                recur.setdefault((a, c), {})[window] = (i, at)
    out = []
    for cell, rows in by.items():
        tokens = {k: r["region"][k].split(" ") for k in rows}
        patterns = recur.get(cell, {})
        if firsts and (known := firsts.get(cell)):
            windows = {" ".join(w[x:x + size]) for w in tokens.values() for x in range(len(w) - size + 1)}
            patterns = {w: first for w in windows if (first := known.get(window_key(w)))}
        if not patterns:
            continue
        machine = Automaton(patterns)
        for k, w in tokens.items():
            i, key, at, span = r["doc_id"][k], r["row_key"][k], r["at"][k], None
            for end, first in machine.hits(w):
                begin = at + end - size + 1
                if (i, begin) > first:
                    if span and begin <= span[1]:
                        span[1] = begin + size
                    else:
                        if span:
                            out.append((i, key, *span))
                        span = [begin, begin + size]
            if span:
                out.append((i, key, *span))
    return out


def repeated(df: DataFrame, size: int = SIZE, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text",
             cell_rows: int = CELL_ROWS, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(docs, rows, spans): the documents as ``doc_id, text`` (null ids as ``LAST``); ``doc_id, row_key, n_words,
    kept_sha256, copy`` of every row; and ``doc_id, row_key, spans`` (word runs to remove) of those that are no copies."""
    if not 0 < anchor <= size:
        raise ValueError("anchor must be between 1 and size")
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"), F.col(text_col).alias("text"))
    rows = store(whole(docs), "whole")
    heads = rows.where(F.col("n_words") >= size).groupBy("d1", "d2").agg(F.min("doc_id").alias("head"))
    rows = store(rows.join(heads, ["d1", "d2"], "left")
                 .select("doc_id", "row_key", "n_words", "kept_sha256", F.coalesce(F.col("head") < F.col("doc_id"), F.lit(False)).alias("copy")), "rows")
    places = store(anchors(docs, size, anchor), "anchors")
    often = (places.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
             .select("anchor", F.ceil(F.col("n") / cell_rows).cast("int").alias("cells")))
    plain = rows.where("NOT copy").select("doc_id").distinct()
    # ids of which every row is a copy need no further look
    gone = rows.where("copy").select("doc_id").distinct().join(plain, "doc_id", "left_anti")
    marks = store(places.drop("n").join(often, "anchor").join(gone, "doc_id", "left_anti").distinct().groupBy("doc_id")
                  .agg(F.collect_list(F.struct("at", "anchor", "cells")).alias("marks")), "marks")        # of one document
    found = regions(docs.join(marks.hint("merge"), "doc_id"), size, anchor)
    cell = F.pmod(F.xxhash64("doc_id", "row_key"), F.col("cells")).cast("int")
    found = store(found.select("anchor", "cells", cell.alias("cell"), "doc_id", "row_key", "at", "region"), "regions")
    shards = max(1, -(-found.count() // shard_rows))
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("anchor", "cell"), F.lit(shards)).cast("int"))
    alone, split = dealt.where("cells = 1"), dealt.where("cells > 1")
    span_type = arrow_schema(SPAN)

    def spans_of(rows: pa.Table, firsts: dict | None) -> pa.Table:
        got = covered(rows, firsts, size)
        return pa.Table.from_arrays([pa.array([g[k] for g in got], f.type) for k, f in enumerate(span_type)], schema=span_type)

    # an anchor in one cell: its windows are confirmed and located in one go
    single = alone.groupBy("shard").applyInArrow(lambda rows: spans_of(rows, None), SPAN)
    # an anchor in several: confirmed in each cell, merged, and the first places taken back to the cells
    schema = "shard int, anchor long, cell int, k1 long, k2 long, n long, first_doc long, first_at int"
    target = arrow_schema(schema)

    def confirmed(rows: pa.Table) -> pa.Table:
        shard_of = rows.column("shard")[0].as_py() if rows.num_rows else 0
        out = [(shard_of, a, c, *window_key(w), *v) for (a, c, w), v in confirm(rows, size).items()]
        return pa.Table.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(target)], schema=target)

    windows = store(split.groupBy("shard").applyInArrow(confirmed, schema), "windows")
    first = (windows.groupBy("anchor", "k1", "k2").agg(F.sum("n").alias("n"), F.min(F.struct("first_doc", "first_at")).alias("first"))
             .where("n > 1").select("anchor", "k1", "k2", "first"))
    recurring = windows.select("shard", "anchor", "cell", "k1", "k2").join(first, ["anchor", "k1", "k2"]).select(
        "shard", "anchor", "cell", "k1", "k2", "first.first_doc", "first.first_at")

    def located(rows: pa.Table, known: pa.Table) -> pa.Table:
        firsts: dict[tuple, dict] = {}
        for a, c, k1, k2, i, at in zip(*(known.column(x).to_pylist() for x in ("anchor", "cell", "k1", "k2", "first_doc", "first_at")), strict=True):
            firsts.setdefault((a, c), {})[k1, k2] = (i, at)
        return spans_of(rows, firsts)

    several = split.groupBy("shard").cogroup(recurring.groupBy("shard")).applyInArrow(located, SPAN)
    spans = store(single.unionByName(several).distinct(), "spans")
    return docs, rows, spans.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))   # of one document


def drop_spans(text: str | None, spans: list) -> list[bytes]:
    w = words(text)
    keep = np.ones(len(w), bool)
    for s in spans:
        keep[s["start"]:s["end"]] = False
    return [x for x, k in zip(w, keep.tolist(), strict=True) if k]


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, row_key, n_kept, left_sha256, kept``: what is left of the rows that lose words."""
    def start():
        def run(r: dict) -> dict:
            out: dict = {c: [] for c in ("doc_id", "row_key", "n_kept", "left_sha256", "kept")}
            for i, t, marks in zip(r["doc_id"], r["text"], r["marks"], strict=True):
                key = row_key(word_hashes(text_bytes(t)))
                for own in (m["spans"] for m in marks if m["row_key"] == key):
                    left = drop_spans(t, own)
                    kept = b" ".join(left)
                    for c, v in zip(out, (i, key, len(left), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")), strict=True):
                        out[c].append(v)
            return out
        return run
    marks = spans.groupBy("doc_id").agg(F.collect_list(F.struct("row_key", "spans")).alias("marks"))
    schema = "doc_id long, row_key long, n_kept long, left_sha256 string, kept string"
    return map_batches(docs.join(marks.hint("merge"), "doc_id"), schema, start).dropDuplicates(["doc_id", "row_key"])


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def substring_dedup(df: DataFrame, size: int = SIZE, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, n_words, n_removed, kept_sha256, kept`` for every row; ``kept`` is the text that is left, its
    words joined by one space, and null where nothing is removed."""
    docs, rows, spans = repeated(df, size, anchor, id_col, text_col)
    joined = rows.join(cut(docs, spans), ["doc_id", "row_key"], "left")
    n_kept = F.when(F.col("copy"), F.lit(0)).otherwise(F.coalesce("n_kept", "n_words"))
    return joined.select(
        F.nullif(F.col("doc_id"), F.lit(LAST)).alias("doc_id"), "row_key", "n_words",
        (F.col("n_words") - n_kept).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY_SHA256)).otherwise(F.coalesce("left_sha256", "kept_sha256")).alias("kept_sha256"),
        F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"))
