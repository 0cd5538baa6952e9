"""Operator 6: n-gram Jaccard join over prefix trees.

A document's set is that of its distinct ``n``-word shingles (A-Z lower-cased).  All sets are held in one global order:
common shingles last, the rest by hash.  Two sets that are similar enough share a shingle in their prefixes, so the
trie is dealt out by prefix shingle: under each one stand the ordered continuations of its documents.  A traversal of
such a subtree shares the overlap of a common path, and prunes branches by what the remaining lengths allow (and
single pairs by parity bitmaps, another exact bound).  Surviving pairs are counted exactly.

Equal sets are one vertex.  Sets that share their least shingle by one of two hashes are spanned by their
nearest links first, so that the traversals only cross groups that are not yet connected: more links inside one change
nothing.

Defined results: null and empty texts have an empty set, linked with nothing, and are their own component; so is a row
with a null id (its component is null); fewer than ``n`` words make one shingle; rows that share an id are one document,
linked where any of them is; ties need no order; an empty table gives no rows; other columns are ignored.

Scale: texts are never grouped.  What moves are prefix shingles (about 1 - threshold of all), and pairs that survived.
A prefix shingle with more than ``block`` documents is dealt out as pairs of blocks; nothing is capped or dropped.
The list of common shingles (at most ``HEAVY``) only fixes the order: any list gives the same links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import arrow_schema, map_batches, mix, ngram_hashes, signed, sorted_set, store, text_bytes, word_hashes
from scorewright.llm.components import components

HEAVY, HEAVY_CHUNK, HEAVY_SEEN = 65_536, 1_000_000, 4
BLOCK, SHARD_ROWS, PATH, MAX_BITS, LEAF = 1024, 20_000, 16, 1024, 12
SECOND = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    h = word_hashes(text_bytes(text).lower())
    return sorted_set(ngram_hashes(h, min(n, len(h)))) if len(h) else h


def ordered(s: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set in the global order: rare shingles by hash, then the common ones, the most common last."""
    if not len(heavy):
        return s
    at = np.searchsorted(heavy, s)
    at[at == len(heavy)] = 0
    common = heavy[at] == s
    if not common.any():
        return s
    late = s[common]
    return np.concatenate([s[~common], late[np.argsort(rank[at[common]], kind="stable")]])


def prefix_length(n: int, share: int) -> int:
    """Shingles of which a similar set has at least one (``share`` in per cent)."""
    return n - -(-share * n // 100) + 1


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap: the symmetric difference of two sets is at least as large as that of their bitmaps."""
    bits = 64
    while bits < min(MAX_BITS, 4 * len(s)):
        bits *= 2
    out = np.zeros(bits, np.uint8)
    np.bitwise_xor.at(out, (s & np.uint64(bits - 1)).astype(np.int64), 1)
    return np.packbits(out, bitorder="little").view(np.uint64)


def fold(b: np.ndarray, size: int) -> np.ndarray:
    while len(b) > size:
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return b


class Subtree:
    """The documents of one size class below one prefix shingle, as a trie of their continuations (four bytes a step).
    ``guest``: documents of the size class below; pairs of two guests are found there."""

    def __init__(self, n: np.ndarray, pos: np.ndarray, paths: list[bytes], maps: list[np.ndarray], groups: np.ndarray,
                 guest: np.ndarray, share: int):
        order = sorted(range(len(n)), key=paths.__getitem__)
        self.order = np.array(order)
        self.paths = [paths[i] for i in order]
        self.n, self.rem, self.groups, self.guest = n[order], (n - pos - 1)[order], groups[order], guest[order]
        sizes = np.array([len(maps[i]) for i in order])
        self.sizes = sizes
        self.maps = {k: np.array([fold(maps[i], k) if len(maps[i]) >= k else np.zeros(k, np.uint64) for i in order])
                     for k in np.unique(sizes).tolist()}
        self.share = share
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def pairs(self) -> list[tuple[int, int]]:
        """Positions (in the input) of the pairs that no bound rules out."""
        stack = [(0, len(self.n), 0)]
        while stack:
            lo, hi, depth = stack.pop()
            if hi - lo < 2 or (self.groups[lo:hi] == self.groups[lo]).all() or self.guest[lo:hi].all():
                continue
            if self._hopeless(lo, hi, lo, hi, depth):
                continue
            at = lo
            while at < hi:
                token = self.paths[at][4 * depth:4 * depth + 4]
                end = at + 1
                while token and end < hi and self.paths[end][4 * depth:4 * depth + 4] == token:
                    end += 1
                if end - at > 1:
                    stack.append((at, end, depth + 1))
                if end < hi:
                    self._cross(at, end, hi, depth)
                at = end
        return [(int(self.order[i]), int(self.order[j])) for a, b in self.found for i, j in zip(a, b, strict=True)]

    def _hopeless(self, a: int, b: int, c: int, d: int, depth: int) -> bool:
        """No pair of the branches can overlap enough: shared path plus the shorter remaining length."""
        most = 1 + depth + max(0, min(self.rem[a:b].max(), self.rem[c:d].max()) - depth)
        return (100 + self.share) * most < self.share * (self.n[a:b].min() + self.n[c:d].min())

    def _cross(self, a: int, b: int, hi: int, depth: int) -> None:
        """Pairs of the branch [a, b) with its later siblings [b, hi): they share the path down to ``depth``."""
        if self._hopeless(a, b, b, hi, depth):
            return
        for lo in range(a, b, 64):
            i = np.arange(lo, min(b, lo + 64))
            both = self.n[i, None] + self.n[None, b:hi]
            most = 1 + depth + np.maximum(0, np.minimum(self.rem[i, None], self.rem[None, b:hi]) - depth)
            ok = ((100 + self.share) * most >= self.share * both) & (self.groups[i, None] != self.groups[None, b:hi]) & ~(self.guest[i, None] & self.guest[None, b:hi])
            x, y = np.nonzero(ok)
            if len(x):
                self._bits(i[x], y + b)

    def _bits(self, x: np.ndarray, y: np.ndarray) -> None:
        least = np.minimum(self.sizes[x], self.sizes[y])
        for k, maps in self.maps.items():
            own = np.flatnonzero(least == k)
            for lo in range(0, len(own), 1 << 15):
                p, q = x[own[lo:lo + (1 << 15)]], y[own[lo:lo + (1 << 15)]]
                apart = np.bitwise_count(maps[p] ^ maps[q]).sum(1, dtype=np.int64)
                ok = (100 + self.share) * apart <= (100 - self.share) * (self.n[p] + self.n[q])
                if ok.any():
                    self.found.append((p[ok], q[ok]))


def leaf_pairs(rows: list[tuple], share: int) -> list[tuple[int, int]]:
    """The same for a subtree of few documents, ``(id, component, n, rest, guest, map)``, pair by pair."""
    out = []
    for x, (a, group, n, rest, guest, held) in enumerate(rows):
        for b, other, m, more, too, also in rows[x + 1:]:
            if group != other and not (guest and too) and (100 + share) * min(rest, more) >= share * (n + m):
                p, q = np.frombuffer(held, np.uint64), np.frombuffer(also, np.uint64)
                size = min(len(p), len(q))
                apart = int.from_bytes(fold(p, size).tobytes()) ^ int.from_bytes(fold(q, size).tobytes())
                if (100 + share) * apart.bit_count() <= (100 - share) * (n + m):
                    out.append((min(a, b), max(a, b)))
    return out


def common_shingles(docs: DataFrame, n: int) -> list[tuple[int, int]]:
    """(hash, count) of shingles that repeat within chunks of the documents; at most ``HEAVY``, most common last."""
    def start():
        held, size = [], [0]

        def flush() -> dict | None:
            if not held:
                return None
            value, count = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            size[0] = 0
            on = count >= HEAVY_SEEN
            return {"h": signed(value[on]), "n": count[on]}

        def run(r: dict) -> dict | None:
            for t in r["text"]:
                held.append(shingles(t, n))
                size[0] += len(held[-1])
            return flush() if size[0] >= HEAVY_CHUNK else None
        run.finish = flush
        return run

    rows = (map_batches(docs.select("text"), "h long, n long", start).groupBy("h").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= 4 * HEAVY_SEEN).orderBy(F.desc("n"), "h").limit(HEAVY).collect())
    return [(r["h"], r["n"]) for r in reversed(rows)]


def order_arrays(common: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    h = np.array([x for x, _ in common], np.int64).view(np.uint64)
    at = np.argsort(h)
    return h[at], at


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, first, second``: set size, set digest and the least of two hashes of its shingles."""
    def start():
        def run(r: dict) -> dict:
            out: dict = {c: [] for c in ("n_shingles", "d1", "d2", "first", "second")}
            for t in r["text"]:
                s = shingles(t, n)
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                out["n_shingles"].append(len(s))
                least = (int(s[0]), int(mix(s ^ SECOND).min())) if len(s) else (0, 0)
                for c, v in (("d1", d >> 64), ("d2", d & ((1 << 64) - 1)), ("first", least[0]), ("second", least[1])):
                    out[c].append(v - (1 << 64) if v >> 63 else v)
            return {"doc_id": r["doc_id"], **out}
        return run
    return map_batches(docs, "doc_id long, n_shingles long, d1 long, d2 long, first long, second long", start)


def prefixes(docs: DataFrame, n: int, share: int, order) -> DataFrame:
    """``doc_id, token, pos, digest``: one row for each shingle of a document's prefix."""
    def start():
        heavy, rank = order.value

        def run(r: dict) -> dict | None:
            ids, tokens, places, digests = [], [], [], []
            for i, t in zip(r["doc_id"], r["text"], strict=True):
                s = shingles(t, n)
                if len(s):
                    p = ordered(s, heavy, rank)[:prefix_length(len(s), share)]
                    tokens.append(p)
                    places.append(np.arange(len(p), dtype=np.int32))
                    ids.append(np.full(len(p), i, np.int64))
                    digests.append(np.full(len(p), xxhash.xxh64_intdigest(s.tobytes()), np.uint64))
            if not ids:
                return None
            return {"doc_id": np.concatenate(ids), "token": signed(np.concatenate(tokens)), "pos": np.concatenate(places),
                    "digest": signed(np.concatenate(digests))}
        return run
    return map_batches(docs, "doc_id long, token long, pos int, digest long", start)


def branches(docs: DataFrame, n: int, share: int, order) -> DataFrame:
    """``shard, token, class, i, j, guest, doc_id, component, n, pos, path, map``: what follows a document's prefix
    shingles in the trie.  ``docs`` has ``doc_id, component, text, cells`` (the first columns: where it stands)."""
    def start():
        heavy, rank = order.value

        def run(r: dict) -> dict:
            out: dict = {c: [] for c in ("shard", "token", "class", "i", "j", "guest", "doc_id", "component", "n", "pos", "path", "map")}
            for doc, group, t, cells in zip(r["doc_id"], r["component"], r["text"], r["cells"], strict=True):
                s = shingles(t, n)
                p = ordered(s, heavy, rank)[:prefix_length(len(s), share)] if len(s) else s
                at = {v: k for k, v in enumerate(signed(p).tolist())}
                path, held = (p >> np.uint64(32)).astype(np.uint32).tobytes(), bitmap(s).tobytes()
                for c in cells:
                    if (k := at.get(c["token"])) is not None:
                        row = (c["shard"], c["token"], c["class"], c["i"], c["j"], c["guest"], doc, group, len(s), k,
                               path[4 * (k + 1):4 * (k + 1 + PATH)], held)
                        for name, v in zip(out, row, strict=True):
                            out[name].append(v)
            return out
        return run
    return map_batches(docs, "shard int, token long, class int, i int, j int, guest boolean, doc_id long, component long, n long, pos int, "
                       "path binary, map binary", start)


def sets_of(docs: DataFrame, n: int, shards: str = "array<int>") -> DataFrame:
    """``doc_id, shards, shingles``: the sorted set as bytes."""
    def start():
        return lambda r: {"doc_id": r["doc_id"], "shards": r["shards"], "shingles": [shingles(t, n).tobytes() for t in r["text"]]}
    return map_batches(docs.select("doc_id", "shards", "text"), f"doc_id long, shards {shards}, shingles binary", start)


def linked(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, n: int, share: int, block: int = 512, shard_rows: int = 2000) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough, counted exactly.  ``sizes`` has ``doc_id, own`` (size class).

    Sets are moved to the pairs by cell, not by pair: the documents of a connected group of pairs are dealt to size
    classes (a pair belongs to its larger one) and blocks, and a pair of blocks that has pairs is a cell, which gets
    every set it needs once."""
    pairs = store(pairs, "pairs")
    group = components(pairs).join(sizes.select(F.col("doc_id").alias("id"), "own"), "id")
    parts = F.ceil(F.col("size") / block).cast("int")
    many = group.groupBy("component", "own").agg(F.count(F.lit(1)).alias("size")).select("component", "own", parts.alias("parts"))
    place = store(group.join(many, ["component", "own"]).select(
        "id", "component", "own", F.pmod(F.xxhash64("id", F.lit(29)), F.col("parts")).cast("int").alias("block")), "blocks")
    of_a = place.select(F.col("id").alias("a"), F.col("component"), F.struct("own", "block").alias("x"))
    of_b = place.select(F.col("id").alias("b"), F.struct("own", "block").alias("y"))
    cells = store(pairs.join(of_a, "a").join(of_b, "b").select("component", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "a", "b"), "pair-cells")
    key = ["component", "i", "j"]
    need = cells.select(*key, F.col("a").alias("doc_id")).union(cells.select(*key, "b")).distinct()
    need = store(need, "needed")
    shards = max(1, -(-need.count() // shard_rows) * 4)
    shard = F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int").alias("shard")
    of_doc = need.groupBy("doc_id").agg(F.collect_set(shard).alias("shards"))      # at most the blocks of its group
    sets = sets_of(docs.join(of_doc.hint("merge"), "doc_id"), n).select("doc_id", "shingles", F.explode("shards").alias("shard"))
    schema = arrow_schema("a long, b long")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        held: dict[int, list[np.ndarray]] = {}
        for i, raw in zip(right.column("doc_id").to_pylist(), right.column("shingles").to_pylist(), strict=True):
            held.setdefault(i, []).append(np.frombuffer(raw, np.uint64))
        out = []
        for a, b in zip(left.column("a").to_pylist(), left.column("b").to_pylist(), strict=True):
            if any(similar(x, y, share) for x in held.get(a, ()) for y in held.get(b, ())):
                out.append((a, b))
        return pa.Table.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], schema=schema)

    return (cells.withColumn("shard", shard).groupBy("shard").cogroup(sets.groupBy("shard")).applyInArrow(count, "a long, b long").distinct())


def nearest_links(roots: DataFrame, docs: DataFrame, n: int, share: int, block: int = BLOCK, shard_rows: int = 4000) -> DataFrame:
    """Links ``a, b`` that span each subtree of ``token, head`` rows, nearest pairs first, counted exactly.  Subtrees of
    several blocks span each block and join it to the first: what that misses is found among all shingles."""
    parts = F.ceil(F.col("size") / block).cast("int")
    sizes = roots.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("token", parts.alias("parts"))
    own = F.pmod(F.xxhash64("head", F.lit(31)), F.col("parts")).cast("int")
    cells = F.when(F.col("own") > 0, F.array("own")).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = store(roots.join(sizes, "token").withColumn("own", own).select("token", "head", F.explode(cells).alias("i")), "roots")
    shards = max(1, -(-dealt.count() // shard_rows) * 4)
    cell = F.struct("token", "i", F.pmod(F.xxhash64("token", "i"), F.lit(shards)).cast("int").alias("shard"))
    of_doc = dealt.groupBy(F.col("head").alias("doc_id")).agg(F.collect_list(cell).alias("shards"))
    sets = sets_of(docs.join(of_doc.hint("merge"), "doc_id"), n, "array<struct<token:bigint,i:int,shard:int>>")
    rows = sets.select("doc_id", "shingles", F.inline("shards"))
    schema = arrow_schema("a long, b long")

    def span(table: pa.Table) -> pa.Table:
        r = table.to_pydict()
        by: dict[tuple, dict[int, np.ndarray]] = {}
        for k, key in enumerate(zip(r["token"], r["i"], strict=True)):
            by.setdefault(key, {})[r["doc_id"][k]] = np.frombuffer(r["shingles"][k], np.uint64)
        out = {pair for held in by.values() if len(held) > 1 for pair in spanning(sorted(held), held, share)}
        return pa.Table.from_arrays([pa.array([p[k] for p in sorted(out)], pa.int64()) for k in (0, 1)], schema=schema)

    return rows.groupBy("shard").applyInArrow(span, "a long, b long").distinct()


def spanning(ids: list[int], sets: dict[int, np.ndarray], share: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``ids``: pairs in the order of their bitmaps' distance, counted exactly
    unless already connected."""
    m = len(ids)
    sizes = np.array([len(sets[i]) for i in ids])
    maps = np.array([fold(b, min(map(len, raw))) for raw in [[bitmap(sets[i]) for i in ids]] for b in raw])
    xs, ys, ds = [], [], []
    for x in range(m - 1):
        both = sizes[x] + sizes[x + 1:]
        apart = np.bitwise_count(maps[x] ^ maps[x + 1:]).sum(1, dtype=np.int64)
        ok = np.flatnonzero(((100 + share) * apart <= (100 - share) * both) & ((100 + share) * np.minimum(sizes[x], sizes[x + 1:]) >= share * both))
        xs.append(np.full(len(ok), x))
        ys.append(ok + x + 1)
        ds.append(apart[ok] / both[ok])
    x, y = np.concatenate(xs), np.concatenate(ys)
    order = np.argsort(np.concatenate(ds), kind="stable")
    label, out = np.arange(m), []
    for lo in range(0, len(order), 512):
        at = order[lo:lo + 512]
        for k in at[label[x[at]] != label[y[at]]].tolist():
            a, b = int(x[k]), int(y[k])
            if label[a] != label[b] and similar(sets[ids[a]], sets[ids[b]], share):
                label[label == label[b]] = label[a]
                out.append((ids[a], ids[b]))
    return out


def similar(x: np.ndarray, y: np.ndarray, share: int) -> bool:
    """Whether two sorted sets meet the share; a set without members meets none."""
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < share * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= share * (len(both) - common)


def trie_pairs(places: DataFrame, docs: DataFrame, n: int, share: int, order, block: int = BLOCK,
               shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Candidate pairs ``a, b`` by traversal of the subtrees; ``places`` has
    ``token, class, guest, doc_id, component``."""
    parts = F.ceil(F.col("size") / block).cast("int")
    key = ["token", "class"]
    sizes = places.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where("size > 1").select(*key, parts.alias("parts"))
    own = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.col("parts")).cast("int")
    # a subtree of several blocks is visited once for each pair of blocks
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")))
    dealt = store(places.join(sizes, key).withColumn("own", own).select(*key, "guest", "doc_id", "component", F.explode(cells).alias("cell"))
                  .select(*key, "guest", "doc_id", "component", "cell.i", "cell.j"), "cells")
    shards = max(1, -(-dealt.count() // shard_rows) * 4)
    shard = F.pmod(F.xxhash64("token", "class", "i", "j"), F.lit(shards)).cast("int")
    cell = F.struct("token", "class", "i", "j", "guest", shard.alias("shard"))
    of_doc = dealt.groupBy("doc_id", "component").agg(F.collect_list(cell).alias("cells"))      # of one prefix
    rows = branches(docs.join(of_doc.hint("merge"), "doc_id").select("doc_id", "component", "text", "cells"), n, share, order)
    schema = arrow_schema("a long, b long")

    def traverse(table: pa.Table) -> pa.Table:
        r = table.to_pydict()
        out: set[tuple[int, int]] = set()
        by: dict[tuple, list[int]] = {}
        for k, key in enumerate(zip(r["token"], r["class"], r["i"], r["j"], strict=True)):
            by.setdefault(key, []).append(k)
        for at in by.values():
            if len(at) <= LEAF:
                out.update(leaf_pairs([(r["doc_id"][k], r["component"][k], r["n"][k], r["n"][k] - r["pos"][k], r["guest"][k], r["map"][k]) for k in at], share))
                continue
            ids = [r["doc_id"][k] for k in at]
            tree = Subtree(np.array([r["n"][k] for k in at]), np.array([r["pos"][k] for k in at]), [r["path"][k] for k in at],
                           [np.frombuffer(r["map"][k], np.uint64) for k in at], np.array([r["component"][k] for k in at]),
                           np.array([r["guest"][k] for k in at]), share)
            out.update((min(ids[x], ids[y]), max(ids[x], ids[y])) for x, y in tree.pairs())
        pairs = sorted(out)
        return pa.Table.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=schema)

    return rows.groupBy("shard").applyInArrow(traverse, "a long, b long").where("a <> b").distinct()


def jaccard_components(df: DataFrame, n: int = 4, share: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; sets are linked from ``share`` per cent on."""
    if not 50 < share <= 100:
        raise ValueError("share must be above 50 and at most 100")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    order = df.sparkSession.sparkContext.broadcast(order_arrays(common_shingles(named, n)))   # at most HEAVY entries
    signed_docs = store(signatures(docs, n), "signatures")
    full = signed_docs.where("doc_id IS NOT NULL AND n_shingles > 0")
    # equal sets: one vertex, the least id
    heads = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("head"), F.min("first").alias("first"), F.min("second").alias("second"))
    same = full.join(heads.select("d1", "d2", "head"), ["d1", "d2"]).where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
    # sets that share their least shingle by one of two hashes, before the rest
    roots = heads.select("head", F.explode(F.array_distinct(F.array("first", "second"))).alias("token"))
    edges = store(same.unionByName(nearest_links(roots, named, n, share)), "links")
    grouped = store(components(edges), "groups")
    # all prefix shingles, where they meet documents of different groups
    tokens = store(prefixes(named, n, share, order), "prefixes")
    shared = tokens.groupBy("token").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("token")
    # similar sets have sizes of one class or two neighbouring ones (the margin covers the logarithm's rounding)
    size_class = F.floor(F.log(F.col("n")) / F.lit(math.log(100 / share) * (1 + 1e-9))).cast("int") if share < 100 else F.col("n").cast("int")
    vertices = (full.groupBy("doc_id", "d1", "d2").agg(F.min("n_shingles").alias("n"))
                .join(heads.select(F.col("head").alias("doc_id"), "d1", "d2"), ["doc_id", "d1", "d2"])
                .join(grouped.withColumnRenamed("id", "doc_id"), "doc_id", "left")
                .select("doc_id", F.coalesce("component", "doc_id").alias("component"), "n", size_class.alias("own")))
    classes = F.explode(F.array(F.struct(F.col("own").alias("class"), F.lit(False).alias("guest")),
                                F.struct((F.col("own") + 1).alias("class"), F.lit(True).alias("guest")))).alias("at")
    vertices = store(vertices, "vertices")
    met = store(tokens.join(shared, "token", "left_semi").select("token", "doc_id", "pos").join(vertices, "doc_id")
                .select("token", "doc_id", "component", "n", (F.col("n") - F.col("pos")).alias("rest"), classes)
                .select("token", "doc_id", "component", "n", "rest", "at.class", "at.guest"), "met")
    crossing = (met.groupBy("token", "class").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("guest").alias("g"),
                                                F.count(F.lit(1)).alias("size"), F.min("rest").alias("rest"), F.sum("n").alias("n"))
                .where("x <> y AND NOT g")
                # of two documents, what remains from the shingle on must be enough
                .where((F.col("size") > 2) | (F.col("rest") * (100 + share) >= F.col("n") * share)).select("token", "class"))
    open_rows = store(met.join(crossing, ["token", "class"], "left_semi")
                      .select("token", "class", "guest", "doc_id", "component").distinct(), "open")
    more = linked(trie_pairs(open_rows, named, n, share, order), named, vertices.groupBy("doc_id").agg(F.min("own").alias("own")), n, share)
    ids = components(edges.unionByName(more)).withColumnRenamed("id", "doc_id")
    return (signed_docs.select("doc_id", "n_shingles").join(ids, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
