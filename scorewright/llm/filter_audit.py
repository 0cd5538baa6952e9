"""Operator 12: filter interaction audit by decision diagrams.

Every document gets a mask of the filters it fails; documents of a part with equal masks are one count.  A part's counts
become a count-weighted decision diagram: a node tests one filter, its two branches hold the documents that pass and
that fail it, leaves hold the counts, equal subdiagrams are one node and empty ones the zero leaf.  Swapping two
adjacent levels turns a diagram of one filter order into that of another; a sequence of such swaps visits every order.
Along the path on which all filters pass, the fail branch at each level holds exactly the documents which that step removes.

Filters (failure): A fewer than 50 words; B distinct words below 65 % of the words; C upper-case A-Z above 5 % of the code
points; D any of ``#$%&*|``; E the text of a smaller doc_id anywhere in the table.

Defined results: a null text is empty (it fails A, and E after another empty text); a null source is the part ``''``; a
null doc_id is neither smaller nor larger than another one, so E never fails it, and it has no labels; rows that repeat
a doc_id count each, and equal texts under one id are no copies of each other.  A document counts as good when any
of its label rows has quality 1, as toxic when any has toxic 1; labels without a document, null values and columns beyond
the named ones have no effect.  An empty table has no parts and gives no rows.

Scale: texts are reduced to masks and a digest where they are read, in built-in functions; what is shuffled is one small row
a document.  Equal texts are first summed by (text, part) before their least id is looked up, so a text that a third of
all rows share is one row a part; null ids are spread by their digest.  A part is 16 counts at most when it
reaches its diagram, whatever its size, and parts are diagrammed in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm.common import map_batches

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
Counts = tuple[int, int, int]                    # documents, good ones, toxic ones
ZERO = 0                                         # the empty diagram


class Diagram:
    """Count-weighted decision diagram of one part.  Nodes are numbers; ``parts[n]`` is (level's filter, pass, fail) or a
    leaf's counts, ``total[n]`` the counts below.  A level is never skipped except into the zero leaf."""

    def __init__(self, masks: dict[int, Counts], n: int = len(FILTERS)):
        self.known: dict = {}
        self.parts: list = []
        self.total: list[Counts] = []
        self.leaf((0, 0, 0))
        self.order = list(range(n))
        self.root = self._build(masks, 0)

    def _add(self, key: tuple, total: Counts) -> int:
        if key not in self.known:
            self.known[key] = len(self.parts)
            self.parts.append(key)
            self.total.append(total)
        return self.known[key]

    def leaf(self, counts: Counts) -> int:
        return self._add(("leaf", *counts), counts)

    def node(self, test: int, passed: int, failed: int) -> int:
        if passed == failed == ZERO:
            return ZERO
        a, b = self.total[passed], self.total[failed]
        return self._add((test, passed, failed), (a[0] + b[0], a[1] + b[1], a[2] + b[2]))

    def _build(self, masks: dict[int, Counts], level: int) -> int:
        if not masks:
            return ZERO
        if level == len(self.order):
            return self.leaf(next(iter(masks.values())))
        bit = 1 << self.order[level]
        return self.node(self.order[level], self._build({m: c for m, c in masks.items() if not m & bit}, level + 1),
                         self._build({m: c for m, c in masks.items() if m & bit}, level + 1))

    def branches(self, n: int) -> tuple[int, int]:
        return (ZERO, ZERO) if n == ZERO else self.parts[n][1:]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one: nodes above are rebuilt over the new pair, nodes below stay."""
        upper, lower = self.order[level], self.order[level + 1]
        done: dict[int, int] = {}

        def moved(n: int, depth: int) -> int:
            if n == ZERO:
                return ZERO
            if n not in done:
                passed, failed = self.branches(n)
                if depth < level:
                    done[n] = self.node(self.order[depth], moved(passed, depth + 1), moved(failed, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self.branches(passed), self.branches(failed)
                    done[n] = self.node(lower, self.node(upper, pp, fp), self.node(upper, pf, ff))
            return done[n]

        self.root = moved(self.root, 0)
        self.order[level], self.order[level + 1] = lower, upper

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """Along the all-pass path: filter, counts kept after it, counts it removes."""
        at = self.root
        for test in self.order:
            passed, failed = self.branches(at)
            yield test, self.total[passed], self.total[failed]
            at = passed


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, to visit every order of ``n`` filters once: the last one walks through each
    order of the others, to and fro."""
    if n < 2:
        return
    down = True
    for inner in [*adjacent_swaps(n - 1), None]:
        yield from (range(n - 2, -1, -1) if down else range(n - 1))
        if inner is not None:
            yield inner + 1 if down else inner         # the walker stands first, or last
        down = not down


def audit_rows(part: str | None, masks: dict[int, Counts]) -> Iterator[dict]:
    diagram = Diagram(masks)
    n = len(diagram.order)
    fails = [sum(c[0] for m, c in masks.items() if m >> f & 1) for f in range(n)]
    alone = [masks.get(1 << f, (0, 0, 0))[0] for f in range(n)]
    shapley = [0] * n
    rows = []
    for level in [None, *adjacent_swaps(n)]:
        if level is not None:
            diagram.swap(level)
        order = "".join(FILTERS[f] for f in diagram.order)
        for at, (f, kept, removed) in enumerate(diagram.steps(), 1):
            shapley[f] += removed[0]
            rows.append((f, {"part": part, "filter_order": order, "step": at, "kept": kept[0], "removed": removed[0],
                             "redundant": fails[f] - removed[0], "unique_fails": alone[f], "good_lost": removed[1], "toxic_lost": removed[2]}))
    for f, row in rows:
        yield row | {"shapley": shapley[f]}


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that ``text`` (not null) fails."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    fails = [n < 50, 100 * distinct.cast("long") < 65 * n.cast("long"), 100 * upper.cast("long") > 5 * F.length(text).cast("long"),
             text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cells``: per part the counts of every mask that occurs, as ``mask, n, good, toxic``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_mask(text).cast("int").alias("mask"))
    once = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    judged = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("key"))
              .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
              .withColumn("no_id", F.lit(False)))
    keyed = once.withColumns({"key": F.coalesce("doc_id", F.xxhash64("digest", "part")), "no_id": F.col("doc_id").isNull()})
    marked = keyed.join(judged, ["key", "no_id"], "left").select(
        "doc_id", "digest", "part", "mask", "n", (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    # within a (text, part), one row an id: the least one with its counts is the candidate for the first of all
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n", "good", "toxic")))
    same = marked.groupBy("digest", "part", "mask").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"), least.alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    first_of_all = F.col("first.doc_id") == F.min("first.doc_id").over(Window.partitionBy("digest"))
    kept = {c: F.coalesce(F.when(first_of_all, F.col(f"first.{c}")), F.lit(0)) for c in ("n", "good", "toxic")}
    kept["n"] = kept["n"] + F.col("no_id")
    split = same.select("part", "mask", *[e.alias(f"{c}_kept") for c, e in kept.items()], "n", "good", "toxic")
    cells = split.groupBy("part", "mask").agg(*[F.sum(f"{c}_kept").alias(f"{c}_kept") for c in kept], *[F.sum(c).alias(c) for c in kept])
    both = F.array(F.struct("mask", *[F.col(f"{c}_kept").alias(c) for c in kept]),
                   F.struct((F.col("mask") + 16).alias("mask"), *[(F.col(c) - F.col(f"{c}_kept")).alias(c) for c in kept]))
    return cells.groupBy("part").agg(F.flatten(F.collect_list(both)).alias("cells"))           # 16 masks a part at most


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``: 600 rows a part."""
    schema = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
              "good_lost long, toxic_lost long, shapley long")
    names = [c.split()[0] for c in schema.split(", ")]

    def start():
        def run(r: dict) -> dict:
            out: dict[str, list] = {n: [] for n in names}
            for part, cells in zip(r["part"], r["cells"], strict=True):
                masks = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in cells if c["n"]}
                for row in audit_rows(part, masks):
                    for n in names:
                        out[n].append(row[n])
            return out
        return run

    return map_batches(failure_counts(docs, labels), schema, start)
