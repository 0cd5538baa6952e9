"""Operator 1: hierarchical empirical Bayes quality.

A document classifier (logistic regression over style features and a learnt lexicon) gives each document a probability
of being good.  Grouped aggregations over all documents give every host and every path of a host a share of good
documents; sparse paths are shrunk to their host, sparse hosts to the whole, with strengths estimated from the spread
between sites (method of moments).  The site's share replaces the global prior in the document's odds.

A document lies on the sites that ``sites`` names (its pages' hosts and path templates), else on its own host and path.  With
several pages it counts on each of their sites by its share of pages, and its prior's log odds are the pages' mean.

A document counts as good when its label has quality 1 and it is not toxic.  Defined results: null and empty texts are
rejected with probability 0; a null host or path is a site of its own; labels that are null or repeated: the worst of
an id counts; without any labels every non-empty document has probability 0.5 and is kept; repeated rows get equal
results; rows with a null id are judged like others; an empty table gives no rows.

Scale: the classifier is fitted on a bounded sample of labelled ids (``train_docs``, broadcast); texts are read where
they are, and one small row each is grouped with partial sums, so a host with a third of all rows is no hot task.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import WordHash, hash_sample, map_batches, sample_rate, store
from scorewright.llm.quality_rules import base_counts

TRAIN_DOCS = 20_000             # bound of the labelled sample
LEXICON_WORDS = 4000            # strongest entries kept by the model
MIN_DOCS, MIN_LOG_ODDS = 3, 3.0
_EDGE = b".,;:!?\"'()[]-"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


def lexicon_keys(raw: bytes) -> set[bytes]:
    """Distinct lower-cased words without punctuation at their ends, and the first five bytes of longer ones."""
    out = {w.strip(_EDGE) for w in set(raw.lower().split())}
    out |= {b"^" + w[:5] for w in out if len(w) > 5}
    out.discard(b"")
    return out


def features(raw: bytes, weights: dict[int, float], hashed: WordHash) -> list[float]:
    n_words, chars, symbols, dup_lines, repeats = base_counts(raw)
    n = max(1, len(raw))
    lines = raw.count(b"\n") + 1
    hits = [weights[h] for h in map(hashed.__getitem__, lexicon_keys(raw)) if h in weights] if weights else []
    return [1.0, min(1.0, 20 * symbols / n), min(1.0, raw.count(b"!!") / max(1, n_words)),
            (len(raw) - len(raw.translate(None, _UPPER))) / n, (len(raw) - len(raw.translate(None, _DIGITS))) / n,
            repeats / max(1, n_words), dup_lines / lines, min(1.0, chars / max(1, n_words) / 20),
            min(1.0, np.log1p(n_words) / 10), max(hits, default=0.0) / 5, min(3.0, sum(hits) / 10)]


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def known_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, good, toxic`` once an id; the worst label counts."""
    good = F.when((F.col("quality") >= 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min(good).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")))


def train(docs: DataFrame, known: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[dict[int, float], np.ndarray] | None:
    """Lexicon weights (word hash -> log odds of toxic) and logistic weights, from at most about ``train_docs`` ids."""
    few = hash_sample(known, "doc_id", sample_rate(known.count(), train_docs))
    rows = store(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").where("text IS NOT NULL")
                 .select("text", "good", "toxic"), "labelled")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    if not size["n"]:
        return None

    def start_words():
        hashed = WordHash()

        def run(r: dict) -> dict:
            bad, fine = Counter(), Counter()
            for text, toxic in zip(r["text"], r["toxic"], strict=True):
                (bad if toxic else fine).update(map(hashed.__getitem__, lexicon_keys(text.encode("utf-8", "replace"))))
            keys = list(bad | fine)
            return {"word": np.array(keys, np.uint64).view(np.int64), "bad": [bad[k] for k in keys], "fine": [fine[k] for k in keys]}
        return run

    n_bad, n_fine = float(size["t"] or 0), float(size["n"] - (size["t"] or 0))
    counted = map_batches(rows, "word long, bad long, fine long", start_words, rows=4096).groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
    odds = F.log((F.col("bad") + 0.1) / (n_bad + 1)) - F.log((F.col("fine") + 0.1) / (n_fine + 1))
    strong = (counted.where(F.col("bad") >= MIN_DOCS).select("word", odds.alias("odds"), "bad").where(F.col("odds") >= MIN_LOG_ODDS)
              .orderBy(F.desc("bad"), "word").limit(LEXICON_WORDS).collect())
    lexicon = {int(np.int64(r["word"]).view(np.uint64)): float(r["odds"]) for r in strong}
    got = feature_rows(rows.withColumn("doc_id", F.col("good").cast("long")).withColumns(
        {"host": F.lit(""), "path": F.lit("")}), lexicon, None).select("doc_id", "x").collect()    # bounded by the sample
    return lexicon, fit_logistic(np.array([g["x"] for g in got]), np.array([g["doc_id"] for g in got], float))


def feature_rows(docs: DataFrame, lexicon: dict[int, float], weights: np.ndarray | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``carry, doc_id, host, path, x, p``: features (in training) or the probability of a good document."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, weights))      # at most LEXICON_WORDS entries

    def start():
        lex, w = shared.value
        hashed = WordHash()

        def run(r: dict) -> dict:
            carried = {c: r[c] for c in ("doc_id", "host", "path", *carry)}
            xs = [features((t or "").encode("utf-8", "replace"), lex, hashed) for t in r["text"]]
            p = [None] * len(xs)
            if w is not None:
                z = 1 / (1 + np.exp(-np.clip(np.array(xs) @ w, -30, 30)))
                p = [float(v) if t and t.strip() else 0.0 for v, t in zip(z, r["text"], strict=True)]
            return {**carried, "x": xs if w is None else [None] * len(xs), "p": p}
        return run

    schema = "".join(f"`{c}` string, " for c in carry) + "doc_id long, host string, path string, x array<double>, p double"
    return map_batches(docs.select("doc_id", "host", "path", "text", *carry), schema, start)


def strength(sites: DataFrame, share) -> float:
    """Strength of the beta prior of ``sites`` (``s`` good of ``n``) around ``share``: method of moments, 1 to 1000."""
    gap, noise = F.col("s") / F.col("n") - share, share * (1 - share)
    between = F.greatest((F.sum(F.col("n") * gap * gap) - F.sum(noise)) / F.sum("n"), F.lit(1e-6))
    k = (F.sum(F.col("n") * noise) / F.sum("n")) / between - 1
    return float(sites.agg(F.least(F.greatest(k, F.lit(1.0)), F.lit(1000.0)).alias("k")).first()["k"] or 1.0)


def site_shares(sites: DataFrame) -> DataFrame:
    """``page_doc, host, path, share``: the distinct sites of each document and their shares of its pages."""
    said = (sites.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("page_doc"), F.coalesce(F.col("host").cast("string"), F.lit("")).alias("host"),
                                                     F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"))
            .groupBy("page_doc", "host", "path").agg(F.count(F.lit(1)).alias("n")))
    whole = said.groupBy("page_doc").agg(F.sum("n").alias("pages"))
    return said.join(whole, "page_doc").select("page_doc", "host", "path", (F.col("n") / F.col("pages")).alias("share"))


def posteriors(paths: DataFrame) -> tuple[DataFrame, float]:
    """``host, path, host_share, path_share`` from ``host, path, s, n`` (``s`` good of ``n``), and the share of the whole."""
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    whole = paths.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    base = float(((whole["s"] or 0.0) + 1) / ((whole["n"] or 0) + 2))
    of_hosts = strength(hosts, F.lit(base))
    host_share = hosts.select("host", ((F.col("s") + of_hosts * base) / (F.col("n") + of_hosts)).alias("host_share"))
    joined = paths.join(host_share, "host")
    of_paths = strength(joined, F.col("host_share"))
    return joined.select("host", "path", "host_share",
                         ((F.col("s") + of_paths * F.col("host_share")) / (F.col("n") + of_paths)).alias("path_share")), base


def logit(c) -> F.Column:
    c = F.greatest(F.least(c, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(c / (1 - c))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, train_docs: int = TRAIN_DOCS,
             sites: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, p_text, host_share, path_share, p_good, kept``; ``docs`` has ``doc_id, text, host, path``.  ``sites`` (``doc_id,
    host, path``, any number of rows a document) takes the place of host and path of the documents it names; ``carry`` names
    string columns of ``docs`` that come back with their row.  A document with several sites reports their mean shares."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("host").cast("string"), F.lit("")).alias("host"),
                      F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), *carry)
    if sites is None:
        sites = docs.sparkSession.createDataFrame([], "doc_id long, host string, path string")
    known = known_labels(labels)
    model = train(src, known, train_docs)
    lexicon, weights = model if model else ({}, np.zeros(11))
    scored = store(feature_rows(src, lexicon, weights, carry).select(*carry, "doc_id", "host", "path", "p"), "quality")
    pages = store(site_shares(sites), "sites")
    seen = scored.join(known.select("doc_id", "good"), "doc_id", "left").select(
        "doc_id", "host", "path", F.coalesce(F.col("good").cast("double"), F.col("p")).alias("value"))
    on_pages = pages.withColumnsRenamed({"host": "page_host", "path": "page_path"})
    witnesses = seen.join(on_pages, F.col("doc_id") == F.col("page_doc"), "left").select(
        F.coalesce("page_host", "host").alias("host"), F.coalesce("page_path", "path").alias("path"),
        F.coalesce("share", F.lit(1.0)).alias("share"), "value")
    paths = store(witnesses.groupBy("host", "path").agg(F.sum(F.col("share") * F.col("value")).alias("s"), F.sum("share").alias("n")), "paths")
    site, base = posteriors(paths)
    of_pages = pages.join(site, ["host", "path"]).groupBy("page_doc").agg(
        *[F.sum(F.col("share") * v).alias(c) for c, v in (("host_share", F.col("host_share")), ("path_share", F.col("path_share")),
                                                          ("prior", logit(F.col("path_share"))))])
    own = (scored.join(pages.select("page_doc").distinct(), F.col("doc_id") == F.col("page_doc"), "left_anti")
           .join(site, ["host", "path"]).withColumn("prior", logit(F.col("path_share"))))
    cols = [*carry, "doc_id", "p", "host_share", "path_share", "prior"]
    both = own.select(*cols).unionByName(scored.join(of_pages, F.col("doc_id") == F.col("page_doc")).select(*cols))
    site_odds = F.col("prior") - logit(F.lit(base)) if model else F.lit(0.0)      # without labels, no evidence
    good = F.when(F.col("p") <= 0, F.lit(0.0)).otherwise(1 / (1 + F.exp(-(logit(F.col("p")) + site_odds))))
    return both.select(*carry, "doc_id", F.round("p", 9).alias("p_text"), F.round("host_share", 9).alias("host_share"),
                       F.round("path_share", 9).alias("path_share"), F.round(good, 9).alias("p_good"), (good >= threshold).alias("kept"))
