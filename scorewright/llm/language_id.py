"""Operator 7: language identification by Bayesian evidence fusion.

Four pieces of evidence are multiplied: the text's likelihood under byte-trigram models, the declared markup
language, the suffix of the address, and a host prior that is smoothed hierarchically (host to suffix to the whole).
All tables but the trigram models are grouped aggregations over every document; the trigram models are fitted on a
bounded, documented sample of the rows of each declared language.  Languages that fewer than ``MIN_ROWS`` documents declare
share one pooled model: a document that it fits best has its own declared tag as language if that is one of them,
else it is ``other`` and rejected.

Defined results: a text that is null, empty or without letters has language ``und`` and is rejected, as is one whose best
language has a posterior below ``confidence``; null hosts and declarations are values of their own and carry little
evidence; repeated rows get equal results; an empty table gives no rows; a null id is kept as it is, and has no pages.  Of equal
posteriors the language that comes first in the model's order (by name, the pooled one last) is taken.

Scale: texts are read where they are and become one small row each; only those rows are joined and grouped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import map_batches, sample_rate, store

BUCKETS = 1 << 14
SAMPLE_DOCS = 20_000            # bound of each language's sample for its trigram model
MIN_ROWS = 20                   # languages that fewer rows declare share one model, OTHER
OTHER = "other"
TEXT_WEIGHT = 48.0              # a text counts as at most so many independent trigrams
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 50.0
CONFIDENCE = 0.5
_SPACED = bytes(32 if c < 128 and not (97 <= c <= 122) else c for c in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of the lower-cased text; all but letters counts as space."""
    if not text:
        return np.empty(0, np.int64)
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_SPACED).split()) + b" "
    if len(raw) < 3:
        return np.empty(0, np.int64)
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    h = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
    return (h >> np.uint32(18)).astype(np.int64)


def declared(column) -> F.Column:
    """Primary subtag of a declared language, in lower case."""
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(column, F.lit("")), r"^\s*([A-Za-z]{2,3})", 1)), F.lit(""))


class TextModel:
    """Trigram models of ``languages``; the last one is ``OTHER``, pooled over declared languages with few rows."""

    def __init__(self, languages: list[str], logp: np.ndarray):
        self.languages, self.logp = languages, logp          # (languages, BUCKETS)


def fit_text(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> TextModel:
    """Trigram counts by declared language over at most about ``sample_docs`` rows of each one.  Every language that at
    least ``MIN_ROWS`` rows declare has a model; the rows of the others are pooled.  No languages: nothing is declared."""
    known = docs.where("declared IS NOT NULL AND text IS NOT NULL")
    rows_of = {r["declared"]: r["n"] for r in known.groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()}   # tags of 2 or 3 letters
    if not rows_of:
        return TextModel([], np.zeros((0, BUCKETS)))
    langs = sorted(x for x, n in rows_of.items() if n >= MIN_ROWS)
    at = {x: i for i, x in enumerate(langs)}
    other = len(langs)
    full = 1 << 20
    rates = {x: int(sample_rate(rows_of[x], sample_docs) * full) for x in langs}
    rare = int(sample_rate(sum(n for x, n in rows_of.items() if x not in at), sample_docs) * full)
    often = {x: r for x, r in rates.items() if r < full}
    rate = F.when(~F.col("declared").isin(langs), F.lit(rare)) if langs else F.when(F.lit(True), F.lit(rare))
    if often:
        rate = rate.when(F.col("declared").isin(list(often)),
                         F.create_map(*[F.lit(v) for kv in often.items() for v in kv])[F.col("declared")])
    few = known.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(full)) < rate.otherwise(F.lit(full))).select("declared", "text")

    def start():
        by: dict[int, np.ndarray] = {}

        def run(r: dict) -> None:
            for lang, text in zip(r["declared"], r["text"], strict=True):
                i = at.get(lang, other)
                if i not in by:
                    by[i] = np.zeros(BUCKETS, np.int64)
                by[i] += np.bincount(trigrams(text), minlength=BUCKETS)

        def finish() -> dict | None:
            if not by:
                return None
            some = {i: np.flatnonzero(c) for i, c in by.items()}
            return {"lang": np.concatenate([np.full(len(b), i, np.int32) for i, b in some.items()]),
                    "bucket": np.concatenate([b.astype(np.int32) for b in some.values()]),
                    "n": np.concatenate([by[i][b] for i, b in some.items()])}
        run.finish = finish
        return run

    cells = map_batches(few, "lang int, bucket int, n long", start).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((other + 1, BUCKETS), 0.5)
    counts[cells["lang"].to_numpy(), cells["bucket"].to_numpy()] += cells["n"].to_numpy()      # at most languages x BUCKETS cells
    return TextModel([*langs, OTHER], np.log(counts / counts.sum(1, keepdims=True)))


def text_evidence(docs: DataFrame, model: TextModel, weight: float = TEXT_WEIGHT, carry: tuple[str, ...] = ()) -> DataFrame:
    """All columns but the text, and ``evidence``: tempered log-likelihoods (null for texts without letters)."""
    logp = docs.sparkSession.sparkContext.broadcast(model.logp.T.copy())     # languages x BUCKETS doubles

    def start():
        table = logp.value

        def run(r: dict) -> dict:
            out = []
            for text in r["text"]:
                t = trigrams(text)
                if len(t):
                    s = np.bincount(t, minlength=BUCKETS)
                    at = np.flatnonzero(s)
                    ll = s[at] @ table[at] * (min(len(t), weight) / len(t))
                    out.append((ll - ll.max()).tolist())
                else:
                    out.append(None)
            return {**{c: r[c] for c in ("doc_id", "declared", "host", "suffix", *carry)}, "evidence": out}
        return run

    extra = "".join(f"`{c}` string, " for c in carry)
    return map_batches(docs, f"{extra}doc_id long, declared string, host string, suffix string, evidence array<double>", start)


def suffix_of(host) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(host, r"\.([A-Za-z]+)$", 1)), F.lit(""))


def page_witnesses(evidence: DataFrame, named: list[str]) -> DataFrame:
    """``page_doc, host, suffix, tag, share``: every page of a document as a witness, pages that say the same as one; ``share`` is
    theirs of the document's pages that name a host or a language."""
    said = (evidence.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("page_doc"), F.coalesce(F.col("page_host").cast("string"), F.lit("")).alias("host"),
        declared(F.col("page_declared")).alias("declared"))
        .groupBy("page_doc", "host", "declared").agg(F.count(F.lit(1)).alias("n")))
    whole = said.groupBy("page_doc").agg(F.sum("n").alias("pages"))
    return said.join(whole, "page_doc").select("page_doc", "host", suffix_of(F.col("host")).alias("suffix"), "declared",
                                               tag_of(F.col("declared"), named).alias("tag"), "n", (F.col("n") / F.col("pages")).alias("share"))


def tag_of(language, named: list[str]) -> F.Column:
    """``*``: a declared language without a model of its own; ``?``: none declared."""
    return F.when(language.isNull(), F.lit("?")).when(language.isin(named), language).otherwise(F.lit("*"))


def identify(docs: DataFrame, confidence: float = CONFIDENCE, sample_docs: int = SAMPLE_DOCS,
             evidence: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang, confidence, text_lang, kept``.  ``docs`` has ``doc_id, text, declared, host``; ``evidence`` (``doc_id,
    page_declared, page_host``, any number of rows a document) takes the place of host and declaration of the documents it
    names: every declaration counts (log likelihoods add up), the prior is the mean of the pages' log host priors.  ``carry`` names string
    columns of ``docs`` that come back with their row."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), declared(F.col("declared")).alias("declared"),
                      F.col("host").cast("string").alias("host"), *carry)
    spark = docs.sparkSession
    model = fit_text(src, sample_docs)
    n = len(model.languages)
    scored = text_evidence(src.withColumn("suffix", F.lit(None).cast("string")), model, carry=carry)
    if not n:
        return scored.select(*carry, "doc_id", F.lit("und").alias("lang"), F.lit(0.0).alias("confidence"),
                             F.lit("und").alias("text_lang"), F.lit(False).alias("kept"))
    named = model.languages[:-1]
    langs = F.array(*[F.lit(x) for x in model.languages])
    if evidence is None:
        evidence = spark.createDataFrame([], "doc_id long, page_host string, page_declared string")
    pages = store(page_witnesses(evidence, named), "pages")
    most = F.max(F.when(F.col("declared").isNotNull(), F.struct("n", "declared")))        # what most pages declare
    paged = (pages.groupBy("page_doc", "declared").agg(F.sum("n").alias("n")).groupBy("page_doc").agg(most["declared"].alias("page_declared")))
    weights = F.transform("evidence", lambda e: F.exp(e))
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    rows = store(scored.join(paged, F.col("doc_id") == F.col("page_doc"), "left")
                 .withColumns({"own_declared": F.col("declared"), "declared": F.coalesce("page_declared", "declared")})
                 .select(*carry, "doc_id", "page_doc", "declared", tag_of(F.col("own_declared"), named).alias("own_tag"),
                         F.col("page_declared").isNotNull().alias("pages_declare"), F.coalesce("host", F.lit("")).alias("host"),
                         suffix_of(F.col("host")).alias("suffix"), "evidence", weights.alias("weights"))
                 .withColumn("p", F.transform("weights", lambda x: x / total)).drop("weights"), "languages")
    lettered = rows.where(F.col("evidence").isNotNull())
    # one witness a document without pages, its pages' for the others; shares sum to one a document
    witnesses = (lettered.where("page_doc IS NULL").select("host", "suffix", F.col("own_tag").alias("tag"), F.lit(1.0).alias("share"), "p")
                 .unionByName(lettered.where("page_doc IS NOT NULL").select("page_doc", "own_tag", "pages_declare", "p").join(pages, "page_doc").select(
                     "host", "suffix", F.when(F.col("pages_declare"), F.col("tag")).otherwise(F.col("own_tag")).alias("tag"), "share", "p")))
    # languages + 2 tags: the map side leaves one row a task of each (host, tag)
    soft = store(witnesses.groupBy("suffix", "host", "tag").agg(F.array(*[F.sum(F.col("p")[i] * F.col("share")) for i in range(n)]).alias("s")), "soft")

    def summed(by: list[str], frame: DataFrame) -> DataFrame:
        return frame.groupBy(*by).agg(F.array(*[F.sum(F.col("s")[i]) for i in range(n)]).alias("s"))
    by_host = summed(["suffix", "host"], soft)
    by_suffix = summed(["suffix"], by_host)
    whole = summed(["tag"], soft).collect()                              # at most languages + 2 rows
    seen = np.array([r["s"] for r in whole]).reshape(-1, n)
    base = (seen.sum(0) + 1) / (seen.sum() + n)
    # P(declaration | language), smoothed; lettered rows have no other tags
    says = np.log((seen + 0.5) / (seen.sum(0) + 0.5 * (n + 1)))
    decl = spark.createDataFrame([(r["tag"], row) for r, row in zip(whole, says.tolist(), strict=True)], "tag string, says array<double>")

    def smooth(prior, strength: float) -> F.Column:
        size = F.aggregate("s", F.lit(strength), lambda a, x: a + x)
        return F.zip_with("s", prior, lambda x, p: (x + strength * p) / size)

    suffixes = by_suffix.select("suffix", smooth(F.array(*[F.lit(float(b)) for b in base]), SUFFIX_WEIGHT).alias("suffix_prior"))
    # the host prior already holds the suffix's share: P(language | suffix, host)
    hosts = (by_host.join(suffixes, "suffix")
             .select("host", "suffix", F.transform(smooth(F.col("suffix_prior"), HOST_WEIGHT), lambda x: F.log(x)).alias("prior")))
    small = F.broadcast(decl)                                            # languages + 2 rows
    of_pages = (pages.join(hosts, ["suffix", "host"], "left").join(small, "tag", "left").groupBy("page_doc").agg(
        F.array(*[F.coalesce(F.sum(F.col("prior")[i] * F.col("share")), F.lit(0.0)) for i in range(n)]).alias("page_prior"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("declared").isNotNull(), F.col("says")[i] * F.col("n"))), F.lit(0.0)) for i in range(n)]).alias("page_says")))
    alone = rows.where("page_doc IS NULL").join(hosts, ["suffix", "host"], "left").join(small.withColumnRenamed("tag", "own_tag"), "own_tag", "left")
    paged_rows = (rows.where("page_doc IS NOT NULL").join(of_pages, "page_doc").join(small.withColumnRenamed("tag", "own_tag"), "own_tag", "left")
                  .withColumns({"prior": F.col("page_prior"), "says": F.when(F.col("pages_declare"), F.col("page_says")).otherwise(F.col("says"))}))
    cols = [*carry, "doc_id", "declared", "evidence", "prior", "says"]
    both = F.zip_with("evidence", "prior", lambda e, p: e + p)
    fused = alone.select(*cols).unionByName(paged_rows.select(*cols)).select(
        *carry, "doc_id", "declared", tag_of(F.col("declared"), named).alias("tag"), "evidence", F.zip_with(both, "says", lambda e, d: e + d).alias("f"))
    top = F.array_max("f")
    norm = F.aggregate(F.transform("f", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    lettered_now = F.col("evidence").isNotNull()
    best = F.when(lettered_now, F.element_at(langs, F.array_position("f", top).cast("int"))).otherwise(F.lit("und"))
    sure = F.when(lettered_now, 1 / norm).otherwise(F.lit(0.0))
    text_best = F.when(lettered_now, F.element_at(langs, F.array_position("evidence", F.array_max("evidence")).cast("int"))).otherwise(F.lit("und"))
    judged = fused.select(*carry, "doc_id", "declared", "tag", best.alias("lang"), sure.alias("sure"), text_best.alias("text_lang"))
    rest = F.col("lang") == OTHER
    own = rest & (F.col("tag") == "*")
    return judged.select(*carry, "doc_id", F.when(own, F.col("declared")).otherwise(F.col("lang")).alias("lang"),
                         F.round("sure", 9).alias("confidence"), "text_lang",
                         ((F.col("sure") >= confidence) & (own | ~rest)).alias("kept"))
