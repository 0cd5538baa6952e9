"""The registered queries of the text operators, one per operator: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import (ann, bpe, filter_audit, hidden_markov, jump_sharding, language_id, packing, phrase_automata, prefix_trie,
                             quality_bayes, quality_rules, shallot, url_templates)
from scorewright.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Sites are the hosts and path templates of the documents' pages; a document without pages has its source and language."""
    src = docs.select("doc_id", "text", F.concat(F.lit("source:"), "source").alias("host"), F.col("lang").alias("path"), *carry)
    pages = page_numbers(table(spark, sf_dir, "pages"))
    sites = pages.select("doc_id", url_templates.host_of(F.col("url")).alias("host"),
                         url_templates.template_of(url_templates.path_of(F.col("url"))).alias("path"))
    return quality_bayes.classify(src, table(spark, sf_dir, "labels"), sites=sites, carry=carry)


def page_numbers(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, doc_id``: the number in a page's path is the id of its document."""
    path = url_templates.path_of(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    return pages.select("page_id", "url", "html", F.nullif(number, F.lit("")).cast("long").alias("doc_id"))


def page_evidence(pages: DataFrame) -> DataFrame:
    markup = F.regexp_extract("html", r"(?is)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    return page_numbers(pages).select("doc_id", url_templates.host_of(F.col("url")).alias("page_host"), markup.alias("page_declared"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(spark, table(spark, sf_dir, "documents"), sf_dir)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jump_sharding.shard_rows(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    good = (quality_bayes.known_labels(table(spark, sf_dir, "labels")).join(page_numbers(pages), "doc_id")
            .select("page_id", "good"))
    return url_templates.filter_urls(pages, good)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = phrase_automata.substring_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))
    return judged.withColumn("content_share", F.round("content_share", 9))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.jaccard_components(table(spark, sf_dir, "documents"), n=4, share=85)


def identify_documents(spark: SparkSession, docs: DataFrame, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    src = docs.select("doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"), *carry)
    return language_id.identify(src, evidence=page_evidence(table(spark, sf_dir, "pages")), carry=carry)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_documents(spark, table(spark, sf_dir, "documents"), sf_dir)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenize_digest(table(spark, sf_dir, "documents"), bpe.read_vocabulary(VOCABULARY))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "id % 20 = 0", k=20)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


def op11_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.lm_scores(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.shallot_clusters(table(spark, sf_dir, "embeddings"))


def _kmeans_sql(k: int, rounds: int, dim: int, scale: int, salt: str) -> str:
    """Lloyd's algorithm round by round over rows (rid) and centroids (cid), all in integers."""
    def assigned(r: int) -> str:
        return (f"a{r} AS MATERIALIZED (SELECT rid, min(struct_pack(d := d, c := cid)) AS b FROM (SELECT rid, cid, list_sum(list_transform("
                f"range(1, {dim + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS d FROM vec, c{r}) GROUP BY rid)")

    def moved(r: int) -> str:
        return (f"m{r} AS (SELECT b.c AS cid, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r} JOIN vec USING (rid), range(1, {dim + 1}) t(i) GROUP BY ALL), "
                f"c{r + 1} AS MATERIALIZED (SELECT o.cid, coalesce(any_value(f.c), any_value(o.c)) AS c FROM c{r} o LEFT JOIN "
                f"(SELECT cid, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM m{r} GROUP BY cid) f USING (cid) GROUP BY o.cid)")
    ctes = [f"kept AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings "
            f"WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dim})",
            "vec AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) AS rid, vec_id, v FROM kept)",
            f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS cid, v AS c FROM "
            f"(SELECT sha256('{salt}:' || vec_id) AS h, v FROM vec) ORDER BY h NULLS LAST, v LIMIT {k})"]
    for r in range(rounds):
        ctes += [assigned(r), moved(r)]
    ctes.append(assigned(rounds))
    return (f"WITH {', '.join(ctes)} SELECT vec_id, b.c::INTEGER AS cluster, b.d AS distance, "
            f"sum(b.d) OVER (PARTITION BY b.c)::BIGINT AS cluster_inertia, sum(b.d) OVER ()::BIGINT AS inertia, "
            f"sha256(array_to_string(c{rounds}.c, ',')) AS centroid_sha256 FROM a{rounds} JOIN vec USING (rid) JOIN c{rounds} ON cid = b.c")


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_sharding, op3_url_filters, op4_substring_dedup, op5_quality_rules, op6_ngram_jaccard_join, op7_language_id, op8_bpe, op9_ann,
    op10_best_fit_packing, op11_hidden_markov, op12_filter_audit, op13_shallot_clusters)}

# Those whose rows SQL can state; the others rest on fitted models, a public vocabulary, unsigned hash arithmetic or greedy order.
ORACLE: dict[str, str] = {
    "op4_substring_dedup": r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM texts),
windows AS (SELECT doc_id, j, w[j] AS word, CASE WHEN j + 19 <= len(w) THEN array_to_string(w[j:j + 19], ' ') END AS passage FROM words),
ranked AS (SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, j) > 1 AND passage IS NOT NULL AS later FROM windows),
judged AS (SELECT *, bool_or(later) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS removed FROM ranked),
kept AS (SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT removed) AS text
         FROM judged GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)""",
    "op6_ngram_jaccard_join": r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_sets FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id != b.doc_id
           GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * both_sets >= 85 * (x.n + y.n - both_sets)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM texts UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT t.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM texts t JOIN reach r USING (doc_id) LEFT JOIN sizes z USING (doc_id) GROUP BY t.doc_id""",
    "op12_filter_audit": r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
known AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM texts),
judged AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
  + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
  + 16 * coalesce(x.doc_id > first_id, false)::INT AS mask FROM words x LEFT JOIN known USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM one a, one b, one c, one d, one e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step::INTEGER AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
  list_sum([1 << (ascii(filter_order[i]) - 65) FOR i IN range(1, step)])::BIGINT AS before FROM orders, range(1, 6) r(step)),
counted AS (SELECT part, filter_order, step, bit,
  coalesce(sum(n) FILTER (WHERE mask & (coalesce(before, 0) | bit) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE mask & coalesce(before, 0) > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit, before)
SELECT * EXCLUDE (bit), sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM counted""",
    "op13_shallot_clusters": _kmeans_sql(shallot.K, shallot.ROUNDS, shallot.DIM, shallot.SCALE, shallot.SALT),
}
