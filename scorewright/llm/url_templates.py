"""Operator 3: url filters from a path-template tree.

Paths become templates: segments that look variable (numbers, dates, long hex or mixed ids) turn into wildcards that keep
their file ending.  The tree of each host is then built from the top: where a branch has many sparse children, these become a
wildcard too.  From the leaves up, sibling branches (alike but for one segment) whose share of good labelled pages does
not differ significantly from their parent's are merged into a wildcard, and their labels pooled.  A template whose smoothed share of good
pages (shrunk to its host, the host to the whole) is below ``purity`` blocks the urls under it.  Fixed rules
on host and path come first; the longest one that fits decides.

Defined results: a null url, and one without ``://``, has an empty host and path, fits no rule and is judged as the
template of the empty host; unlabelled templates have their host's share; repeated pages count each time; an empty
table gives no rows; other columns of the pages are ignored.  Labels other than 0 and 1 and null labels are ignored.

Everything is a grouped aggregation with partial sums: a host that holds a third of all pages arrives as one row a
template and task.  The template tree is joined back by (host, template), which Spark may split when it is skewed.  Each level
of the tree is stored, two passes a level; a level at which no host has enough different segments for siblings needs none, so
endless paths of repeating segments cost no jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import store

#: The contract's rules: (verdict, rule); host up to the first slash, path prefix from it.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
PURITY, HOST_WEIGHT, TEMPLATE_WEIGHT, Z = 0.5, 20.0, 10.0, 1.96
SPARSE_PAGES, MANY_CHILDREN = 4, 10     # from so many children of at most so many pages on, these are one wildcard
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null when none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        name, _, rest = r.partition("/")
        fits = ((host == F.lit(name)) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _wildcard(seg: Column) -> Column:
    return F.concat(F.lit("*"), F.regexp_extract(seg, r"(\.[A-Za-z]{1,5})$", 1))


def template_of(path: Column) -> Column:
    """The path with its variable segments as wildcards."""
    def one(seg: Column) -> Column:
        stem = F.regexp_replace(seg, r"\.[A-Za-z]{1,5}$", "")
        variable = stem.rlike(r"^[0-9][0-9._-]*$|^[0-9a-fA-F-]{12,}$|^(?=.*[0-9].*[0-9].*[0-9])[0-9A-Za-z_-]{6,}$")
        return F.when(variable, _wildcard(seg)).otherwise(seg)
    return F.array_join(F.transform(F.split(path, "/"), one), "/")


def _levels(urls: DataFrame, least: int, *by: Column) -> list[int]:
    """Levels at which some host (and ``by``) has ``least`` different segments: no others can have that many siblings.  At most
    one integer a level comes to the driver."""
    cells = urls.select("host", *[c.alias(f"by{i}") for i, c in enumerate(by)], F.posexplode("segs").alias("level", "seg"))
    kinds = cells.where("level > 0").groupBy(*cells.columns).agg(F.lit(1).alias("one"))
    wide = kinds.groupBy([c for c in cells.columns if c != "seg"]).agg(F.count("one").alias("kinds")).where(F.col("kinds") >= least)
    return sorted(r["level"] for r in wide.select("level").distinct().collect())


def _replace(column: str, k: int, value: Column) -> Column:
    return F.concat(F.slice(column, 1, k), F.array(value), F.slice(column, k + 2, 1 << 30))


def host_wildcards(urls: DataFrame) -> DataFrame:
    """``segs`` of each template with the sparse children of many-branched parents as wildcards, from the top down."""
    for k in _levels(urls, MANY_CHILDREN):
        seg = F.get("segs", F.lit(k))
        urls = urls.withColumns({"prefix": F.slice("segs", 1, k), "seg": seg})
        kids = urls.where("seg <> '' AND seg NOT LIKE '*%'").groupBy("host", "prefix", "seg").agg(F.sum("pages").alias("of_seg"))
        sparse = kids.where(F.col("of_seg") <= SPARSE_PAGES)
        many = sparse.groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("children")).where(F.col("children") >= MANY_CHILDREN)
        wild = sparse.join(many, ["host", "prefix"]).select("host", "prefix", "seg", F.lit(True).alias("wild"))
        urls = store(urls.join(wild, ["host", "prefix", "seg"], "left").select(
            "host", "template", "pages", "good", "n",
            F.when(F.col("wild"), _replace("segs", k, _wildcard(F.col("seg")))).otherwise(F.col("segs")).alias("segs")),
            "url-wildcards")
    return urls


def merged_branches(nodes: DataFrame) -> DataFrame:
    """``host, segs, branch`` from ``host, segs, good, n``: alike siblings merged, from the leaves up."""
    nodes = nodes.withColumn("branch", F.col("segs"))
    for k in reversed(_levels(nodes, 2, F.size("segs"))):        # siblings have equally many segments
        cells = nodes.groupBy("host", "branch").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        families = cells.where(F.size("branch") > k).withColumn("parent", _replace("branch", k, F.lit("*")))
        pooled = (families.groupBy("host", "parent").agg(F.sum("good").alias("pg"), F.sum("n").alias("pn"), F.count(F.lit(1)).alias("siblings"))
                  .where("siblings > 1"))
        share = (F.col("pg") + 1) / (F.col("pn") + 2)
        alike = F.abs(F.col("good") - F.col("n") * share) <= Z * F.sqrt(F.col("n") * share * (1 - share)) + 0.5
        moved = families.join(pooled, ["host", "parent"]).where(alike).select("host", "branch", "parent")
        nodes = store(nodes.join(moved, ["host", "branch"], "left").select(
            "host", "segs", "good", "n", F.coalesce("parent", "branch").alias("branch")), "url-branches")
    return nodes


def template_tree(urls: DataFrame) -> DataFrame:
    """From ``host, template, pages, good, bad`` counts (one row a template) the merged tree: ``host, template, host_template,
    branch, purity``.  ``host_template`` has the host's own wildcards; ``branch`` is it after merging."""
    urls = store(urls.select("host", "template", "pages", "good", (F.col("good") + F.col("bad")).alias("n"),
                             F.split("template", "/").alias("segs")), "url-templates")
    total = urls.agg(F.sum("good").alias("g"), F.sum("n").alias("t"))
    base = total.select((F.coalesce(F.col("g"), F.lit(0)) + 1) / (F.coalesce(F.col("t"), F.lit(0)) + 2)).scalar()
    hosts = (urls.groupBy("host").agg(F.sum("good").alias("hg"), F.sum("n").alias("hn"))
             .select("host", ((F.col("hg") + HOST_WEIGHT * base) / (F.col("hn") + HOST_WEIGHT)).alias("host_share")))
    own = host_wildcards(urls)
    merged = merged_branches(own.groupBy("host", "segs").agg(F.sum("good").alias("good"), F.sum("n").alias("n")))
    counts = merged.groupBy("host", "branch").agg(F.sum("good").alias("bg"), F.sum("n").alias("bn"))
    purity = (F.col("bg") + TEMPLATE_WEIGHT * F.col("host_share")) / (F.col("bn") + TEMPLATE_WEIGHT)
    judged = counts.join(hosts, "host").select("host", "branch", purity.alias("purity"))
    return (own.select("host", "template", "segs").join(merged.select("host", "segs", "branch"), ["host", "segs"])
            .join(judged, ["host", "branch"])
            .select("host", "template", F.array_join("segs", "/").alias("host_template"), F.array_join("branch", "/").alias("branch"), "purity"))


def filter_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules=RULES, purity: float = PURITY) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, branch, purity`` for every page.  ``labels`` has
    ``page_id, good`` (1 or 0), at most one row a page that counts."""
    url = F.col(url_col)
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("template", template_of(F.col("path")))
    known = (labels.where("page_id IS NOT NULL AND good IN (0, 1)").groupBy("page_id")
             .agg(F.min("good").alias("good")))
    joined = parsed.join(known, "page_id", "left")
    counts = joined.groupBy("host", "template").agg(
        F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum(1 - F.col("good")), F.lit(0)).alias("bad"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("purity") < purity, F.lit("block")).otherwise(F.lit("allow"))
    return (parsed.join(template_tree(counts), ["host", "template"])
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                    F.col("host_template").alias("template"), "branch", F.round("purity", 9).alias("purity")))
