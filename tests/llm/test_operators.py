"""The text operators against brute force, a public library, or held-out labels."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute_force import NASTY, SF, check_packing, tokens, true_components, true_dedup

from scorewright.llm import ann, bpe, common, jump_sharding, packing, phrase_automata, prefix_trie, quality_bayes, quality_rules
from scorewright.llm import queries as Q
from scorewright.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, token string, `row` long, shard int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing extra columns."""
    rows = [(i, t, "en", f"s{i % 3}", 0, "t", 1, 2) for i, t in enumerate(NASTY)]
    rows += [rows[5], rows[11], (None, "a null id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None),
             (3, "the same id again", "de", None, 5, "", 0, 0)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_word_hashes_follow_the_words():
    seen = {}
    for text in [t for t in NASTY if t] + ["x" * 3_000_000 + " a\n" + "b c " * 300_000]:
        raw = text.encode()
        h = common.word_hashes(raw).tolist()
        assert len(h) == len(raw.split())
        for w, x in zip(raw.split(), h, strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


# ------------------------------------------------------------------ 2 sharding

def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_plain_loop_and_moves_only_to_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 1 << 64, 3000, dtype=np.uint64)
    for n in (1, 2, 24, 25, 1000):
        assert jump_sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]
    a, b = jump_sharding.jump_hash(keys, 24), jump_sharding.jump_hash(keys, 25)
    assert ((a == b) | (b == 24)).all() and 60 < (a != b).sum() < 200


def test_sharding_query(spark, odd, empty):
    rows = Q.op2_sharding(spark, SF).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(text)
    for r in rows:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
    hot = odd.unionByName(spark.createDataFrame([(3, "the same id again", "", "", 1, "", 0, 0)] * 500, DOCS))
    got = jump_sharding.shard_rows(hot).collect()
    assert len(got) == odd.count() + 500 and len({r["shard"] for r in got if r["doc_id"] == 3}) == 1
    for rs in (rows, got):
        for shard, of in itertools.groupby(sorted(rs, key=lambda r: r["shard"]), key=lambda r: r["shard"]):
            slots = sorted(r["slot"] for r in of)
            assert slots == list(range(len(slots)))
    assert jump_sharding.shard_rows(empty).count() == 0


# ------------------------------------------------------------------ 8 BPE

def test_bpe_equals_the_library(spark, docs, odd, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(Q.VOCABULARY)
    t.no_truncation()
    vocabulary = bpe.read_vocabulary(Q.VOCABULARY)
    codec = bpe.Codec(vocabulary)
    rng = random.Random(5)
    chars = "ab  \n\t'sS1٣é\u00a0\u2003\x85\x1c日!<|>-\U0001f600"
    texts = NASTY + [r["text"] for r in docs.limit(80).collect()] + ["".join(rng.choices(chars, k=rng.randint(1, 40))) for _ in range(3000)]
    for x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        mine = np.frombuffer(codec.encode(x), "<u4")
        assert mine.tolist() == ids, repr(x)[:200]
        assert codec.decode(mine) == t.decode(ids, skip_special_tokens=False)
    got = bpe.tokenize_digest(odd, vocabulary).collect()
    assert len(got) == odd.count()
    for r, x in zip(got, [r["text"] for r in odd.collect()], strict=True):
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((x or "").encode()).hexdigest()
    assert bpe.tokenize_digest(empty, vocabulary).count() == 0
    assert bpe.tokenize(odd, vocabulary).where("doc_id = 3").first()["decoded"] == "a"


def test_bpe_keeps_mixed_white_space_runs_whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(Q.VOCABULARY)
    t.no_truncation()
    codec = bpe.Codec(bpe.read_vocabulary(Q.VOCABULARY))
    assert np.frombuffer(codec.encode("a \u00a0 \u00a0 b"), "<u4").tolist() == [64, 11504, 275]
    runs = [" \u00a0" * n for n in (1, 2, 3, 4, 5, 8, 9, 16)] + ["\u00a0 " * n for n in (1, 2, 4, 8)]
    runs += ["".join(w) for n in (2, 3, 4) for w in itertools.product(" \u00a0\n\u2003\x85", repeat=n)]
    for x in [f"{a}{r}{b}" for r in runs for a, b in (("a", "b"), ("", ""), ("a ", " b"), ("<|endoftext|>", "'s"))]:
        assert np.frombuffer(codec.encode(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_bpe_merges_each_pre_token_once():
    """Words that differ in what follows them share their merges, and tasks of one process share a codec."""
    vocabulary = bpe.read_vocabulary(Q.VOCABULARY)
    codec = bpe.ready_codec(vocabulary)
    assert bpe.ready_codec(vocabulary) is codec
    merged, merge = [], codec.merge
    codec.merge = lambda data: merged.append(data) or merge(data)
    text = "qozzle qozzle. qozzle, qozzle\nqozzle; (qozzle)"
    assert codec.decode(np.frombuffer(codec.encode(text), "<u4")) == text
    assert len(merged) == len(set(merged))


# ------------------------------------------------------------------ 5 quality rules

def base(text):
    w = tokens(text)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(tri) if tri.count(x) > 1 for k in range(3)} if len(w) < 4000 else None
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if tokens(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, None if covered is None else len(covered))


def test_base_counts(docs, odd):
    for text in [r["text"] for r in docs.limit(60).collect()] + [r["text"] for r in odd.collect()]:
        got = quality_rules.base_counts((text or "").encode())
        assert all(b is None or a == b for a, b in zip(got, base(text), strict=True)), text[:80]


def test_viterbi_is_the_best_of_all_sequences():
    rng = np.random.default_rng(3)
    for _ in range(30):
        x, w, m = rng.normal(size=(6, 10)), rng.normal(size=10), rng.normal(size=(2, 2))
        score = lambda y: sum(x[i] @ w for i in range(6) if y[i]) + sum(m[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: E731,B023
        best = max(itertools.product((0, 1), repeat=6), key=score)
        assert quality_rules.Crf(w, m).viterbi(x).astype(int).tolist() == list(best)


def test_quality_rules_keep_good_and_drop_bad(spark, odd, empty):
    got = Q.op5_quality_rules(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    r = got.agg(F.avg(F.when(F.col("quality") == 1, (F.col("kept") | F.col("base_failed")).cast("int"))).alias("good"),
                F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("bad")).first()
    assert r["good"] > 0.97 and r["bad"] < 0.2
    assert got.where("base_failed AND kept").count() == 0
    crf = quality_rules.fit([], [])
    judged = quality_rules.judge(odd, crf).collect()
    assert len(judged) == odd.count() and not any(r["kept"] for r in judged if not r["n_words"])
    assert quality_rules.judge(empty, crf).count() == 0
    assert quality_rules.train(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).weights.tolist() == quality_rules.PRIOR.tolist()


# ------------------------------------------------------------------ 9 nearest neighbours

def brute(vectors, k, every):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        s = (x * vectors[q]).sum(1)
        out[int(q)] = [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
    return out


def test_ann_recall_and_exact_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    true = brute({r[0]: np.array(r[1], float) for r in df.select("vec_id", "embedding").collect()}, 20, 20)
    got = {}
    for r in ann.search(df, "id % 20 = 0", 20, part_rows=128, block_rows=64).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in t}) for q, t in true.items())
    assert hits / sum(map(len, true.values())) >= 0.9
    scores = {(q, a): s for q, t in true.items() for a, s in t}
    assert all(abs(scores[q, a] - s) < 1e-12 for q, t in got.items() for a, s in t if (q, a) in scores)


def test_ann_edge_rows(spark):
    rng = np.random.default_rng(2)
    hot = [1.0, 2.0, 0.5]
    rows = [(i, hot if i % 2 else rng.normal(size=3).tolist(), 1) for i in range(300)]
    rows += [(1000, None, 1), (1020, [0.0, 0.0, 0.0], 1), (1040, [1.0, None, 2.0], 1), (1060, [float("nan"), 1.0, 1.0], 1),
             (1080, [float("inf"), 1.0, 1.0], 1), (None, [9.0, 9.0, 9.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part int")
    true = brute({r[0]: np.array(r[1]) for r in rows[:300]}, 20, 20)
    got = {}
    for r in ann.search(df, "id % 20 = 0", 20, part_rows=400, block_rows=32).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == true
    few = ann.search(df.where("vec_id < 5"), "id % 2 = 0", 20).collect()
    assert len(few) == 12
    assert ann.search(df.limit(0), "id % 20 = 0").count() == 0


# ------------------------------------------------------------------ 3 url filters

def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def own_rule(host, path):
    best = (None, None)
    for verdict, rule in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")):
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return best


def test_url_filters(spark):
    from scorewright.llm.url_templates import filter_urls
    urls = [None, "", "no scheme/x", "http://", "http://A.Example.ORG/es/1?x=/y", "https://example.org/en/12#z", "https://example.org/en/2",
            "x://com/fr/", "http://a.com", "http://notcom/de/1", "http://É.com/de/x", "http://h.net:80?q=/a://b/c", "a://b://c/d", "http://h.net/a\n/b"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, "http://h.net/z"), (3, "http://")], "page_id long, url string")
    labels = spark.createDataFrame([(4, 1), (None, 0), (5, None), (6, 7)], "page_id long, good int")
    rows = filter_urls(pages.withColumn("host", F.lit("x")).withColumn("good", F.lit(3)), labels).collect()
    assert len(rows) == 16
    for r in rows:
        if r["page_id"] is None:
            continue
        host, path = split_url(urls[r["page_id"]])
        rule, verdict = own_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), urls[r["page_id"]]
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert filter_urls(pages.limit(0), labels).count() == 0
    assert filter_urls(pages, labels.limit(0)).where("rule IS NULL AND verdict = 'block'").count() == 0
    # a bad branch stands out of its host and is rejected, the good ones merge
    pages = spark.createDataFrame([(i, f"http://h.net/{('spam', 'en', 'fr')[i % 3]}/{i}.html") for i in range(900)], "page_id long, url string")
    got = filter_urls(pages, pages.select("page_id", (F.col("page_id") % 3 > 0).cast("int").alias("good")))
    assert {(r["branch"], r["verdict"]) for r in got.collect()} >= {("/spam/*.html", "block")}
    assert got.where("verdict = 'block' AND path NOT LIKE '/spam%'").count() == 0


def test_url_tree_carries_labels_over_word_slugs(spark):
    from scorewright.llm.url_templates import filter_urls
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i)) + "-tale"           # noqa: E731
    urls = [(i, f"http://mixed.net/{('blog', 'en/news', 'en/sport')[i % 3]}/{word(i)}") for i in range(300)]
    urls += [(300 + i, f"http://mixed.net/u/{word(i)}/{('cheap', 'fine')[i % 2]}/{word(i * 7)}.html") for i in range(200)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    bad = F.col("url").contains("/blog/") | F.col("url").contains("/cheap/")
    some = pages.where("page_id % 5 < 2").select("page_id", F.when(bad, 0).otherwise(1).alias("good"))
    got = filter_urls(pages, some).collect()
    assert len(got) == 500
    for r in got:
        assert r["verdict"] == ("block" if "/blog/" in r["path"] or "/cheap/" in r["path"] else "allow"), r
    assert {r["template"] for r in got} == {"/blog/*", "/en/news/*", "/en/sport/*", "/u/*/cheap/*.html", "/u/*/fine/*.html"}
    assert {r["branch"] for r in got if "/blog/" in r["path"]} == {"/blog/*"}
    # few slugs: no wildcard by number, but alike siblings share their labels at every depth
    few = spark.createDataFrame([(i, f"http://few.net/a/{'xyz'[i % 3]}/p") for i in range(9)], "page_id long, url string")
    assert {r["branch"] for r in filter_urls(few, few.where("page_id < 2").selectExpr("page_id", "0 AS good")).collect()} == {"/a/*/p"}


# ------------------------------------------------------------------ 10 packing

def test_packing(spark, docs, odd, empty):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = packing.best_fit_packing(docs, capacity=700, per_source=3, group_rows=64).collect()
    n = check_packing(got, texts, 700, 3)
    assert n < 1.6 * sum(len(tokens(t)) for t in texts.values()) / 700
    some = odd.where("doc_id IS NOT NULL AND doc_id NOT IN (3, 5, 11)")
    check_packing(packing.best_fit_packing(some, capacity=100).collect(), {r["doc_id"]: r["text"] for r in some.collect()}, 100, 4)
    whole = packing.best_fit_packing(odd, capacity=100).collect()
    assert sum(r["n_words"] for r in whole) == sum(len(tokens(r["text"])) for r in odd.collect())
    assert packing.best_fit_packing(empty).count() == 0


def test_pack_takes_the_tightest_compatible_bin():
    rng = random.Random(4)
    sizes, sources = [rng.randint(1, 50) for _ in range(300)], [rng.randint(0, 5) for _ in range(300)]
    clusters = [rng.randint(0, 120) for _ in range(300)]
    got = packing.pack(sizes, sources, clusters, 60, 2)
    bins, want = [], [0] * 300
    for i in sorted(range(300), key=lambda k: (-sizes[k], k)):
        fit = [(60 - sum(sizes[x] for x in b), k) for k, b in enumerate(bins) if 60 - sum(sizes[x] for x in b) >= sizes[i]
               and sum(sources[x] == sources[i] for x in b) < 2 and all(clusters[x] != clusters[i] for x in b)]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([])
        bins[k].append(i)
        want[i] = k
    assert got == want


# ------------------------------------------------------------------ 6 Jaccard join

def near_copies(rng, groups, copies, length, edits):
    out = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(length)]
        for c in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(length)] = f"e{rng.randint(0, 10**6)}"
            out.append((g * copies + c, " ".join(w)))
    return out


@pytest.mark.parametrize(("n", "share", "block", "edits"), [(4, 85, 1024, 3), (5, 80, 5, 4), (2, 60, 7, 9)])
def test_jaccard_components(spark, monkeypatch, n, share, block, edits):
    rng = random.Random(n)
    rows = near_copies(rng, 4, 25, 60, edits) + near_copies(rng, 12, 3, 9, 1)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    line = "the very common line of them all "
    rows = [(i, line + t if i % 3 == 0 else t) for i, t in rows]
    monkeypatch.setattr(prefix_trie.trie_pairs, "__defaults__", (block, 50))
    if block < 1024:        # many cells and blocks in every step that moves whole sets
        monkeypatch.setattr(prefix_trie.nearest_links, "__defaults__", (block, 40))
        monkeypatch.setattr(prefix_trie.linked, "__defaults__", (block, 40))
    monkeypatch.setattr(prefix_trie, "HEAVY_SEEN", 2)
    want, _ = true_components(rows, n, share)
    got = prefix_trie.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), n, share).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_jaccard_edge_rows(spark, odd, empty):
    want, sets = true_components([(r["doc_id"], r["text"]) for r in odd.collect()], 4, 85)
    got = prefix_trie.jaccard_components(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}
    assert prefix_trie.jaccard_components(empty).count() == 0


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(90)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])
    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in got} == {x: find(x) for e in edges for x in e if e[0] != e[1]}


# ------------------------------------------------------------------ 4 substring dedup

def dedup(df, **kw):
    rows = phrase_automata.substring_dedup(df, **kw).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return sorted(map(tuple, rows), key=str)


def test_substring_dedup(spark, odd, empty, monkeypatch):
    rng = random.Random(1)
    passages = [[f"p{rng.randint(0, 30)}" for _ in range(30)] for _ in range(6)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randint(0, 20)
            w += rng.choice([p, p[a:], [f"u{rng.randint(0, 10**6)}" for _ in range(12)], ["same"] * rng.randint(1, 30)])
        rows.append((i * 7 % 120, rng.choice([" ", "\n"]).join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert dedup(df, size=6, anchor=3) == true_dedup(rows, 6)
    assert dedup(df) == true_dedup(rows, 20)
    with monkeypatch.context() as m:        # anchors in many cells
        m.setattr(phrase_automata.repeated, "__defaults__", (*phrase_automata.repeated.__defaults__[:-2], 5, 200))
        assert dedup(df, size=6, anchor=3) == true_dedup(rows, 6)
    plain = odd.select("doc_id", "text").collect()
    assert dedup(odd, size=2, anchor=2) == true_dedup([tuple(r) for r in plain], 2)
    assert dedup(empty) == []


# ------------------------------------------------------------------ 7 and 1

def test_language_id(spark, odd, empty):
    from scorewright.llm.language_id import identify
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = Q.op7_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "n_chars").withColumnRenamed("lang", "said"), "doc_id")
    r = got.agg(F.avg((F.col("lang") == F.col("said")).cast("int")).alias("acc"), F.avg(F.col("kept").cast("int")).alias("kept")).first()
    assert r["acc"] > 0.98 and r["kept"] > 0.99
    # text alone, fitted on one half, tested on the other
    from scorewright.llm.language_id import fit_text, text_evidence
    src = docs.selectExpr("doc_id", "text", "lang AS declared", "source AS host", "'' AS suffix")
    model = fit_text(src.where("doc_id % 2 = 0"))
    held = text_evidence(src.where("doc_id % 2 = 1 AND length(text) > 200"), model).collect()
    right = sum(model.languages[int(np.argmax(h["evidence"]))] == h["declared"] for h in held)
    assert right > 0.97 * len(held)
    named = odd.selectExpr("doc_id", "text", "lang AS declared", "source AS host", "token AS suffix")
    rows = identify(named).collect()
    assert len(rows) == odd.count()
    assert all(r["lang"] == "und" and not r["kept"] for r in rows if r["doc_id"] in (0, 1, 2))
    assert identify(named.where("doc_id < 0")).count() == 0


def test_language_id_of_rare_languages(spark):
    from scorewright.llm.language_id import identify
    rng = random.Random(3)
    bags = {lang: ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(300)]
            for lang, letters in (("aa", "abcdefgh"), ("bb", "hijklmno"), ("cc", "opqrstuv"), ("dd", "vwxyzabc"), ("ee", "aeimquyd"))}
    said = ["aa"] * 3000 + ["bb"] * 3000 + ["cc"] * 40 + ["dd"] * 4 + ["ee"] * 4       # cc: 0.7 % of the rows
    rows = [(i, " ".join(rng.choices(bags[x], k=60)), x, f"h{i % 7}.net") for i, x in enumerate(said)]
    rows += [(len(rows), " ".join(rng.choices(bags["cc"], k=60)), None, "h0.net")]
    df = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string")
    got = {r["doc_id"]: r for r in identify(df).collect()}
    assert [got[i]["lang"] for i in range(len(said))] == said and all(got[i]["kept"] for i in range(len(said)))
    assert got[len(said)]["lang"] == "cc"
    # the sample is bounded for each language, not over all of them
    assert {r["doc_id"]: r["lang"] for r in identify(df, sample_docs=30).collect() if r["doc_id"] in range(6000, 6040)} == dict.fromkeys(range(6000, 6040), "cc")


def test_quality_classifier(spark, odd, empty):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text", "source AS host", "lang AS path")
    got = quality_bayes.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    r = got.agg(F.avg(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.col("kept").cast("int"))).alias("good"),
                F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("bad"),
                F.avg(F.when(F.col("toxic") == 1, F.col("kept").cast("int"))).alias("toxic")).first()
    assert r["good"] > 0.97 and r["bad"] < 0.1 and r["toxic"] < 0.1, r
    named = odd.selectExpr("doc_id", "text", "source AS host", "lang AS path", "token")
    none = labels.limit(0)
    rows = quality_bayes.classify(named, none).collect()
    assert len(rows) == odd.count() and all(r["kept"] == bool(t and t.strip()) or r["doc_id"] in (None, 3) for r in rows for t in [dict(enumerate(NASTY)).get(r["doc_id"])])
    assert quality_bayes.classify(named.limit(0), none).count() == 0
    odd_labels = spark.createDataFrame([(None, 1, 0), (3, None, 1), (4, 1, None), (4, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_bayes.classify(named, odd_labels).count() == odd.count()
