"""Repeated vectors and ids in the neighbour search; whole texts in the fit of the line model; all pages of a document."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from scorewright.llm import ann, language_id, quality_rules


def true_neighbours(rows, k):
    """Distinct (id, vector) rows; every row of a query id is a query of its own."""
    rows = sorted(set((i, tuple(v)) for i, v in rows))
    out = []
    for i, v in rows:
        if i % 20 == 0:
            near = sorted(((-float(np.dot(v, w)), j) for j, w in rows if j != i))[:k]
            out += [(i, r, j, round(-s, 9)) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def test_repeated_rows_are_one_query_and_one_candidate(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(100)]
    rows += [rows[0]] * 2 + [rows[7]] * 6 + [rows[40]] * 3                     # repeated queries and candidates
    rows += [(20, rows[21][1]), (33, rows[34][1]), (60, [1.0] * 8)]           # one id, two vectors: a query twice, a candidate twice
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block_rows, query_rows in ((2048, 8192), (16, 2)):                     # also cut into blocks and chunks
        got = ann.search(df, "id % 20 = 0", 20, recall=1.0, block_rows=block_rows, query_rows=query_rows).collect()
        assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == true_neighbours(rows, 20)


def brute_gradient(w, m, x, y):
    """Seen less expected counts, by listing every labelling of a short sequence."""
    def counts(lab):
        emit = sum((x[t] for t in range(len(x)) if lab[t]), np.zeros(x.shape[1]))
        moves = np.zeros((2, 2))
        for a, b in itertools.pairwise(lab):
            moves[a, b] += 1
        return np.concatenate([emit, moves.ravel()])
    every = [counts(lab) for lab in itertools.product((0, 1), repeat=len(x))]
    theta = np.concatenate([w, m.ravel()])
    weight = np.exp([c @ theta for c in every])
    return counts(y.tolist()) - (weight[:, None] * np.array(every)).sum(0) / weight.sum()


def test_gradient_equals_all_labellings():
    rng = np.random.default_rng(3)
    xs = [rng.normal(size=(n, 4)) for n in (1, 5, 7, 3)]
    ys = [rng.integers(0, 2, len(x)) for x in xs]
    w, m = rng.normal(size=4), rng.normal(size=(2, 2))
    got = quality_rules.Padded(xs, ys).gradient(w, m)
    assert np.allclose(got, sum(brute_gradient(w, m, x, y) for x, y in zip(xs, ys, strict=True)))


def test_lines_at_the_end_of_long_texts_train_the_model(spark):
    """Good pages open with 300 plain lines; only the footers after them hold what tells bad pages."""
    plain = "\n".join(f"this is an ordinary sentence number {i} of the page." for i in range(300))
    footer = "\n".join(f"### $$$ offer {i} ### $$$" for i in range(80))
    docs, labels = [], []
    for i in range(24):
        docs.append((i, plain + (f"\n{footer}" if i % 2 else "")))
        labels.append((i, 1 - i % 2, 0))
    crf = quality_rules.train(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    symbols = quality_rules.FEATURES.index("symbols")
    none = quality_rules.train(spark.createDataFrame([(i, "\n".join(t.split("\n")[:64])) for i, t in docs], "doc_id long, text string"),
                               spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert crf.weights[symbols] < none.weights[symbols]                       # what a fit on prefixes never sees


def test_all_pages_of_a_document_are_evidence(spark):
    """A text that leans to en a little, on documents with no, one and several pages."""
    words = {"es": "el perro corre por la calle con su amigo", "en": "the dog runs down the street with its friend"}
    docs = [(i, words[lang], lang, f"{lang}.example") for lang, lo in (("es", 0), ("en", 1000)) for i in range(lo, lo + 60)]
    unclear = words["es"] + " " + words["en"]
    docs += [(i, unclear, None, "mixed.example") for i in range(2000, 2006)] + [(None, unclear, None, None), (2003, unclear, None, "mixed.example")]
    pages = [*[(2000, "es", f"m{i}.example") for i in range(9)], (2000, "en", "a.example"),          # nine of ten agree, the least host does not
             *[(2001, "en", f"m{i}.example") for i in range(5)], (2001, "es", "a.example"),
             *[(2002, "es", "en.example")] * 9,                                                       # declared nine times, on a misleading host
             (2004, None, "es.example"), (2005, None, None), (None, "es", "es.example"), (9999, "en", "en.example")]
    df = spark.createDataFrame(docs, "doc_id long, text string, declared string, host string").withColumn("tag", F.lit("x"))
    evidence = spark.createDataFrame(pages, "doc_id long, page_declared string, page_host string")
    got = language_id.identify(df, evidence=evidence).collect()
    assert len(got) == len(docs)
    lang = {r["doc_id"]: r["lang"] for r in got}
    assert [lang[i] for i in (2000, 2001, 2002, 2003, 2004, 2005, None)] == ["es", "en", "es", "en", "en", "en", "en"]
    assert all(lang[i] == ("es" if i < 1000 else "en") for i in lang if i is not None and i < 2000)
    # the same page nine times is nine pages: once alone, it does not outweigh the text
    once = {r["doc_id"]: r["lang"] for r in language_id.identify(df, evidence=evidence.where("doc_id = 2002").distinct()).collect()}
    assert once[2002] == "en"
