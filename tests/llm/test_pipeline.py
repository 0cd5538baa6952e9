"""The pipeline's stages against brute force on the smallest tables, and on odd rows."""

import pytest

from brute_force import NASTY, SF, check_packing, tokens, true_components, true_dedup

import corpus_pipeline as P

COLUMNS = list(P.COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_filters_keep_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in docs.collect()}
    spoken = P.language_id(spark, docs, sf)
    assert spoken.columns == COLUMNS and len({r["doc_id"] for r in spoken.collect()}) > 0.98 * len(ids)
    kept = {r["doc_id"] for r in P.quality(spark, docs, sf).collect()}
    clean = {i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
    assert len(clean & kept) > 0.97 * len(clean)
    assert len((set(labels) - clean) & kept) < 0.2 * len(set(labels) - clean)


def test_near_duplicates_and_substrings(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, _ = true_components(rows, 5, 80)
    one = P.near_duplicates(spark, docs, SF)
    assert one.columns == COLUMNS
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(want.values()))
    cut = P.substring_dedup(spark, docs, SF)
    assert cut.columns == COLUMNS
    got = {r["doc_id"]: r for r in cut.collect()}
    text = dict(rows)
    for i, _, removed, _ in true_dedup(rows, 20):
        assert len(tokens(text[i])) - len(tokens(got[i]["text"])) == removed
        assert removed or got[i]["text"] == text[i]
        assert got[i]["n_chars"] == len(got[i]["text"])


def test_whole_run(spark, docs):
    packed = P.run(spark, SF).collect()
    ids = {r["doc_id"] for r in packed}
    assert ids and ids <= {r["doc_id"] for r in docs.collect()}
    held = P.table(spark, SF, "documents")
    for _, stage in P.STAGES[:-1]:
        held = P.store(stage(spark, held, SF), "test")
    check_packing(packed, {r["doc_id"]: r["text"] for r in held.collect()}, 2048, 4)


def test_odd_rows_and_empty_tables(spark):
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "x", 1) for i, t in enumerate(NASTY)] + [(None, None, None, None, None, None, None), (None, "a b", "en", "s", 1, "", 0)]
    rows += [rows[10], (4, "another text of one id", "en", "s", 1, "", 0)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, __id long")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == COLUMNS
        # the row without text goes where texts are judged, whatever its id
        assert out.where("doc_id IS NULL AND text IS NULL").count() == (stage not in (P.language_id, P.quality))
        assert stage(spark, odd.limit(0), SF).count() == 0
    one = P.near_duplicates(spark, odd, SF)
    assert one.where("text IS NOT NULL AND n_chars > 10").count() == one.where("n_chars > 10").select("text").distinct().count()
    assert P.pack(spark, odd, SF).where("doc_id IS NULL").count() == 2
    assert P.pack(spark, odd.limit(0), SF).count() == 0
