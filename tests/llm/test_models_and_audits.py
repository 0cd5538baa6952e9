"""Hidden Markov model, filter audit and Shallot clustering against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute_force import NASTY, SF, tokens

from scorewright.llm import filter_audit, hidden_markov, shallot

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, `at` long, good int"
LABELS = "doc_id long, quality int, toxic int, n long"


@pytest.fixture(scope="module")
def odd_rows():
    rows = [(i, t, "en", f"s{i % 3}", 0, "t", 1, 2) for i, t in enumerate(NASTY)]
    rows += [rows[5], rows[11], (None, "a null id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None),
             (3, "the same id again", "de", None, 5, "", 0, 0), (90, "a null id", "en", "s1", 0, "", 0, 0), (91, "a null id", "en", "s2", 0, "", 0, 0)]
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "GAMMA", "delta|", "x", "y", "Z"] + [f"w{i}" for i in range(40)]
    rows += [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 120))), "en", rng.choice(["s0", "s1", None]), 0, "", 0, 0) for i in range(150)]
    return rows + [(300 + i, rows[20 + i][1], "en", "s0", 0, "", 0, 0) for i in range(30)]


# ------------------------------------------------------------------ 11 hidden Markov model

def lowered(text):
    return tokens(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_scores(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    words = [[*lowered(t), None] for _, t in rows]                       # None: the end token
    count = Counter(w for h, ws in zip(held, words, strict=True) if not h for w in ws)
    n, v = sum(count.values()), len(count)
    base = [sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws) for ws in words]
    return held, words, count, n, base


def test_base_counts_equal_brute_force(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, DOCS)
    rows = [(r[0], r[1]) for r in odd_rows]
    held, words, count, n, base = base_scores(rows)
    got = hidden_markov.lm_scores(df.repartition(3), start_rounds=2, rounds=1).collect()
    want = sorted((str(i), h, len(w), sum(count[x] > 0 for x in w), n, round(b, 6)) for (i, _), h, w, b in zip(rows, held, words, base, strict=True))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_one_state_is_the_base_model(spark, odd_rows):
    got = hidden_markov.lm_scores(spark.createDataFrame(odd_rows, DOCS), states=1, start_rounds=1, rounds=1).collect()
    assert max(abs(r["score"] - r["base_score"]) for r in got) < 1e-5


def plain_forward_backward(model, seq):
    """Unscaled recursions of one short sequence: likelihood and expected counts."""
    b = [model.ratio[x] for x in seq]
    alpha = [model.start * b[0]]
    for e in b[1:]:
        alpha.append((alpha[-1] @ model.move) * e)
    beta = [np.ones(len(model.start))]
    for e in reversed(b[1:]):
        beta.insert(0, model.move @ (e * beta[0]))
    like = alpha[-1].sum()
    total = np.zeros((len(model.ratio) + len(model.start), len(model.start)))
    k = len(model.ratio) - 1
    for t, x in enumerate(seq):
        total[x] += alpha[t] * beta[t] / like
        if t + 1 < len(seq):
            total[k:-1] += alpha[t][:, None] * model.move * (b[t + 1] * beta[t + 1])[None, :] / like
    total[-1] += alpha[0] * beta[0] / like
    return math.log(like), total


@pytest.mark.parametrize("segment", [1, 3, 7, 1000])
def test_segments_do_not_change_likelihoods_or_expectations(segment):
    rng = np.random.default_rng(1)
    model = hidden_markov.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.random((9, 3)) + 0.05)
    size = np.array([1, 2, 40, 7, 3, 21, 1])
    flat = rng.integers(0, 8, size.sum()).astype(np.int32)
    seqs = np.split(flat, np.cumsum(size)[:-1])
    want = [plain_forward_backward(model, s) for s in seqs]
    total = np.zeros((8 + 3 + 1, 3))
    hidden_markov.expect(model, flat, size, total, segment, np.float64)
    assert np.allclose(total, sum(w[1] for w in want), atol=1e-10)
    assert np.allclose(hidden_markov.log_likelihood(model, flat, size, segment), [w[0] for w in want], atol=1e-10)


def test_training_and_scores_equal_a_plain_baum_welch(spark):
    """The whole operator, its sample being all documents, against the same iterations written as plain loops."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["a", "b", "c"] if i % 2 else ["x", "y", "z", "a"], k=rng.randrange(0, 12)))) for i in range(60)]
    got = {r["doc_id"]: r for r in hidden_markov.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), states=2, start_docs=10 ** 6,
                                                           start_rounds=0, rounds=3).collect()}
    held, words, count, n, base = base_scores(rows)
    whole = n + 0.5 * (len(count) + 1)
    code = {w: int(hidden_markov.END if w is None else hidden_markov.word_hashes(w.encode())[0]) % (1 << hidden_markov.BUCKET_BITS) for w in count}
    assert len(set(code.values())) == len(code)
    buckets = 1 << hidden_markov.BUCKET_BITS
    weight = np.zeros(buckets)
    for w, c in count.items():
        weight[code[w]] = (c + 0.5) / whole
    model = hidden_markov.first_model(2, buckets)
    for _ in range(3):
        total = np.zeros((buckets + 3, 2))
        for h, ws in zip(held, words, strict=True):
            if not h:
                total += plain_forward_backward(model, [code[w] for w in ws])[1]
        model = hidden_markov.maximise(total[-1], total[-3:-1], total[:buckets], weight, 0.5 / whole)
    for (i, _), ws, b in zip(rows, words, base, strict=True):
        want = b + plain_forward_backward(model, [code.get(w, buckets) for w in ws])[0] / math.log(10)
        assert got[i]["score"] == pytest.approx(want, abs=1e-4)


def test_every_round_learns_from_all_training_documents(spark):
    """Whatever bound on the first rounds' documents is named, and with repeated rows, against plain iterations over all."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["a", "b", "c"] if i % 2 else ["x", "y", "z", "a"], k=rng.randrange(1, 9)))) for i in range(80)]
    rows += rows[:20] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = hidden_markov.lm_scores(df, states=2, start_docs=4, start_rounds=3, rounds=1).collect()
    held, words, count, n, base = base_scores(rows)
    whole, buckets = n + 0.5 * (len(count) + 1), 1 << hidden_markov.BUCKET_BITS
    code = {w: int(hidden_markov.END if w is None else hidden_markov.word_hashes(w.encode())[0]) % buckets for w in count}
    weight = np.zeros(buckets)
    for w, c in count.items():
        weight[code[w]] = (c + 0.5) / whole
    model = hidden_markov.first_model(2, buckets)
    for _ in range(4):
        total = np.zeros((buckets + 3, 2))
        for h, ws in zip(held, words, strict=True):
            if not h:
                total += plain_forward_backward(model, [code[w] for w in ws])[1]
        model = hidden_markov.maximise(total[-1], total[-3:-1], total[:buckets], weight, 0.5 / whole)
    want = [b + plain_forward_backward(model, [code.get(w, buckets) for w in ws])[0] / math.log(10) for ws, b in zip(words, base, strict=True)]
    assert np.allclose(sorted(r["score"] for r in got), sorted(want), atol=1e-4)


def test_model_is_a_distribution_and_better_on_held_out_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    r = hidden_markov.lm_scores(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]
    weight, rng = np.array([0.2, 0.0, 0.5, 0.29]), np.random.default_rng(0)
    m = hidden_markov.maximise(rng.random(2), rng.random((2, 2)), rng.random((4, 2)) * 9, weight, 0.01)
    assert np.allclose((m.ratio * np.append(weight, 0.01)[:, None]).sum(0), 1)       # q(bucket) x ratio, over all outcomes
    assert np.allclose(m.move.sum(1), 1) and np.isclose(m.start.sum(), 1)


def test_language_model_odd_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert hidden_markov.lm_scores(empty, start_rounds=1, rounds=1).collect() == []
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = hidden_markov.lm_scores(spark.createDataFrame([(one, "only held out")], "doc_id long, text string")).collect()[0]
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (True, 4, 0, 0, 0.0, 0.0)
    long = spark.createDataFrame([(i, "w" + " common rare" * 40_000) for i in range(6)], "doc_id long, text string")
    got = hidden_markov.lm_scores(long, start_rounds=1, rounds=1).collect()
    assert {r["n_tokens"] for r in got} == {80_002} and all(math.isfinite(r["score"]) for r in got)


# ------------------------------------------------------------------ 12 filter audit

def true_audit(rows, labels):
    first, good, toxic = {}, set(), set()
    for i, q, t, *_ in labels:
        good |= {i} if q == 1 else set()
        toxic |= {i} if t == 1 else set()
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    parts = {}
    for i, text, _, source, *_ in rows:
        t = text or ""
        w = tokens(t)
        fails = {f for f, bad in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                                              bool(re.search("[#$%&*|]", t)), i is not None and first[t] < i), strict=True) if bad}
        parts.setdefault(source or "", []).append((fails, i is not None and i in good, i is not None and i in toxic))
    out, shapley = [], Counter()
    for part, docs in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[part, f] += len(gone)
                out.append([part, order, step, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs),
                            sum(d[1] for d in gone), sum(d[2] for d in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_filter_audit_equals_brute_force(spark, odd_rows):
    labels = [(i, i % 2, i % 3 % 2, 1) for i in range(0, 330, 2)] + [(4, 1, 0, 1), (4, 0, 1, 1), (None, 1, 1, 1), (7, None, None, 1), (10_000, 1, 1, 1)]
    got = filter_audit.filter_audit(spark.createDataFrame(odd_rows, DOCS).repartition(4), spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, got.collect())) == true_audit(odd_rows, labels)


def test_filter_audit_one_text_many_times(spark):
    rows = [(i, "the same text", "en", f"s{i % 2}", 0, "", 0, 0) for i in range(500)] + [(0, "the same text", "en", "s1", 0, "", 0, 0)]
    got = filter_audit.filter_audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS))
    assert sorted(map(tuple, got.collect())) == true_audit(rows, [])
    assert filter_audit.filter_audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_adjacent_swaps_visit_every_order_once():
    for n in range(1, 6):
        order, seen = list(range(n)), [tuple(range(n))]
        for level in filter_audit.adjacent_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert len(seen) == len(set(seen)) == math.factorial(n)


def test_swapped_diagram_is_the_one_built_in_that_order():
    rng = random.Random(1)
    masks = {m: (rng.randrange(1, 9), rng.randrange(3), rng.randrange(3)) for m in rng.sample(range(32), 20)}
    diagram = filter_audit.Diagram(masks)
    for level in filter_audit.adjacent_swaps(5):
        diagram.swap(level)
        left = dict(masks)
        for f, kept, removed in diagram.steps():
            gone = {m: left.pop(m) for m in list(left) if m >> f & 1}
            assert removed == tuple(sum(c[i] for c in gone.values()) for i in range(3))
            assert kept == tuple(sum(c[i] for c in left.values()) for i in range(3))


# ------------------------------------------------------------------ 13 Shallot clustering

def true_clusters(rows, k, rounds):
    x = np.array([[math.floor(256 * float(c)) for c in v] for _, v in rows], np.int64)
    by = sorted(range(len(rows)), key=lambda j: (rows[j][0] is None, hashlib.sha256(f"2:{rows[j][0]}".encode()).hexdigest() if rows[j][0] is not None else "",
                                                 x[j].tolist()))
    c = x[by[:k]].copy()
    for r in range(rounds + 1):
        d = ((x[:, None, :] - c[None]) ** 2).sum(2)
        near = d.argmin(1)
        if r < rounds:
            for j in set(near.tolist()):
                c[j] = x[near == j].sum(0) // (near == j).sum()
    least = d.min(1)
    return sorted((str(i), int(near[j]), int(least[j]), int(least[near == near[j]].sum()), int(least.sum()),
                   hashlib.sha256(",".join(map(str, c[near[j]])).encode()).hexdigest()) for j, (i, _) in enumerate(rows))


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(c)) for c in rng.normal(0, spread, dim)]) for i in range(n)]


@pytest.mark.parametrize(("n", "dim", "k", "rounds", "spread"), [(300, 64, 40, 5, 0.2), (400, 2, 7, 9, 0.05), (30, 3, 40, 3, 1.0), (5, 64, 1, 2, 1.0)])
def test_shallot_equals_lloyd(spark, n, dim, k, rounds, spread):
    rows = vectors(n, dim, n, spread)
    rows += [rows[1]] * 20 + [(rows[2][0], rows[3][1]), (None, rows[0][1])]       # repeated rows, a repeated id, a null id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit(7), "v": F.lit("x")})
    got = shallot.shallot_clusters(df.repartition(3), k=k, rounds=rounds, dim=dim).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == true_clusters(rows, k, rounds)


def test_shallot_leaves_out_unsound_vectors(spark):
    sound = vectors(50, 4, 3)
    bad = [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0, 3.0]), (104, [float("nan"), 1.0, 1.0, 1.0]),
           (105, [float("inf"), 1.0, 1.0, 1.0]), (106, [1e30, 0.0, 0.0, 0.0]), (None, None)]
    df = spark.createDataFrame(sound + bad, "vec_id long, embedding array<float>")
    got = shallot.shallot_clusters(df, k=6, rounds=4, dim=4).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == true_clusters(sound, 6, 4)
    assert shallot.shallot_clusters(df.limit(0), k=6, dim=4).collect() == []
    assert shallot.shallot_clusters(df.where("vec_id > 99"), k=6, dim=4).collect() == []


def test_shallot_scan_with_ties_and_large_numbers():
    """Assignments after many moves, bounds kept all along, equal the full comparison; ties go to the smaller number."""
    rng = np.random.default_rng(9)
    for size in (3, 1000, 1 << 26):
        x = rng.integers(-size, size, (500, 3))
        c = x[:12].copy()
        c[5] = c[4]
        near, second, upper, lower = np.zeros(500, int), np.ones(500, int), np.full(500, np.inf), np.zeros(500)
        moved = np.zeros(12)
        for _ in range(8):
            near, second, upper, lower = shallot.assign(x, near, second, upper, lower, shallot.Neighbours(c), moved)
            assert (near == ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)).all()
            new = c + rng.integers(-max(1, size // 50), max(2, size // 50), c.shape)
            moved, c = np.sqrt(((new - c) ** 2).sum(1).astype(float)), new
