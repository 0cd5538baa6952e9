"""Operator 11: hidden Markov language model.

A text is its words with A-Z lower-cased and one end token.  Every word's count over the training documents gives the base
probability ``q(w) = (c + 0.5) / (N + 0.5 (V + 1))``, unknown words being one more outcome.  A hidden state bends it:
words are dealt to ``2**BUCKET_BITS`` emission buckets by a hash, and ``p(w | state) = q(w) * p(bucket | state) / q(bucket)``,
which sums to one over all outcomes.  Baum-Welch trains the states: each iteration sums the expected transitions and
emissions of every training document (forward and backward in tasks, sums across partitions) and sets the parameters
from them.  Every iteration runs over all training documents, from the same fixed start.  The score is the scaled forward
recursion's log10 likelihood, which for one state is the base score.

Long texts are cut into segments whose transfer matrices are found first; every segment then starts from its true prior, so
likelihoods and expectations are those of the uncut text.

Defined results: a null or empty text is one end token; a null id is trained on (its remainder is not 1); repeated rows
count and are scored each time; words that no training document has share the unknown outcome; without training
documents every probability is one and scores are 0; an empty table gives no rows; other columns are left out.

Scale: texts are encoded once into stored rows: per token its bucket and its number among the bucket's words in the block, as
compressed bytes.  A block has about ``BLOCK_TOKENS`` tokens and a vocabulary of its own; word counts join blocks, not
tokens, so a frequent word meets a block once.  The word table stays distributed however large the vocabulary is; only
parameters of fixed size (states x buckets) are broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import arrow_schema, free_shuffles, store, text_bytes, word_hashes

STATES, BUCKET_BITS, START_ROUNDS, ROUNDS = 8, 15, 10, 2
KAPPA = 2.0                     # tokens' worth of shrinking of a bucket's states towards all states
SEGMENT = 2048                  # tokens walked one after the other
BLOCK_TOKENS, BLOCK_DOCS = 1 << 21, 1 << 16
AT_ONCE = 1 << 20               # tokens whose state shares are held at once
MATRICES = 512                  # segments whose transfer matrices are walked at once
TASKS = 2                       # tasks of an iteration for each core
RESCALE = 8                     # steps between two scalings of a transfer matrix
END = np.uint64(0x5BF0_3635_DCE7_F1A9)          # stands for the end token among the word hashes
ENCODED = ("block long, doc_id long, train boolean, n int, buckets binary, nth binary, word_hash long, word int, bucket int, seen long")


def packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def unpacked(column: pa.Array, size: np.ndarray, kind: type) -> np.ndarray:
    """The tokens of all documents of a column, one after the other."""
    width = np.dtype(kind).itemsize
    return np.concatenate([np.frombuffer(pa.decompress(v.as_buffer(), int(n) * width, codec="zstd"), kind) for v, n in zip(column, size, strict=True)])


def encode(docs: DataFrame) -> DataFrame:
    """One row a document (``n`` tokens, their buckets and numbers in the bucket) and one a word of a block (its position
    ``word`` by bucket and number, ``seen``: how often the block's training documents hold it)."""
    train = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 1, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("train", train)
    target = arrow_schema(ENCODED)
    mask = np.uint64((1 << BUCKET_BITS) - 1)

    def out(block: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(h) for _, _, h in held])
        coded = pa.array(np.concatenate([h for _, _, h in held])).dictionary_encode()
        vocabulary, word = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        count = np.bincount(word)
        bucket = (vocabulary & mask).astype(np.int32)
        order = np.lexsort((-count, bucket))                    # by bucket, frequent words first
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        vocabulary, bucket, word = vocabulary[order], bucket[order], place[word]
        nth = np.arange(len(order)) - np.searchsorted(bucket, bucket)
        seen = np.bincount(word[np.repeat([t for _, t, _ in held], size)], minlength=len(order))
        cuts = np.cumsum(size)[:-1]
        n, v = len(held), len(vocabulary)
        docs_ = {"block": pa.array(np.full(n, block)), "doc_id": pa.array([i for i, _, _ in held], pa.int64()),
                 "train": pa.array([t for _, t, _ in held]), "n": pa.array(size, pa.int32()),
                 "buckets": pa.array([packed(x) for x in np.split(bucket[word].astype(np.uint16), cuts)], pa.binary()),
                 "nth": pa.array([packed(x) for x in np.split(nth[word].astype(np.uint32), cuts)], pa.binary())}
        words_ = {"block": pa.array(np.full(v, block)), "word_hash": pa.array(vocabulary.view(np.int64)),
                  "word": pa.array(np.arange(v), pa.int32()), "bucket": pa.array(bucket), "seen": pa.array(seen, pa.int64())}
        for cols, rows_ in ((docs_, n), (words_, v)):
            yield pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else pa.nulls(rows_, f.type) for f in target], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32           # block numbers repeat when a task is run again
        held: list[tuple] = []
        tokens = blocks = 0
        for b in batches:
            for i, t, text in zip(b.column("doc_id").to_pylist(), b.column("train").to_pylist(), b.column("text"), strict=True):
                raw = text_bytes(text.as_py()).lower()
                held.append((i, t, np.append(word_hashes(raw), END) if raw else np.array([END])))
                tokens += len(held[-1][2])
                if tokens >= BLOCK_TOKENS or len(held) >= BLOCK_DOCS:
                    yield from out(first + blocks, held)
                    held, tokens, blocks = [], 0, blocks + 1
        if held:
            yield from out(first + blocks, held)

    return store(rows.mapInArrow(run, ENCODED), "encoded")


class Model:
    """``start`` (S), ``move`` (S, S) and ``ratio`` (buckets + 1, S): p(bucket | state) / q(bucket), the last row for
    unknown words."""

    def __init__(self, start: np.ndarray, move: np.ndarray, ratio: np.ndarray):
        self.start, self.move, self.ratio = start, move, ratio


def first_model(states: int, buckets: int) -> Model:
    """Every state a slightly different distribution; the same one every time."""
    rng = np.random.default_rng(11)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, np.exp(rng.normal(0, 0.3 if states > 1 else 0, (buckets + 1, states))))


class Segments:
    """Sequences of ``buckets`` cut into segments, in columns by step; longer ones first, so those still running are a prefix."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, segment: int):
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        pieces = -(-size // segment)
        self.doc = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(len(self.doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.at = start[self.doc] + nth * segment
        self.size = np.minimum(segment, size[self.doc] - nth * segment)
        self.nth, self.last = nth, nth == pieces[self.doc] - 1
        self.order = np.argsort(-self.size, kind="stable")
        self.flat, self.depth = flat, int(pieces.max(initial=0))

    def running(self, chosen: np.ndarray) -> list[int]:
        """For every step, how many of ``chosen`` (segments by falling size) have a token there."""
        size = self.size[chosen]
        return np.searchsorted(-size, -np.arange(int(size[0])), side="left").tolist() if len(size) else []


def transfer(model: Model, seg: Segments, chosen: np.ndarray) -> np.ndarray:
    """Transfer matrix of each chosen segment (state before to state after, by rows), up to scale."""
    m = np.repeat(np.eye(len(model.start))[:, None], len(chosen), 1)         # state before, segment, state after
    step, at = np.empty_like(m), seg.at[chosen]
    for t, n in enumerate(seg.running(chosen)):
        np.multiply(m[:, :n], model.ratio[seg.flat[at[:n] + t]], out=step[:, :n])
        np.matmul(step[:, :n], model.move, out=m[:, :n])
        if t % RESCALE == RESCALE - 1:
            m[:, :n] /= m[:, :n].max((0, 2))[:, None]
    return (m / m.max((0, 2))[:, None]).transpose(1, 0, 2)


def carried(model: Model, seg: Segments, chosen: np.ndarray) -> np.ndarray:
    """Prior of the state after each chosen segment, which opens its text."""
    p, at = np.tile(model.start, (len(chosen), 1)), seg.at[chosen]
    for t, n in enumerate(seg.running(chosen)):
        p[:n] = (p[:n] * model.ratio[seg.flat[at[:n] + t]]) @ model.move
        if t % RESCALE == RESCALE - 1:
            p[:n] /= p[:n].sum(1, keepdims=True)
    return p / p.sum(1, keepdims=True)


def awaited(model: Model, seg: Segments, chosen: np.ndarray) -> np.ndarray:
    """Weights of the state before each chosen segment, which ends its text, up to scale."""
    w, at, back = np.ones((len(chosen), len(model.start))), seg.at[chosen], np.ascontiguousarray(model.move.T)
    for t, n in reversed(list(enumerate(seg.running(chosen)))):
        w[:n] = model.ratio[seg.flat[at[:n] + t]] * (w[:n] @ back)
        if t % RESCALE == 0:
            w[:n] /= w[:n].sum(1, keepdims=True)
    return w


def entries(model: Model, seg: Segments, backward: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Of every segment: the prior of its first state, and (``backward``) the weights of its exit states (what follows, up to
    scale).  Only segments with others on both sides need their matrices."""
    k, s = len(seg.doc), len(model.start)
    prior, after = np.tile(model.start, (k, 1)), np.ones((k, s))
    longest = np.argsort(-seg.size, kind="stable")
    ends = longest[(seg.last & (seg.nth > 0))[longest]]
    if len(ends):
        opens, inner = np.flatnonzero(~seg.last & (seg.nth == 0)), longest[(~seg.last & (seg.nth > 0))[longest]]
        matrix = np.empty((k, s, s)) if len(inner) else None
        for lo in range(0, len(inner), MATRICES):
            matrix[inner[lo:lo + MATRICES]] = transfer(model, seg, inner[lo:lo + MATRICES])
        by_depth = [inner[seg.nth[inner] == d] for d in range(1, seg.depth)]
        prior[opens + 1] = carried(model, seg, opens)            # the next segment is the next row
        for now in by_depth:
            if len(now):
                p = np.einsum("ki,kij->kj", prior[now], matrix[now])
                prior[now + 1] = p / p.sum(1, keepdims=True)
        if backward:
            after[ends - 1] = awaited(model, seg, ends)
            for now in reversed(by_depth):
                if len(now):
                    w = np.einsum("kij,kj->ki", matrix[now], after[now])
                    after[now - 1] = w / w.sum(1, keepdims=True)
    return prior, after


def log_likelihood(model: Model, flat: np.ndarray, size: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Natural logarithm of the states' factor of every sequence (0 for one state): scaled forward recursion."""
    seg = Segments(flat, size, segment)
    p, log, at = entries(model, seg, backward=False)[0][seg.order], np.zeros(len(seg.order)), seg.at[seg.order]
    ones, sums = np.ones((len(model.start),) * 2), np.empty_like(p)            # times ones: the sum in every column
    for t, n in enumerate(seg.running(seg.order)):
        a = model.ratio[seg.flat[at[:n] + t]]
        a *= p[:n]
        c = np.matmul(a, ones, out=sums[:n])
        log[:n] += np.log(c[:, 0])
        a /= c
        np.matmul(a, model.move, out=p[:n])
    return np.bincount(seg.doc[seg.order], log, minlength=len(size))


def expect(model: Model, flat: np.ndarray, size: np.ndarray, total: np.ndarray, segment: int = SEGMENT, kind=np.float32) -> None:
    """Add the expected counts of a batch of sequences to ``total``: a row a bucket, then transitions, then first states.
    Shares of one token are ``kind``, sums over tokens are doubles."""
    seg, s = Segments(flat, size, segment), len(model.start)
    buckets = len(total) - s - 1
    prior, after = entries(model, seg)
    ratio, move, ones = np.maximum(model.ratio, 1e-30).astype(kind), model.move.astype(kind), np.ones((s, s), kind)
    back = np.ascontiguousarray(move.T)
    moves = np.zeros((s, s))
    tokens = np.cumsum(seg.size[seg.order])
    cuts = np.flatnonzero(np.diff(tokens // AT_ONCE, prepend=-1))         # segments are independent now: a few at a time
    for lo, hi in zip(cuts, [*cuts[1:], len(seg.order)], strict=True):
        chosen = seg.order[lo:hi]
        running = seg.running(chosen)
        row = np.concatenate([[0], np.cumsum(running)])                        # the tokens of a step lie together
        share, bucket = np.empty((row[-1], s), kind), np.empty(row[-1], np.int64)
        p, at = prior[chosen].astype(kind), seg.at[chosen]
        sums, betas, joint = np.empty_like(p), np.empty_like(p), np.empty_like(p)
        for t, n in enumerate(running):
            a, now = share[row[t]:row[t + 1]], bucket[row[t]:row[t + 1]]
            now[:] = flat[at[:n] + t]
            np.take(ratio, now, axis=0, out=a, mode="clip")                        # clip: written without a buffer
            a *= p[:n]
            a /= np.matmul(a, ones, out=sums[:n])                                  # times ones: the sum in every column
            np.matmul(a, move, out=p[:n])
        ahead = after[chosen].astype(kind)                                     # weights of the state after the token
        go_on, end = (~seg.last[chosen]).astype(kind), 0
        for t, n in reversed(list(enumerate(running))):
            a, now = share[row[t]:row[t + 1]], bucket[row[t]:row[t + 1]]
            beta = np.matmul(ahead[:n], back, out=betas[:n])
            g = np.multiply(a, beta, out=joint[:n])
            c = np.matmul(g, ones, out=sums[:n])
            a /= c
            if end < n:
                a[end:] *= go_on[end:n, None]                                  # a text's last token goes nowhere
            moves += a.T @ ahead[:n]
            np.divide(g, c, out=a)                                             # from here on the share given the whole text
            w = np.take(ratio, now, axis=0, out=g, mode="clip")
            w *= beta
            np.divide(w, np.matmul(w, ones, out=c), out=ahead[:n])
            end = n
        total[-1] += share[:len(chosen)][seg.nth[chosen] == 0].sum(0, dtype=float)
        for i in range(s):
            total[:buckets, i] += np.bincount(bucket, share[:, i], minlength=buckets)
    total[buckets:buckets + s] += moves * model.move


def baum_welch(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts over all ``rows`` (``n, buckets`` of documents): first states, transitions, buckets x states."""
    s, buckets = len(model.start), len(model.ratio) - 1
    shared = rows.sparkSession.sparkContext.broadcast(model)      # states x buckets numbers
    schema = "at int, " + ", ".join(f"e{i} double" for i in range(s))
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((buckets + s + 1, s))                    # buckets, transitions, first states
        for b in batches:
            if b.num_rows:
                size = b.column("n").to_numpy()
                expect(shared.value, unpacked(b.column("buckets"), size, np.uint16), size, total)
        seen = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), *[pa.array(total[seen, i]) for i in range(s)]], schema=target)

    sums = rows.select("n", "buckets").mapInArrow(run, schema).groupBy("at").agg(*[F.sum(f"e{i}").alias(f"e{i}") for i in range(s)])
    total = np.zeros((buckets + s + 1, s))
    for r in sums.collect():                                      # at most buckets + states + 1 rows
        total[r["at"]] = r[1:]
    return total[-1], total[buckets:buckets + s], total[:buckets]


def maximise(first: np.ndarray, moves: np.ndarray, emitted: np.ndarray, weight: np.ndarray, unknown: float) -> Model:
    """Parameters from expected counts; ``weight`` is q of every bucket, ``unknown`` that of unknown words.  A bucket's states
    are shrunk towards all states by ``KAPPA`` tokens; p(bucket | state) is q(bucket) times them, made to sum to one."""
    share = emitted.sum(0) / emitted.sum() if emitted.any() else np.full(len(first), 1 / len(first))
    of_bucket = np.vstack([(emitted + KAPPA * share) / (emitted.sum(1, keepdims=True) + KAPPA), share])
    start, move = first + 0.5, moves + 0.5
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), np.maximum(of_bucket / (np.append(weight, unknown) @ of_bucket), 1e-300))


def train(encoded: DataFrame, weight: np.ndarray, unknown: float, states: int = STATES, rounds: int = START_ROUNDS + ROUNDS) -> Model:
    """``rounds`` iterations, each over all training documents."""
    tasks = TASKS * encoded.sparkSession.sparkContext.defaultParallelism          # each sends all buckets' sums: no more of them than are kept busy
    rows = encoded.where("train").coalesce(tasks)
    model = first_model(states, len(weight))
    for _ in range(rounds):
        model = maximise(*baum_welch(rows, model), weight, unknown)
        free_shuffles(rows.sparkSession)
    return model


def lm_scores(docs: DataFrame, states: int = STATES, start_docs: int | None = None, start_rounds: int = START_ROUNDS,
              rounds: int = ROUNDS, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.  ``start_docs``, once a
    bound on the documents of the first ``start_rounds`` iterations, is accepted and bounds nothing."""
    if bucket_bits != BUCKET_BITS:
        raise ValueError(f"texts are encoded for {BUCKET_BITS} bits")
    encoded = encode(docs)
    words = encoded.where("word IS NOT NULL").select("block", "word", "bucket", "word_hash", "seen")
    counts = store(words.where("seen > 0").groupBy("word_hash", "bucket").agg(F.sum("seen").alias("c")), "word-counts")
    per_bucket = counts.groupBy("bucket").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()    # 2**bits rows
    tokens, types = sum(r["c"] for r in per_bucket), sum(r["v"] for r in per_bucket)
    whole = tokens + 0.5 * (types + 1)
    weight = np.zeros(1 << BUCKET_BITS)
    for r in per_bucket:
        weight[r["bucket"]] = (r["c"] + 0.5 * r["v"]) / whole
    model = train(encoded, weight, 0.5 / whole, states, start_rounds + rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    target = arrow_schema(schema)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        count, bucket = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right.column("word").to_numpy()
        count[at], bucket[at] = right.column("c").to_numpy(), right.column("bucket").to_numpy()
        first = np.searchsorted(bucket, np.arange(1 << BUCKET_BITS))
        base = np.log10((count + 0.5) / whole)
        m, cols = shared.value, [[] for _ in target]
        for b in left.combine_chunks().to_batches(max_chunksize=1024):
            size = b.column("n").to_numpy().astype(np.int64)
            flat = unpacked(b.column("buckets"), size, np.uint16).astype(np.int32)
            word = first[flat] + unpacked(b.column("nth"), size, np.uint32)
            doc = np.repeat(np.arange(len(size)), size)
            known = count[word] > 0
            plain = np.bincount(doc, base[word], minlength=len(size))
            bent = log_likelihood(m, np.where(known, flat, len(m.ratio) - 1), size) / np.log(10) if tokens else np.zeros(len(size))
            for c, v in zip(cols, (b.column("doc_id"), pa.array(~b.column("train").to_numpy(zero_copy_only=False)), size,
                                   np.bincount(doc, known, minlength=len(size)).astype(np.int64), np.full(len(size), tokens),
                                   np.round(plain, 9), np.round(plain + bent, 9)), strict=True):
                c.append(v if isinstance(v, pa.Array) else pa.array(v))
        return pa.Table.from_arrays([pa.chunked_array(c, f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    found = (words.join(counts.select("word_hash", "c"), "word_hash", "left")
             .select("block", "word", "bucket", F.coalesce("c", F.lit(0).cast("long")).alias("c")))
    texts = encoded.where("n IS NOT NULL").select(F.col("block").alias("block"), "doc_id", "train", "n", "buckets", "nth")      # apart from that of found
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(scored, schema)
