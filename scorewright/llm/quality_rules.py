"""Operator 5: line labelling by a linear-chain conditional random field.

Every line of a text is content or boilerplate.  A linear-chain CRF over line features is fitted on a bounded sample
of labelled documents, their whole texts; Viterbi decoding labels the lines of each document, and the share of characters in content
lines decides whether the document is kept.

Defined results: null and empty texts have no words, fail the base rules and are not kept; lines without a word take
no part; repeated rows are judged alike; without labelled documents the fixed start weights stand (see ``PRIOR``).
Each row is judged on its own: no shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import hash_sample, map_batches, sample_rate

SYMBOLS = b"#*$%&|<>"
FEATURES = ("bias", "symbols", "shouts", "upper", "digits", "repeats", "seen", "long_words", "short_line", "ends")
CONTENT_SHARE = 0.5
TRAIN_DOCS = 4000               # bound of the labelled sample
CHAIN = 256                     # lines; in the fit, a longer text is cut into chains of so many, and all its lines count
#: Start weights of the content label against boilerplate; the fit pulls towards them where labels are few.
PRIOR = np.array([2.0, -6.0, -4.0, -2.0, -1.0, -5.0, -2.0, -1.0, 0.0, 0.5])
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_ENDS = (b".", b"!", b"?", b":", b";", b'"')


def line_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(n, len(FEATURES)) features and byte lengths of the lines that have a word."""
    seen: set[bytes] = set()
    rows, sizes = [], []
    for line in lines:
        tokens = line.split()
        if not tokens:
            continue
        n, k = sum(map(len, tokens)), len(tokens)
        distinct = len(set(tokens))
        rows.append((1.0, (n - len(line.translate(None, SYMBOLS).translate(None, b" \t\n\r\x0b\x0c"))) / n,
                     min(1.0, line.count(b"!!") / k), (len(line) - len(line.translate(None, _UPPER))) / n,
                     (len(line) - len(line.translate(None, _DIGITS))) / n, 1.0 - distinct / k if k > 3 else 0.0,
                     1.0 if line in seen else 0.0, 1.0 if n > 25 * k else 0.0, 1.0 if k < 4 else 0.0,
                     1.0 if line.rstrip().endswith(_ENDS) else 0.0))
        seen.add(line)
        sizes.append(n)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(sizes, float)


class Crf:
    """Two labels: 0 boilerplate, 1 content.  Emission score of content: features @ weights (boilerplate: 0)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """The best label sequence; ties go to content."""
        emit = (x @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b, back = 0.0, emit[0], []
        for e in emit[1:]:
            to0, to1 = b + m10 >= a + m00, b + m11 >= a + m01
            back.append((to0, to1))
            a, b = (b + m10 if to0 else a + m00), (b + m11 if to1 else a + m01) + e
        out = [b >= a]
        for to0, to1 in reversed(back):
            out.append(to1 if out[-1] else to0)
        return np.array(out[::-1], bool)


class Padded:
    """Sequences of similar length side by side."""

    def __init__(self, features: list[np.ndarray], labels: list[np.ndarray]):
        n, self.longest = len(features), max(map(len, features))
        self.x = np.zeros((n, self.longest, features[0].shape[1]))
        self.y = np.zeros((n, self.longest), int)
        self.on = np.zeros((n, self.longest), bool)
        for i, (f, lab) in enumerate(zip(features, labels, strict=True)):
            self.x[i, :len(f)], self.y[i, :len(f)], self.on[i, :len(f)] = f, lab, True
        self.both = self.on[:, 1:] & self.on[:, :-1]
        self.moves = np.array([[(self.both & (self.y[:, :-1] == a) & (self.y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])

    def gradient(self, w: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Of the log likelihood, summed over the sequences: seen counts less expected ones (forward-backward)."""
        on, x = self.on, self.x
        n, longest = on.shape
        emit = np.stack([np.zeros((n, longest)), x @ w], -1)
        fwd, bwd = np.empty((n, longest, 2)), np.zeros((n, longest, 2))
        fwd[:, 0] = emit[:, 0]
        for t in range(1, longest):
            fwd[:, t] = np.where(on[:, t, None], np.logaddexp(fwd[:, t - 1, 0, None] + m[0], fwd[:, t - 1, 1, None] + m[1]) + emit[:, t], fwd[:, t - 1])
        z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            nxt = emit[:, t + 1] + bwd[:, t + 1]
            bwd[:, t] = np.where(on[:, t + 1, None], np.logaddexp(m[:, 0] + nxt[:, 0, None], m[:, 1] + nxt[:, 1, None]), 0.0)
        p1 = np.where(on, np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z[:, None]), 0.0)
        pair = np.exp(fwd[:, :-1, :, None] + m + (emit + bwd)[:, 1:, None, :] - z[:, None, None, None])
        expected = np.where(self.both[..., None, None], pair, 0.0).sum((0, 1))
        return np.concatenate([((self.y * on - p1)[..., None] * x).sum((0, 1)), (self.moves - expected).ravel()])


def fit(features: list[np.ndarray], labels: list[np.ndarray], steps: int = 150, rate: float = 0.1,
        ridge: float = 0.02) -> Crf:
    """Maximum likelihood by forward-backward, with a ridge towards ``PRIOR``.  Sequences are padded to the next power of
    two of their length, so a few long ones cost what they hold."""
    w, m = PRIOR.copy(), np.array([[0.5, -0.5], [-0.5, 0.5]])
    if not features:
        return Crf(w, m)
    by_size: dict[int, list[int]] = {}
    for i, f in enumerate(features):
        by_size.setdefault((len(f) - 1).bit_length(), []).append(i)
    groups = [Padded([features[i] for i in at], [labels[i] for i in at]) for _, at in sorted(by_size.items())]
    total = sum(g.on.sum() for g in groups)
    start, mean, var = np.concatenate([w, m.ravel()]), np.zeros(w.size + 4), np.zeros(w.size + 4)
    theta = start.copy()
    for step in range(1, steps + 1):
        w, m = theta[:w.size], theta[w.size:].reshape(2, 2)
        g = sum(p.gradient(w, m) for p in groups) / total - ridge * (theta - start) / total ** 0.5
        mean, var = 0.9 * mean + 0.1 * g, 0.99 * var + 0.01 * g * g
        theta = theta + rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(var / (1 - 0.99 ** step)) + 1e-8)
    return Crf(theta[:w.size], theta[w.size:].reshape(2, 2))


def train(documents: DataFrame, labels: DataFrame, docs: int = TRAIN_DOCS) -> Crf:
    """Fit on at most about ``docs`` labelled documents, chosen by a hash of their id.  A line of a low-quality
    document, and a line that repeats an earlier one, is boilerplate."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    few = hash_sample(known, "doc_id", sample_rate(known.count(), docs))
    rows = (documents.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(few), "doc_id")   # at most ``docs`` ids
            .select("text", "quality"))
    width = len(FEATURES)

    def start():
        def run(r: dict) -> dict:
            xs = [line_features(t.encode("utf-8", "replace").split(b"\n"))[0] for t in r["text"]]
            return {"x": [x.astype(np.float32).ravel() for x in xs], "quality": r["quality"]}
        return run

    got = map_batches(rows, "x array<float>, quality int", start).collect()      # bounded by the sample
    xs = [np.array(g["x"], float).reshape(-1, width) for g in got if g["x"]]
    seen = FEATURES.index("seen")
    ys = [np.where(x[:, seen] > 0, 0, int(g["quality"] > 0)) for x, g in zip(xs, (g for g in got if g["x"]), strict=True)]
    cut = [(x[a:a + CHAIN], y[a:a + CHAIN]) for x, y in zip(xs, ys, strict=True) for a in range(0, len(x), CHAIN)]
    return fit([x for x, _ in cut], [y for _, y in cut])


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    tokens = text.split()
    chars = sum(len(t) for t in tokens) - sum(len(t.translate(None, _FOLLOWS_NOT)) for t in tokens if not t.isascii())
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.split():
            seen.add(line)
    return (len(tokens), chars, len(text) - len(text.translate(None, SYMBOLS)), dup, repeat_words(tokens))


#: UTF-8 bytes that are not continuation bytes.
_FOLLOWS_NOT = bytes([*range(0x80), *range(0xC0, 0x100)])


def repeat_words(tokens: list[bytes]) -> int:
    """Words covered by 3-word windows that stand in the text at least twice."""
    windows = list(zip(tokens, tokens[1:], tokens[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def judge(df: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text",
          content_share: float = CONTENT_SHARE) -> DataFrame:
    """Counts, base verdict, content share, labelled line counts and the final verdict of every row."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    weights, moves = crf.weights, crf.moves
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def start():
        model = Crf(weights, moves)

        def run(r: dict) -> dict:
            out: dict = {c: [] for c in (*names, "base_failed", "n_lines", "n_content_lines", "content_share", "kept")}
            for t in r["text"]:
                raw = (t or "").encode("utf-8", "surrogatepass")
                counts = base_counts(raw)
                for c, v in zip(names, counts, strict=True):
                    out[c].append(v)
                failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
                x, sizes = line_features(raw.split(b"\n"))
                on = model.viterbi(x) if len(x) else np.zeros(0, bool)
                share = float(sizes[on].sum() / sizes.sum()) if len(x) else 0.0
                out["base_failed"].append(failed)
                out["n_lines"].append(len(x))
                out["n_content_lines"].append(int(on.sum()))
                out["content_share"].append(share)
                out["kept"].append(not failed and share >= content_share)
            return {"doc_id": r["doc_id"], **out}
        return run

    return map_batches(src, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                       "n_repeat_words long, base_failed boolean, n_lines long, n_content_lines long, "
                       "content_share double, kept boolean", start)
