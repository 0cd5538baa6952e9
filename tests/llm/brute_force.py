"""Brute-force versions and odd inputs for the tests of the text operators."""

import hashlib
import itertools
import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NASTY = [None, "", " \t\n\x0b\x0c\r", "a", "  double  spaces\n\n\tand tabs ", "\x1c\x1d fs \x85 nel \xa0 nbsp \u3000 wide",
         "It's we'll I'd  x's 's", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "naïve \U0001f600 日本語 ٣٤",
         "x" * 5000, "word " * 3000, "\n".join(["line one two"] * 40), "tail ", " head", "1234567 12.5e3 --- $$$ ##"]


def tokens(text):
    return WORD.findall(text) if text else []


def check_packing(rows, texts, capacity, per_source):
    length = {i: len(tokens(t)) for i, t in texts.items()}
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        if r["bin"] is not None:
            bins.setdefault((r["pack_group"], r["bin"]), []).append(r)
    assert set(pieces) == set(texts)
    for i, p in pieces.items():
        p.sort(key=lambda r: r["piece"])
        assert sum(r["n_words"] for r in p) == length[i]
        assert [r["first_word"] for r in p] == [k * capacity for k in range(len(p))]
    for b in bins.values():
        b.sort(key=lambda r: r["bin_offset"])
        assert sum(r["n_words"] for r in b) <= capacity
        assert [r["bin_offset"] for r in b] == [sum(x["n_words"] for x in b[:k]) for k in range(len(b))]
        assert len({r["cluster"] for r in b}) == len(b)
        sources = [r["source"] for r in b]
        assert max(map(sources.count, sources)) <= per_source
    return len(bins)


def true_components(texts, n, share):
    sets = {}
    for i, t in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = tokens(w)
        sets.setdefault(i, []).append({tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    root = {i: i for i in sets if i is not None}

    def find(x):
        return x if root[x] == x else find(root[x])
    for a, b in itertools.combinations(sorted(root), 2):
        if any(x and y and 100 * len(x & y) >= share * len(x | y) for x in sets[a] for y in sets[b]):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}, sets


def true_dedup(rows, size):
    """Rows that share an id are one document for the order."""
    first = {}
    texts = [(i if i is not None else 1 << 63, tokens(t)) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for i, w in texts:
        keep = [True] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < (i, k):
                keep[k:k + size] = [False] * size
        kept = [x for x, y in zip(w, keep, strict=True) if y]
        out.append((i if i < 1 << 63 else None, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)
