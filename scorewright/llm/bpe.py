"""Operator 8: byte-level BPE encoding and decoding.

A pre-token is held as a doubly linked list of symbols; a priority queue gives the lowest-ranked pair next, and
entries whose symbols changed meanwhile are skipped as stale.  An entry is one number, the pair's rank and its place, and
is stale when the pair at that place has another rank now (a place never has the same pair twice).  Decoding concatenates vocabulary strings.

Defined results: a null or empty text has no tokens and decodes to an empty string; special tokens of the
vocabulary file that stand in a text are encoded as one id; repeated rows and null ids are encoded like any row.
No row needs another one, so there is no shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import regex
from pyspark.sql import DataFrame

from scorewright.llm.common import CACHE_ENTRIES, map_batches

#: The pre-token pattern of byte-level BPE; white space is the Unicode property.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: A space after other white space (Python's ``\s`` holds all of White_Space): cutting before it would cut a run.
_IN_RUN = re.compile(r"\s ").search


def byte_alphabet() -> dict[int, str]:
    """Printable stand-in of each byte: itself where printable, else the next free code point from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    free = 256
    for b in range(256):
        if b not in out:
            out[b] = chr(free)
            free += 1
    return out


class Remembered(dict):
    """text -> ``find(text)``; bounded, and long texts are not kept."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, text: str) -> bytes:
        out = self.find(text)
        if len(text) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[text] = out
        return out


class Codec:
    """Encoder and decoder for one vocabulary file (its parsed JSON)."""

    def __init__(self, spec: dict):
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary without a normalizer is needed")
        if spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("add_prefix_space is not supported")
        alphabet = byte_alphabet()
        byte_of = {c: b for b, c in alphabet.items()}
        vocab = spec["model"]["vocab"]
        self.first = [vocab[alphabet[b]] for b in range(256)]
        self.strings = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.ranks: list[dict[int, int]] = [{} for _ in self.strings]       # first id -> second id -> rank
        self.made: list[int] = []                                           # rank -> id made
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a]][vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.split = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.tokens = Remembered(self._token)
        self.pieces = Remembered(self._piece)
        self.spaced = Remembered(lambda p: self._piece(" " + p))            # pieces by what stands behind their space

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids: list[int] = [self.first[b] for b in data]
        n, ranks, made = len(ids), self.ranks, self.made
        shift = max(14, n.bit_length())             # small numbers for all but huge pre-tokens
        place = (1 << shift) - 1
        rank = [ranks[a].get(b, -1) for a, b in zip(ids, ids[1:])]          # of the pair that begins at a place, -1: none
        heap = [r << shift | i for i, r in enumerate(rank) if r >= 0]
        if not heap:
            return ids
        rank.append(-1)
        heapify(heap)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry & place
            r = entry >> shift
            if rank[i] != r:
                continue                            # stale: a neighbour was merged meanwhile
            j = nxt[i]
            nxt[i] = k = nxt[j]
            ids[i] = new = made[r]
            ids[j] = rank[j] = -1
            if k < n:
                prev[k] = i
                rank[i] = r = ranks[new].get(ids[k], -1)
                if r >= 0:
                    heappush(heap, r << shift | i)
            else:
                rank[i] = -1
            p = prev[i]
            if p >= 0:
                rank[p] = r = ranks[ids[p]].get(new, -1)
                if r >= 0:
                    heappush(heap, r << shift | p)
        return [i for i in ids if i >= 0]

    def _token(self, token: str) -> bytes:
        """Little-endian ids of one pre-token."""
        ids = self.merge(token.encode("utf-8", "surrogatepass"))
        return pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        """Little-endian ids of a piece of text whose pre-tokens do not depend on what stands around it."""
        return b"".join([self.tokens[t] for t in self.split(piece)])

    def _plain(self, text: str) -> bytes:
        if _IN_RUN(text):                       # runs of white space: a pre-token may span the cuts
            return b"".join([self.tokens[t] for t in self.split(text)])
        parts = text.split(" ")
        head = [parts[0]] if parts[0] else []
        return b"".join([self.pieces[p] for p in head] + [self.spaced[p] for p in parts[1:]])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p)
                        for p in self.cut.split(text) if p)

    def decode(self, ids: np.ndarray) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in ids.tolist()]).decode("utf-8", "replace")


def read_vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


_ready: list = []               # the vocabulary that this process used last, and its codec


def ready_codec(spec: dict) -> Codec:
    """The codec of ``spec``, which tasks that run in one process one after the other share, with what it remembers."""
    if not _ready or _ready[0] is not spec:
        _ready[:] = [spec, Codec(spec)]
    return _ready[1]


def tokenize(df: DataFrame, vocabulary: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` for every row."""
    return _run(df, vocabulary, id_col, text_col, digest=False)


def tokenize_digest(df: DataFrame, vocabulary: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row."""
    return _run(df, vocabulary, id_col, text_col, digest=True)


def _run(df: DataFrame, vocabulary: dict, id_col: str, text_col: str, digest: bool) -> DataFrame:
    src = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
    spec = df.sparkSession.sparkContext.broadcast(vocabulary)        # one vocabulary file, a few MB

    def start():
        codec = ready_codec(spec.value)

        def run(rows: dict) -> dict:
            packed = [codec.encode(t) for t in rows["text"]]
            ids = [np.frombuffer(p, "<u4") for p in packed]
            decoded = [codec.decode(i) for i in ids]
            if not digest:
                return {"doc_id": rows["doc_id"], "ids": [i.astype(np.int32) for i in ids], "decoded": decoded}
            return {"doc_id": rows["doc_id"], "n_tokens": [len(i) for i in ids],
                    "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                    "decoded_sha256": [hashlib.sha256(d.encode("utf-8", "replace")).hexdigest() for d in decoded]}
        return run

    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest \
        else "doc_id long, ids array<int>, decoded string"
    return map_batches(src, out, start)
