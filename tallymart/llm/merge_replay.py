"""Byte-level BPE by replaying the merges over many words at once.

All distinct words stand one after the other in one array of tokens, each
linked to its neighbours. An inverted index leads from the rank of a token pair
to the positions where that pair stands. Ranks are taken in ascending order;
each merge touches its positions and their two neighbours only, and enters the
pairs that it makes into the index.

A merge may make a pair of a lower rank than its own (a token can have been
learnt from another split). Where a rank can do so, only the leftmost position
of each word is merged before the lower rank gets its turn, which is the order
in which a word alone would be encoded.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallymart.llm.chunk_encode import ChunkEncoder
from tallymart.llm.support import columns, ship, text_or_empty

NO_PAIR = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Encodes words by a table of ranks, and decodes ids. Every single byte must have a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing}")
        self._of_byte = np.array([ranks[bytes([byte])] for byte in range(256)], np.int32)
        size = max(ranks.values()) + 1
        self._tokens = [b""] * size
        pairs = []
        for token, rank in ranks.items():
            self._tokens[rank] = token
            for at in range(1, len(token)):
                left, right = ranks.get(token[:at]), ranks.get(token[at:])
                if left is not None and right is not None:
                    pairs.append((left * size + right, rank))
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self._size, self._keys, self._ranks = size, table[:, 0], table[:, 1].astype(np.int32)
        # Ranks whose token is part of a pair of a lower rank.
        self._may_go_back = np.zeros(size, bool)
        for part in (self._keys // size, self._keys % size):
            self._may_go_back[part[self._ranks < part]] = True

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens; NO_PAIR where they do not merge (or one is missing, -1)."""
        if not len(self._keys):
            return np.full(len(left), NO_PAIR, np.int32)
        keys = left.astype(np.int64) * self._size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._ranks[at], NO_PAIR)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        n = int(lengths.sum())
        # A place after each word's last byte keeps words apart.
        token = np.full(n + len(words) + 1, -1, np.int32)
        word = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(n) + word + 1
        token[place] = self._of_byte[np.frombuffer(b"".join(words), np.uint8)]
        of_word = np.zeros(len(token), np.int64)
        of_word[place] = word
        after = np.arange(1, len(token) + 1)
        after[-1] = len(token) - 1
        before = np.arange(-1, len(token) - 1)
        before[0] = 0
        rank = np.full(len(token), NO_PAIR, np.int32)
        rank[:-1] = self._rank(token[:-1], token[1:])

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
            real = ranks != NO_PAIR
            positions, ranks = positions[real], ranks[real]
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1, append=-1)).tolist()
            for begin, end in pairwise(cuts):
                now = int(ranks[begin])
                if now not in index:
                    index[now] = []
                    heapq.heappush(heap, now)
                index[now].append(positions[begin:end])

        enter(np.arange(len(token)), rank)
        while heap:
            now = heapq.heappop(heap)
            at = np.unique(np.concatenate(index.pop(now)))
            at = at[rank[at] == now]
            if not len(at):
                continue
            later = at[:0]
            if self._may_go_back[now]:
                leftmost = np.ones(len(at), bool)
                leftmost[1:] = of_word[at[1:]] != of_word[at[:-1]]
                at, later = at[leftmost], at[~leftmost]
            elif len(at) > 1:
                at = at[_not_overlapping(at, after)]
            gone = after[at]
            beyond = after[gone]
            token[at] = now
            after[at], before[beyond] = beyond, at
            previous = before[at]
            token[gone], rank[gone] = -1, NO_PAIR
            rank[at] = self._rank(token[at], token[beyond])
            rank[previous] = self._rank(token[previous], token[at])
            enter(np.concatenate([at, previous]), np.concatenate([rank[at], rank[previous]]))
            if len(later):
                enter(later, rank[later])
        left = np.flatnonzero(token >= 0)
        counts = np.bincount(of_word[left], minlength=len(words))
        return np.split(token[left], np.cumsum(counts)[:-1]) if len(ends) else []

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self._tokens.__getitem__, ids.tolist()))


def _not_overlapping(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions in a row whose pairs overlap, every other one from the left."""
    follows = np.zeros(len(at), bool)
    follows[1:] = after[at[:-1]] == at[1:]
    order = np.arange(len(at))
    row = np.maximum.accumulate(np.where(follows, 0, order))
    return (order - row) % 2 == 0


def chunk_encoder(replay: MergeReplay, pattern: str) -> Callable[[list[str]], list[list[int]]]:
    """Encodes chunks: splits them by the pattern and replays the merges over all distinct matches."""
    split = regex.compile(pattern)

    def encode(chunks: list[str]) -> list[np.ndarray]:
        matches = [split.findall(chunk) for chunk in chunks]
        places: dict[str, int] = {}
        for found in matches:
            for match in found:
                places.setdefault(match, len(places))
        ids = replay.encode([match.encode() for match in places])
        joined = []
        for found in matches:
            parts = [ids[places[match]] for match in found]
            joined.append(parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts]))
        return joined

    return encode


_workers: dict[tuple[str, str], tuple[MergeReplay, ChunkEncoder, list[bytes]]] = {}


def _worker(path: str, pattern: str) -> tuple[MergeReplay, ChunkEncoder, list[bytes]]:
    if (path, pattern) not in _workers:
        ranks = read_ranks(path)
        replay = MergeReplay(ranks)
        decimal = [b"%d" % rank for rank in range(max(ranks.values()) + 1)]
        _workers[path, pattern] = replay, ChunkEncoder(chunk_encoder(replay, pattern)), decimal
    return _workers[path, pattern]


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    _, encode, _ = _worker(path, pattern)
    for batch in batches:
        ids, bounds = encode(batch["text"])
        arrays = [batch["doc_id"], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    replay, _, decimal = _worker(path, pattern)
    for batch in batches:
        lists = batch["ids"]
        offsets = np.asarray(lists.offsets).astype(np.int64)
        ids = np.asarray(lists.values)
        rows = []
        for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
            own = ids[begin:end].tolist()
            joined = b",".join(map(decimal.__getitem__, own))
            data = replay.decode(ids[begin:end])
            rows.append((int(end - begin), hashlib.sha256(joined).hexdigest(), hashlib.sha256(data).hexdigest()))
        values = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds = [pa.int64(), pa.string(), pa.string()]
        arrays = [batch["doc_id"], *[pa.array(v, k) for v, k in zip(values, kinds, strict=True)]]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every text, as the rank file's tokenizer has them without special tokens.

    A null text counts as empty and has no ids; a null doc_id and repeated rows
    are kept; an empty table gives no rows; other columns are ignored. A text of
    any length is encoded whole, but its longest word must fit in memory.
    """
    ship(docs.sparkSession)
    texts = columns(docs, doc_id="long", text="string").select("doc_id", text_or_empty().alias("text"))
    return texts.mapInArrow(lambda batches: _encode(batches, path, pattern), "doc_id long, ids array<int>")


def decoded_digests(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``encode_documents``: number of ids, digest of the ids, and digest of the bytes they decode to."""
    ship(encoded.sparkSession)
    return encoded.mapInArrow(
        lambda batches: _decode(batches, path, pattern),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
