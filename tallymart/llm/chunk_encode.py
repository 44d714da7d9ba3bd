"""Byte-level BPE over Arrow batches, each distinct piece of text encoded once.

The split pattern of GPT-2 style tokenizers never lets a token cross

* a white-space character that follows a non-white-space one, or
* a punctuation character that follows a letter or digit,

because a token holds white space only as its first character or throughout,
and letters, digits and punctuation each form their own tokens (only an
apostrophe joins letters, from its left). So a text can be cut there, and every
distinct chunk needs to be encoded once. The cuts are found in the bytes of all
texts at a time: a table gives the kind of each character, a change of kind is
a cut, and ids are gathered by index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallymart.llm.support import binary_values, kept, ragged

# Kinds of characters. A chunk begins where a space follows another kind, or a mark a letter or digit.
SPACE, WORD, MARK = 0, 1, 2

# What one Python worker remembers; beyond this number it forgets all but those that came again, and of these
# the older ones beyond the second number. Each search in a memory first makes a hash table of all its texts,
# which takes several times as much as they do.
CHUNKS_REMEMBERED = 500_000
CHUNKS_CARRIED_OVER = 250_000
# Bytes of text worked on at a time; a longer text is worked on alone.
BYTES_AT_ONCE = 6 << 20
# Chunks handed to the tokenizer at a time: what it returns for each takes far more memory than the ids.
CHUNKS_AT_ONCE = 10_000
# Chunks that the tokenizer gets in one text where a special token can stand between them.
CHUNKS_IN_A_TEXT = 100


def _kind(character: str) -> int:
    """White space as Unicode has it; Python also counts the four separators 1C to 1F as such."""
    if character.isspace() and character not in "\x1c\x1d\x1e\x1f":
        return SPACE
    return WORD if character.isalnum() else MARK


@cache
def _kinds() -> np.ndarray:
    """The kinds of the characters that UTF-8 writes in up to three bytes."""
    return np.fromiter(map(_kind, map(chr, range(1 << 16))), np.uint8, 1 << 16)


def _starts(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 text, whether a chunk may begin there."""
    kinds = _kinds()
    kind = np.full(len(data) + 3, MARK, np.uint8)
    np.take(kinds[:256], data, out=kind[: len(data)])
    # All bytes of a character are of its kind, so that no cut falls within it.
    for begin in range(0, len(data), BYTES_AT_ONCE):
        some = data[begin : begin + BYTES_AT_ONCE]
        for low, high, size in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
            at = begin + np.flatnonzero((some >= low) & (some < high))
            at = at[at + size <= len(data)]
            if not len(at):
                continue
            code = data[at].astype(np.int32) & (0x7F >> size)
            for byte in range(1, size):
                code = code << 6 | data[at + byte] & 0x3F
            if size < 4:
                found = kinds[code]
            else:
                distinct, index = np.unique(code, return_inverse=True)
                found = np.array([_kind(chr(min(x, 0x10FFFF))) for x in distinct.tolist()], np.uint8)[index]
            for byte in range(size):
                kind[at + byte] = found
    starts = np.zeros(len(data), bool)
    before, after = kind[: max(len(data) - 1, 0)], kind[1 : len(data)]
    starts[1:] = (before != SPACE) & (after == SPACE)
    starts[1:] |= (before == WORD) & (after == MARK)
    return starts


class _Store:
    """Id sequences by text: a slot per text, all ids in one array."""

    def __init__(self) -> None:
        self._texts = pa.array([], pa.large_string())
        self._ids = np.zeros(0, np.int32)
        self._bounds = np.zeros(1, np.int64)
        self._again = np.zeros(0, bool)

    def __len__(self) -> int:
        return len(self._texts)

    def add(self, texts: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._texts = pa.concat_arrays([self._texts, texts])
        self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(lengths)])
        self._ids = np.concatenate([self._ids, ids])
        self._again = np.concatenate([self._again, np.zeros(len(texts), bool)])

    def newest_again(self, most: int) -> _Store:
        """A store of the texts that came again, the newest ``most`` of them."""
        slots, fresh = np.flatnonzero(self._again), _Store()
        slots = slots[max(0, len(slots) - most) :]
        fresh.add(self._texts.take(pa.array(slots)), self.ids(slots), self.lengths(slots))
        return fresh

    def find(self, texts: pa.Array) -> pa.Array:
        """The slot of each text, or null."""
        return pc.index_in(texts, self._texts)

    def came_again(self, slots: np.ndarray) -> None:
        self._again[slots] = True

    def lengths(self, slots: np.ndarray) -> np.ndarray:
        return self._bounds[slots + 1] - self._bounds[slots]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        return self._ids[ragged(self._bounds[slots], self.lengths(slots))]


def _each(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct texts, and for every text its place among them."""
    seen = pc.dictionary_encode(texts)
    return seen.dictionary, np.asarray(seen.indices).astype(np.int64)


class ChunkEncoder:
    """Encodes Arrow string arrays; ``encode`` maps new chunks to their ids.

    Strings in ``controls`` are tokens across all cuts: a text that holds one is encoded as a whole.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[list[int]]],
        remembered: int = CHUNKS_REMEMBERED,
        carried_over: int = CHUNKS_CARRIED_OVER,
        controls: Iterable[str] = (),
    ):
        self._encode = encode
        self._controls = tuple(controls)
        self._remembered, self._carried_over = remembered, carried_over
        self._chunks = _Store()

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(chunks), CHUNKS_AT_ONCE):
            found = self._encode(chunks[at : at + CHUNKS_AT_ONCE])
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.int32, int(lengths[-1].sum())))
        return np.concatenate(ids), np.concatenate(lengths)

    def _slots_of(self, distinct: pa.Array) -> np.ndarray:
        """The slots of distinct chunks; ids of those not remembered are worked out first."""
        store = self._chunks
        found = store.find(distinct)
        new = pc.is_null(found).to_numpy(zero_copy_only=False)
        slots = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        store.came_again(slots[~new])
        if new.any():
            slots[new] = len(store) + np.arange(new.sum())
            texts = distinct.filter(pa.array(new))
            store.add(texts, *self._encoded(texts.to_pylist()))
        return slots

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids begin (and the last end)."""
        texts = texts.cast(pa.large_string())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        found, bounds, at = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        while at < len(texts):
            limit = (sizes[at - 1] if at else 0) + BYTES_AT_ONCE
            after = max(at + 1, int(np.searchsorted(sizes, limit, "right")))
            ids, ends = self._with_controls(texts.slice(at, after - at))
            found.append(ids)
            bounds.append(ends[1:] + bounds[-1][-1])
            at = after
            pa.default_memory_pool().release_unused()
        return np.concatenate(found), np.concatenate(bounds)

    def _with_controls(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        held = np.zeros(len(texts), bool)
        for control in self._controls:
            held |= pc.match_substring(texts, control).to_numpy(zero_copy_only=False)
        if not held.any():
            return self._some(texts)
        empty = pa.scalar("", pa.large_string())
        ids, ends = self._some(pc.if_else(pa.array(held), empty, texts))
        found, lengths = self._encoded(texts.filter(pa.array(held)).to_pylist())
        more = np.zeros(len(texts), np.int64)
        more[held] = lengths
        ids = np.insert(ids, np.repeat(ends[:-1][held], lengths), found)
        return ids, ends + np.concatenate([[0], np.cumsum(more)])

    def _some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self._chunks) > self._remembered:
            self._chunks = self._chunks.newest_again(self._carried_over)
        data, ends = binary_values(texts)
        starts = _starts(data)
        starts[ends[:-1][np.diff(ends) > 0]] = True
        cuts = np.append(np.flatnonzero(starts), len(data))
        chunks = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
        distinct, index = _each(chunks)
        slots = self._slots_of(distinct)[index]
        tokens = np.concatenate([[0], np.cumsum(self._chunks.lengths(slots))])
        return self._chunks.ids(slots), tokens[np.searchsorted(cuts, ends)]


def _apart(ids: list[int], mark: int) -> list[list[int]]:
    """The ids between the marks."""
    found, at = [], 0
    for _ in range(ids.count(mark)):
        end = ids.index(mark, at)
        found.append(ids[at:end])
        at = end + 1
    return [*found, ids[at:]]


def _mark(added: dict) -> tuple[str, int] | None:
    """A special token that can stand between texts without any effect on their ids, and its id.

    It must not take white space or letters around it into account, and neither it nor another
    special token may begin in a text and end in it.
    """
    if len(added) != 1:
        return None
    ((number, token),) = added.items()
    text = token.content
    bound = token.lstrip or token.rstrip or token.single_word or token.normalized
    overlaps = any(text.startswith(text[at:]) for at in range(1, len(text)))
    return None if bound or overlaps or not text else (text, number)


def tokenizers_encoder(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[str]]:
    """Encodes by the tokenizers library as its plain call does; and the strings that it takes for tokens anywhere."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = tokenizer.get_added_tokens_decoder()
    mark = _mark(added)

    def plain(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(texts: list[str]) -> list[list[int]]:
        """Many short texts as one, as the call itself costs more than a short text in it."""
        found: list[list[int]] = []
        for at in range(0, len(texts), CHUNKS_IN_A_TEXT):
            group = texts[at : at + CHUNKS_IN_A_TEXT]
            joined = mark[0].join(group)
            # A text may itself hold the token.
            held = joined.count(mark[0]) >= len(group)
            found += plain(group) if held else _apart(plain([joined])[0], mark[1])
        return found

    return encode if mark else plain, [token.content for token in added.values() if token.content]


def encoder_for(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file; it lives until a task of the worker keeps something else."""

    def make() -> ChunkEncoder:
        encode, controls = tokenizers_encoder(path)
        return ChunkEncoder(encode, controls=controls)

    return kept((ChunkEncoder, path), make)
