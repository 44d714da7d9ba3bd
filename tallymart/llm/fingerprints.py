"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up. On each level the sequence of names is cut into
phrases, and each phrase gets a name made from the names inside it. Where a cut
falls depends only on the few names around it:

1. A run of equal names becomes one name, so that neighbours differ.
2. Deterministic coin tossing shrinks the names: with i the lowest bit in which
   a name differs from its left neighbour, the new label is 2 i plus that bit.
   Neighbours still differ, and after four rounds labels are below 6.
3. A label larger than both neighbours begins a phrase.

So equal substrings get equal phrases, but for a few at their ends, wherever
they stand. The signatures of a text are the names of its phrases on the levels
``LEVELS`` (and of its whole, if it ends below them); its fingerprint is the
smallest ``SIZE`` of their scrambled values. The likeness of two fingerprints is
the share of common values among the smallest ``SIZE`` of both together, which
estimates the Jaccard similarity of the signatures.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.support import binary_values, columns, materialise, ship, text_or_empty

SIZE = 32
LEVELS = (2, 3)
TOSSES = 4
DIGITS = 8  # hexadecimal digits of one value

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FIRST, _SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one mixing of 64-bit numbers."""
    x = x + _ODD
    x = (x ^ x >> np.uint64(30)) * _FIRST
    x = (x ^ x >> np.uint64(27)) * _SECOND
    return x ^ x >> np.uint64(31)


_POWERS = scramble(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _runs_joined(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal names within a text as one name each; ``first`` marks each text's first name."""
    begins = first.copy()
    begins[1:] |= names[1:] != names[:-1]
    starts = np.flatnonzero(begins)
    lengths = np.diff(starts, append=len(names)).astype(np.uint64)
    joined = names[starts]
    long = lengths > 1
    joined[long] = scramble(joined[long] ^ scramble(lengths[long]))
    return joined, first[starts]


def _tossed(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing against the left neighbour; a text's first name tosses its lowest bit."""
    differ = np.empty_like(labels)
    differ[0] = 1
    np.bitwise_xor(labels[1:], labels[:-1], out=differ[1:])
    differ[first] = 1
    lowest = differ & (~differ + labels.dtype.type(1))
    place = np.bitwise_count(lowest - labels.dtype.type(1))
    return (place << 1 | ((labels & lowest) != 0)).astype(np.uint8)


def _phrases(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the phrases of one level, and which of them begin a text."""
    names, first = _runs_joined(names, first)
    labels = names
    for _ in range(TOSSES):
        labels = _tossed(labels, first)
    begins = first.copy()
    higher = labels[1:] > labels[:-1]
    begins[1:-1] |= higher[:-1] & ~higher[1:] & ~first[1:-1] & ~first[2:]
    starts = np.flatnonzero(begins)
    lengths = np.diff(starts, append=len(names))
    inside = np.arange(len(names)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(names * _POWERS[inside & 63], starts)
    return scramble(sums ^ lengths.astype(np.uint64)), first[starts]


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each text of a batch of UTF-8 bytes, its smallest signature values, ascending (none for an empty text)."""
    filled = np.flatnonzero(np.diff(offsets))
    found: list[np.ndarray] = [np.zeros(0, np.uint32)] * (len(offsets) - 1)
    if not len(filled):
        return found
    first = np.zeros(len(data), bool)
    first[offsets[filled]] = True
    names = _BYTE_NAMES[data]
    values, owners = [], []
    for level in range(1, max(LEVELS) + 1):
        names, first = _phrases(names, first)
        owner = np.cumsum(first) - 1
        # A text that is one phrase already is known by it on every level.
        alone = np.bincount(owner, minlength=len(filled)) == 1
        use = np.ones(len(names), bool) if level in LEVELS else alone[owner]
        values.append((names[use] >> np.uint64(64 - 4 * DIGITS)).astype(np.uint32))
        owners.append(owner[use])
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    bounds = np.searchsorted(owner, np.arange(len(filled) + 1))
    for row, begin, end in zip(filled.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        found[row] = value[begin : min(end, begin + SIZE)]
    return found


_BYTE_NAMES = scramble(np.arange(256, dtype=np.uint64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common values among the smallest of both; two empty fingerprints are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    smallest = np.union1d(a, b)[:SIZE]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(smallest, common, assume_unique=True).sum() / len(smallest))


def written(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def read(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following`` as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
# Beside results, the first document of a part (its head) and the last, whose successor is another part's head.
STORED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, \
near_edited double, near_next double, part int, is_head boolean, is_tail boolean, text string"


def _of(texts: list[str]) -> list[np.ndarray]:
    return fingerprints(*binary_values(pa.array(texts, pa.large_string())))


def _results(doc_ids: list, texts: list[str], prints: list, following: list[str], next_prints: list) -> list[tuple]:
    changed = [edited(text, after) for text, after in zip(texts, following, strict=True)]
    rows = []
    for doc_id, text, own, change, new, after in zip(
        doc_ids, texts, prints, changed, _of(changed), next_prints, strict=True
    ):
        digest = hashlib.sha256(change.encode()).hexdigest()
        near = likeness(own, new), likeness(own, after)
        rows.append((doc_id, len(text), digest, written(own), written(new), *near))
    return rows


def _batch(rows: list[tuple], extra: dict[str, list] | None = None) -> pa.RecordBatch:
    values = list(zip(*rows, strict=True)) if rows else [[]] * len(RESULT)
    arrays = [pa.array(v, kind) for v, kind in zip(values, RESULT.values(), strict=True)]
    names = list(RESULT)
    kinds = {"part": pa.int32(), "is_head": pa.bool_(), "is_tail": pa.bool_(), "text": pa.string()}
    for name, column in (extra or {}).items():
        names.append(name)
        arrays.append(pa.array(column, kinds[name]))
    return pa.RecordBatch.from_arrays(arrays, names)


# Characters worked on at a time; a longer text is worked on alone.
CHARS_AT_ONCE = 4_000_000


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    doc_ids, texts, size = [], [], 0
    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
        if doc_ids and size + len(text) > CHARS_AT_ONCE:
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
        doc_ids.append(doc_id)
        texts.append(text)
        size += len(text)
    if doc_ids:
        yield doc_ids, texts


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document of a sorted part next to its successor; the part's first and last are also kept as text."""
    part, held = TaskContext.get().partitionId(), None

    def marks(n: int, text: str | None, head: bool, tail: bool) -> dict[str, list]:
        return {"part": [part] * n, "is_head": [head] * n, "is_tail": [tail] * n, "text": [text] * n}

    for batch in batches:
        for doc_ids, texts in _groups(batch):
            prints = _of(texts)
            if held is None:
                first = (doc_ids[0], len(texts[0]), None, written(prints[0]), None, None, None)
                yield _batch([first], marks(1, texts[0], True, False))
            else:
                doc_ids, texts, prints = [held[0], *doc_ids], [held[1], *texts], [held[2], *prints]
            held = doc_ids[-1], texts[-1], prints[-1]
            rows = _results(doc_ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
            yield _batch(rows, marks(len(rows), None, False, False))
    if held is not None:
        last = (held[0], len(held[1]), None, written(held[2]), None, None, None)
        yield _batch([last], marks(1, held[1], False, True))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            own, after = read(row["fingerprint"]), read(row["next_fingerprint"])
            yield _batch(_results([row["doc_id"]], [row["text"]], [own], [row["next_text"]], [after]))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike neighbours are.

    A document's successor is the next in ascending ``doc_id`` order (equal ids
    in the order of a hash of their text, null ids first), the last one's is the
    first. Null texts count as empty; an empty text has an empty fingerprint,
    which is like another empty one (1.0) and unlike any other (0.0). Repeated
    rows are kept, an empty table gives no rows, other columns are ignored.

    Documents are sorted in parts. Only the first and last of each part meet
    others in a second step; memory holds one batch and one held-back text.
    Runs one job while it is built: the parts' results are stored.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    texts = columns(docs, doc_id="long", text="string").select("doc_id", text_or_empty().alias("text"))
    tie = F.xxhash64("text")
    ordered = texts.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    stored = materialise(ordered.mapInArrow(_walk, STORED))
    # One number per part that has rows.
    parts = sorted(row["part"] for row in stored.filter("is_head").select("part").collect())
    turn = list(zip(parts, parts[1:] + parts[:1], strict=True))
    following = spark.createDataFrame(turn, "part int, next_part int")
    heads = stored.filter("is_head").select(
        F.col("part").alias("next_part"),
        F.col("text").alias("next_text"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    ends = stored.filter("is_tail").select("doc_id", "fingerprint", "text", "part")
    pairs = ends.join(following, "part").join(heads, "next_part")
    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, \
near_edited double, near_next double"
    finished = pairs.select("doc_id", "fingerprint", "text", "next_text", "next_fingerprint").mapInArrow(_finish, kinds)
    return stored.filter("not is_head and not is_tail").select(*RESULT).unionByName(finished)
