"""Passages that repeat an earlier one, by relative Lempel-Ziv parsing against indexed reference blocks.

A window is ``WINDOW`` consecutive words of a document. What repeats an earlier
window is found by parsing documents greedily into the longest factors that
occur in a reference, taken in document order:

1. The least hash among the ``GRAM``-word grams of a window is its anchor. Equal
   windows have equal anchors, wherever they stand, so the reference falls into
   blocks by anchor that can be indexed and parsed apart. Consecutive windows
   with one anchor form a slice. Anchors that occur once have nothing to meet.
2. Slices of repeated anchors go to their block. Copies within some hundred
   thousand words are settled where they stand, so that a passage which a third
   of all documents share sends a slice for each such run of words, not for each
   document. An anchor in very many different slices has them cut into windows,
   dealt by the window's own hash.
3. A block parses its slices in document order against the slices before them:
   from every indexed window on, the longest factor of a reference is taken,
   word by word; windows across the end of a factor are looked up on their own.
   Factors of ``WINDOW`` words or more, and such windows, are duplicate spans.

Blocks compare words, not hashes. Nothing is sampled: a window is inside a
factor or looked up, and each meets all windows that could equal it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.fingerprints import scramble
from tallymart.llm.support import columns, filesystem, materialise, scratch_path, ship

WINDOW, GRAM = 20, 8
# Words that are cut into slices at a time, and bytes of a text that are split into words at a time.
RUN_WORDS, PIECE_BYTES = 400_000, 1 << 22
# Different slices of an anchor from which they are cut into windows, and groups to which so many are dealt.
MANY_SLICES, GROUPS = 1024, 8
# The number of a row holds that of its part of the stored table from this bit on.
PART_BIT = 33

_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


class Unit(NamedTuple):
    """Consecutive words of a document, from the ``first`` of them on."""

    doc_id: int | None
    row: int
    first: int
    words: list[bytes]


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that end before white space."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, bytes]]:
    for batch in batches:
        texts = batch["text"].cast(pa.large_binary())
        for row, doc_id, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), texts, strict=True):
            yield row, doc_id, text.as_py() or b""


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[Unit]]]:
    """Some hundred thousand words of one part of the table at a time, in document order; pieces of a text overlap."""
    run, held, part = [], 0, None

    def ordered() -> list[Unit]:
        return sorted(run, key=lambda unit: (unit.doc_id is None, unit.doc_id or 0, unit.row, unit.first))

    for row, doc_id, text in _texts(batches):
        if row >> PART_BIT != part and run:
            yield part, ordered()
            run, held = [], 0
        part = row >> PART_BIT
        first, carried = 0, []
        for piece in pieces(text, PIECE_BYTES):
            words = carried + piece.split()
            run.append(Unit(doc_id, row, first, words))
            held += len(words)
            carried = words[max(0, len(words) - WINDOW + 1) :]
            first += len(words) - len(carried)
            if held >= RUN_WORDS:
                yield part, ordered()
                run, held = [], 0
    if run:
        yield part, ordered()


class Slices(NamedTuple):
    """Slices of a run: anchor, a hash of all words, the unit, the first word in the unit and the number of windows."""

    anchor: np.ndarray
    content: np.ndarray
    unit: np.ndarray
    start: np.ndarray
    windows: np.ndarray


def slices_of(units: list[Unit]) -> Slices:
    lengths = np.array([len(unit.words) for unit in units], np.int64)
    flat = [word for unit in units for word in unit.words]
    if len(flat) < WINDOW:
        return Slices(*(np.zeros(0, np.int64) for _ in range(5)))
    with np.errstate(over="ignore"):
        values = pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
        rolled = np.zeros(len(values) - GRAM + 1, np.uint64)
        for place in range(GRAM):
            rolled = rolled * _STEP + values[place : place + len(rolled)]
        gram = scramble(rolled)
        reach = WINDOW - GRAM + 1
        least = np.lib.stride_tricks.sliding_window_view(gram, reach).argmin(axis=1) + np.arange(len(gram) - reach + 1)
        ends = np.cumsum(lengths)
        unit_of = np.repeat(np.arange(len(units)), lengths)
        starts = np.flatnonzero(np.arange(len(least)) + WINDOW <= ends[unit_of[: len(least)]])
        place, own = least[starts], unit_of[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (own[1:] != own[:-1])
        begin = np.flatnonzero(new)
        windows = np.diff(begin, append=len(starts))
        start = starts[begin]
        end = start + windows + WINDOW - 1
        content = windows.astype(np.uint64)
        # A slice has up to 2 * WINDOW - GRAM = 4 * GRAM words; these grams cover them.
        for covered in (start, start + GRAM, end - 2 * GRAM, end - GRAM):
            content = scramble(content * _STEP + gram[covered])
    before = ends - lengths
    anchor = gram[place[begin]].view(np.int64)
    return Slices(anchor, content.view(np.int64), own[begin], start - before[own[begin]], windows)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run each anchor once, with how often it occurs and in how many different slices."""
    for part, units in _runs(batches):
        found = slices_of(units)
        order = np.lexsort((found.content, found.anchor))
        anchor, content = found.anchor[order], found.content[order]
        first = np.ones(len(anchor), bool)
        first[1:] = anchor[1:] != anchor[:-1]
        differ = first.copy()
        differ[1:] |= content[1:] != content[:-1]
        begin = np.flatnonzero(first)
        counts = np.diff(begin, append=len(anchor))
        kinds = np.add.reduceat(differ.astype(np.int64), begin) if len(begin) else counts
        same = np.full(len(begin), part, np.int32)
        arrays = [pa.array(x) for x in (anchor[begin], same, counts, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["anchor", "part", "times", "kinds"])


# --- tables that tasks read by the part of the rows they hold ----------------------------------------------


def _by_part(df: DataFrame, *order: str) -> str:
    """Store ``df`` with a folder for each ``part``, and return the place."""
    path = scratch_path(df.sparkSession)
    df.repartition("part").sortWithinPartitions("part", *order).write.partitionBy("part").parquet(path)
    return path


def _of_part(path: str, part: int) -> pa.Table | None:
    """The rows that were stored for a part, or None."""
    system, place = filesystem(path)
    folder = f"{place}/part={part}"
    if system.get_file_info(folder).type.name == "NotFound":
        return None
    return pads.dataset(folder, filesystem=system, format="parquet").to_table()


# --- slices -----------------------------------------------------------------------------------------------

_SLICE = "anchor long, salt int, doc_id long, row long, start long, length long, words binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["anchor", "salt", "doc_id", "row", "start", "length", "words"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    values = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    rows.clear()
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def _repeated(batches: Iterator[pa.RecordBatch], path: str, many: int) -> Iterator[pa.RecordBatch]:
    """Slices of repeated anchors, one of each in a run; of its copies there, the span alone (without an anchor)."""
    part, known, kinds = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows: list[tuple] = []
    for at, units in _runs(batches):
        if at != part:
            part, stored = at, _of_part(path, at)
            known, kinds = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if stored is not None:
                known, places = np.unique(stored["anchor"].to_numpy(), return_index=True)
                kinds = stored["kinds"].to_numpy()[places]
        if not len(known):
            continue
        found = slices_of(units)
        place = np.minimum(np.searchsorted(known, found.anchor), len(known) - 1)
        met: set[tuple[int, bytes]] = set()
        for i in np.flatnonzero(known[place] == found.anchor).tolist():
            unit, start, windows = units[found.unit[i]], int(found.start[i]), int(found.windows[i])
            anchor, salts = int(found.anchor[i]), int(kinds[place[i]]) // many * GROUPS
            cuts = range(start, start + windows) if salts else (start,)
            length = WINDOW if salts else windows + WINDOW - 1
            for cut in cuts:
                words = b" ".join(unit.words[cut : cut + length])
                if (anchor, words) in met:
                    rows.append((None, None, None, unit.row, unit.first + cut, length, None))
                    continue
                met.add((anchor, words))
                salt = zlib.crc32(words) % (salts + 1)
                rows.append((anchor, salt, unit.doc_id, unit.row, unit.first + cut, length, words))
            if len(rows) >= 20_000:
                yield _rows(rows)
    yield _rows(rows)


# --- parsing ----------------------------------------------------------------------------------------------


class Reference:
    """An indexed reference block: slices in document order, and where each of their windows first stands."""

    def __init__(self):
        self.slices: list[list[bytes]] = []
        self.whole: set[bytes] = set()
        self.index: dict[bytes, tuple[int, int]] = {}

    def parse(self, text: bytes) -> list[tuple[int, int]]:
        """First word and length of the spans of a slice that occur in the block; then the slice joins the block."""
        words = text.split(b" ")
        if text in self.whole:
            return [(0, len(words))]
        spans, last = [], len(words) - WINDOW
        windows = [b" ".join(words[i : i + WINDOW]) for i in range(last + 1)]
        at = 0
        while at <= last:
            place = self.index.get(windows[at])
            if place is None:
                at += 1
                continue
            length, (number, offset) = WINDOW, place
            reference = self.slices[number]
            while (
                at + length < len(words)
                and offset + length < len(reference)
                and words[at + length] == reference[offset + length]
            ):
                length += 1
            spans.append((at, length))
            # Windows across the end of the factor may occur elsewhere in the block.
            for crossing in range(at + length - WINDOW + 1, min(at + length, last + 1)):
                if windows[crossing] in self.index:
                    spans.append((crossing, WINDOW))
            at += length
        number = len(self.slices)
        self.slices.append(words)
        self.whole.add(text)
        for i, window in enumerate(windows):
            self.index.setdefault(window, (number, i))
        return spans


def _factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of slices that come sorted by block and document."""
    key, reference = None, Reference()
    names = ["row", "start", "length"]
    for batch in batches:
        found = []
        values = (batch[name].to_pylist() for name in ("anchor", "salt", "row", "start", "words"))
        for anchor, salt, row, start, words in zip(*values, strict=True):
            if (anchor, salt) != key:
                key, reference = (anchor, salt), Reference()
            found += [(row, start + first, length) for first, length in reference.parse(words)]
        values = list(zip(*found, strict=True)) if found else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], names)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that come sorted by row and start, with those that touch or overlap as one."""
    names = ["part", "row", "start", "end"]
    current: list[int] | None = None
    for batch in batches:
        out = []
        values = (batch[name].to_pylist() for name in ("row", "start", "length"))
        for row, start, length in zip(*values, strict=True):
            if current and current[0] == row and start <= current[2]:
                current[2] = max(current[2], start + length)
            else:
                if current:
                    out.append((current[0] >> PART_BIT, *current))
                current = [row, start, start + length]
        values = list(zip(*out, strict=True)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(values, [pa.int32(), *[pa.int64()] * 3], strict=True)], names
        )
    if current:
        arrays = [pa.array([x]) for x in (np.int32(current[0] >> PART_BIT), *current)]
        yield pa.RecordBatch.from_arrays(arrays, names)


# --- the documents without them ---------------------------------------------------------------------------

RESULT = "doc_id long, n_words long, n_removed long, kept string, starts array<long>, ends array<long>"


def _without(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept", "starts", "ends"]
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), longs, longs]
    part, spans, rows, held = None, {}, [], 0

    def flush() -> pa.RecordBatch:
        values = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    for row, doc_id, text in _texts(batches):
        if row >> PART_BIT != part:
            part = row >> PART_BIT
            stored, spans = _of_part(path, part), {}
            if stored is not None:
                for own, start, end in zip(*(stored[x].to_pylist() for x in ("row", "start", "end")), strict=True):
                    spans.setdefault(own, []).append((start, end))
        own = sorted(spans.get(row, ()))
        kept, first = [], 0
        for piece in pieces(text, PIECE_BYTES):
            words = piece.split()
            at = 0
            for start, end in own:
                if start < first + len(words) and end > first:
                    kept += words[at : max(start - first, 0)]
                    at = end - first
            kept += words[at:]
            first += len(words)
        removed = sum(end - start for start, end in own)
        whole = b" ".join(kept).decode()
        rows.append((doc_id, first, removed, whole, [a for a, _ in own], [b for _, b in own]))
        held += len(whole) + 64
        if held >= 8_000_000:
            held = 0
            yield flush()
    yield flush()


def remove_repeats(docs: DataFrame, many: int = MANY_SLICES) -> DataFrame:
    """Documents without the words of windows that also start earlier.

    Words are runs of characters other than ASCII white space, unchanged. A word
    goes if a window of ``WINDOW`` words that covers it has the same words as
    one that starts earlier: in a document with a smaller doc_id, or before it
    in the same one. Windows are judged on the input. Returns doc_id, n_words,
    n_removed, kept (the other words, joined by single spaces), and starts and
    ends (the removed spans as numbers of words from 0, end exclusive).

    A null or empty text has no words, and one of fewer than ``WINDOW`` words
    keeps them all. Rows with the same doc_id are documents of their own, in
    the order of the table; those with a null id come last. An empty table gives
    no rows. Columns other than doc_id and text are ignored.

    ``many`` is the number of different slices of one anchor from which they are
    dealt out window by window; it changes the work, not the result. Runs jobs
    while it is built; texts, slices and spans are stored.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = columns(docs, doc_id="long", text="string")
    stored = materialise(plain.withColumn("row", F.monotonically_increasing_id()))
    seen = materialise(stored.mapInArrow(_anchors, "anchor long, part int, times long, kinds long"))
    often = seen.groupBy("anchor").agg(F.sum("times").alias("times"), F.sum("kinds").alias("kinds"))
    often = often.filter("times > 1").select("anchor", "kinds")
    wanted = _by_part(seen.select("anchor", "part").join(often, "anchor"), "anchor")
    found = materialise(stored.mapInArrow(lambda batches: _repeated(batches, wanted, many), _SLICE))

    spans = "row long, start long, length long"
    sent = found.filter("anchor is not null")
    blocks = sent.repartition("anchor", "salt").sortWithinPartitions(
        "anchor", "salt", F.asc_nulls_last("doc_id"), "row", "start"
    )
    factors = blocks.mapInArrow(_factors, spans)
    copies = found.filter("anchor is null").select("row", "start", "length")
    both = factors.union(copies).repartition("row").sortWithinPartitions("row", "start")
    merged = both.mapInArrow(_merged, "part int, row long, start long, end long")
    removed = _by_part(merged, "row", "start")
    return stored.mapInArrow(lambda batches: _without(batches, removed), RESULT)
