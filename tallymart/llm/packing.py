"""Documents packed into as few sequences of a fixed length as possible.

Which lengths share a sequence depends on the lengths alone, so the plan is
made from their histogram: at most ``capacity`` numbers, whatever the size of
the corpus. Each bin starts with the longest piece left. A bitset holds the
sums that the shorter lengths left can reach; its highest bit within the rest
of the bin is the fullest combination. That combination is then removed as
often as the histogram allows, which uses up at least one length, so the number
of rounds depends on ``capacity`` only. Pieces are numbered within their length
and look up their bin by that number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.chunk_encode import ChunkEncoder, encoder_for
from tallymart.llm.support import columns, frugal, materialise, ship, slices, text_or_empty

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"


def fullest(available: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how often each, out of ``available``, that fill ``room`` best.

    Of equally full combinations the one with longer lengths is taken.
    """
    lengths = sorted((x for x, n in available.items() if n and x <= room), reverse=True)
    mask = (1 << room + 1) - 1
    reach, stages = 1, []
    for length in lengths:
        stages.append((length, reach))
        copies, step = min(available[length], room // length), 1
        while copies:
            take = min(step, copies)
            reach |= reach << take * length & mask
            copies, step = copies - take, step * 2
        if reach >> room:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(stages):
        while not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + 1
            target -= length
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs of equal bins: length, first number, copies in a bin, first bin, offset in the bin.

    The copies of a length numbered ``first number`` onwards go, ``copies`` at a
    time, into consecutive bins; a run ends where the next of its length begins.
    """
    available = {x: n for x, n in histogram.items() if n > 0}
    used = dict.fromkeys(available, 0)
    runs, bins = [], 0
    for longest in sorted(available, reverse=True):
        while available[longest]:
            available[longest] -= 1
            chosen = fullest(available, capacity - longest)
            available[longest] += 1
            chosen[longest] = chosen.get(longest, 0) + 1
            times, offset = min(available[x] // n for x, n in chosen.items()), 0
            for length, copies in sorted(chosen.items(), reverse=True):
                runs.append((length, used[length], copies, bins, offset))
                used[length] += copies * times
                available[length] -= copies * times
                offset += copies * length
            bins += times
    return runs


def cut(n_tokens: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences, before them what does not fill one."""
    rest = n_tokens % capacity
    return [rest] * bool(rest) + [capacity] * (n_tokens // capacity)


def _pieces(
    batches: Iterator[pa.RecordBatch], encode: ChunkEncoder, end_id: int, capacity: int, keep_ids: bool
) -> Iterator[pa.RecordBatch]:
    """The pieces of all texts, made for a slice of a batch at a time."""
    part = TaskContext.get().partitionId()
    seen: dict[int, int] = {}
    for some in (own for batch in batches for own in slices(batch)):
        ids, bounds = encode(some.column("text"))
        ids = ids.astype("<u4")
        rows = []
        for row, doc_id in enumerate(some.column("doc_id").to_pylist()):
            own, start = np.append(ids[bounds[row] : bounds[row + 1]], np.uint32(end_id)), 0
            for piece, length in enumerate(cut(len(own), capacity)):
                data = own[start : start + length].tobytes()
                number = seen[length] = seen.get(length, -1) + 1
                facts = (doc_id, piece, start, length, zlib.crc32(data), part, number)
                rows.append((*facts, data) if keep_ids else facts)
                start += length
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number", "ids"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        many = len(names) if keep_ids else len(names) - 1
        values = list(zip(*rows, strict=True)) if rows else [[]] * many
        arrays = [pa.array(v, k) for v, k in zip(values, kinds[:many], strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names[:many])


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, keep_ids: bool) -> DataFrame:
    """One row per piece; ``number`` counts the pieces of its length in its part of the table."""
    ship(docs.sparkSession)
    texts = columns(docs, doc_id="long", text="string").select("doc_id", text_or_empty().alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pieces(batches, encoder_for(tokenizer_path), end_id, capacity, keep_ids)

    return texts.mapInArrow(frugal(work, keeps=True), PIECES + ", ids binary" * keep_ids)


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048, keep_ids: bool = False
) -> DataFrame:
    """Place every document's ids (and an end id) in sequences of at most ``capacity``.

    Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and,
    with ``keep_ids``, ids (uint32, little-endian). Only documents longer than
    a sequence are cut. A null text counts as empty and is the end id alone; a
    null doc_id is kept; each of several equal rows is placed. An empty table
    gives no rows. Columns of ``docs`` other than doc_id and text are ignored.
    Runs one job while it is built: pieces are stored, so that their numbers stay.
    """
    pieces = materialise(tokenized_pieces(docs, tokenizer_path, end_id, capacity, keep_ids))
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(histogram, capacity)
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["length", "part"])
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    # One sortable number for (length, first number), to find a piece's run in one search.
    scale = int(table[:, 1].max(initial=0)) + max(histogram.values(), default=0) + 1
    keys = table[:, 0] * scale + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy()
            number = batch["number"].to_numpy() + batch["before"].to_numpy()
            run = table[np.searchsorted(keys, length * scale + number, "right") - 1]
            within = number - run[:, 1]
            sequence = run[:, 3] + within // np.maximum(run[:, 2], 1)
            offset = run[:, 4] + within % np.maximum(run[:, 2], 1) * length
            kept = [name for name in batch.schema.names if name not in ("part", "number", "before")]
            arrays = [batch[name] for name in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "sequence_id", "offset"])

    kept = "length long, doc_id long, piece int, start long, ids_crc32 long" + ", ids binary" * keep_ids
    return numbered.mapInArrow(place, kept + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids themselves, from pieces with ``ids``: one row per sequence, no longer than the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("array_size(parts)").alias("n_pieces"),
        F.aggregate("parts", F.expr("X''"), lambda ids, part: F.concat(ids, part["ids"])).alias("ids"),
    )
