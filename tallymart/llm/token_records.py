"""Token ids in files of length-delimited binary records, with an offset index.

A shard file is a run of records. Each record is framed as

    length of payload   uint64, little-endian
    masked checksum of those eight bytes   uint32
    payload
    masked checksum of the payload   uint32

The checksum is CRC-32 (zlib), rotated right by 15 bits plus a constant, so a
checksum stored inside checksummed data does no harm. The payload of a document is

    doc_id   int64; has_doc_id   uint8; bytes per id   uint8; ids, little-endian

Beside ``x.rec`` lies ``x.idx``: offset and payload length of each record, as
pairs of uint64, so that a reader can fetch records in any order.

Tasks write under names that no other attempt uses and return them; the
manifest, a stored table, holds only those of the attempts that count. A lost
executor or a second attempt therefore never adds or doubles records.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.chunk_encode import encoder_for
from tallymart.llm.support import columns, filesystem, materialise, scratch_path, ship, text_or_empty

# Fixed values of the format: the mask of a stored checksum.
MASK_ADDEND = 0xA282EAD8
MASK_ROTATION = 15

HEADER = struct.Struct("<QI")
TRAILER = struct.Struct("<I")
PAYLOAD_HEAD = struct.Struct("<qBB")
INDEX_ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8")])

MANIFEST = "shard int, part int, path string, n_records long, n_tokens long"
READ_BYTES = 8 << 20


class CorruptRecord(ValueError):
    """A frame whose length or checksum does not fit."""
# Tasks that read files back at most; each may read many files.
MOST_READERS = 100_000


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> MASK_ROTATION | crc << 32 - MASK_ROTATION) + MASK_ADDEND) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + TRAILER.pack(masked_checksum(length)) + payload + TRAILER.pack(masked_checksum(payload))


def unframe(data: memoryview | bytes, at: int = 0) -> tuple[bytes, int]:
    """The payload of the frame at ``at``, and where the next frame begins."""
    if len(data) < at + HEADER.size:
        raise CorruptRecord(f"no frame header at byte {at}")
    length, check = HEADER.unpack_from(data, at)
    if masked_checksum(bytes(data[at : at + 8])) != check:
        raise CorruptRecord(f"wrong length checksum at byte {at}")
    begin, end = at + HEADER.size, at + HEADER.size + length
    if len(data) < end + TRAILER.size:
        raise CorruptRecord(f"record at byte {at} is cut off")
    payload = bytes(data[begin:end])
    if TRAILER.unpack_from(data, end)[0] != masked_checksum(payload):
        raise CorruptRecord(f"wrong payload checksum at byte {at}")
    return payload, end + TRAILER.size


def serialize(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return PAYLOAD_HEAD.pack(doc_id or 0, doc_id is not None, width) + ids.astype(f"<u{width}").tobytes()


def deserialize(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, known, width = PAYLOAD_HEAD.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=PAYLOAD_HEAD.size)


def write_token_records(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    part_bytes: int = 64 << 20,
    vocabulary: int = 1 << 16,
) -> DataFrame:
    """Write the ids of every text, in ascending ``doc_id`` order, and return the manifest.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null
    text counts as empty and gives the end id alone. Null ids come first, equal
    ids in the order of a hash of their text; repeated rows each give a record.
    An empty table gives an empty manifest. Texts may have any length: one
    record is never split, and a new file begins once ``part_bytes`` are written.
    ``folder`` must be on a file system that all executors share.
    """
    ship(docs.sparkSession)
    width = 2 if vocabulary <= 1 << 16 else 4
    ordered = columns(docs, doc_id="long", text="string").select("doc_id", text_or_empty().alias("text"))
    tie = F.xxhash64("text")
    ordered = ordered.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write_shard(batches, folder, tokenizer_path, end_id, part_bytes, width)

    return materialise(ordered.mapInArrow(write, MANIFEST))


def _write_shard(
    batches: Iterator[pa.RecordBatch], folder: str, tokenizer_path: str, end_id: int, part_bytes: int, width: int
) -> Iterator[pa.RecordBatch]:
    shard, encode = TaskContext.get().partitionId(), encoder_for(tokenizer_path)
    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    done, out = [], None
    for batch in batches:
        ids, bounds = encode(batch.column("text"))
        for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            if out is None:
                name = f"{root}/{shard:06d}-{len(done):04d}-{uuid.uuid4().hex}"
                out, size, tokens, entries = store.open_output_stream(f"{name}.rec"), 0, 0, []
            own = np.append(ids[bounds[row] : bounds[row + 1]], end_id)
            data = frame(serialize(doc_id, own, width))
            entries.append((size, len(data) - HEADER.size - TRAILER.size))
            out.write(data)
            size, tokens = size + len(data), tokens + len(own)
            if size >= part_bytes:
                done.append(_close(store, out, name, shard, len(done), entries, tokens))
                out = None
    if out is not None:
        done.append(_close(store, out, name, shard, len(done), entries, tokens))
    names = ["shard", "part", "path", "n_records", "n_tokens"]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    values = zip(*done, strict=True) if done else [[] for _ in names]
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def _close(store, out, name: str, shard: int, part: int, entries: list, tokens: int) -> tuple:
    out.close()
    with store.open_output_stream(f"{name}.idx") as index:
        index.write(np.array(entries, INDEX_ENTRY).tobytes())
    return shard, part, f"{name}.rec", len(entries), tokens


def read_index(store, path: str) -> np.ndarray:
    with store.open_input_stream(path.removesuffix(".rec") + ".idx") as stream:
        return np.frombuffer(stream.read(), INDEX_ENTRY)


def read_records(store, path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of a shard file, in order; memory holds a few megabytes and one record."""
    index = read_index(store, path)
    ends = (index["offset"] + index["length"]).astype(np.int64) + HEADER.size + TRAILER.size
    with store.open_input_file(path) as file:
        row, at = 0, 0
        while row < len(index):
            last = max(row + 1, int(np.searchsorted(ends, at + READ_BYTES, "right")))
            data, begin = file.read_at(int(ends[last - 1]) - at, at), at
            while row < last:
                if int(index["offset"][row]) != at:
                    raise CorruptRecord(f"{path}: the index has another offset than byte {at}")
                payload, after = unframe(data, at - begin)
                yield deserialize(payload)
                row, at = row + 1, begin + after
        if file.size() != at:
            raise CorruptRecord(f"{path}: bytes after the last indexed record")


def read_record(store, path: str, row: int) -> tuple[int | None, np.ndarray]:
    """One record by its place in the index, for reading in shuffled order."""
    entry = read_index(store, path)[row]
    with store.open_input_file(path) as file:
        data = file.read_at(int(entry["length"]) + HEADER.size + TRAILER.size, int(entry["offset"]))
    return deserialize(unframe(data)[0])


def read_token_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Per record of the manifest's files: doc_id, start, n_tokens and ids_crc32, all from the files.

    About as many tasks read as there are files, up to ``MOST_READERS``.

    ``start`` counts the ids of all documents before it. The running total over
    files is one row per file; inside a file it is kept while reading.
    """
    files = manifest.withColumn(
        "before",
        F.sum("n_tokens").over(Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)),
    ).fillna(0, ["before"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read_files(batches, folder)

    # A number of its own keeps adaptive execution from putting the few rows of a manifest into one task.
    spread = files.select("path", "before").repartition(max(1, min(manifest.count(), MOST_READERS)), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read_files(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, _ = filesystem(folder)
    for batch in batches:
        for path, start in zip(batch["path"].to_pylist(), batch["before"].to_pylist(), strict=True):
            doc_ids, starts, counts, sums = [], [], [], []
            for doc_id, ids in read_records(store, path):
                doc_ids.append(doc_id)
                starts.append(start)
                counts.append(len(ids))
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                start += len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (doc_ids, starts, counts, sums)],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def token_records(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write all documents and read them back; by default under the session's shared folder."""
    folder = folder or scratch_path(docs.sparkSession)
    return read_token_records(write_token_records(docs, folder, tokenizer_path, end_id), folder)
