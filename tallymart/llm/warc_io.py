"""WARC archives: written from a table of payloads, read by a Python data source.

Written files are gzip members, one per record, so a reader can start at any
record. Beside ``x.warc.gz`` lies ``x.cdx``: offset, length and record type of
each member as JSON lines. The reader plans ranges of bytes of these indexes
from file sizes; each task reads its own range.

The data source ``warc`` (option ``path``) returns a row per record. Equality
and IN filters on ``record_type`` and on header columns are taken over by the
reader: the type is looked up in the index, other headers are compared as soon
as they are parsed, and a payload is decoded only if its column is asked for
and its record passed all filters.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from tallymart.llm.support import columns, filesystem, materialise, scratch_path, ship, text_or_empty

VERSION = b"WARC/1.1"
MANIFEST = "manifest.json"
PART_BYTES = 64 << 20
PARTITION_BYTES = 16 << 20
READ_BYTES = 1 << 16

# Column of a record and the header it comes from.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "page_id": "X-Page-ID",
    "refers_to_page": "X-Refers-To-Page",
    "payload_bytes": "X-Payload-Length",
}
SCHEMA = ", ".join(f"{name} string" for name in HEADERS) + ", path string, offset long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member. Line breaks in header values become spaces."""
    lines = [VERSION, *(f"{k}: {' '.join(v.splitlines())}".encode() for k, v in headers.items())]
    plain = b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", b""]) + block + b"\r\n\r\n"
    machine = zlib.compressobj(1, zlib.DEFLATED, 31)
    return machine.compress(plain) + machine.flush()


class Member:
    """A record read piece by piece: headers first, the block only on demand."""

    def __init__(self, data: bytes):
        self._machine, self._data, self._plain = zlib.decompressobj(31), data, b""
        while (end := self._plain.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise ValueError("a record without an end of its headers")
        version, *lines = self._plain[:end].split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:20]!r}")
        self.headers = {}
        for line in lines:
            name, _, value = line.decode().partition(":")
            self.headers[name.strip().lower()] = value.strip()
        self._begin = end + 4

    def _more(self) -> bool:
        if self._machine.eof:
            return False
        rest = self._machine.unconsumed_tail or (self._data if not self._plain else b"")
        piece = self._machine.decompress(rest, READ_BYTES)
        self._plain += piece
        return bool(piece)

    def block(self) -> bytes:
        length = int(self.headers["content-length"])
        pieces = [self._plain]
        have = len(self._plain)
        while have < self._begin + length:
            piece = self._machine.decompress(self._machine.unconsumed_tail, 1 << 22)
            if not piece:
                raise ValueError("a record's block is cut off")
            pieces.append(piece)
            have += len(piece)
        return b"".join(pieces)[self._begin : self._begin + length]


class Span(InputPartition):
    """A range of bytes of one archive's index: the members whose lines begin there."""

    def __init__(self, path: str, begin: int, end: int):
        super().__init__((path, begin, end))
        self.path, self.begin, self.end = path, begin, end


def _index_of(archive: str) -> str:
    return archive.removesuffix(".warc.gz") + ".cdx"


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self._path = path
        self._names = [field.name for field in schema.fields]
        self._wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            name = one.attribute[0] if isinstance(one, EqualTo | In | IsNotNull) and len(one.attribute) == 1 else None
            if name in HEADERS and isinstance(one, EqualTo):
                self._wanted.append((name, frozenset([one.value])))
            elif name in HEADERS and isinstance(one, In):
                self._wanted.append((name, frozenset(one.value)))
            else:
                yield one

    def partitions(self) -> list[Span]:
        """Ranges of the indexes, a range for every ``PARTITION_BYTES`` of an archive.

        Comes from file sizes alone: the indexes, a line per record, are read by the tasks.
        """
        store, root = filesystem(self._path)
        archives = _archives(store, root)
        sizes = {info.path: info.size for info in store.get_file_info([*archives, *map(_index_of, archives)])}
        spans = []
        for archive in archives:
            lines = sizes[_index_of(archive)]
            pieces = max(1, -(-sizes[archive] // PARTITION_BYTES))
            cuts = [lines * i // pieces for i in range(pieces + 1)]
            spans += [Span(archive, begin, end) for begin, end in zip(cuts, cuts[1:]) if begin < end]
        return spans

    def members(self, span: Span) -> Iterator[tuple[int, int]]:
        """Offset and length of the span's records, but for those whose type no filter lets through."""
        store, _ = filesystem(self._path)
        types = [values for name, values in self._wanted if name == "record_type"]
        with store.open_input_file(_index_of(span.path)) as file:
            for line in _lines(file, span.begin, span.end):
                offset, length, kind = json.loads(line)
                if all(kind in values for values in types):
                    yield offset, length

    def read(self, partition: Span | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no records
            return
        store, _ = filesystem(self._path)
        rows, held = [], 0
        with store.open_input_file(partition.path) as file:
            for offset, length in self.members(partition):
                row = self._row(partition.path, offset, file.read_at(length, offset))
                if row is None:
                    continue
                rows.append(row)
                held += len(row[-1] or b"")
                if held >= 4 << 20 or len(rows) >= 2000:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _row(self, path: str, offset: int, data: bytes) -> tuple | None:
        member = Member(data)
        values = {name: member.headers.get(header.lower()) for name, header in HEADERS.items()}
        if any(values[name] not in wanted for name, wanted in self._wanted):
            return None
        own = values | {"path": path, "offset": offset, "payload": None}
        if "payload" in self._names:
            own["payload"] = member.block()
        return *(own[name] for name in self._names if name != "payload"), own["payload"]

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        names = [*(name for name in self._names if name != "payload"), "payload"]
        kinds = {"offset": pa.int64(), "payload": pa.binary()}
        found = {
            name: pa.array(values, kinds.get(name, pa.string()))
            for name, values in zip(names, zip(*rows, strict=True), strict=True)
        }
        return pa.RecordBatch.from_arrays([found[name] for name in self._names], self._names)


def _lines(file: pa.NativeFile, begin: int, end: int) -> Iterator[bytes]:
    """The lines that begin in a range of bytes; the last of them may end beyond it."""
    # A line begins at `begin` only if the byte before ends one.
    at, rest, skipping = max(begin - 1, 0), b"", begin > 0
    start = at
    while start < end:
        data = file.read_at(READ_BYTES, at)
        at += len(data)
        *whole, rest = (rest + data).split(b"\n")
        if not data:
            whole, rest = ([rest] if rest else []), b""
        for line in whole:
            if start >= end:
                return
            if not skipping:
                yield line
            skipping = False
            start += len(line) + 1
        if not data:
            return


def _archives(store: pafs.FileSystem, root: str) -> list[str]:
    """The archives of a folder: those of its manifest, or all if it has none."""
    manifest = f"{root}/{MANIFEST}"
    if store.get_file_info(manifest).type == pafs.FileType.File:
        with store.open_input_stream(manifest) as lines:
            return [f"{root}/{name}" for name in json.loads(lines.read())]
    found = store.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted(info.path for info in found if info.path.endswith(".warc.gz"))


class WarcSource(DataSource):
    """Format ``warc``: option ``path`` names a folder of archives with their indexes.

    A given schema may leave out columns, which then are not read.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema)


def read_warc(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    """Records of a folder, of the given columns (all, if none are given)."""
    ship(spark)
    spark.dataSource.register(WarcSource)
    kinds = dict(part.split() for part in SCHEMA.split(", "))
    wanted = ", ".join(f"{name} {kinds[name]}" for name in names or kinds)
    # Filters reach the reader only with this setting; without it they are applied after reading.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(wanted).option("path", folder).load()


def _record_id(row: int) -> str:
    return f"<urn:tallymart:record:{row}>"


def _write(batches: Iterator[pa.RecordBatch], folder: str, part_bytes: int) -> Iterator[pa.RecordBatch]:
    store, root = filesystem(folder)
    out, done = None, []

    def close() -> None:
        out.close()
        with store.open_output_stream(f"{name}.cdx") as index:
            index.write("".join(json.dumps(entry) + "\n" for entry in entries).encode())
        done.append((f"{name}.warc.gz", len(entries)))

    for batch in batches:
        for value in range(len(batch)):
            row = {field: batch[field][value].as_py() for field in batch.schema.names}
            if out is None:
                store.create_dir(root, recursive=True)
                name, entries, size = f"{root}/{uuid.uuid4().hex}", [], 0
                out = store.open_output_stream(f"{name}.warc.gz", compression=None)
            repeats = row["refers_to_row"] is not None
            headers = {
                "WARC-Type": "revisit" if repeats else "response",
                "WARC-Record-ID": _record_id(row["row"]),
                "WARC-Date": "1970-01-01T00:00:00Z",
                "WARC-Target-URI": row["url"] or "",
                "WARC-Payload-Digest": f"sha1:{base64.b32encode(bytes.fromhex(row['sha1'])).decode()}",
                "X-Payload-Length": str(row["size"]),
            }
            if row["page_id"] is not None:
                headers["X-Page-ID"] = str(row["page_id"])
            if repeats:
                headers["WARC-Refers-To"] = _record_id(row["refers_to_row"])
                if row["refers_to_page"] is not None:
                    headers["X-Refers-To-Page"] = str(row["refers_to_page"])
            data = record_bytes(headers, b"" if repeats else (row["html"] or "").encode())
            out.write(data)
            entries.append((size, len(data), headers["WARC-Type"]))
            size += len(data)
            if size >= part_bytes:
                close()
                out = None
    if out is not None:
        close()
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["path", "records"]
    )


def write_warc(pages: DataFrame, folder: str, min_payload: int = 0, part_bytes: int = PART_BYTES) -> None:
    """Archive every row of ``pages`` (page_id, url, html) as a record whose payload is the html in UTF-8.

    Of rows with equal payloads of at least ``min_payload`` bytes the one with
    the largest page_id is a response (of several such rows, one of them), and
    the others are revisits of it, without a block. A null html is an empty
    payload; a null page_id is smaller than any; repeated rows are records of
    their own; other columns are ignored. An empty table leaves an archive
    folder without records.

    Rows get their record numbers in a stored table, so that a second attempt
    of a task gives the same records. Tasks write under names of their own, and
    the manifest names the files of the attempts that count.
    """
    spark = pages.sparkSession
    ship(spark)
    html = text_or_empty("html")
    plain = columns(pages, page_id="long", url="string", html="string").select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        "url",
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha1"),
        F.octet_length(html).cast("long").alias("size"),
    )
    numbered = materialise(plain)
    first = F.max(F.struct("page_id", "row")).alias("first")
    repeated = numbered.filter(F.col("size") >= min_payload).groupBy("sha1", "size").agg(
        first, F.count(F.lit(1)).alias("n")
    )
    repeated = repeated.filter("n > 1").select("sha1", "size", "first.*")
    repeated = repeated.withColumnsRenamed({"page_id": "first_page", "row": "first_row"})
    joined = numbered.join(repeated, ["sha1", "size"], "left")
    refers = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    records = joined.select(
        "row",
        "page_id",
        "url",
        F.when(F.coalesce(~refers, F.lit(True)), F.col("html")).alias("html"),
        "sha1",
        "size",
        F.when(refers, F.col("first_row")).alias("refers_to_row"),
        F.when(refers, F.col("first_page")).alias("refers_to_page"),
    )
    written = materialise(
        records.mapInArrow(lambda batches: _write(batches, folder, part_bytes), "path string, records long")
    )
    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    names = sorted(row["path"].rpartition("/")[2] for row in written.select("path").collect())
    with store.open_output_stream(f"{root}/{MANIFEST}") as out:
        out.write(json.dumps(names).encode())


FACTS = "page_id long, payload_bytes long, payload_digest string"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of payloads as they were read; they must be those of the headers."""
    for batch in batches:
        rows = []
        for page_id, stated, payload in zip(batch["page_id"], batch["payload_digest"], batch["payload"], strict=True):
            data = payload.as_py()
            found = digest(data)
            if stated.as_py() != f"sha1:{found}":
                raise ValueError(f"the payload of page {page_id} is not the one that was archived")
            rows.append((None if page_id.as_py() is None else int(page_id.as_py()), len(data), found))
        values = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds = [pa.int64(), pa.int64(), pa.string()]
        names = ["page_id", "payload_bytes", "payload_digest"]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def archived_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Per record of a folder that ``write_warc`` filled: the page, its payload's size and digest, its type.

    Payloads of responses are read and measured; of revisits only the headers
    are read.
    """
    responses = read_warc(spark, folder, "page_id", "record_type", "payload_digest", "payload")
    measured = responses.filter("record_type = 'response'").select("page_id", "payload_digest", "payload").mapInArrow(
        _measure, FACTS
    )
    revisits = read_warc(
        spark, folder, "page_id", "record_type", "payload_digest", "payload_bytes", "refers_to_page"
    ).filter("record_type = 'revisit'")
    return measured.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long")}).unionByName(
        revisits.select(
            F.col("page_id").cast("long"),
            F.col("payload_bytes").cast("long"),
            F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
            "record_type",
            F.col("refers_to_page").cast("long").alias("refers_to"),
        )
    )


def archive_pages(pages: DataFrame, folder: str | None = None, min_payload: int = 0) -> DataFrame:
    """Write the archives, by default under the session's shared folder, and read them back."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark)
    write_warc(pages, folder, min_payload)
    return archived_pages(spark, folder)
