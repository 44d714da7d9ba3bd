"""Secrets in texts and in whatever the texts encode.

Each text is scanned as it stands. Then a worklist unwraps it: the text with its
percent-encoded bytes decoded (also as form data, with plus signs as blanks, and
code units after ``%u``), with its backslash escapes decoded, with two bytes a
character read as one, and each of its base64 segments are layers of their own,
and so is compressed data written in any of these ways (as escapes, if every byte
is escaped) or lying anywhere within other decompressed data, once opened. Each layer
is scanned and unwrapped in turn, until nothing new comes up. Decoded bytes become one character each, whether or not
they are text. Every layer remembers, for each of its characters, the place in
the original text that it came from, so a secret found at any depth is reported
as a span of the original.

A layer equal to one already seen at the same place is not unwrapped again, and
decoding always shortens a segment or opens compressed data, so the worklist
ends. Compressed data is opened to its end, member after member, and scanned in
pieces of about ``PIECE_BYTES``. A piece ends where no secret and no encoded run
can go on, so the pieces give what the whole would; without such a place a piece
grows. Data that is damaged or ends early is scanned as far as it opens, and its
text is reported as ``cut_short``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymart.llm.support import columns, frugal, ship, slices, text_or_empty

# Kinds of secrets in their order, what they look like and how long they must be.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20

PIECE_BYTES = 4 << 20
# Compressed bytes handed over at a time, and looked at to tell whether compressed data begins.
FEED_BYTES, BEGIN_BYTES = 16 << 10, 512
# After these bytes nothing goes on that a pattern could match: one outside all patterns, or a line end after one
# that cannot be in a base64 line.
BREAK = re.compile(rb"""[^A-Za-z0-9"' :=+/_.%\\~\t\r\n-]|["':.%~]\r?\n""")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
# Percent-encoded code units, as old scripts write them.
UNITS = re.compile(r"(?:%u[0-9A-Fa-f]{4})+")
# A run with both percent-encoded bytes and plus signs is also read as form data, where a plus sign is a blank.
FORM = re.compile(
    r"(?<![A-Za-z0-9_.~*+&=%-])(?=[A-Za-z0-9_.~*&=%-]*+\+)(?=[A-Za-z0-9_.~*+&=-]*+%[0-9A-Fa-f]{2})"
    r"(?:[A-Za-z0-9_.~*+&=-]|%[0-9A-Fa-f]{2})++"
)
# Text of two bytes a character, either way round.
WIDE = [re.compile(r"(?:[\t\n\r\x20-\x7e]\x00){8,}"), re.compile(r"(?:\x00[\t\n\r\x20-\x7e]){8,}")]
ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\})+")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}")
# Shorter segments cannot hold the shortest secret.
LEAST_BASE64 = 16
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_BASE64},}}={{0,2}}")
# Base64 over several lines, whose ends may be written as escapes.
LINE_END = re.compile(r"[ \t]*\r?\n[ \t]*|(?:\\r)?\\n")
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:(?:[ \t]*\r?\n[ \t]*|(?:\\r)?\\n)[A-Za-z0-9+/_-]++)+={0,2}"
)
BASE64_PART = re.compile(r"[A-Za-z0-9+]+")
# Where compressed data may begin within other bytes: gzip, or zlib as all tools write it.
PACKED_BYTES = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")


@dataclass(frozen=True, order=True)
class Span:
    """A secret: half-open range of code points of the original text, and how deeply it was wrapped."""

    start: int
    kind: int
    end: int
    depth: int = field(default=0, compare=False)

    def written(self) -> str:
        return f"{KINDS[self.kind]}:{self.start}:{self.end}"


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of the secrets in a text as it stands."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@dataclass
class Layer:
    """A text and where it came from: character i stands for original characters ``begins[i]`` to ``ends[i]``.

    Both are None for the original, and for decoded data whose characters have
    no place of their own: those stand for the whole of ``whole``.
    """

    text: str
    begins: np.ndarray | None
    ends: np.ndarray | None
    whole: tuple[int, int] | None
    depth: int

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.begins is not None:
            return int(self.begins[start]), int(self.ends[end - 1])
        return self.whole or (start, end)


# Characters of a decoded run, each with the length of its source.
Decoded = list[tuple[str, int]]


def _unpercent(run: str) -> Decoded:
    return [(char, 3) for char in unquote_to_bytes(run).decode("latin-1")]


def _unform(run: str) -> Decoded:
    return [
        (chr(int(part[1:], 16)), 3) if len(part) == 3 else (" " if part == "+" else part, 1)
        for part in re.findall("%..|.", run)
    ]


def _ununit(run: str) -> Decoded:
    # As long as the escapes of the same units.
    return _unescape(run.replace("%", "\\"))


def _unescape(run: str) -> Decoded:
    found: Decoded = []
    high = None
    for match in ESCAPE.finditer(run):
        value, size = int(match[1] or match[2] or match[3] or match[4], 16), len(match[0])
        if high is not None and 0xDC00 <= value < 0xE000:
            found[-1] = chr(0x10000 + (high - 0xD800 << 10) + value - 0xDC00), found[-1][1] + size
            high = None
            continue
        high = value if 0xD800 <= value < 0xDC00 else None
        found.append((chr(value) if value <= 0x10FFFF and not 0xD800 <= value < 0xE000 else "\ufffd", size))
    return found


# Ways of writing characters: a mark that must be there, what a run looks like, how it is read.
READINGS: list[tuple[str, re.Pattern, Callable[[str], Decoded]]] = [
    ("%", PERCENT, _unpercent),
    ("%u", UNITS, _ununit),
    ("%", FORM, _unform),
    ("\\", ESCAPES, _unescape),
    ("\0", WIDE[0], lambda run: [(char, 2) for char in run[::2]]),
    ("\0", WIDE[1], lambda run: [(char, 2) for char in run[1::2]]),
]


def _decoded(layer: Layer, pattern: re.Pattern, decode: Callable[[str], Decoded]) -> Layer | None:
    """The layer with every run of ``pattern`` decoded, each character tied to its source."""
    texts, starts, sizes, at = [], [], [], 0
    for match in pattern.finditer(layer.text):
        found = decode(match[0])
        texts += [layer.text[at : match.start()], "".join(char for char, _ in found)]
        lengths = np.array([size for _, size in found], np.int64)
        starts += [np.arange(at, match.start()), match.start() + np.cumsum(lengths) - lengths]
        sizes += [np.ones(match.start() - at, np.int64), lengths]
        at = match.end()
    if not texts:
        return None
    tail = len(layer.text) - at
    begin = np.concatenate([*starts, np.arange(at, len(layer.text))])
    end = begin + np.concatenate([*sizes, np.ones(tail, np.int64)])
    text = "".join([*texts, layer.text[at:]])
    if layer.begins is not None:
        begin, end = layer.begins[begin], layer.ends[end - 1]
    elif layer.whole is not None:
        return Layer(text, None, None, layer.whole, layer.depth + 1)
    return Layer(text, begin, end, None, layer.depth + 1)


def _window(head: bytes) -> int:
    """How zlib is to open data that begins like this (gzip or zlib), or 0."""
    if head[:3] == b"\x1f\x8b\x08":
        return 31
    return 15 if len(head) > 2 and head[0] & 15 == 8 and int.from_bytes(head[:2], "big") % 31 == 0 else 0


def _begins(data: bytes) -> bool:
    """Whether bytes from somewhere within others are the begin of compressed data; zlib's two first bytes tell little."""
    window = _window(data)
    try:
        return window == 31 or window == 15 and bool(zlib.decompressobj(window).decompress(data[:BEGIN_BYTES]))
    except zlib.error:
        return False


def _inflated(machine: zlib._Decompress, fed: bytes) -> Iterator[bytes]:
    """What comes out for some compressed bytes; if they are damaged, first all that precedes the damage."""
    while True:
        before = machine.copy()
        try:
            out = machine.decompress(fed, PIECE_BYTES)
        except zlib.error:
            yield from (before.decompress(fed[i : i + 1]) for i in range(len(fed)))
            raise
        yield out
        fed = machine.unconsumed_tail
        if machine.eof or not (fed or out):
            return


@dataclass
class Opening:
    """What became of compressed data: whether a member opened to its end, whether one did not, and where they end."""

    whole: bool = False
    damaged: bool = False
    fed: int = 0
    end: int = 0


def _members(head: bytes, rest: Iterator[bytes], opening: Opening, outer: bool, alone: bool) -> Iterator[bytes]:
    """The decompressed bytes of members that follow each other; after a zero byte, whatever else follows them.

    The latter not if ``alone``. Data that is damaged or ends early counts as such,
    unless it only began like zlib data by chance.
    """
    while window := _window(head):
        machine, fed, feeds = zlib.decompressobj(window), head, 0
        while fed and not machine.eof:
            try:
                yield from _inflated(machine, fed)
            except zlib.error:
                break
            feeds += 1
            fed = machine.unused_data if machine.eof else next(rest, b"")
        if not machine.eof:
            opening.damaged |= window == 31 or feeds > 1
            head = head if feeds < 2 and not fed else fed
            break
        opening.whole = True
        if outer:
            opening.end = opening.fed - len(fed)
        head = fed
        while len(head := head.lstrip(b"\0")) < 3 and (more := next(rest, b"")):
            head += more
    if head and not alone:
        yield from chain([b"\0", head], rest)


def _fed(chunks: Iterable[bytes], opening: Opening | None = None) -> Iterator[bytes]:
    for chunk in chunks:
        for i in range(0, len(chunk), FEED_BYTES):
            part = bytes(chunk[i : i + FEED_BYTES])
            if opening:
                opening.fed += len(part)
            yield part


def _opened(data: memoryview, opening: Opening, alone: bool) -> Iterator[bytes]:
    """The bytes inside all layers of compression, chunk by chunk; other data as it stands."""
    chunks, heads, outer = _fed([data], opening), set(), True
    while True:
        head = b""
        while len(head) <= FEED_BYTES and (more := next(chunks, b"")):
            head += more
        # Short data that opens to itself would go on for ever.
        if not _window(head) or head in heads:
            return chain([head], chunks)
        if len(head) <= FEED_BYTES:
            heads.add(head)
        chunks, outer = _fed(_members(head, chunks, opening, outer, outer and alone)), False


class _Cutter:
    """Bytes that come in order, handed out in pieces that end at a break."""

    def __init__(self) -> None:
        self._parts: list[bytes] = []
        self._size, self._enough = 0, PIECE_BYTES

    def add(self, chunk: bytes) -> bytes:
        """The next piece, or nothing yet."""
        self._parts.append(chunk)
        self._size += len(chunk)
        if self._size < self._enough:
            return b""
        held, at, back = b"".join(self._parts), 0, 1 << 10
        while not at and back < 2 * self._size:
            at = max((match.end() for match in BREAK.finditer(held, max(0, self._size - back))), default=0)
            back *= 8
        self._parts, self._size = [held[at:]], self._size - at
        self._enough = max(PIECE_BYTES, 2 * self._size)
        return held[:at]

    def rest(self) -> bytes:
        return b"".join(self._parts)


def _pieces(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The same bytes, in pieces that end at a break."""
    cutter = _Cutter()
    for chunk in chunks:
        if piece := cutter.add(chunk):
            yield piece
    if rest := cutter.rest():
        yield rest


class _Within:
    """Compressed data that begins anywhere within a stream of bytes, opened as the stream goes by."""

    def __init__(self, heads: frozenset[bytes], opening: Opening):
        # Data that opens to itself would go on for ever: what is open around this stream does not open again.
        self._heads, self.inside, self._opening = heads, heads, opening
        self._held, self._open, self._gzip = b"", False, False
        self._machine: zlib._Decompress | None = None

    def add(self, chunk: bytes, last: bool = False) -> Iterator[bytes | None]:
        """What opens in the next bytes, and None wherever it ends. ``last``: no more bytes will come."""
        data, self._held = self._held + chunk, b""
        while data:
            again = data
            if self._machine is None:
                if self._open and len(data) < 3 and not last:
                    self._held = data
                    return
                # A member right after another one goes on with its data.
                if not (self._open and data[:3] == b"\x1f\x8b\x08"):
                    if self._open:
                        self._open = False
                        yield None
                    if (begin := self._begin(data, last)) < 0:
                        return
                    data = data[begin:]
                self._machine, self._open, self._gzip = zlib.decompressobj(_window(data)), True, data[0] == 0x1F
                again = data[1:]
            try:
                yield from filter(None, _inflated(self._machine, data))
            except zlib.error:
                yield from self._damaged()
                data = again
                continue
            if not self._machine.eof:
                break
            data, self._machine = self._machine.unused_data, None
        if last and self._machine is not None:
            yield from self._damaged()
        if last and self._open:
            self._open = False
            yield None

    def _begin(self, data: bytes, last: bool) -> int:
        """Where compressed data begins, or -1; then the bytes that may belong to a begin are kept."""
        sure = len(data) if last else max(0, len(data) - BEGIN_BYTES + 1)
        for match in PACKED_BYTES.finditer(data):
            at, head = match.start(), data[match.start() : match.start() + BEGIN_BYTES]
            if at >= sure:
                break
            if head not in self._heads and _begins(head):
                self.inside = self._heads | {head}
                return at
        self._held = data[sure:]
        return -1

    def _damaged(self) -> Iterator[None]:
        self._opening.damaged |= self._gzip
        self._machine, self._open = None, False
        yield None


def _all_pieces(chunks: Iterable[bytes], opening: Opening) -> Iterator[tuple[int, bytes]]:
    """The pieces of a stream and of all compressed data within it, at any depth, each with its depth.

    Gzip data within that is damaged counts as damage of the whole.
    """
    # For each stream that is open: its pieces, what is within it, and whether it has ended.
    streams: list[tuple[_Cutter, _Within]] = []
    ended: list[bool] = []
    work: list[Iterator[bytes | None]] = [chain(chunks, [None])]
    while work:
        depth = len(work) - 1
        try:
            event = next(work[-1])
        except StopIteration:
            work.pop()
            if work and ended[depth - 1]:
                cutter, _ = streams.pop()
                ended.pop()
                if rest := cutter.rest():
                    yield depth - 1, rest
            continue
        if event is None:
            if depth < len(streams):
                ended[depth] = True
                work.append(streams[depth][1].add(b"", last=True))
            continue
        if depth == len(streams):
            around = streams[-1][1].inside if streams else frozenset()
            streams.append((_Cutter(), _Within(around, opening)))
            ended.append(False)
        cutter, within = streams[depth]
        if piece := cutter.add(event):
            yield depth, piece
        work.append(within.add(event))


def _escaped_bytes(run: str) -> bytes:
    return bytes(int(match[1] or match[2] or match[3], 16) for match in ESCAPE.finditer(run))


# Per way of writing bytes: its mark, where compressed data (gzip, or zlib as all tools write it) begins, what belongs
# to it, how it is read. Percent encoding leaves some bytes as they are.
PACKED = [
    (
        "%",
        re.compile(r"%1[Ff]%8[Bb]|(?:%78|x)%(?:01|5[Ee]|9[Cc]|[Dd][Aa])"),
        re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~/+-])+"),
        unquote_to_bytes,
    ),
    (
        "\\",
        re.compile(
            r"(?:\\x|\\u00|\\U000000)1[Ff](?:\\x|\\u00|\\U000000)8[Bb]"
            r"|(?:\\x|\\u00|\\U000000)78(?:\\x|\\u00|\\U000000)(?:01|5[Ee]|9[Cc]|[Dd][Aa])"
        ),
        re.compile(r"(?:\\u00[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2}|\\U000000[0-9A-Fa-f]{2})+"),
        _escaped_bytes,
    ),
]


def _unbase64(body: str) -> bytes:
    """The bytes of base64 digits of either alphabet; a digit left over after the last byte is dropped."""
    body = body[: len(body) - (len(body) % 4 == 1)].translate(_URL_SAFE)
    return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)


_URL_SAFE = str.maketrans("-_", "+/")


def _segments(text: str) -> Iterator[tuple[int, int, str, int]]:
    """Base64 segments: where they begin and end, their digits, and how many of these to leave out at the begin.

    A segment is a run of digits, or several joined over line ends. Since a name,
    a path or a line above may stand right before it, it is also read from its
    second, third and fourth digit, and the parts of a run between separators are segments as well.
    """
    for match in BASE64.finditer(text):
        body = match[0].rstrip("=")
        yield from ((*match.span(), body, skip) for skip in range(4))
        for part in BASE64_PART.finditer(body):
            if LEAST_BASE64 <= len(part[0]) < len(body):
                end = match.end() if part.end() == len(body) else match.start() + part.end()
                yield match.start() + part.start(), end, part[0], 0
    if "\n" in text or "\\n" in text:
        for match in WRAPPED.finditer(text):
            body = LINE_END.sub("", match[0]).rstrip("=")
            if len(body) >= LEAST_BASE64:
                yield from ((*match.span(), body, skip) for skip in range(4))


def _unwrapped(layer: Layer, cuts: list[bool]) -> Iterator[Layer]:
    """The layers directly inside one; of compressed data, its pieces. ``cuts`` tells of damaged ones."""
    text = layer.text
    for mark, pattern, decode in READINGS:
        if mark in text and (inner := _decoded(layer, pattern, decode)) is not None:
            yield inner
    streams: list[tuple[int, int, int, Opening]] = []
    for start, end, data in _packed(text):
        yield from _contents(data, layer, (start, end, 0), streams, False)
    for start, end, body, skip in _segments(text):
        yield from _contents(_unbase64(body[skip:]), layer, (start, end, skip), streams, True)
    # Half of a stream, as one line of several holds, is no damage if the whole was read.
    whole = [(start, end, begin) for start, end, begin, opening in streams if not opening.damaged]
    for start, end, begin, opening in streams:
        if opening.damaged:
            cuts.append(not any(a <= start and end <= b and (b - a > end - start or c <= begin) for a, b, c in whole))


def _contents(
    data: bytes,
    layer: Layer,
    source: tuple[int, int, int],
    streams: list[tuple[int, int, int, Opening]],
    kept: bool,
) -> Iterator[Layer]:
    """The layers of bytes written in some place of a layer: compressed data in them opened, and the bytes if ``kept``.

    All bytes are kept, as characters. Compressed data within what was opened is opened as well. Adds to ``streams``
    what was opened.
    """
    start, end, skip = source
    place, view, done = layer.origin(start, end), memoryview(data), 0
    for at in chain([0], (match.start() for match in PACKED_BYTES.finditer(data, 1))):
        first = kept and not at
        if at < done or not first and not _begins(data[at : at + BEGIN_BYTES]):
            continue
        opening = Opening()
        chunks = _opened(view[at:], opening, not first)
        pieces = _all_pieces(chunks, opening) if _window(data[at : at + 3]) else ((0, piece) for piece in _pieces(chunks))
        for depth, piece in pieces:
            yield Layer(piece.decode("latin-1"), None, None, place, layer.depth + 1 + depth)
        done = at + opening.end
        if opening.whole or opening.damaged and (not at or data[at] == 0x1F):
            streams.append((start, end, start + skip + at, opening))


def _packed(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Where compressed data may be written as percent-encoded bytes or backslash escapes, and the bytes from there."""
    for mark, start, run, decode in PACKED:
        done = 0
        for found in start.finditer(text) if mark in text else ():
            if found.start() >= done:
                source = run.match(text, found.start())
                done = source.end()
                yield *source.span(), decode(source[0])


@dataclass
class Found:
    plain: list[Span]
    wrapped: list[Span]
    layers: int
    cut_short: bool

    def all(self) -> list[Span]:
        return sorted(set(self.plain) | set(self.wrapped))


def scan(text: str) -> Found:
    """All secrets of a text, and of the layers inside it."""
    plain = [Span(*span) for span in plain_spans(text)]
    wrapped: set[Span] = set()
    seen: set[tuple[bytes, tuple[int, int]]] = set()
    # A layer is unwrapped to the end before the next one is made, so that few are held at a time.
    cuts: list[bool] = []
    work, layers = [_unwrapped(Layer(text, None, None, None, 0), cuts)], 0
    while work:
        if (inner := next(work[-1], None)) is None:
            work.pop()
            continue
        place = inner.origin(0, len(inner.text)) if inner.text else (0, 0)
        key = hashlib.blake2b(inner.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), place
        if key in seen:
            continue
        seen.add(key)
        layers += 1
        for start, kind, end in plain_spans(inner.text):
            begin, stop = inner.origin(start, end)
            wrapped.add(Span(begin, kind, stop, inner.depth))
        work.append(_unwrapped(inner, cuts))
    return Found(plain, sorted(wrapped.difference(plain)), layers, any(cuts))


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by the name of its kind; overlapping spans become one."""
    out, at = [], 0
    for span in sorted(spans):
        if span.start >= at:
            out += [text[at : span.start], f"[{KINDS[span.kind]}]"]
        at = max(at, span.end)
    return "".join([*out, text[at:]])


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, \
n_wrapped long, layers long, cut_short boolean"


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            found = scan(text.as_py())
            counts = [sum(span.kind == kind for span in found.plain) for kind in range(len(KINDS))]
            base = ",".join(span.written() for span in found.plain)
            every = ",".join(span.written() for span in found.all())
            digest = hashlib.sha256(base.encode()).hexdigest()
            rows.append((doc_id.as_py(), *counts, digest, every, len(found.wrapped), found.layers, found.cut_short))
        names = [part.split()[0] for part in RESULT.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2 + [pa.bool_()]
        values = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Per document: numbers of secrets by kind, and their spans, from the whole text.

    ``base_sha256`` covers the spans of the text as it stands, ``spans`` those
    and the ones from inside layers, ``n_wrapped`` counts the latter. A null or
    empty text has no spans. Null ids and repeated rows are kept, an empty table
    gives no rows, columns other than doc_id and text are ignored.
    """
    ship(docs.sparkSession)
    texts = columns(docs, doc_id="long", text="string").select("doc_id", text_or_empty().alias("text"))
    return texts.mapInArrow(_scan_batches, RESULT)


def _redact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = batch.schema.get_field_index("text")
        for own in slices(batch):
            texts = []
            for value in own["text"]:
                text = value.as_py()
                texts.append(text if text is None else redact(text, scan(text).all()))
            yield own.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with all secrets in ``text`` replaced; texts without any, null texts and other columns stay."""
    ship(docs.sparkSession)
    return docs.mapInArrow(frugal(_redact_batches), docs.schema)
