"""Conversations formatted for training: marked turns, placeholders for attachments, a loss mask.

The content of a turn is a list of typed parts. A visitor flattens them in
order: text is escaped, an image, audio or document part leaves a placeholder,
a reference to its source and the number of tokens it will expand to.

Turns are marked as

    system:     <s>[SYS] text [/SYS]</s>
    user:       <s>[INST] text [/INST]</s>
    assistant:  <s>text</s>
    any other:  <s>[ROLE]role[/ROLE] text</s>

Inside texts and role names a backslash becomes two, and every control string
gets a backslash after its first character. So no text can imitate a mark, and
reading undoes it exactly. The loss covers what stands between the marks of an
assistant turn.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.support import columns, ship

# Fixed values of the template.
BEGIN, END = "<s>", "</s>"
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]")}
ROLE, ROLE_END = "[ROLE]", "[/ROLE] "
LEARNT = "assistant"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
CONTROL = re.compile("|".join(
    re.escape(mark.strip())
    for mark in (BEGIN, END, *(m for pair in MARKS.values() for m in pair), ROLE, ROLE_END, *PLACEHOLDERS.values())
))
SPECIAL = re.compile(rf"\\|{CONTROL.pattern}")
ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    return SPECIAL.sub(lambda found: "\\\\" if found[0] == "\\" else f"{found[0][0]}\\{found[0][1:]}", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Expansion:
    """How many tokens an attachment stands for."""

    image_patch: int = 14
    audio_tokens_per_second: int = 25
    document_tokens_per_page: int = 512


@dataclass
class Flat:
    """A turn's content as one text, with what its placeholders stand for."""

    text: str = ""
    attachments: list[dict] = field(default_factory=list)


class Flattener:
    """Visits the parts of one turn, in order."""

    def __init__(self, expansion: Expansion | None = None):
        self._expansion = expansion or Expansion()
        self.flat = Flat()

    def visit(self, part: object) -> None:
        if isinstance(part, str):
            part = {"type": "text", "text": part}
        if not isinstance(part, dict) or part.get("type") not in ("text", *PLACEHOLDERS):
            raise ValueError(f"no part of a known type: {part!r}")
        getattr(self, f"visit_{part['type']}")(part)

    def visit_text(self, part: dict) -> None:
        self.flat.text += escape(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        patch = self._expansion.image_patch
        across, down = (-(-int(part.get(side) or 0) // patch) for side in ("width", "height"))
        self._attach(part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, -(-int(1000 * (part.get("seconds") or 0)) * self._expansion.audio_tokens_per_second // 1000))

    def visit_document(self, part: dict) -> None:
        self._attach(part, int(part.get("pages") or 0) * self._expansion.document_tokens_per_page)

    def _attach(self, part: dict, tokens: int) -> None:
        mark = PLACEHOLDERS[part["type"]]
        self.flat.attachments.append(
            {"type": part["type"], "source": part.get("source"), "offset": len(self.flat.text), "tokens": tokens}
        )
        self.flat.text += mark


def parts_of(content: str | None, typed: bool) -> list:
    """The parts of a turn: with ``typed`` a JSON list of them, else one text."""
    if content is None:
        return []
    return json.loads(content) if typed else [content]


def format_turn(role: str, parts: list, expansion: Expansion | None = None) -> tuple[str, int, int, list[dict]]:
    """The marked turn, the range of it that is learnt, and its attachments with offsets in the turn."""
    visitor = Flattener(expansion)
    for part in parts:
        visitor.visit(part)
    before, after = MARKS.get(role, ("", "") if role == LEARNT else (f"{ROLE}{escape(role)}{ROLE_END}", ""))
    head = BEGIN + before
    turn = f"{head}{visitor.flat.text}{after}{END}"
    begin = len(head) if role == LEARNT else len(turn)
    end = len(head) + len(visitor.flat.text) if role == LEARNT else begin
    moved = [attached | {"offset": attached["offset"] + len(head)} for attached in visitor.flat.attachments]
    return turn, begin, end, moved


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and flattened text (placeholders as they are, else unescaped) of every turn of a formatted text."""
    at = 0
    while at < len(formatted):
        stop = formatted.find(END, at)
        if stop < 0 or not formatted.startswith(BEGIN, at):
            raise ValueError(f"no turn at character {at}")
        body, at = formatted[at + len(BEGIN) : stop], stop + len(END)
        for role, (before, after) in MARKS.items():
            if body.startswith(before):
                yield role, unescape(body[len(before) : len(body) - len(after)])
                break
        else:
            if body.startswith(ROLE):
                role, _, text = body[len(ROLE) :].partition(ROLE_END)
                yield unescape(role), unescape(text)
            else:
                yield LEARNT, unescape(body)


FORMATTED = "conv_id long, turn long, formatted string, loss_begin long, loss_end long, \
attachments array<struct<type:string,source:string,offset:long,tokens:long>>, attachment_tokens long"
_ATTACHMENT = pa.struct(
    [("type", pa.string()), ("source", pa.string()), ("offset", pa.int64()), ("tokens", pa.int64())]
)


def _format(batches: Iterator[pa.RecordBatch], typed: bool, expansion: Expansion) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, turn, role, text in zip(*(batch[name].to_pylist() for name in batch.schema.names), strict=True):
            formatted, begin, end, attached = format_turn(role, parts_of(text, typed), expansion)
            rows.append((conv_id, turn, formatted, begin, end, attached, sum(x["tokens"] for x in attached)))
        names = ["conv_id", "turn", "formatted", "loss_begin", "loss_end", "attachments", "attachment_tokens"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(_ATTACHMENT), pa.int64()]
        values = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def format_conversations(
    conversations: DataFrame, typed: bool = False, expansion: Expansion | None = None
) -> DataFrame:
    """Every turn of ``conversations`` (conv_id, turn, role, text), formatted on its own.

    A conversation's text is its turns' ``formatted``, one after the other by
    turn. The learnt range and the attachments' offsets count characters within
    the turn; a turn that is not learnt has an empty range at its end. With
    ``typed``, text is a JSON list of parts. A null text has no parts, a null
    role is the empty role name. Repeated rows are turns of their own; an empty
    table gives no rows; other columns are ignored.
    """
    ship(conversations.sparkSession)
    plain = columns(conversations, conv_id="long", turn="long", role="string", text="string").fillna("", ["role"])
    expansion = expansion or Expansion()
    return plain.mapInArrow(lambda batches: _format(batches, typed, expansion), FORMATTED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of sorted conversations; one turn at a time, so a conversation may have any length."""

    def turns() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch[name].to_pylist() for name in batch.schema.names), strict=True)

    rows = []
    for conv_id, own in groupby(turns(), key=itemgetter(0)):
        count = chars = learnt = 0
        every, loss = hashlib.sha256(), hashlib.sha256()
        for _, _, formatted, begin, end in own:
            for role, text in read_turns(formatted):
                every.update(f"{role}\n{text}\n".encode())
                count += 1
            masked = unescape(formatted[begin:end])
            loss.update(masked.encode())
            learnt += len(masked)
            chars += len(formatted)
        rows.append((conv_id, count, every.hexdigest(), learnt, loss.hexdigest(), chars))
        if len(rows) >= 10_000:
            yield _digest_batch(rows)
            rows = []
    yield _digest_batch(rows)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in DIGEST.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    values = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted turns: number of turns, digests of turns and of the learnt text.

    Turns stand in ascending order, a missing number first, equal ones by their
    formatted text. Rows without conv_id are one conversation. The digest of a
    conversation's text has to see it in order, so its turns pass through one
    task, one at a time.
    """
    ship(formatted.sparkSession)
    narrow = formatted.select("conv_id", "turn", "formatted", "loss_begin", "loss_end")
    # Equal conv_ids meet in one partition; the sort there keeps them next to each other.
    dealt = narrow.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "formatted")
    return dealt.mapInArrow(_digest, DIGEST)
