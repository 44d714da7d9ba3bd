"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts up to ``ORDER`` long holds how often
each byte followed. The code length of a byte is minus the binary logarithm of
its probability: after a context seen t times with d different bytes, a byte
seen c times has c / (t + d), and d / (t + d) escapes to the context without
its oldest byte (escape method C, no exclusions). Below the empty context all
256 bytes are equally likely. Statistics are frozen: scoring learns nothing.
The language with the shortest code for the whole text wins.

Scoring walks all texts of a batch at once. The contexts of all languages form
one tree. Each language has a row, with the code length of every byte, for each
context that it knows; where it does not know one, its row of the context
without the oldest byte stands in. So a byte costs ``ORDER`` steps down the tree
and one lookup in each language. The rows grow with the contexts of the sample,
which is bounded for each language; only 4 bytes are kept for each pair of a
context and a language.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.support import binary_values, columns, frugal, kept, ship, text_or_empty

ORDER = 3
UNDETERMINED = "und"
# Bounds of what a model is fitted on: bytes per language, and bytes of a passage (longer texts are several). Passages are drawn whole, one of each group of copies, by a hash; at least one of each language.
SAMPLE_BYTES = 3_000_000
SAMPLE_LONGEST = 100_000
# A text starts as if after spaces.
PAD = 0x20
WINDOW = 1 << 18


@dataclass(frozen=True)
class Model:
    """Languages, and how often each (ORDER + 1)-byte sequence occurred: language number, sequence, count."""

    languages: tuple[str, ...]
    language: np.ndarray
    sequence: np.ndarray
    count: np.ndarray

    def key(self) -> str:
        parts = [repr(self.languages).encode(), *(x.tobytes() for x in (self.language, self.sequence, self.count))]
        return hashlib.sha256(b"".join(parts)).hexdigest()


class Scorer:
    """The context tree of a model as tables."""

    def __init__(self, model: Model):
        n = len(model.languages)
        seen = np.unique(np.concatenate([model.sequence >> 8 * i & 255 for i in range(ORDER + 1)] + [[PAD]]))
        self.width = width = len(seen) + 1  # the last symbol stands for all bytes never seen
        self.symbol = np.full(256, width - 1, np.int32)
        self.symbol[seen] = np.arange(len(seen))
        # by[i]: the symbol i places before the predicted one.
        by = [self.symbol[model.sequence >> 8 * i & 255].astype(np.int64) for i in range(ORDER + 1)]
        # The rows of the former round of contexts, the number of the first, and each language's row in each context.
        cost, first = np.full((1, width), 8.0), 0
        own = np.zeros((1, n), np.int32)
        node = np.zeros(len(by[0]), np.int64)  # the context of each sequence, so far
        rows, row_of, self.steps = [cost], [], []
        nodes = 0
        for order in range(ORDER + 1):
            if order:
                key = node * width + by[order]
                kept, index = np.unique(key, return_inverse=True)
                step = np.repeat(np.arange(nodes, dtype=np.int32), width)
                step[kept] = nodes + np.arange(len(kept))
                self.steps.append(step)
                own = np.concatenate(row_of)[kept // width]
                node = nodes + index
            pairs, where = np.unique((node - nodes) * n + model.language, return_inverse=True)
            cost = _after(cost[own.reshape(-1)[pairs] - first], where, by[0], model.count)
            first = sum(map(len, rows))
            own.reshape(-1)[pairs] = first + np.arange(len(pairs))
            rows.append(cost.astype(np.float32))
            row_of.append(own)
            nodes += len(own)
        self.row_of = np.concatenate(row_of)
        self.cost = np.concatenate(rows, dtype=np.float32).reshape(-1)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language. Besides ``data``, memory is that of a window, whatever the texts."""
        languages = self.row_of.shape[1]
        total = np.zeros((len(offsets) - 1, languages))
        filled = np.flatnonzero(np.diff(offsets))
        starts, ends = offsets[filled], offsets[filled + 1]
        step_size = max(1 << 12, WINDOW // (1 + languages // 8))
        for low in range(0, len(data), step_size):
            at = np.arange(low, min(low + step_size, len(data)))
            begin = np.searchsorted(starts, low, "right") - 1
            end = np.searchsorted(starts, low + len(at), "left")
            own = np.repeat(starts[begin:end], np.minimum(ends[begin:end], low + len(at)) - np.maximum(starts[begin:end], low))
            node = np.zeros(len(at), np.int32)
            for order, step in enumerate(self.steps, 1):
                back = at - order
                symbol = np.where(back >= own, self.symbol[data[np.maximum(back, 0)]], self.symbol[PAD])
                node = step[node * self.width + symbol]
            row = self.row_of[node].astype(np.int64)
            row *= self.width
            row += self.symbol[data[at]][:, None]
            cost = self.cost[row]
            cuts = np.maximum(starts[begin:end] - low, 0)
            total[filled[begin:end]] += np.add.reduceat(cost, cuts, axis=0, dtype=np.float64)
        return total


def _after(parents: np.ndarray, row: np.ndarray, symbol: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Code lengths after each context in a language, given those after the context one byte shorter."""
    width = parents.shape[1]
    cells, index = np.unique(row * width + symbol, return_inverse=True)
    count = np.bincount(index, weights=counts, minlength=len(cells))
    where = cells // width
    total = np.bincount(where, weights=count, minlength=len(parents))
    different = np.bincount(where, minlength=len(parents)).astype(float)
    cost = parents + np.log2((total + different) / different)[:, None]
    cost.reshape(-1)[cells] = np.log2((total + different)[where] / count)
    return cost


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learnt from: CRC-32 of the id as text leaves 1 modulo 3 (a null id counts as empty)."""
    written = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(written.cast("binary")) % 3 == 1


def fit(labelled: DataFrame) -> Model:
    """Fit a model on rows with ``text`` and ``lang``, on a bounded sample of each language.

    Rows without language or text are left out. The sample is of passages: whole
    texts, or pieces of ``SAMPLE_LONGEST`` bytes of longer ones. Copies count
    once. If the distinct passages of a language have up to ``SAMPLE_BYTES``
    bytes all are learnt, otherwise those with the least hashes, as many as fit.
    Runs three jobs; what reaches the driver is the languages, the bytes of each
    in some hundred ranges of hashes, and the counted sequences of the sample,
    all bounded for each language.
    """
    ship(labelled.sparkSession)
    known = columns(labelled, text="string", lang="string").dropna().filter(F.octet_length("text") > 0)
    found = known.select("lang").distinct().collect()
    languages = tuple(sorted(row["lang"] for row in found))
    if not languages:
        return Model((), *(np.zeros(0, np.int64) for _ in range(3)))
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    known = known.select(number[F.col("lang")].alias("language"), "text")
    longest = SAMPLE_LONGEST
    hashed = known.mapInArrow(frugal(lambda batches: _passages(batches, longest)), "language int, hash long, range int, size long")
    distinct = hashed.groupBy("language", "hash").agg(F.max("range").alias("range"), F.max("size").alias("size"))
    sizes = distinct.groupBy("language", "range").agg(F.sum("size").alias("size")).collect()
    last = _last_ranges([(row["language"], row["range"], row["size"]) for row in sizes])
    drawn = known.mapInArrow(frugal(lambda batches: _passages(batches, longest, last)), "language int, hash long, text binary")
    sample = drawn.groupBy("language", "hash").agg(F.first("text").alias("text"))
    counted = sample.select("language", "text").mapInArrow(frugal(_count), "language int, sequence long, count long")
    found = counted.groupBy("language", "sequence").agg(F.sum("count").alias("count")).toArrow()
    table = [found[name].to_numpy() for name in ("language", "sequence", "count")]
    order = np.lexsort((table[1], table[0]))
    return Model(languages, *(x[order].astype(np.int64) for x in table))


def _hash_range(value: int) -> int:
    """Number of a range of hashes, 16 to each power of two; greater hashes have no smaller number."""
    bits = value.bit_length()
    return 16 * bits + ((value >> bits - 5 if bits > 5 else value << 5 - bits) & 15)


def _last_ranges(sizes: list[tuple[int, int, int]]) -> dict[int, int]:
    """For each language the last range of hashes that is drawn: up to SAMPLE_BYTES, and always its first range."""
    last: dict[int, int] = {}
    total: dict[int, int] = {}
    for language, number, size in sorted(sizes):
        total[language] = total.get(language, 0) + size
        if total[language] <= SAMPLE_BYTES or language not in last:
            last[language] = number
    return last


def _passages(
    batches: Iterator[pa.RecordBatch], longest: int, last: dict[int, int] | None = None
) -> Iterator[pa.RecordBatch]:
    """Hash, its range and size of every passage; given the last ranges to draw, the passages up to there, once each."""
    sent: set[tuple[int, int]] = set()
    for batch in batches:
        rows: list[tuple] = []
        data, offsets = binary_values(batch["text"])
        view = memoryview(data)
        for language, start, end in zip(batch["language"].to_pylist(), offsets[:-1], offsets[1:], strict=True):
            for low in range(int(start), int(end), longest):
                passage = view[low : min(low + longest, int(end))]
                value = int.from_bytes(hashlib.blake2b(passage, digest_size=8).digest()) >> 1
                number = _hash_range(value)
                if last is None:
                    rows.append((language, value, number, len(passage)))
                elif number <= last[language] and (language, value) not in sent:
                    sent.add((language, value))
                    rows.append((language, value, bytes(passage)))
        kinds = {"language": pa.int32(), "hash": pa.int64()}
        kinds |= {"range": pa.int32(), "size": pa.int64()} if last is None else {"text": pa.binary()}
        values = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        arrays = [pa.array(v, kind) for v, kind in zip(values, kinds.values(), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, list(kinds))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages = batch["language"].to_numpy()
        for language in np.unique(languages):
            data, offsets = binary_values(batch["text"].filter(pa.array(languages == language)))
            texts = len(offsets) - 1
            padded = np.full(len(data) + ORDER * texts, PAD, np.int64)
            place = np.arange(len(data)) + ORDER * np.repeat(np.arange(1, texts + 1), np.diff(offsets))
            padded[place] = data
            sequence = sum(padded[place - i] << 8 * i for i in range(ORDER + 1))
            found, count = np.unique(sequence, return_counts=True)
            same = np.full(len(found), language, np.int32)
            arrays = [pa.array(same), pa.array(found), pa.array(count.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["language", "sequence", "count"])


LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    found = LETTER.search(text)
    return found is not None and (found[0].isalpha() or any(map(str.isalpha, text)))


def _scorer(model: Model, key: str) -> Scorer:
    return kept((Scorer, key), lambda: Scorer(model))


def _judge(texts: pa.Array, model: Model, key: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits per byte of each text."""
    size = np.diff(binary_values(texts)[1])
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    bits = _scorer(model, key).code_lengths(*binary_values(texts))
    best = bits.argmin(axis=1)
    shortest = bits[np.arange(len(bits)), best]
    score = 1 / np.exp2(np.maximum(shortest[:, None] - bits, -1000)).sum(axis=1)
    spoken = np.fromiter((has_letter(text.as_py()) for text in texts), bool, len(texts))
    names = [model.languages[i] if known else UNDETERMINED for i, known in zip(best, spoken, strict=True)]
    return names, np.where(spoken, score, 0.0), shortest / np.maximum(size, 1)


def _predict(batches: Iterator[pa.RecordBatch], model: Model, key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, score, bits = _judge(batch["text"], model, key)
        kept = [name for name in batch.schema.names if name != "text"]
        arrays = [pa.array(names, pa.string()), pa.array(score), pa.array(bits)]
        yield pa.RecordBatch.from_arrays(
            [batch[name] for name in kept] + arrays, [*kept, "lang_pred", "score", "bits_per_byte"]
        )


def _accept(
    batches: Iterator[pa.RecordBatch], model: Model, key: str, least_score: float, most_bits: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].fill_null("").cast(pa.string())
        names, score, bits = _judge(texts, model, key)
        known = np.array([name != UNDETERMINED for name in names], bool)
        yield batch.filter(pa.array(known & (score >= least_score) & (bits <= most_bits), pa.bool_()))


def predict(docs: DataFrame, model: Model, row: str = "doc_id") -> DataFrame:
    """Per document: the column ``row``, lang_pred, score and bits_per_byte, from the whole text.

    ``score`` is the winner's share when each language weighs two to the minus
    code length. Ties go to the first language in alphabetical order. A null or
    empty text, or one without a letter, is ``und`` with score 0; so is every
    text if nothing was learnt. Null ids and repeated rows are kept.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(row), text_or_empty(F.col("text").cast("string")).alias("text"))
    shared, key = spark.sparkContext.broadcast(model), model.key()
    kind = texts.schema[row].dataType.simpleString()
    return texts.mapInArrow(
        frugal(lambda batches: _predict(batches, shared.value, key), keeps=True),
        f"`{row}` {kind}, lang_pred string, score double, bits_per_byte double",
    )


def accept(docs: DataFrame, model: Model, least_score: float = 0.5, most_bits: float = 8.0) -> DataFrame:
    """The rows of ``docs`` whose text is in a language of the model, with all their columns.

    Rejected are texts that are null, or have no letter, whose best language
    has a score below ``least_score``, or takes more than ``most_bits`` a byte:
    at 8 the model tells no more about the text than the plain bytes do.
    """
    spark = docs.sparkSession
    ship(spark)
    shared, key = spark.sparkContext.broadcast(model), model.key()
    work = frugal(lambda batches: _accept(batches, shared.value, key, least_score, most_bits), keeps=True)
    return docs.mapInArrow(work, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out, and predict the language of every document."""
    model = fit(docs.filter(~held_out()))
    plain = columns(docs, doc_id="long", text="string")
    predicted = predict(plain, model)
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")
