"""Spelling variants of the words of a corpus, by an index of variable-length grams.

A word, with ``LONG - 1`` marks before and after it, falls into grams of
``SHORT`` to ``LONG`` code points: from each position the longest that is in the
gram dictionary, unless an earlier one already reaches as far. The dictionary
holds every short gram, and longer ones only where their first part is frequent
(at least one in ``FREQUENT`` of all grams): that keeps lists of common grams
short, and bounds the dictionary by the alphabet and by ``FREQUENT``, whatever
the corpus.

One edit touches only the grams that start from ``LONG - 1`` code points before
its place to ``LONG - SHORT`` after it. These bounds are taken for every place
of every word: two words one edit apart have all grams outside the bounds of
that edit in common, at the same places or moved by one. So the inverted lists
of those grams are merged at once: a word stands in one list for each place and
kind of edit, named by all grams that the edit leaves alone. What meets in a
list is verified by its letters. Words of a list differ in a few code points
around one place, so its length is bounded by the alphabet, not by the corpus.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.support import columns, materialise, ship, text_or_empty

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORT, LONG = 2, 3
MARK = "\x00"
FREQUENT = 4096
# Characters of a text whose runs are taken at a time, and different words that a task counts at a time.
PIECE, HELD = 1 << 20, 200_000

_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def lowered(run: str) -> str:
    """The run with A to Z, and no other letter, in lower case."""
    return run.lower() if run.isascii() else run.translate(_LOWER)


def runs(text: str) -> Counter:
    """How often each run of letters stands in the text, in lower case."""
    if len(text) <= PIECE:
        raw = Counter(RUN.findall(text))
    else:
        raw = Counter(found[0] for found in RUN.finditer(text))
    counts: Counter = Counter()
    for run, n in raw.items():
        counts[lowered(run)] += n
    return counts


def misspelt(prefix: int, run: str, one_in: int) -> str:
    """The run without one code point if its hash, which goes on from ``prefix``, is divisible by ``one_in``."""
    h = zlib.crc32(run.encode(), prefix)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch], one_in: int, least: int) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        arrays = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in runs(text.as_py()).items():
                word = misspelt(prefix, run, one_in) if one_in else run
                if len(word) >= least:
                    counts[word] += n
            if len(counts) >= HELD:
                yield flush()
    yield flush()


def word_counts(docs: DataFrame, one_in: int = 0, least_length: int = 7) -> DataFrame:
    """``word`` and ``n``, its occurrences, for the runs of letters of all texts, of ``least_length`` or more.

    With ``one_in``, a run whose hash with the document's id it divides has lost one code point.
    """
    ship(docs.sparkSession)
    texts = columns(docs, doc_id="long", text="string").withColumn("text", text_or_empty())
    counted = texts.mapInArrow(lambda batches: _counted(batches, one_in, least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# --- grams ------------------------------------------------------------------------------------------------


def marked(word: str) -> str:
    return MARK * (LONG - 1) + word + MARK * (LONG - 1)


def grams_of(word: str, longer: frozenset[str]) -> list[tuple[int, str]]:
    """Position and gram of each variable-length gram; ``longer``: the dictionary's grams that may grow by one."""
    text = marked(word)
    found, reached = [], -1
    for start in range(len(text) - SHORT + 1):
        end = start + SHORT
        while end - start < LONG and end < len(text) and text[start:end] in longer:
            end += 1
        if end > reached:
            found.append((start, text[start:end]))
            reached = end
    return found


def _gram_counts(batches: Iterator[pa.RecordBatch], size: int, longer: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """Grams of one size, those beyond SHORT only where their first part may grow."""
    counts: Counter = Counter()
    for batch in batches:
        for word in batch["word"].to_pylist():
            text = marked(word)
            counts.update(text[i : i + size] for i in range(len(text) - size + 1) if size == SHORT or text[i : i + size - 1] in longer)
    yield _counts_batch(counts)


def _counts_batch(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"]
    )


def gram_dictionary(words: DataFrame) -> frozenset[str]:
    """The dictionary's grams that may grow by a code point: of each size, those with one in FREQUENT of all grams or more."""
    longer: frozenset[str] = frozenset()
    for size in range(SHORT, LONG):
        last = longer
        counted = words.mapInArrow(lambda batches, n=size, g=last: _gram_counts(batches, n, g), "gram string, n long")
        # Bounded by the square of the alphabet, then by FREQUENT times the alphabet.
        rows = counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()
        total = sum(row["n"] for row in rows)
        longer |= {row["gram"] for row in rows if row["n"] * FREQUENT >= total}
    return longer


# --- lists ------------------------------------------------------------------------------------------------

# A code point is replaced; one is missing, or one too many, against the other word.
REPLACED, SHORTER, LONGER = 0, 1, 2
_BITS = (1 << 64) - 1
_LENGTH, _PLACE, _KIND = 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 0xA0761D6478BD642F

_numbers: dict[str, int] = {}


def _number(gram: str) -> int:
    """A fixed 64-bit number of a gram; as many are remembered as the dictionary has."""
    if gram not in _numbers:
        _numbers[gram] = int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=8).digest(), "little")
    return _numbers[gram]


def lists_of(word: str, longer: frozenset[str]) -> Iterator[tuple[int, int, int]]:
    """List, kind of edit and place of it, for every edit by which a word can differ from another.

    A list's name adds up the grams that the edit leaves alone, each times its
    place in the shorter word. A code point that repeats the one before it is
    never the one too many: that is the first of them.
    """
    grams = grams_of(word, longer)
    starts = [start for start, _ in grams]
    same = [_number(gram) * (2 * start + 1) for start, gram in grams]
    back = [_number(gram) * (2 * start - 1) for start, gram in grams]
    before = list(accumulate(same, initial=0))
    after = list(accumulate(reversed(same), initial=0))[::-1]
    moved = list(accumulate(reversed(back), initial=0))[::-1]
    n = len(word)
    for place in range(n + 1):
        at = place + LONG - 1
        low = bisect_left(starts, at - LONG + 1)
        if place < n:
            high = bisect_right(starts, at + LONG - SHORT)
            yield _name(before[low] + after[high], n, place, 0), REPLACED, place
            if not place or word[place] != word[place - 1]:
                yield _name(before[low] + moved[high], n - 1, place, 1), LONGER, place
        high = bisect_right(starts, at + LONG - SHORT - 1)
        yield _name(before[low] + after[high], n, place, 1), SHORTER, place


def _name(grams: int, length: int, place: int, kind: int) -> int:
    name = (grams + length * _LENGTH + place * _PLACE + kind * _KIND) & _BITS
    return name - (1 << 64) if name >> 63 else name


_LISTED = "list long, kind int, place int, word string, n long"


def _listed(batches: Iterator[pa.RecordBatch], longer: frozenset[str]) -> Iterator[pa.RecordBatch]:
    names = ["list", "kind", "place", "word", "n"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
    rows: list[tuple] = []
    letters = 0

    def flush() -> pa.RecordBatch:
        values = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    for batch in batches:
        for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True):
            rows += [(*own, word, n) for own in lists_of(word, longer)]
            letters += 3 * len(word) ** 2
            if len(rows) >= 50_000 or letters >= 20_000_000:
                letters = 0
                yield flush()
    yield flush()


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists, sorted by name: for each word of a list how many near words it has there, and the best of them."""
    left = None
    for batch in batches:
        if left is not None:
            batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
        if not len(batch):
            continue
        names = batch["list"].to_numpy()
        cut = int(np.searchsorted(names, names[-1]))
        left = batch.slice(cut)
        yield _judged(batch.slice(0, cut))
    if left is not None:
        yield _judged(left)


def _judged(batch: pa.RecordBatch) -> pa.RecordBatch:
    names = batch["list"].to_numpy()
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    group = np.cumsum(new) - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1) if len(group) else group
    some = batch.take(pa.array(several))
    # Per list, rest of the letters: the words that have it, shorter ones as they are.
    sides: dict[tuple, tuple[list, list]] = {}
    columns = (some[name].to_pylist() for name in ("kind", "place", "word", "n"))
    for number, kind, place, word, n in zip(group[several].tolist(), *columns, strict=True):
        rest = word if kind == SHORTER else word[:place] + word[place + 1 :]
        both = sides.setdefault((number, kind == REPLACED, rest), ([], []))
        both[kind == LONGER].append((-n, word))
    rows = []
    for (_, replaced, _), (some, others) in sides.items():
        if replaced and len(some) > 1:
            some.sort()
            rows += [(word, len(some) - 1, *some[word == some[0][1]]) for _, word in some]
        elif some and others:
            for mine, theirs in ((some, others), (others, some)):
                rows += [(word, len(theirs), *min(theirs)) for _, word in mine]
    values = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "less", "near"])


def near_words(words: DataFrame) -> DataFrame:
    """For the distinct ``words`` (word, n) that have near words: n_near, and the best's near and near_n."""
    # Bounded by the alphabet and FREQUENT.
    longer = words.sparkSession.sparkContext.broadcast(gram_dictionary(words))
    listed = words.mapInArrow(lambda batches: _listed(batches, longer.value), _LISTED)
    lists = listed.repartition("list").sortWithinPartitions("list")
    found = lists.mapInArrow(_near, "word string, n_near long, less long, near string")
    best = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("less", "near")).alias("best")
    )
    return best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form or null, ...) with ``root``: the last word on the way from form to form, or the word itself.

    Each round doubles the way that is covered. Forms must not lead back.
    """
    roots = materialise(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("next"), "root")
        moved = materialise(joined)
        roots = moved.select("word", F.col("next").alias("root"))
        if moved.filter("next <> root").isEmpty():
            return forms.join(roots, "word")


def group_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """For each of the distinct ``words`` (word, n) its form, root, near words and their counts.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. A word's form is its near word of largest n (ties: the
    smallest in code-point order) if that is at least ``times`` the word's own n,
    else null; its root is where forms lead in the end. Returns word, form,
    root, n, n_near (0 without near words) and form_n (null without a form).

    Words must be distinct; null words are left out. An empty table gives no
    rows. Runs jobs while it is built: words, forms and roots are stored.
    """
    if times < 2:
        raise ValueError("forms of words as rare as themselves could lead back")
    ship(words.sparkSession)
    words = materialise(words.filter("word is not null").select("word", "n"))
    judged = words.join(near_words(words), "word", "left")
    good = F.col("near_n") >= times * F.col("n")
    forms = materialise(
        judged.select(
            "word",
            F.when(good, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("near_n")).alias("form_n"),
        )
    )
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, one_in: int = 31, least_count: int = 2, times: int = 10) -> DataFrame:
    """Variants among the words of all texts that occur ``least_count`` times or more.

    Words are runs of letters (A to Z and U+00C0 to U+00FF), only A to Z in
    lower case. A run of a document whose CRC-32 with the document's id
    ``one_in`` divides has lost one code point, as a planted misspelling; 0
    plants none. A null id counts as empty there. Null or empty texts have no
    words, and each of repeated rows counts. Other columns are ignored.
    """
    return group_variants(word_counts(docs, one_in).filter(F.col("n") >= least_count), times)
