"""Documents linked by the Jaccard similarity of their word shingles, by a size-aware heavy-light join.

Equal sets become one class first. Which sets are small is chosen by cost.

* Light: two sets of sizes a <= b link exactly when they share a subset of the
  least overlap k(a, b). Small sets list all their subsets of that fixed size
  for each partner size; sharing one is a link, and nothing is left to verify.
* Heavy: large sets meet in inverted lists. Only the rarest part of a set (its
  prefix) needs to be listed: two sets that link have one of those shingles in
  common. Rarity comes from a sketch of the frequencies of all shingles.

Lists of up to ``SHORT_LIST`` classes give candidate pairs directly. In longer
lists, each class first meets a pivot of each of its lists; what links becomes
one component, and after ``ROUNDS`` such rounds only pairs from different components
still meet. So a large group of near copies costs a few pairs a member, and no
link between components is lost. Candidates pass a bound from parity sketches,
then the sets themselves are intersected.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallymart.llm.components import connected
from tallymart.llm.fingerprints import scramble
from tallymart.llm.support import columns, frugal, materialise, ship, slices

WORDS = 5
# Jaccard similarity of at least SAME / ALL.
SAME, ALL = 3, 4

# Cells of the frequency sketch and of the class filter: fixed sizes, whatever the corpus. A larger corpus
# blurs them, which makes lists longer but loses nothing.
CELLS, BLOCK = 1 << 23, 1 << 17
FILTER_BITS = 1 << 25
RARE = 16  # classes in a list before its shingle counts as frequent
SHORT_LIST = 32
ROUNDS = 2
PARITY_BYTES = 128
# A posting of a large set costs about this many subsets of a small one: it is sorted, listed and verified.
POSTING_COST = 8
SMALLEST_LARGE, LARGEST_SMALL = 2, 16
MOST_SALTS = 12  # binary logarithm
# Up to so many classes, their texts are found by id.
FEW_CLASSES = 10_000

LINK, PAIR, LISTED = 0, 1, 2


def least_overlap(a, b):
    """The overlap from which sets of sizes ``a`` and ``b`` link."""
    return -(-SAME * (a + b) // (SAME + ALL))


def partner_sizes(size: int) -> range:
    return range(-(-SAME * size // ALL), ALL * size // SAME + 1)


def prefix_length(size):
    return size - -(-SAME * size // ALL) + 1


def boundary(counts: dict[int, int]) -> int:
    """The largest size whose sets are treated as small, given how many sets have each size."""
    light = heavy = best = 0
    for size in range(1, LARGEST_SMALL + 1):
        subsets = sum(comb(size, least_overlap(size, other)) for other in partner_sizes(size))
        light += counts.get(size, 0) * subsets
        heavy += counts.get(size, 0) * prefix_length(size) * POSTING_COST
        if light <= heavy:
            best = size
    return max(best, SMALLEST_LARGE - 1)


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The sorted 64-bit values of each text's distinct shingles."""
    words = [text.encode().lower().split() for text in texts]
    flat = [word for own in words for word in own]
    if not flat:
        yield from (np.zeros(0, np.uint64) for _ in texts)
        return
    values = pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
    rolled = np.zeros(max(len(values) - WORDS + 1, 0), np.uint64)
    for place in range(WORDS):
        rolled = rolled * _STEP + values[place : place + len(rolled)]
    rolled = scramble(rolled)
    at = 0
    for own in words:
        if len(own) >= WORDS:
            yield np.unique(rolled[at : at + len(own) - WORDS + 1])
        elif own:
            value = np.uint64(len(own))
            for word in values[at : at + len(own)]:
                value = value * _STEP + word
            yield scramble(np.array([value ^ _STEP], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        at += len(own)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets_of(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[object, np.ndarray]]:
    """Ids and sets, made for some texts at a time: about ``size`` bytes, or one longer text."""
    for batch in batches:
        for own in slices(batch, size):
            texts = [text or "" for text in own["text"].to_pylist()]
            yield from zip(own["doc_id"].to_pylist(), _quiet(texts), strict=True)


def _quiet(texts: list[str]) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        yield from shingle_sets(texts)


# --- first pass: classes, sizes and the frequency sketch -------------------------------------------------


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells, part = np.zeros(CELLS, np.uint32), TaskContext.get().partitionId()
    names = ["doc_id", "cls", "n", "part", "block", "cells"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    waiting, rows = [], []

    def counted() -> None:
        if waiting:
            # Counts in place: an array of all cells for each turn would be the most that a worker holds.
            np.add.at(cells, np.concatenate(waiting) >> np.uint64(64 - 23), np.uint32(1))
            waiting.clear()

    def flush() -> pa.RecordBatch:
        values = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    held = 0
    for doc_id, tokens in _sets_of(batches):
        rows.append((doc_id, class_of(tokens) if len(tokens) else None, len(tokens), part, None, None))
        waiting.append(tokens)
        held += len(tokens)
        if held >= 500_000:
            counted()
            held = 0
        if len(rows) >= 20_000:
            yield flush()
    counted()
    yield flush()
    for block in range(CELLS // BLOCK):
        own = cells[block * BLOCK : (block + 1) * BLOCK]
        if own.any():
            rows.append((None, None, None, part, block, zlib.compress(own.tobytes(), 1)))
            if len(rows) >= 8:
                yield flush()
    yield flush()


def _summed(rows: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, np.uint32)
    for cells in rows["cells"]:
        total += np.frombuffer(zlib.decompress(cells.as_py()), np.uint32)
    return pa.table({"block": rows["block"][:1], "cells": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _levels(seen: DataFrame) -> np.ndarray:
    """How frequent the shingles of each cell are: 0 for rare ones, else a binary logarithm."""
    sums = seen.agg(F.sum("n").alias("tokens"), F.max("part").alias("parts")).first()
    noise = (sums["tokens"] or 0) / CELLS
    limit = noise + 4 * noise**0.5 + RARE
    salts = max(1, round(((sums["parts"] or 0) + 1) ** 0.5))
    blocks = seen.filter("block is not null").select("block", "cells", (F.col("part") % salts).alias("salt"))
    some = blocks.groupBy("block", "salt").applyInArrow(_summed, "block int, cells binary")

    def level(rows: pa.Table) -> pa.Table:
        merged = _summed(rows)
        count = np.frombuffer(zlib.decompress(merged["cells"][0].as_py()), np.uint32).astype(float)
        levels = np.where(count < limit, 0, 1 + np.log2(np.maximum(count - noise, RARE) / RARE)).astype(np.uint8)
        packed = zlib.compress(levels.tobytes(), 1)
        return pa.table({"block": merged["block"], "cells": pa.array([packed], pa.binary())})

    out = np.zeros(CELLS, np.uint8)
    # At most CELLS / BLOCK rows of BLOCK bytes.
    for row in some.groupBy("block").applyInArrow(level, "block int, cells binary").collect():
        own = np.frombuffer(zlib.decompress(row["cells"]), np.uint8)
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = own
    return out


# --- second pass: subsets of small sets, prefixes of large ones -------------------------------------------

# A posting's facts in one number: size (26 bits), place (24 bits), salt + 1 or 0 (13 bits).
_PLACE, _SIZE = 13, 37
_MOST = 1 << 26


def subset_keys(tokens: np.ndarray) -> Iterator[tuple[int, bool]]:
    """A key for every subset that a partner could share, and whether this set is the smaller of the two sizes."""
    size = len(tokens)
    values = tokens.tolist()
    for other in partner_sizes(size):
        low, high = min(size, other), max(size, other)
        for subset in combinations(values, least_overlap(size, other)):
            data = np.array([low, high, *subset], np.uint64).tobytes()
            yield int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True), size == low


def _post(batches: Iterator[pa.RecordBatch], levels: np.ndarray, small: int) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    smallest = -(-SAME * (small + 1) // ALL)  # a set this large may link to a large one
    keys, classes, facts, held = [], [], [], 0

    def flush() -> pa.RecordBatch:
        arrays = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, classes, facts)]
        for x in (keys, classes, facts):
            x.clear()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["token", "cls", "facts"])

    for _, tokens in _sets_of(batches):
        size = len(tokens)
        if not size or (cls := class_of(tokens)) in seen:
            continue
        if size >= _MOST:
            raise ValueError(f"a text of {size} distinct shingles is beyond this operator")
        seen.add(cls)
        if size <= small:
            own = list(subset_keys(tokens))
            keys.append(np.array([key for key, _ in own], np.int64))
            # Subsets have place 0, which no shingle has.
            facts.append(np.array([size << _SIZE | int(lower) for _, lower in own], np.int64))
            classes.append(np.full(len(own), cls, np.int64))
            held += len(own)
        if size >= smallest:
            level = levels[(tokens >> np.uint64(64 - 23)).astype(np.int64)]
            order = np.argsort(level, kind="stable")[: prefix_length(size)]
            level = np.minimum(level[order].astype(np.int64), MOST_SALTS)
            salt = np.where(level > 0, (cls >> 7 & (1 << level) - 1) + 1, 0)
            keys.append(tokens[order].view(np.int64))
            facts.append(size << _SIZE | np.arange(1, len(order) + 1) << _PLACE | salt)
            classes.append(np.full(len(order), cls, np.int64))
            held += len(order)
        if held >= 200_000:
            held = 0
            yield flush()
    yield flush()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists, sorted by shingle, salt and class: links of subsets, pairs of short lists, entries of long ones."""
    carry = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        now = [
            np.concatenate([a, batch[name].to_numpy()])
            for a, name in zip(carry, ("token", "cls", "facts"), strict=True)
        ]
        if not len(now[0]):
            continue
        last = np.flatnonzero((now[0] != now[0][-1]) | (_salt(now[2]) != _salt(now[2][-1:])))
        cut = last[-1] + 1 if len(last) else 0
        carry = [x[cut:] for x in now]
        yield from _met(*(x[:cut] for x in now))
    yield from _met(*carry)


def _salt(facts: np.ndarray) -> np.ndarray:
    """What keeps sublists apart; subsets use the lowest bit otherwise."""
    return np.where(facts >> _PLACE & (1 << 24) - 1, facts & (1 << _PLACE) - 1, 0)


def _met(token: np.ndarray, cls: np.ndarray, facts: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(token):
        return
    salt, size = _salt(facts), facts >> _SIZE
    place = facts >> _PLACE & (1 << 24) - 1
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1]) & (cls[1:] == cls[:-1])
    token, cls, facts, salt, size, place = (x[~again] for x in (token, cls, facts, salt, size, place))
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(starts, append=len(token))
    run = np.cumsum(new) - 1
    subset = place == 0
    # Subsets: a member of the smaller size links to all others.
    lower = subset & (facts & 1 == 1)
    center = np.full(len(starts), -1)
    center[run[lower][::-1]] = np.flatnonzero(lower)[::-1]
    linked = subset & (center[run] >= 0) & (center[run] != np.arange(len(run)))
    yield _rows(LINK, cls[center[run[linked]]], cls[linked])
    long = ~subset & ((salt > 0) | (lengths[run] > SHORT_LIST))
    yield _rows(LISTED, token[long], cls[long], size[long], place[long])
    short = np.flatnonzero(~subset & ~long & (lengths[run] > 1))
    pairs = []
    for shift in range(1, min(SHORT_LIST, int(lengths[run[short]].max(initial=1)))):
        i, j = short[:-shift], short[shift:]
        same = run[i] == run[j]
        i, j = i[same], j[same]
        fits = may_link(size[i], place[i], size[j], place[j]) & (cls[i] != cls[j])
        pairs.append(np.stack([np.minimum(cls[i[fits]], cls[j[fits]]), np.maximum(cls[i[fits]], cls[j[fits]])], axis=1))
    if pairs:
        found = np.unique(np.concatenate(pairs), axis=0)
        yield _rows(PAIR, found[:, 0], found[:, 1])


def may_link(size_a, place_a, size_b, place_b):
    """Whether sets that share the shingle at these places (from 1) of their order can still reach the overlap."""
    rest = np.minimum(size_a - place_a, size_b - place_b) + 1
    return rest >= least_overlap(size_a, size_b)


def _need() -> Column:
    return F.floor(((F.col("n") + F.col("other_n")) * SAME + SAME + ALL - 1) / F.lit(SAME + ALL))


def _may_link() -> Column:
    return F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place")) + 1 >= _need()


_FOUND = "kind int, x long, y long, n long, place long"


def _rows(kind: int, x: np.ndarray, y: np.ndarray, n=None, place=None) -> pa.RecordBatch:
    nothing = pa.nulls(len(x), pa.int64())
    more = [nothing if v is None else pa.array(v) for v in (n, place)]
    arrays = [pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y), *more]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "x", "y", "n", "place"])


# --- third pass: the sets of classes that have candidates -------------------------------------------------


def _class_filter(classes: DataFrame) -> np.ndarray:
    """A bit map that holds a bit of every class, and by chance of some others."""
    block_bits = 1 << 20

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            mine[_filter_place(batch["cls"].to_numpy())] = True
        yield from _bit_rows(np.packbits(mine), block_bits // 8)

    def either(rows: pa.Table) -> pa.Table:
        total = np.zeros(block_bits // 8, np.uint8)
        for packed in rows["bits"]:
            total |= np.frombuffer(zlib.decompress(packed.as_py()), np.uint8)
        return pa.table({"block": rows["block"][:1], "bits": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    kind = "block int, bits binary"
    some = classes.coalesce(64).mapInArrow(frugal(bits), kind)
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in some.groupBy("block").applyInArrow(either, kind).collect():
        own = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
        out[row["block"] * len(own) : (row["block"] + 1) * len(own)] = own
    return out


def _bit_rows(packed: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    for block in range(len(packed) // size):
        own = packed[block * size : (block + 1) * size]
        if own.any():
            row = [pa.array([block], pa.int32()), pa.array([zlib.compress(own.tobytes(), 1)], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, ["block", "bits"])


def _filter_place(classes: np.ndarray) -> np.ndarray:
    return (scramble(classes.view(np.uint64)) >> np.uint64(64 - 25)).astype(np.int64)


PARITY = [f"parity{i}" for i in range(PARITY_BYTES // 8)]
FOLDED = [f"folded{i}" for i in range(8)]


def parity_sketch(tokens: np.ndarray) -> list[int]:
    """For each bit, whether an odd number of shingles falls on it."""
    bits = 8 * PARITY_BYTES
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


def _near_enough(parity: list[str]) -> Column:
    """Whether parity sketches allow the overlap: every bit in which they differ is a shingle that only one has."""
    apart = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(f"other_{x}"))) for x in parity), F.lit(0))
    return F.col("n") + F.col("other_n") - apart >= 2 * _need()


def _sets(batches: Iterator[pa.RecordBatch], wanted: np.ndarray, whole: bool) -> Iterator[pa.RecordBatch]:
    """Of the wanted classes the sets themselves, or their sizes and parity sketches; each once per task."""
    seen: set[int] = set()
    rows, held = [], 0
    names = ["cls", "tokens"] if whole else ["cls", "n", *PARITY]
    kinds = [pa.int64(), pa.binary()] if whole else [pa.int64()] * len(names)

    def flush() -> pa.RecordBatch:
        values = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    for _, tokens in _sets_of(batches):
        if not len(tokens):
            continue
        cls = class_of(tokens)
        place = int(_filter_place(np.array([cls], np.int64))[0])
        if cls in seen or not wanted[place >> 3] >> (7 - (place & 7)) & 1:
            continue
        seen.add(cls)
        rows.append((cls, tokens.tobytes()) if whole else (cls, len(tokens), *parity_sketch(tokens)))
        held += len(tokens) if whole else len(PARITY)
        if held >= 500_000:
            held = 0
            yield flush()
    yield flush()


def _sets_of_classes(texts: DataFrame, classes: DataFrame, whole: bool) -> DataFrame:
    """Stored sets (or sketches) of the classes in ``classes.cls``, and of a few others by chance."""
    bits = texts.sparkSession.sparkContext.broadcast(zlib.compress(_class_filter(classes).tobytes(), 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sets(batches, np.frombuffer(zlib.decompress(bits.value), np.uint8), whole)

    kind = "cls long, tokens binary" if whole else ", ".join(f"{name} long" for name in ("cls", "n", *PARITY))
    return materialise(texts.mapInArrow(frugal(work), kind).dropDuplicates(["cls"]))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for one, two in zip(batch["tokens"], batch["other_tokens"], strict=True):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, two))
            both = np.concatenate([a, b])
            both.sort()
            keep.append(int((both[1:] == both[:-1]).sum()) >= least_overlap(len(a), len(b)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _classes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()


def _with_both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with the columns of ``sets`` for a, and as ``other_`` for b."""
    facts = [name for name in sets.columns if name != "cls"]
    one = sets.withColumnRenamed("cls", "a")
    two = sets.select(F.col("cls").alias("b"), *[F.col(x).alias(f"other_{x}") for x in facts])
    return pairs.join(one, "a").join(two, "b")


class _Known:
    """The sets that were made so far, each from its text once."""

    def __init__(self, texts: DataFrame, rows: DataFrame):
        self.texts, self.rows, self.sets = texts, rows, None

    def of(self, classes: DataFrame) -> DataFrame:
        """Stored sets, those of ``classes`` among them."""
        if self.sets is None:
            self.sets = _sets_of_classes(self.texts, classes, whole=True)
            return self.sets
        missing = materialise(classes.join(self.sets.select("cls"), "cls", "left_anti"))
        count = missing.count()
        if count:
            texts = self.texts
            if count <= FEW_CLASSES:
                # One text of each class is enough, and their ids are few.
                ids = self.rows.join(F.broadcast(missing), "cls").groupBy("cls").agg(F.min("doc_id").alias("own_id"))
                ids = materialise(ids.select("own_id").distinct())
                texts = texts.join(F.broadcast(ids), texts["doc_id"].eqNullSafe(ids["own_id"]), "left_semi")
            # A set that is made again by chance gives the same links again.
            self.sets = self.sets.union(_sets_of_classes(texts, missing, whole=True))
        return self.sets


def _verified(pairs: DataFrame, sketches: DataFrame, known: _Known) -> DataFrame | None:
    """Links among the distinct pairs (a, b) of classes that connect all that link, stored; None if none are likely.

    Sketches leave few pairs that do not link; only their sets are made again
    from the texts. Sets move with the pair of each class and its smallest
    likely partner first, then only with pairs of what this did not connect.
    """
    likely = materialise(_with_both(pairs, sketches).filter(_near_enough(PARITY)).select("a", "b"))
    if likely.isEmpty():
        return None
    sets = known.of(_classes(likely))
    star = materialise(likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    links = materialise(_with_both(star, sets).mapInArrow(frugal(_linked), "a long, b long").distinct())
    # Classes that hang from the same one need no pair of their own.
    one = links.select(F.col("b").alias("a"), F.col("a").alias("of_a"))
    two = links.select("b", F.col("a").alias("of_b"))
    apart = likely.join(star, ["a", "b"], "left_anti").join(one, "a", "left").join(two, "b", "left")
    apart = materialise(apart.filter("coalesce(of_a, a) <> coalesce(of_b, b)").select("a", "b"))
    if apart.isEmpty():
        return links
    return links.union(materialise(_with_both(apart, sets).mapInArrow(frugal(_linked), "a long, b long")))


def _pairs(entries: DataFrame, others: DataFrame, differ: Column) -> DataFrame:
    met = entries.join(others, "token").filter(differ & _may_link() & _near_enough(FOLDED))
    low, high = F.least("cls", "other_cls").alias("a"), F.greatest("cls", "other_cls").alias("b")
    return met.select(low, high).distinct()


def _renamed(entries: DataFrame, *names: str) -> DataFrame:
    return entries.select("token", *[F.col(name).alias(f"other_{name}") for name in names])


def link_classes(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Per row its class and set size, and for linked classes their component (None if there are no links)."""
    spark = texts.sparkSession
    seen = materialise(texts.mapInArrow(
        frugal(_summarise), "doc_id long, cls long, n int, part int, block int, cells binary"
    ))
    rows = seen.filter("block is null").select("doc_id", "cls", "n")
    sizes = rows.filter(F.col("n").between(1, LARGEST_SMALL)).groupBy("n").agg(F.countDistinct("cls").alias("classes"))
    small = boundary({row["n"]: row["classes"] for row in sizes.collect()})
    levels = spark.sparkContext.broadcast(zlib.compress(_levels(seen).tobytes(), 1))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _post(batches, np.frombuffer(zlib.decompress(levels.value), np.uint8), small)

    posted = texts.mapInArrow(frugal(post), "token long, cls long, facts long")
    salt = F.when(F.shiftright("facts", _PLACE).bitwiseAND((1 << 24) - 1) == 0, 0).otherwise(
        F.col("facts").bitwiseAND((1 << _PLACE) - 1)
    )
    dealt = posted.repartition("token", salt).sortWithinPartitions("token", salt, "cls")
    found = materialise(dealt.mapInArrow(frugal(_meet), _FOUND))
    links = found.filter(F.col("kind") == LINK).select(F.col("x").alias("a"), F.col("y").alias("b"))
    short = found.filter(F.col("kind") == PAIR).select(F.col("x").alias("a"), F.col("y").alias("b"))
    entries = found.filter(F.col("kind") == LISTED).select(F.col("x").alias("token"), F.col("y").alias("cls"), "n", "place")
    wanted = _classes(short).union(entries.select("cls").distinct())
    sketches = _sets_of_classes(texts, wanted, whole=False)
    # A sketch folded by exclusive or is the sketch with fewer bits.
    folded = [
        reduce(Column.bitwiseXOR, [F.col(name) for name in PARITY[i :: len(FOLDED)]]).alias(FOLDED[i])
        for i in range(len(FOLDED))
    ]
    entries = materialise(entries.join(sketches.select("cls", *folded), "cls"))
    candidates = short.distinct()
    component = None
    known = _Known(texts, rows)
    for turn in range(ROUNDS + 1):
        if turn:
            part_of = component.select(F.col("node").alias("cls"), "component")
            listed = entries.join(part_of, "cls", "left")
            listed = listed.withColumn("component", F.coalesce("component", "cls"))
        else:
            listed = entries.withColumn("component", F.col("cls"))
        facts = ["cls", "n", "place", "component", *FOLDED]
        differ = F.col("component") != F.col("other_component")
        if turn < ROUNDS:
            first = F.min(F.struct(F.xxhash64("cls", "token", F.lit(turn)).alias("draw"), *facts)).alias("pivot")
            pivots = listed.groupBy("token").agg(first).select("token", "pivot.*")
            met = _pairs(listed, _renamed(pivots, *facts), differ)
        else:
            mixed = listed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            mixed = mixed.filter("low < high").select("token")
            listed = listed.join(mixed, "token", "left_semi")
            met = _pairs(listed, _renamed(listed, *facts), F.col("component") < F.col("other_component"))
        candidates = met if turn else candidates.union(met).distinct()
        found_links = _verified(candidates, sketches, known)
        if found_links is not None or component is None:
            links = links if found_links is None else links.union(found_links)
            component = connected(links)
    return rows, component


def link_documents(docs: DataFrame) -> DataFrame:
    """Per document: n_shingles (size of its set), component_id, class_id and component_class.

    Words are runs of characters other than ASCII white space, with A to Z in
    lower case; a set holds all runs of five words, or the whole sequence if a
    text has fewer. Two documents link when their sets' Jaccard similarity is
    at least 0.75; ``component_id`` is the smallest doc_id reachable by links,
    itself included. A null, empty or wordless text has an empty set, no class
    and is linked with nothing. Repeated rows and ids are kept; a null id is
    never the smallest unless its component has no other. Columns other than
    doc_id and text are ignored.

    ``class_id`` names the document's set and ``component_class`` its component
    (by the smallest class in it), also where ids repeat.

    Sets and classes are compared by 64-bit values of their shingles. Runs
    several jobs while it is built, each of which stores its result.
    """
    ship(docs.sparkSession)
    rows, component = link_classes(columns(docs, doc_id="long", text="string"))
    classes = rows.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("first"))
    part_of = component.select(F.col("node").alias("cls"), "component")
    classes = classes.join(part_of, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(smallest, "component").select("cls", "component", "component_id")
    return rows.join(named, "cls", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("cls").alias("class_id"),
        F.col("component").alias("component_class"),
    )


def _classed(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        narrow = batch.select(["doc_id", "text"])
        classes = [class_of(tokens) if len(tokens) else None for _, tokens in _sets_of(iter([narrow]))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(classes, pa.int64())], [*batch.schema.names, name]
        )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component of linked documents one row, that of the smallest doc_id, with all columns of ``docs``.

    Rows without shingles are linked with nothing, and all stay. Of several rows
    with that id and set, one stays.
    """
    names = docs.columns
    linked = link_documents(docs).filter("class_id is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "class_id")).alias("first")
    kept = linked.groupBy("component_class").agg(first).select(
        F.col("first.class_id").alias("kept_class"), F.col("first.doc_id").alias("kept_id")
    )
    cls = "shingle_class"
    while cls in names:
        cls += "_"
    kind = StructType([*docs.schema.fields, StructField(cls, LongType())])
    classed = docs.mapInArrow(frugal(lambda batches: _classed(batches, cls)), kind)
    filled = classed.filter(F.col(cls).isNotNull())
    chosen = filled.join(
        kept, (filled[cls] == kept["kept_class"]) & filled["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi"
    )
    # Copies of the chosen row agree in class; partial sums keep one of each task's.
    others = [name for name in names if name != "doc_id"]
    single = chosen.groupBy(cls, "doc_id").agg(F.first(F.struct(*others)).alias("row"))
    single = single.select(*[F.col("doc_id") if name == "doc_id" else F.col(f"row.{name}") for name in names])
    return single.unionByName(classed.filter(F.col(cls).isNull()).select(*names))
