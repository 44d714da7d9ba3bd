"""Hard negatives by exact inner products in a residue number system.

A vector's components become whole numbers. For each of several small primes,
the component matrices modulo that prime are multiplied in float32; residues
are at most half the prime, so that no sum leaves the 24 bits that float32
holds exactly. As many primes are taken as the sizes of the two blocks prove
necessary, and Chinese remaindering gives the exact signed score from its
residues, however large.

Anchors meet all rows in blocks, twice: first for each anchor's positives, then
for the rows of other labels whose score lies in a window below a positive's.
Each meeting keeps only the few best of each anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.support import materialise, ship

# Primes below SMALL come first: 256 products of their residues add up to less than 2**24. Those from there to LARGEST
# serve the widest numbers, in shorter sums; together they exceed any product of two doubles.
SMALL, LARGEST = 512, 2048
ANCHOR_ROWS, CANDIDATE_ROWS = 256, 4096
ANCHOR_BYTES, CANDIDATE_BYTES = 1 << 20, 1 << 22
# Below this product of primes, remaindering fits 64 bits; above it, Python's whole numbers do it.
NARROW = 1 << 55

VECTOR = "row long, vec_id long, label long, dim int, limbs int, bits int, values binary"
BLOCK = "dim int, limbs int, bits int, rows array<long>, ids array<long>, labels array<long>, values binary"
FOUND = "anchor_row long, positive int, key binary, vec_id long, row long"


@cache
def primes() -> tuple[int, ...]:
    """Odd primes in the order of use: those below SMALL, largest first, then the others upwards."""
    odd = [p for p in range(3, LARGEST, 2) if all(p % d for d in range(3, int(p**0.5) + 1, 2))]
    return tuple(sorted(odd, key=lambda p: -p if p < SMALL else p))


def exact_terms(p: int) -> int:
    """How many products of residues modulo p float32 adds up exactly."""
    return (2**24 - 1) // (p // 2) ** 2


@cache
def moduli(bits: int) -> tuple[int, ...]:
    """The fewest of the primes whose product exceeds twice 2**bits."""
    product = 1
    for count, p in enumerate(primes(), 1):
        product *= p
        if product > 2 << bits:
            return primes()[:count]
    raise OverflowError(f"no doubles have products of {bits} bits")


def whole(vector: np.ndarray, scale: int) -> list[int] | np.ndarray:
    """floor(scale x) of finite doubles, exactly."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vector * scale)
    if (np.abs(scaled) < 2**62).all():
        return scaled.astype(np.int64)
    # A double of 2**53 or more is a whole number itself.
    return [int(x) * scale if abs(x) >= 2**53 else int(y) for x, y in zip(vector.tolist(), scaled.tolist(), strict=True)]


def limbs_of(bits: int) -> int:
    """16-bit limbs for signed numbers of so many bits: a power of two, so that blocks come in few kinds."""
    limbs = 1
    while 16 * limbs <= bits:
        limbs *= 2
    return limbs


def _convert(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    names = ["row", "vec_id", "label", "dim", "limbs", "bits", "values"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    for batch in batches:
        rows = []
        vectors = batch["vector"]
        for place, (row, vec_id, label) in enumerate(
            zip(*(batch[name].to_pylist() for name in ("row", "vec_id", "label")), strict=True)
        ):
            own = vectors[place].values
            if label is None or own is None or own.null_count:
                continue
            values = own.to_numpy(zero_copy_only=False)
            if not np.isfinite(values).all():
                continue
            numbers = whole(values, scale)
            ends = (np.min(numbers), np.max(numbers)) if len(numbers) else ()
            bits = max((abs(int(x)).bit_length() for x in ends), default=0)
            limbs = limbs_of(bits)
            if limbs <= 4:
                data = np.asarray(numbers, np.int64).astype({1: "<i2", 2: "<i4", 4: "<i8"}[limbs]).tobytes()
            else:
                data = b"".join(int(x).to_bytes(2 * limbs, "little", signed=True) for x in numbers)
            rows.append((row, vec_id, label, len(numbers), limbs, bits, data))
        values = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def _blocks(batches: Iterator[pa.RecordBatch], most: int, size: int, marked: bool) -> Iterator[pa.RecordBatch]:
    """Vectors of one length and width as blocks, in the order of vec_id and row."""
    names = ["dim", "limbs", "bits", "rows", "ids", "labels", "values"] + ["positives"] * marked
    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.int32(), pa.int32(), longs, longs, longs, pa.binary(), pa.list_(pa.list_(pa.binary()))]
    for batch in batches:
        order = [("dim", "ascending"), ("limbs", "ascending"), ("vec_id", "ascending"), ("row", "ascending")]
        batch = batch.sort_by(order)
        width = np.stack([batch["dim"].to_numpy(), batch["limbs"].to_numpy()], axis=1)
        cuts = [*np.flatnonzero(np.diff(width, axis=0).any(axis=1)) + 1, len(batch)] if len(batch) else []
        low = 0
        for cut in cuts:
            dim, limbs = (int(x) for x in width[low])
            step = max(1, min(most, size // max(1, 2 * dim * limbs)))
            while low < cut:
                some = batch.slice(low, min(step, cut - low))
                low += len(some)
                row = [dim, limbs, max(some["bits"].to_pylist())]
                row += [some[name].to_pylist() for name in ("row", "vec_id", "label")]
                row += [b"".join(some["values"].to_pylist())]
                if marked:
                    row.append(some["positives"].to_pylist())
                arrays = [pa.array([v], k) for v, k in zip(row, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, names)


def residues(values: bytes, rows: int, dim: int, limbs: int, p: int) -> np.ndarray:
    """The matrix modulo p, from -(p - 1) / 2 on, as float32."""
    if limbs == 1:
        left = np.frombuffer(values, "<i2").reshape(rows, dim).astype(np.int32) % p
    else:
        parts = np.frombuffer(values, "<u2").reshape(rows, dim, limbs)
        total = np.zeros((rows, dim), np.int64)
        for i in range(limbs):
            total += parts[:, :, i].astype(np.int64) * pow(2, 16 * i, p)
        left = (total - (parts[:, :, -1] >> 15) * pow(2, 16 * limbs, p)) % p
    return np.where(left > p // 2, left - p, left).astype(np.float32)


class Side:
    """A block of vectors in a meeting."""

    def __init__(self, values: bytes, rows: int, dim: int, limbs: int, bits: int):
        self.values, self.rows, self.dim, self.limbs, self.bits = values, rows, dim, limbs, bits

    def modulo(self, p: int) -> np.ndarray:
        return residues(self.values, self.rows, self.dim, self.limbs, p)


def scores(one: Side, two: Side) -> np.ndarray:
    """Exact inner products of all rows of one with all rows of two: 64 bits, or Python's whole numbers if need be."""
    chosen = moduli(one.bits + two.bits + one.dim.bit_length())
    product = int(np.prod(np.array(chosen, object)))
    kind = np.int64 if product < NARROW else object
    total = np.zeros((one.rows, two.rows), kind)
    for p in chosen:
        a, b = one.modulo(p), two.modulo(p)
        partial = np.zeros((one.rows, two.rows))
        step = exact_terms(p)
        for low in range(0, one.dim, step):
            partial += a[:, low : low + step] @ b[:, low : low + step].T
        partial -= p * np.floor(partial / p)
        rest = product // p
        share = partial * pow(rest, -1, p)
        share -= p * np.floor(share / p)
        total += share.astype(np.int64).astype(kind, copy=False) * rest
    total %= product
    return np.where(total > product // 2, total - product, total)


def first(values: np.ndarray, most: int) -> np.ndarray:
    """Places of the largest values, largest first, ties in their order."""
    if values.dtype == object:
        return np.array(sorted(range(len(values)), key=lambda i: (-values[i], i))[:most], np.int64)
    places = np.arange(len(values))
    if len(values) > most:
        least = np.partition(values, len(values) - most)[len(values) - most]
        above, equal = np.flatnonzero(values > least), np.flatnonzero(values == least)
        places = np.sort(np.concatenate([above, equal[: most - len(above)]]))
    return places[np.argsort(-values[places], kind="stable")]


def key_of(score: int, width: int) -> bytes:
    """Bytes that sort as the scores do."""
    return (int(score) + (1 << 8 * width - 1)).to_bytes(width, "big")


def score_of(key: bytes) -> int:
    return int.from_bytes(key, "big") - (1 << 8 * len(key) - 1)


def _meet(
    batches: Iterator[pa.RecordBatch], most: int, width: int, wanted: Callable[..., Iterator[tuple[int, np.ndarray]]]
) -> Iterator[pa.RecordBatch]:
    """Per anchor (and positive) the best wanted rows among all blocks that follow each other for the same anchors."""
    best: dict[tuple[int, int], list[tuple]] = {}
    current = None

    def flush() -> pa.RecordBatch:
        rows = [(a, q, key_of(-s, width), i, r) for (a, q), own in best.items() for s, _, i, r in own]
        best.clear()
        values = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        names = ["anchor_row", "positive", "key", "vec_id", "row"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    for batch in batches:
        for place in range(len(batch)):
            pair = {name: batch[name][place].as_py() for name in batch.schema.names}
            rows, labels = np.array(pair["rows"], np.int64), np.array(pair["labels"], np.int64)
            asking = pair["anchor_rows"]
            if asking[0] != current and best:
                yield flush()
            current = asking[0]
            found = scores(
                Side(pair["anchor_values"], len(asking), pair["dim"], pair["anchor_limbs"], pair["anchor_bits"]),
                Side(pair["values"], len(rows), pair["dim"], pair["limbs"], pair["bits"]),
            )
            for i, anchor in enumerate(asking):
                for positive, places in wanted(found[i], rows, labels, pair, i):
                    chosen = places[first(found[i][places], most)]
                    if len(chosen):
                        own = best.get((anchor, positive), [])
                        ids = [pair["ids"][x] for x in chosen]
                        own = own + [
                            (-int(found[i][x]), (v is None, v or 0, int(rows[x])), v, int(rows[x]))
                            for x, v in zip(chosen, ids, strict=True)
                        ]
                        best[anchor, positive] = sorted(own, key=lambda x: x[:2])[:most]
    yield flush()


def _same_label(found, rows, labels, pair, i) -> Iterator[tuple[int, np.ndarray]]:
    yield 0, np.flatnonzero((labels == pair["anchor_labels"][i]) & (rows != pair["anchor_rows"][i]))


def _in_window(percent: int) -> Callable[..., Iterator[tuple[int, np.ndarray]]]:
    def wanted(found, rows, labels, pair, i) -> Iterator[tuple[int, np.ndarray]]:
        keys = pair["anchor_positives"][i] or []
        tops = [score_of(key) for key in keys]
        if not tops:
            return
        floors = [-(-percent * top // 100) for top in tops]
        near = np.flatnonzero((found >= min(floors)) & (found <= max(tops)) & (labels != pair["anchor_labels"][i]))
        for number, (low, top) in enumerate(zip(floors, tops, strict=True), 1):
            own = found[near]
            yield number, near[np.flatnonzero((own >= low) & (own <= top))]

    return wanted


def _as_scores(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        arrays = []
        for name in batch.schema.names:
            if name in names:
                plain = [score_of(key) for key in batch[name].to_pylist()]
                arrays.append(pa.array([x if -(2**63) <= x < 2**63 else None for x in plain], pa.int64()))
            else:
                arrays.append(batch[name])
        yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)


def mine(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256
) -> DataFrame:
    """For every row of ``vectors`` (vec_id, embedding, label) that satisfies ``anchor``, hard negatives of its positives.

    A score is the exact inner product of floor(scale x). Higher scores come
    first, ties by smaller vec_id (a null id last), then in the order of the
    table. An anchor's positives are its first ``positives`` other rows of the
    same label; for each, the first ``negatives`` rows of other labels with a
    score of ``percent`` hundredths of the positive's to the positive's own.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score and positive_rank.

    Rows with a null label, a null vector, or a null or non-finite component
    take no part. Vectors of different lengths do not meet. Another row is any
    other, also one with the same vec_id. A score that 64 bits do not hold
    ranks by its exact value and is returned as null. A positive with a
    negative score has no window; an empty table gives no rows; other columns
    are ignored.

    Runs jobs while it is built: vectors and positives are stored.
    """
    spark = vectors.sparkSession
    ship(spark)
    plain = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    stored = materialise(plain.mapInArrow(lambda batches: _convert(batches, scale), VECTOR))
    facts = stored.agg(
        F.count(F.lit(1)).alias("n"), F.max("bits").alias("bits"), F.max("dim").alias("dim")
    ).first()
    width = max(8, (2 * (facts["bits"] or 0) + (facts["dim"] or 0).bit_length() + 10) // 8)
    # Blocks are dealt to so many groups, each of which gets a copy of the anchors.
    salts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), facts["n"] // (CANDIDATE_ROWS // 4)))
    blocks = stored.mapInArrow(lambda batches: _blocks(batches, CANDIDATE_ROWS, CANDIDATE_BYTES, False), BLOCK)
    blocks = blocks.withColumn("salt", F.pmod(F.xxhash64("rows"), F.lit(salts)).cast("int"))
    asking = stored.filter(anchor)

    def meetings(anchors: DataFrame) -> DataFrame:
        marked = "positives" in anchors.columns
        kind = BLOCK + ", positives array<array<binary>>" * marked
        packed = anchors.mapInArrow(lambda batches: _blocks(batches, ANCHOR_ROWS, ANCHOR_BYTES, marked), kind)
        renamed = {name: f"anchor_{name}" for name in packed.columns if name != "dim"}
        copies = packed.withColumnsRenamed(renamed).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        # The anchors' side is read once, with all blocks of the group for each of its rows.
        return copies.hint("merge").join(blocks, ["dim", "salt"])

    def best(found: DataFrame, most: int) -> DataFrame:
        order = Window.partitionBy("anchor_row", "positive").orderBy(F.desc("key"), F.asc_nulls_last("vec_id"), "row")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    same = meetings(asking).mapInArrow(lambda batches: _meet(batches, positives, width, _same_label), FOUND)
    chosen = materialise(best(same, positives).select("anchor_row", "rank", "key", "vec_id"))
    keys = chosen.groupBy(F.col("anchor_row").alias("row")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "key"))), lambda x: x["key"]).alias("positives")
    )
    window = _in_window(percent)
    near = meetings(asking.join(keys, "row")).mapInArrow(lambda batches: _meet(batches, negatives, width, window), FOUND)
    ranked = best(near, negatives)
    named = ranked.join(
        chosen.select(
            "anchor_row",
            F.col("rank").alias("positive"),
            F.col("vec_id").alias("positive_id"),
            F.col("key").alias("positive_score"),
        ),
        ["anchor_row", "positive"],
    ).join(asking.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row")
    result = named.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("key").alias("negative_score"),
        F.col("positive").alias("positive_rank"),
    )
    return result.mapInArrow(
        lambda batches: _as_scores(batches, ["positive_score", "negative_score"]),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long,"
        " positive_rank int",
    )
