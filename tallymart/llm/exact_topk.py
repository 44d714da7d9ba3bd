"""Exact top-k inner products by a three-phase uniform threshold.

A vector is cut into ``LISTS`` slices. For a query, list j holds every
candidate's partial score on slice j; the score is the sum over lists. With
each list shifted so that its lowest partial score is 0, no sum is negative.

1. Every block of candidates takes the best of each of its lists, resolves their
   whole scores, and reports those and the lowest partial scores. The k-th
   largest whole score t is a safe bound: k candidates reach it.
2. The cutoff t / LISTS goes to all blocks. Who stays below it in every list
   stays below t and is out. Of the others, a block holds the remaining partial
   scores itself, so it reports only those whose sum can still reach t.
3. Their scores, by then exact, are ranked.

Queries meet candidates in blocks, as matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.hard_negatives import first, key_of, limbs_of, score_of, whole
from tallymart.llm.support import materialise, ship

LISTS = 2
SCALE = 1024
CANDIDATE_ROWS, QUERY_ROWS = 4096, 256
CANDIDATE_BYTES, QUERY_BYTES = 1 << 22, 1 << 20

VECTOR = "row long, vec_id long, dim int, limbs int, values binary"
BLOCK = "dim int, limbs int, rows array<long>, values binary"


def slices(dim: int) -> list[slice]:
    bounds = [dim * j // LISTS for j in range(LISTS + 1)]
    return [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that take part, with floor(1024 x) of every component as signed numbers of some 16-bit limbs."""
    names = ["row", "vec_id", "dim", "limbs", "values"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    for batch in batches:
        rows = []
        for place, (row, vec_id) in enumerate(zip(batch["row"].to_pylist(), batch["vec_id"].to_pylist(), strict=True)):
            own = batch["vector"][place].values
            if own is None or own.null_count:
                continue
            values = own.to_numpy(zero_copy_only=False)
            if np.isfinite(values).all():
                numbers = whole(values, SCALE)
                ends = (np.min(numbers), np.max(numbers)) if len(numbers) else ()
                limbs = limbs_of(max((abs(int(x)).bit_length() for x in ends), default=0))
                rows.append((row, vec_id, len(numbers), limbs, _to_bytes(numbers, limbs)))
        values = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


_WIDTHS = {1: "<i2", 2: "<i4", 4: "<i8"}


def _to_bytes(numbers, limbs: int) -> bytes:
    if limbs in _WIDTHS:
        return np.asarray(numbers, np.int64).astype(_WIDTHS[limbs]).tobytes()
    return b"".join(int(x).to_bytes(2 * limbs, "little", signed=True) for x in numbers)


def _matrix(values: bytes, rows: int, dim: int, limbs: int) -> np.ndarray:
    """64-bit numbers, or Python's for components that are wider."""
    if limbs in _WIDTHS:
        return np.frombuffer(values, _WIDTHS[limbs]).reshape(rows, dim).astype(np.int64)
    parts = [values[i : i + 2 * limbs] for i in range(0, len(values), 2 * limbs)]
    return np.array([int.from_bytes(x, "little", signed=True) for x in parts], object).reshape(rows, dim)


def _products(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Partial scores, one row per query: in doubles below 2**53, which multiply fastest, else as wide as they must be."""

    def largest(x: np.ndarray) -> int:
        return max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) if x.size else 0

    size = LISTS * largest(candidates) * largest(queries) * max(candidates.shape[1], 1)
    if size < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    kind = np.int64 if size < 2**62 else object
    return queries.astype(kind) @ candidates.astype(kind).T


def _blocks(batches: Iterator[pa.RecordBatch], most: int, size: int, marked: bool) -> Iterator[pa.RecordBatch]:
    """Vectors of one length and width as blocks; queries with the bounds they carry."""
    more = ["bound", "lows"] if marked else []
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.list_(pa.binary()))]
    for batch in batches:
        batch = batch.sort_by([("dim", "ascending"), ("limbs", "ascending"), ("row", "ascending")])
        width = np.stack([batch["dim"].to_numpy(), batch["limbs"].to_numpy()], axis=1)
        cuts = [*np.flatnonzero(np.diff(width, axis=0).any(axis=1)) + 1, len(batch)] if len(batch) else []
        low = 0
        for cut in cuts:
            dim, limbs = (int(x) for x in width[low])
            step = max(1, min(most, size // max(1, 2 * dim * limbs)))
            while low < cut:
                some = batch.slice(low, min(step, cut - low))
                low += len(some)
                row = [dim, limbs, some["row"].to_pylist(), b"".join(some["values"].to_pylist())]
                row += [some[name].to_pylist() for name in more]
                arrays = [pa.array([v], k) for v, k in zip(row, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, ["dim", "limbs", "rows", "values", *more])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, list[int], list[np.ndarray]]]:
    """Each pair of blocks: the pair, the candidates' and queries' row numbers, and the partial scores of each list."""
    for batch in batches:
        for place in range(len(batch)):
            pair = {name: batch[name][place].as_py() for name in batch.schema.names}
            rows, asking = np.array(pair["rows"], np.int64), pair["query_rows"]
            mine = _matrix(pair["values"], len(rows), pair["dim"], pair["limbs"])
            theirs = _matrix(pair["query_values"], len(asking), pair["dim"], pair["query_limbs"])
            lists = [_products(mine[:, own], theirs[:, own]) for own in slices(pair["dim"])]
            if any(x.dtype == object for x in lists):
                lists = [x.astype(object) for x in lists]
            yield pair, rows, asking, lists


REPORT = "query_row long, list int, row long, key binary"


def _report(rows: list[tuple]) -> pa.RecordBatch:
    values = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["query_row", "list", "row", "key"])


def _best(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: per query and block the lowest of each list, and whole scores of the best of each list."""
    for _, rows, asking, lists in _meetings(batches):
        found = []
        for i, query in enumerate(asking):
            others = np.flatnonzero(rows != query)
            found += [(query, j, None, key_of(scores[i].min(), width)) for j, scores in enumerate(lists)]
            best = np.unique(np.concatenate([others[first(scores[i][others], k)] for scores in lists]))
            score = sum(scores[i][best] for scores in lists)
            found += [(query, None, int(rows[best[x]]), key_of(score[x], width)) for x in first(score, k)]
        yield _report(found)


def _reaching(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Phase 2: whole scores of candidates that reach the cutoff in some list, and the bound in sum."""
    for pair, rows, asking, lists in _meetings(batches):
        for i, query in enumerate(asking):
            score = sum(scores[i] for scores in lists)
            near = rows != query
            key = pair["query_bound"][i]
            # Without k candidates there is no bound, and the lowest partial scores are the cutoffs.
            if key is not None:
                lows = [score_of(x) for x in pair["query_lows"][i]]
                bound = score_of(key)
                share = -(-(bound - sum(lows)) // LISTS)
                reach = np.zeros(len(rows), bool)
                for low, scores in zip(lows, lists, strict=True):
                    reach |= (scores[i] >= low + share).astype(bool)
                near &= reach & (score >= bound).astype(bool)
            places = np.flatnonzero(near)
            for low in range(0, len(places), 100_000):
                own = places[low : low + 100_000]
                yield _report([(query, None, int(rows[x]), key_of(score[x], width)) for x in own])
    yield _report([])


def _as_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        plain = [score_of(key) for key in batch["key"].to_pylist()]
        score = pa.array([x if -(2**63) <= x < 2**63 else None for x in plain], pa.int64())
        names = ["query_id", "rank", "vec_id"]
        yield pa.RecordBatch.from_arrays([*(batch[name] for name in names), score], [*names, "score"])


def top_k(vectors: DataFrame, query: Column, k: int = 10) -> DataFrame:
    """For every row of ``vectors`` (vec_id, embedding) that satisfies ``query``, its k best others.

    Returns query_id, rank, vec_id and score: the integer inner product of
    floor(1024 x); ties go to the smaller vec_id (a null id last), then in the
    order of the table. A candidate is every other row, also one with the same
    vec_id. Vectors that are null, or hold a null or non-finite component, take
    no part; vectors of different lengths do not meet. With fewer than k others
    all are returned. A score that 64 bits do not hold ranks by its exact value
    and is returned as null. An empty table gives no rows; other columns are
    ignored.

    Runs jobs while it is built: vectors and bounds are stored.
    """
    spark = vectors.sparkSession
    ship(spark)
    plain = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    stored = materialise(plain.mapInArrow(_convert, VECTOR))
    facts = stored.agg(
        F.count(F.lit(1)).alias("n"), F.max("limbs").alias("limbs"), F.max("dim").alias("dim")
    ).first()
    width = max(8, 4 * (facts["limbs"] or 0) + ((facts["dim"] or 0) * LISTS).bit_length() // 8 + 2)
    asking = stored.filter(query).withColumnRenamed("row", "query_row")
    # Blocks are dealt to so many groups, each of which gets a copy of the queries.
    salts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), facts["n"] // (CANDIDATE_ROWS // 4)))
    blocks = stored.mapInArrow(lambda batches: _blocks(batches, CANDIDATE_ROWS, CANDIDATE_BYTES, False), BLOCK)
    blocks = blocks.withColumn("salt", F.pmod(F.xxhash64("rows"), F.lit(salts)).cast("int"))

    def meetings(queries: DataFrame) -> DataFrame:
        marked = "bound" in queries.columns
        kind = BLOCK + ", bound array<binary>, lows array<array<binary>>" * marked
        packed = queries.withColumnRenamed("query_row", "row").mapInArrow(
            lambda batches: _blocks(batches, QUERY_ROWS, QUERY_BYTES, marked), kind
        )
        renamed = {name: f"query_{name}" for name in packed.columns if name != "dim"}
        copies = packed.withColumnsRenamed(renamed).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return copies.hint("merge").join(blocks, ["dim", "salt"])

    # Phase 1.
    reported = materialise(meetings(asking).mapInArrow(lambda batches: _best(batches, k, width), REPORT))
    lows = reported.filter("row is null").groupBy("query_row", "list").agg(F.min("key").alias("low"))
    lows = lows.groupBy("query_row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("list", "low"))), lambda x: x["low"]).alias("lows")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("key"), "row")
    ranked = reported.filter("row is not null").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    bound = ranked.filter(F.col("rank") == k).select("query_row", F.col("key").alias("bound"))
    bounds = materialise(lows.join(bound, "query_row", "left"))

    # Phase 2.
    left = meetings(asking.join(bounds, "query_row")).mapInArrow(lambda batches: _reaching(batches, width), REPORT)

    # Phase 3.
    scored = left.join(stored.select("row", "vec_id"), "row")
    order = Window.partitionBy("query_row").orderBy(F.desc("key"), F.asc_nulls_last("vec_id"), "row")
    chosen = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = asking.select("query_row", F.col("vec_id").alias("query_id"))
    result = chosen.join(named, "query_row").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "key")
    return result.mapInArrow(_as_scores, "query_id long, rank int, vec_id long, score long")
