"""Hard negatives against plain products of Python's whole numbers."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.llm import hard_negatives as hn

VECTORS = "vec_id long, embedding array<double>, label long, row long, key string, dim int"


def _side(matrix):
    bits = max((abs(x).bit_length() for row in matrix for x in row), default=0)
    limbs = hn.limbs_of(bits)
    data = b"".join(x.to_bytes(2 * limbs, "little", signed=True) for row in matrix for x in row)
    return hn.Side(data, len(matrix), len(matrix[0]), limbs, bits)


@pytest.mark.parametrize(("bits", "dim"), [(0, 4), (1, 0), (7, 64), (15, 700), (31, 5), (63, 9), (64, 3), (300, 2), (1034, 3)])
def test_products_are_exact(bits, dim):
    rng = random.Random(bits)

    def matrix(rows):
        ends = [-(2**bits - 1), 2**bits - 1]
        return [[rng.choice([*ends, rng.randint(*ends)]) for _ in range(dim)] for _ in range(rows)]

    a, b = matrix(4), matrix(6)
    expected = [[sum(x * y for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    assert hn.scores(_side(a), _side(b)).tolist() == expected


def test_residue_sums_stay_within_float32():
    assert all(hn.exact_terms(p) * (p // 2) ** 2 < 2**24 for p in hn.primes())
    assert all(hn.exact_terms(p) >= 256 for p in hn.primes() if p < hn.SMALL)
    for bits in (0, 20, 600, 2100):
        product = math.prod(hn.moduli(bits))
        assert product > 2 << bits
        assert product // hn.moduli(bits)[-1] <= 2 << bits


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), max_size=6))
def test_whole_numbers(values):
    found = hn.whole(np.array(values, np.float64), 256)
    assert [int(x) for x in found] == [math.floor(Fraction(x) * 256) for x in values]


@given(st.lists(st.integers(-3, 3), max_size=30), st.integers(1, 6))
def test_first_places(values, most):
    expected = sorted(range(len(values)), key=lambda i: (-values[i], i))[:most]
    for kind in (np.int64, object):
        assert hn.first(np.array(values, kind), most).tolist() == expected


def _expected(rows, anchor, scale=256, k=5, m=5, percent=80):
    """``rows``: (vec_id, vector, label) in table order."""
    kept = []
    for place, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append(((vec_id is None, vec_id or 0, place), vec_id, [math.floor(Fraction(x) * scale) for x in vector], label))
    out = []
    for order, vec_id, vector, label in kept:
        if vec_id is None or not anchor(vec_id):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, v, strict=True)), o, i, own)
            for o, i, v, own in kept
            if o != order and len(v) == len(vector)
        )
        for p_score, _, p_id, _ in [x for x in scored if x[3] == label][:k]:
            top = -p_score
            window = [x for x in scored if x[3] != label and percent * top <= -100 * x[0] <= 100 * top][:m]
            for rank, (score, _, n_id, _) in enumerate(window, 1):
                out.append((vec_id, p_id, rank, n_id, top, -score))
    return sorted(out, key=repr)


def _mined(spark, rows, **more):
    table = spark.createDataFrame([(i, v, label, 1, "k", 2) for i, v, label in rows], VECTORS).coalesce(1)
    found = hn.mine(table, F.col("vec_id") % 10 == 0, **more)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[x] for x in names) for r in found.collect()), key=repr)


def _vectors(rng, n, dim=6):
    return [(i, [rng.choice([-0.5, 0.25, 0.5, rng.random()]) for _ in range(dim)], rng.randrange(3)) for i in range(n)]


def test_against_all_pairs(spark, monkeypatch):
    rng = random.Random(2)
    rows = _vectors(rng, 150)
    assert _mined(spark, rows) == _expected(rows, lambda i: i % 10 == 0)
    assert _mined(spark, rows, positives=2, negatives=9, percent=50, scale=7) == _expected(
        rows, lambda i: i % 10 == 0, 7, 2, 9, 50
    )
    for block in (hn.ANCHOR_ROWS, hn.CANDIDATE_ROWS):
        assert block > 7  # small blocks meet the same pairs
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(hn, "CANDIDATE_ROWS", 7)
    assert _mined(spark, rows) == _expected(rows, lambda i: i % 10 == 0)


def test_awkward_vectors(spark):
    rng = random.Random(3)
    rows = _vectors(rng, 40, 4)
    rows += [(50, None, 1), (60, [0.1, None, 0.2, 0.3], 1), (70, [0.1, float("nan"), 0.0, 0.0], 1)]
    rows += [(80, [float("inf"), 0.0, 0.0, 0.0], 0), (90, [0.5] * 4, None), (None, [0.5] * 4, 1), (100, [], 0), (110, [], 0)]
    rows += [(120, [0.5] * 3, 2), (0, [0.5] * 4, 1), (0, [0.5] * 4, 1), (3, [0.5] * 4, 2), (None, [0.5] * 4, 2)]
    assert _mined(spark, rows) == _expected(rows, lambda i: i % 10 == 0)


def test_large_components_rank_exactly(spark):
    rng = random.Random(4)
    rows = _vectors(rng, 40, 3)
    rows += [(200 + 10 * i, [1e9 * (i + 1), 3.0, -1e8], i % 2) for i in range(6)]
    rows += [(300 + 10 * i, [1.7e308, float(i), 1e-300], i % 2) for i in range(4)]
    expected = [
        (*row[:4], *(x if -(2**63) <= x < 2**63 else None for x in row[4:])) for row in _expected(rows, lambda i: i % 10 == 0)
    ]
    found = _mined(spark, rows)
    assert found == sorted(expected, key=repr)
    assert any(row[4] is None for row in found)


def test_labels_alone_and_empty_tables(spark):
    one = [(i, [0.5, 0.5], 1) for i in range(0, 40, 10)]
    assert _mined(spark, one) == []
    assert _mined(spark, []) == []
    different = [(i, [0.5, 0.5], i) for i in range(5)]
    assert _mined(spark, different) == []
