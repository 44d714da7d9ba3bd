"""Repeated windows against a plain dictionary of all windows."""

from __future__ import annotations

import random
import re

import pytest

from tallymart.llm import substring_dedup as sd
from tests.llm.tables import DOCS, awkward, documents, empty


def _expected(rows):
    """What stays of each row (doc_id, text), given in document order."""
    seen, out = set(), []
    for doc_id, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        out.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def _found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=repr)


def _passages(rng, n, sizes=(5, 60)):
    return [" ".join(rng.choices("abcdefghij", k=rng.randint(*sizes))) for _ in range(n)]


@pytest.mark.parametrize("many", [1, 3, 4096])
def test_shared_passages(spark, many):
    rng = random.Random(many)
    pool = _passages(rng, 30)
    texts = [" \n".join(rng.choices(pool, k=rng.randint(0, 6))) for _ in range(120)]
    docs = documents(spark, texts).repartition(5)
    assert _found(sd.remove_repeats(docs, many)) == sorted(_expected(enumerate(texts)), key=repr)


def test_factors_end_and_go_on_in_other_references(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [
        " ".join(words[:100]),
        " ".join(words[60:160]),
        " ".join(words[:160]),  # every window stands in one of the two before
        " ".join(words[90:109] + words[10:29]),  # 19 words of each: nothing repeats
        " ".join(words[95:130] + ["new"] + words[95:115]),
    ]
    rows = sd.remove_repeats(documents(spark, texts).repartition(3)).collect()
    assert sorted(map(repr, _found(sd.remove_repeats(documents(spark, texts))))) == sorted(map(repr, _expected(enumerate(texts))))
    spans = {r["doc_id"]: list(zip(r["starts"], r["ends"], strict=True)) for r in rows}
    assert spans == {0: [], 1: [(0, 40)], 2: [(0, 160)], 3: [], 4: [(0, 35), (36, 56)]}


def test_one_word_repeated_and_hot_passages(spark):
    hot = " ".join(f"h{i}" for i in range(25))
    common = " ".join(f"c{i}" for i in range(12))
    texts = ["x " * 500, "x " * 19, "x " * 20]
    texts += [f"{hot} own{i} {common} {' '.join(f'{i}u{j}' for j in range(30))}" for i in range(200)]
    docs = documents(spark, texts).repartition(7)
    assert _found(sd.remove_repeats(docs, many=16)) == sorted(_expected(enumerate(texts)), key=repr)


def test_long_texts_in_pieces(spark, monkeypatch):
    rng = random.Random(4)
    pool = _passages(rng, 12, (25, 90))
    texts = [" \t ".join(rng.choices(pool, k=40)) for _ in range(3)]
    for name, value in (("PIECE_BYTES", 64), ("RUN_WORDS", 150)):
        monkeypatch.setattr(sd, name, value)
    rows = sd._runs(iter([_batch(texts)]))
    covered = {(u.row, u.first + i) for _, run in rows for u in run for i in range(max(0, len(u.words) - 19))}
    assert covered == {(row, i) for row, text in enumerate(texts) for i in range(len(text.split()) - 19)}
    pieces = list(sd.pieces(b"aa bb  cc d", 2))
    assert b"".join(pieces) == b"aa bb  cc d"
    assert [w for p in pieces for w in p.split()] == [b"aa", b"bb", b"cc", b"d"]


def _batch(texts):
    import pyarrow as pa

    numbers = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_arrays([numbers, numbers, pa.array(texts, pa.string())], ["row", "doc_id", "text"])


def test_equal_windows_have_equal_anchors_wherever_they_stand():
    rng = random.Random(9)
    shared = [rng.choice("abcd").encode() for _ in range(200)]
    for left in (0, 3, 11):
        units = [sd.Unit(0, 0, 0, shared), sd.Unit(1, 1, 0, [b"z"] * left + shared)]
        found = sd.slices_of(units)
        anchors = [{}, {}]
        for anchor, unit, start, windows in zip(found.anchor, found.unit, found.start, found.windows, strict=True):
            anchors[unit].update({int(start) + i: int(anchor) for i in range(windows)})
        assert sorted(anchors[0]) == list(range(181))
        assert all(anchors[1][at + left] == anchor for at, anchor in anchors[0].items())


def test_repeated_rows_ids_and_missing_ids(spark):
    texts = [" ".join(f"{i}w{j}" for j in range(30)) for i in range(3)]
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (5, texts[1]), (None, texts[2]), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 1, 2, "x") for i, t in rows], DOCS).coalesce(1)
    found = _found(sd.remove_repeats(docs))
    ordered = sorted(rows, key=lambda row: (row[0] is None, row[0] or 0))
    assert found == sorted(_expected(ordered), key=repr)


def test_awkward_and_empty_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    ordered = sorted(rows, key=lambda row: (row[0] is None, row[0] or 0))
    assert _found(sd.remove_repeats(awkward(spark))) == sorted(_expected(ordered), key=repr)
    assert sd.remove_repeats(empty(spark)).collect() == []
