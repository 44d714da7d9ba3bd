"""Spelling variants against every pair of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tallymart.llm import spelling_variants as sv
from tests.llm.tables import awkward, documents, empty


def _near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def _grouped(counts: dict[str, int], times: int = 10) -> set[tuple]:
    form, near_count = {}, {}
    for word, n in counts.items():
        near = [other for other in counts if _near(word, other)]
        near_count[word] = len(near)
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= times * n else None

    def root(word):
        return word if form[word] is None else root(form[word])

    return {(w, form[w], root(w), n, near_count[w], counts.get(form[w])) for w, n in counts.items()}


def _plain_counts(rows, one_in=31, least=2) -> dict[str, int]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= least}


def _rows(df) -> list[tuple]:
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]


@pytest.mark.parametrize("longer", [frozenset(), frozenset({"ab", "ba", "aa", "\x00a"})])
def test_an_edit_leaves_the_list_of_its_place(longer):
    rng = random.Random(1)
    for _ in range(300):
        word = "".join(rng.choices("abc", k=rng.randint(0, 9)))
        lists = {(kind, place): name for name, kind, place in sv.lists_of(word, longer)}
        at = rng.randrange(len(word) + 1)
        longer_word = word[:at] + rng.choice("abcd") + word[at:]
        first = next(i for i in range(at + 1) if longer_word[i : at + 1] == longer_word[at] * (at + 1 - i))
        theirs = {(kind, place): name for name, kind, place in sv.lists_of(longer_word, longer)}
        assert lists[sv.SHORTER, first] == theirs[sv.LONGER, first]
        if at < len(word):
            other = word[:at] + "d" + word[at + 1 :]
            theirs = {(kind, place): name for name, kind, place in sv.lists_of(other, longer)}
            assert lists[sv.REPLACED, at] == theirs[sv.REPLACED, at]


def _edited(rng, word, alphabet):
    at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    if kind == 0:
        return word[:at] + rng.choice(alphabet) + word[at:]
    return word[:at] + (rng.choice(alphabet) if kind == 1 else "") + word[at + 1 :]


@pytest.mark.parametrize("alphabet", ["ab", "abcdéÿ", "abcdefghijklmnopqrstuvwxyz"])
def test_all_near_words_are_found(spark, alphabet):
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choices(alphabet, k=rng.randint(8, 12))) for _ in range(80)}
    for _ in range(3):
        words |= {_edited(rng, word, alphabet) for word in words}
    counts = {word: rng.choice([2, 2, 3, 25, 300, 4000]) for word in words if len(word) >= 7}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = _rows(sv.group_variants(table))
    assert len(found) == len(counts)
    assert set(found) == _grouped(counts)


def test_roots_follow_long_chains(spark):
    words = ["abcdefgh" + "x" * i for i in range(9)]
    counts = {word: 2 * 10**i for i, word in enumerate(words)}
    found = _rows(sv.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert set(found) == _grouped(counts)
    assert {row[2] for row in found} == {words[-1]}


def test_ties_go_to_the_first_in_code_point_order(spark):
    counts = {"aaaaaaab": 2, "aaaaaaac": 20, "aaaaaaaÿ": 20, "zzzzzzzz": 20}
    found = _rows(sv.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert set(found) == _grouped(counts)


def test_documents_against_all_pairs(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choices("abcdeéÀ", k=rng.randint(6, 11))) for _ in range(40)]
    texts = [" ".join(rng.choice("Aé") + rng.choice(stems[: rng.randint(1, 40)]) for _ in range(200)) for _ in range(60)]
    texts += [None, "", "é" * 3000 + " " + "Z" * 9, "short", "1234567 ½×÷ abcdefg×hij"]
    docs = documents(spark, texts, first=-3)
    docs = docs.union(docs.filter("doc_id between 0 and 9"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = _rows(sv.spelling_variants(docs))
    assert len(found) == len(set(found))
    assert set(found) == _grouped(_plain_counts(rows))
    assert any(row[1] for row in found)


def test_long_texts_in_pieces_and_small_memories_count_the_same(spark, monkeypatch):
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abC", k=rng.randint(6, 8))) for _ in range(5000))
    expected = sv.runs(text)
    monkeypatch.setattr(sv, "PIECE", 100)
    assert sv.runs(text) == expected
    assert sum(expected.values()) == 5000


def test_awkward_and_empty_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    assert set(_rows(sv.spelling_variants(awkward(spark)))) == _grouped(_plain_counts(rows))
    assert sv.spelling_variants(empty(spark)).collect() == []
