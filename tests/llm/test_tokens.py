"""Chunked encoding, records, packing and merge replay against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallymart.llm import chunk_encode, merge_replay, packing, secret_scan, support, token_records
from tallymart.llm.support import filesystem
from tests.llm.tables import awkward, documents, empty

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = " \n\t.,'abstreZ19½²漢 ́_\x1c\x1f!\u00a0\u2003ſK"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTE_BPE)


@pytest.fixture(scope="module")
def tiktoken_encoding():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merge_replay.read_ranks(RANKS), special_tokens={}
    )


def _lists(encoder, texts):
    ids, bounds = encoder(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=ODD, max_size=60), max_size=8))
def test_chunks_give_the_ids_of_whole_texts(texts):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    found = _lists(chunk_encode.encoder_for(BYTE_BPE), texts)
    assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_memory_starting_anew_changes_nothing(tokenizer):
    encode, controls = chunk_encode.tokenizers_encoder(BYTE_BPE)
    encoder = chunk_encode.ChunkEncoder(encode, 3, 3, controls)
    texts = ["one two, three", "four five\nsix", "one two, three", "<|endoftext|> x"]
    for _ in range(2):
        assert _lists(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_strings_of_special_tokens_are_taken_as_the_plain_call_takes_them(tokenizer):
    texts = ["a <|endoftext|> b", "", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "plain", "<|endoftext", "y<|endoftext|>"]
    found = _lists(chunk_encode.encoder_for(BYTE_BPE), texts)
    assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert len(found[2]) == 1 and len(found[5]) > 1


def test_merge_replay_gives_the_ids_of_tiktoken(tiktoken_encoding):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 50))) for _ in range(400)]
    texts += ["a" * 1000, "=" * 501, "ab" * 300, " " * 99, "".join(rng.choices("aeinrst", k=2000)), "😀漢字" * 50, ""]
    replay = merge_replay.MergeReplay(merge_replay.read_ranks(RANKS))
    encoder = chunk_encode.ChunkEncoder(merge_replay.chunk_encoder(replay, public_tokenizers.PATTERN))
    found = _lists(encoder, texts)
    assert found == [tiktoken_encoding.encode_ordinary(text) for text in texts]
    assert [replay.decode(np.array(ids, np.int32)) for ids in found] == [text.encode() for text in texts]


def test_ranks_need_every_byte():
    with pytest.raises(ValueError, match="without a rank"):
        merge_replay.MergeReplay({b"a": 0})


def test_merge_replay_of_awkward_documents(spark, tiktoken_encoding):
    encoded = merge_replay.encode_documents(awkward(spark), RANKS, public_tokenizers.PATTERN)
    rows = merge_replay.decoded_digests(encoded, RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for doc in awkward(spark).collect():
        ids = tiktoken_encoding.encode_ordinary(doc.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc.doc_id, len(ids), digest, hashlib.sha256((doc.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert merge_replay.encode_documents(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def _expected_records(docs, tokenizer, end_id):
    rows, start = [], 0
    for doc in docs:
        ids = np.array([*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, end_id], "<u4")
        rows.append((doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def test_records_read_back_in_order(spark, tokenizer, tmp_path):
    docs = awkward(spark)
    got = token_records.token_records(docs, BYTE_BPE, 2, f"file://{tmp_path}").collect()
    ordered = sorted(docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0))
    # Equal rows may stand in any order, so their starts are the same.
    assert sorted(map(tuple, got), key=lambda r: r[1]) == _expected_records(ordered, tokenizer, 2)
    assert token_records.token_records(empty(spark), BYTE_BPE, 2).count() == 0


def test_records_roll_over_and_are_found_by_index(spark, tmp_path):
    docs = documents(spark, [f"text number {i}" for i in range(50)])
    manifest = token_records.write_token_records(docs, f"file://{tmp_path}", BYTE_BPE, 2, part_bytes=100)
    files = [row.path for row in manifest.orderBy("shard", "part").collect()]
    assert len(files) > 10
    store, _ = filesystem(f"file://{tmp_path}")
    every = [doc_id for path in files for doc_id, _ in token_records.read_records(store, path)]
    assert every == list(range(50))
    assert token_records.read_record(store, files[0], 0)[0] == 0


def test_a_changed_byte_is_noticed():
    data = bytearray(token_records.frame(token_records.serialize(None, np.arange(5), 2)))
    assert token_records.deserialize(token_records.unframe(bytes(data))[0])[0] is None
    for at in (0, 9, 13, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(token_records.CorruptRecord):
            token_records.unframe(bytes(broken))
    with pytest.raises(token_records.CorruptRecord):
        token_records.unframe(bytes(data[:-1]))


def test_fullest_combination_is_the_best_there_is():
    rng = random.Random(5)
    for _ in range(200):
        room = rng.randint(0, 30)
        available = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        reach = {0}
        for length, copies in available.items():
            for _ in range(copies):
                reach |= {x + length for x in reach if x + length <= room}
        chosen = packing.fullest(available, room)
        assert sum(x * n for x, n in chosen.items()) == max(reach)
        assert all(n <= available[x] for x, n in chosen.items())


def _best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6, 12))
def test_plan_uses_every_piece_once_and_beats_best_fit(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(40)}
    bins: dict[int, list[tuple[int, int]]] = {}
    runs = sorted(packing.plan(histogram, 64))
    for length, count in histogram.items():
        own = [run for run in runs if run[0] == length]
        for number in range(count):
            _, first, copies, start, offset = max(run for run in own if run[1] <= number)
            bins.setdefault(start + (number - first) // copies, []).append(
                (offset + (number - first) % copies * length, length)
            )
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    # Many of these lengths have no partner, so the sum alone is no fair bound.
    assert len(bins) <= _best_fit_decreasing([x for x, n in histogram.items() for _ in range(n)], 64)


def test_packing_awkward_documents(spark, tokenizer):
    docs = awkward(spark)
    packed = packing.pack(docs, BYTE_BPE, 0, 64, keep_ids=True)
    rows = packed.collect()
    lengths: dict = {}
    for row in rows:
        lengths.setdefault(row.doc_id, []).append(row.length)
        assert row.ids_crc32 == zlib.crc32(row.ids)
        assert len(row.ids) == 4 * row.length
    long = len(tokenizer.encode("word " * 3000, add_special_tokens=False).ids) + 1
    assert sorted(lengths[7]) == sorted([long % 64] * bool(long % 64) + [64] * (long // 64))
    assert lengths[0] == [1] and lengths[9] == [3, 3] and len(lengths[None]) == 1
    for row in packing.sequences(packed).collect():
        assert len(row.ids) <= 4 * 64
    assert packing.pack(empty(spark), BYTE_BPE).count() == 0


def _batch(texts):
    return pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})


def test_workers_pack_and_redact_some_megabytes_at_a_time(monkeypatch):
    task = SimpleNamespace(partitionId=lambda: 7)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: task))
    sizes = []
    texts = ["a b " * 300_000, None, "c", "d " * 1_500_000, "", "e " * 1_000_000, "password=hunter22"]

    def encode(column):
        sizes.append(sum(len(text or "") for text in column.to_pylist()))
        lengths = [len(text or "") // 1000 for text in column.to_pylist()]
        return np.arange(sum(lengths), dtype=np.int32), np.cumsum([0, *lengths])

    for keep_ids in (False, True):
        found = list(packing._pieces(iter([_batch(texts), _batch([])]), encode, 0, 1000, keep_ids))
        rows = [row for batch in found for row in batch.to_pylist()]
        assert [row["doc_id"] for row in rows if row["piece"] == 0] == list(range(len(texts)))
        assert sum(row["length"] for row in rows) == sum(len(text or "") // 1000 + 1 for text in texts)
        assert len({(row["length"], row["number"]) for row in rows}) == len(rows) and {row["part"] for row in rows} == {7}
        assert all(("ids" in row) == keep_ids for row in rows)
    assert max(sizes) <= support.SLICE_BYTES + max(len(text or "") for text in texts) and len(sizes) == 6

    redacted = list(secret_scan._redact_batches(iter([_batch(texts), _batch([])])))
    assert [text for batch in redacted for text in batch["text"].to_pylist()] == [*texts[:-1], "[assign]"]
    assert len(redacted) > 2 and max(batch.nbytes for batch in redacted) < sum(batch.nbytes for batch in redacted)


def test_tokenizer_gets_a_bounded_number_of_chunks_at_a_time(tokenizer, monkeypatch):
    monkeypatch.setattr(chunk_encode, "CHUNKS_AT_ONCE", 7)
    encode, controls = chunk_encode.tokenizers_encoder(BYTE_BPE)
    asked = []
    encoder = chunk_encode.ChunkEncoder(lambda texts: asked.append(len(texts)) or encode(texts), controls=controls)
    texts = [f"word{i} and{i * i}, more" for i in range(40)] + ["<|endoftext|> x"] * 9
    assert _lists(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(asked) == 7 and sum(asked) > 40


def test_a_worker_keeps_only_what_its_last_task_needed():
    support.kept("model", lambda: "of languages")
    first = chunk_encode.encoder_for(BYTE_BPE)
    assert list(support._kept.values()) == [first] and chunk_encode.encoder_for(BYTE_BPE) is first
    assert list(support.frugal(lambda batches: batches, keeps=True)(iter([_batch(["x"])])))
    assert list(support._kept.values()) == [first]
    assert list(support.frugal(lambda batches: batches)(iter([_batch(["x"])])))
    assert not support._kept


PATTERN_OF_CHUNKS = re.compile(r"[^\S\x1c-\x1f]*[^\W_]+|[^\S\x1c-\x1f]*(?:[^\w\s]|[_\x1c-\x1f])+[^\W_]*|[^\S\x1c-\x1f]+")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(ODD + "😀𝔸𝟙🄰é\u0301\u1680\u2028\u3000\x85"), st.characters(codec="utf-8")), max_size=40))
def test_chunks_begin_where_the_pattern_says(text):
    data = text.encode()
    chunks = PATTERN_OF_CHUNKS.findall(text)
    assert "".join(chunks) == text
    begins = np.cumsum([0, *(len(chunk.encode()) for chunk in chunks)])[1:-1]
    assert np.flatnonzero(chunk_encode._starts(np.frombuffer(data, np.uint8))).tolist() == begins.tolist()


def _counting(monkeypatch):
    """The texts that the tokenizers library is asked for from now on."""
    asked, load = [], tokenizers.Tokenizer.from_file

    class Counting:
        def __init__(self, path):
            self._own = load(path)

        from_file = classmethod(lambda cls, path: cls(path))

        def get_added_tokens_decoder(self):
            return self._own.get_added_tokens_decoder()

        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return self._own.encode_batch_fast(texts, **options)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counting)
    return asked


def test_tokenizer_gets_many_new_chunks_in_one_text(tokenizer, monkeypatch):
    asked = _counting(monkeypatch)
    encode, controls = chunk_encode.tokenizers_encoder(BYTE_BPE)
    encoder = chunk_encode.ChunkEncoder(encode, controls=controls)
    texts = ["".join(f" w{i}x{j}\n" for j in range(40)) for i in range(50)] + ["", " ", "<|endoftext|", "a<|endoftext|>b", "|>c"]
    assert _lists(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) < 60


def test_texts_with_special_tokens_are_not_joined(tokenizer):
    encode, _ = chunk_encode.tokenizers_encoder(BYTE_BPE)
    texts = ["x", "<|endoftext|>", "", "a<|endoftext|><|endoftext|>", *map(str, range(250)), "<|endoftext|>"]
    assert encode(texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert encode([]) == [] and encode([""]) == [[]] and encode(["", ""]) == [[], []]


def test_only_a_token_without_regard_to_its_neighbours_stands_between_chunks():
    def added(text, **options):
        return tokenizers.AddedToken(text, **{"normalized": False, **options})

    assert chunk_encode._mark({7: added("<|end|>")}) == ("<|end|>", 7)
    for options in ({"lstrip": True}, {"rstrip": True}, {"single_word": True}, {"normalized": True}):
        assert chunk_encode._mark({7: added("<|end|>", **options)}) is None
    assert chunk_encode._mark({}) is None and chunk_encode._mark({7: added("aba")}) is None
    assert chunk_encode._mark({7: added("<s>"), 8: added("</s>")}) is None


def test_chunks_that_came_again_are_kept_when_a_memory_is_full():
    asked = []
    encoder = chunk_encode.ChunkEncoder(lambda texts: asked.extend(texts) or [[len(t)] for t in texts], 6, 2)
    for texts in (["a b c"], ["a b"], ["d e f g"], ["a b h"], ["a c"]):
        assert _lists(encoder, texts) == [[len(t) for t in PATTERN_OF_CHUNKS.findall(texts[0])]]
    assert asked == ["a", " b", " c", "d", " e", " f", " g", " h", " c"]
