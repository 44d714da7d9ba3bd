"""Chat formatting, WARC archives and top-k search against brute force; the pipeline."""

from __future__ import annotations

import base64
import hashlib
import json
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tallymart.llm import chat_format, exact_topk, queries, shingle_join, token_records, warc_io
from tests.llm.tables import documents, empty

TRICKY = st.lists(st.sampled_from([*"\\<>/s[]INST ok\n", "</s>", "<s>", "[INST]", "[/INST]", "[ROLE]", "<image>"])).map("".join)


@given(TRICKY)
def test_escaping_is_undone_and_hides_marks(text):
    hidden = chat_format.escape(text)
    assert chat_format.unescape(hidden) == text
    assert not chat_format.CONTROL.search(hidden)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TRICKY), TRICKY)))
def test_formatted_turns_read_back(turns):
    formatted = "".join(chat_format.format_turn(role, [text])[0] for role, text in turns)
    assert list(chat_format.read_turns(formatted)) == turns


def test_typed_parts_become_placeholders():
    parts = [
        "see ", {"type": "image", "source": "a.png", "width": 28, "height": 15}, " <image> ",
        {"type": "audio", "source": "b.wav", "seconds": 1.5}, {"type": "document", "source": "c.pdf", "pages": 2},
    ]
    turn, begin, end, attached = chat_format.format_turn("assistant", parts)
    assert turn[begin:end] == "see <image> <\\image> <audio><document>"
    assert [(x["source"], x["tokens"]) for x in attached] == [("a.png", 4), ("b.wav", 38), ("c.pdf", 1024)]
    marks = [chat_format.PLACEHOLDERS[x["type"]] for x in attached]
    assert all(turn.startswith(mark, x["offset"]) for mark, x in zip(marks, attached, strict=True))
    with pytest.raises(ValueError):
        chat_format.format_turn("user", [{"type": "video"}])


def test_conversations_of_awkward_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "x"), (None, 0, "user", "y"),
            (3, 0, "assistant", ""), (3, 0, "assistant", ""), (4, None, "tool\n", "</s>")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {row.conv_id: row for row in chat_format.conversation_digests(chat_format.format_conversations(table)).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\n").hexdigest()
    assert (got[1].n_turns, got[1].loss_chars, got[3].n_turns, len(got)) == (2, 1, 2, 5)
    assert got[4].turns_sha256 == hashlib.sha256(b"tool\n\n</s>\n").hexdigest()
    typed = table.limit(0).union(spark.createDataFrame(
        [(1, 0, "user", json.dumps([{"type": "image", "source": "s", "width": 1, "height": 1}]), 1)], table.schema))
    row = chat_format.format_conversations(typed, typed=True).first()
    assert row.attachment_tokens == 1 and row.attachments[0].source == "s"
    assert chat_format.format_conversations(table.limit(0)).count() == 0


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string")


def test_archives_read_back(spark, tmp_path):
    long = "x" * 300_000 + "é"
    rows = [(1, "http://a/\r\nX: y", "same", "q"), (5, "u", "same", "q"), (3, None, "same", "q"), (2, "u", None, "q"),
            (4, "u", "", "q"), (6, "u", "\r\n\r\nWARC/1.1\r\n", "q"), (7, "u", "twin", "q"), (7, "u", "twin", "q"),
            (None, "u", "same", "q"), (8, "u", long, "q")]
    got = warc_io.archive_pages(_pages(spark, rows), f"file://{tmp_path}/one").collect()
    largest: dict = {}
    for page, _, html, _ in rows:
        largest[html or ""] = max(largest.get(html or "", -1), page if page is not None else -1)
    seen, expected = set(), Counter()
    for page, _, html, _ in rows:
        data = (html or "").encode()
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = page == largest[html or ""] and (page, html) not in seen
        seen.add((page, html))
        expected[page, len(data), name, "response" if first else "revisit", None if first else largest[html or ""]] += 1
    found = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    assert found == expected
    some = warc_io.archive_pages(_pages(spark, rows), f"file://{tmp_path}/two", min_payload=5)
    assert {row.record_type for row in some.collect()} == {"response"}
    assert warc_io.archive_pages(_pages(spark, []), f"file://{tmp_path}/none").count() == 0


def test_reader_takes_over_filters(spark, tmp_path):
    folder = f"file://{tmp_path}"
    warc_io.write_warc(_pages(spark, [(i, f"u{i % 3}", f"text {i % 4}", None) for i in range(40)]), folder)
    reader = warc_io.WarcReader(folder, warc_io.read_warc(spark, folder, "page_id", "record_type").schema)
    every = sum(len(list(reader.members(span))) for span in reader.partitions())
    left = list(reader.pushFilters([
        warc_io.EqualTo(("record_type",), "response"), warc_io.In(("target_uri",), ("u1",)), warc_io.EqualTo(("offset",), 0),
    ]))
    assert len(left) == 1 and every == 40
    spans = reader.partitions()
    assert sum(len(list(reader.members(span))) for span in spans) == 4
    assert sum(batch.num_rows for span in spans for batch in reader.read(span)) < 4
    frame = warc_io.read_warc(spark, folder).filter("target_uri = 'u1' and record_type = 'response'")
    assert all(row.payload.startswith(b"text") for row in frame.collect())


def test_every_record_is_read_by_one_index_range(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    warc_io.write_warc(_pages(spark, [(i, f"u{i}", f"text {i} " * (i % 7), None) for i in range(60)]).coalesce(2), folder)
    schema = warc_io.read_warc(spark, folder, "page_id", "payload").schema

    def found(spans):
        reader = warc_io.WarcReader(folder, schema)
        return sorted(page for span in spans for batch in reader.read(span) for page in batch["page_id"].to_pylist())

    whole = warc_io.WarcReader(folder, schema).partitions()
    assert len(whole) == len({span.path for span in whole}) and found(whole) == sorted(map(str, range(60)))
    for size, step in ((1, 7), (300, 1 << 16), (1000, 64)):
        monkeypatch.setattr(warc_io, "PARTITION_BYTES", size)
        monkeypatch.setattr(warc_io, "READ_BYTES", step)
        spans = warc_io.WarcReader(folder, schema).partitions()
        assert len(spans) > len(whole)
        assert found(spans) == sorted(map(str, range(60)))


def _brute_top(rows, k):
    kept = []
    for number, (vec_id, vector) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((number, vec_id, [math.floor(1024 * x) for x in vector]))
    found = Counter()
    for number, vec_id, own in kept:
        if vec_id is not None and vec_id % 100 == 0:
            others = [(-sum(a * b for a, b in zip(own, v, strict=True)), i is None, i or 0, i)
                      for other, i, v in kept if other != number and len(v) == len(own)]
            for rank, (score, _, _, i) in enumerate(sorted(others)[:k], 1):
                found[vec_id, rank, i, -score] += 1
    return found


def test_top_k_matches_brute_force(spark):
    rng = random.Random(9)
    vectors = [[rng.gauss(0, 1) for _ in range(7)] for _ in range(240)]
    rows = [(i * 10, v) for i, v in enumerate(vectors)]
    rows += [(5, vectors[0]), (6, vectors[0]), (200, vectors[3]), (7, None), (8, [1.0, None]), (9, [math.nan] * 7),
             (400, [math.inf] * 7), (11, [1.0, 2.0]), (600, [3.0, 1.0]), (12, [0.5]), (700, []), (None, vectors[1]),
             (800, [0.0] * 7), (13, [-5.0] * 7)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = exact_topk.top_k(table, F.col("vec_id") % 100 == 0, 10).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == _brute_top(rows, 10)
    assert exact_topk.top_k(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    expected = con.execute(queries.oracle_sql()["op3_exact_topk"]).fetchall()
    got = queries.queries()["op3_exact_topk"](spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()
    assert Counter(map(tuple, got)) == Counter(expected)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_copies", "secret_scan", "packing"]
    understood = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert understood.columns == docs.columns and understood.count() > 0.98 * docs.count()
    linked = shingle_join.link_documents(understood)
    kept = corpus_pipeline.STAGES[1][1](spark, understood, sf_dir)
    assert Counter(row.doc_id for row in kept.collect()) == Counter(
        row.component_id for row in linked.select("component_id").distinct().collect()
    )
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {row.doc_id for row in packed} == {row.doc_id for row in kept.select("doc_id").collect()}
    assert max(row.offset + row.length for row in packed) <= corpus_pipeline.CAPACITY


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_queries_cover_all_operators():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert np.all([name in queries.queries() for name in queries.oracle_sql()])


def test_top_k_ranks_components_of_any_size(spark):
    rng = random.Random(10)
    sizes = (1.0, 1e5, 1e9, 1e200, 1e304)
    rows = [(i * 10, [rng.uniform(-1, 1) * rng.choice(sizes) for _ in range(4)]) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = exact_topk.top_k(table, F.col("vec_id") % 100 == 0, 5).collect()
    expected = Counter()
    for (query, rank, other, score), n in _brute_top(rows, 5).items():
        expected[query, rank, other, score if -(2**63) <= score < 2**63 else None] += n
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == expected
    assert any(r.score is None for r in got)


def test_near_copies_keep_a_column_that_is_named_like_their_own(spark):
    texts = ["a b c d e f", "a b c d e f", "", None]
    docs = documents(spark, texts).withColumn("shingle_class", F.lit("mine"))
    kept = shingle_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    assert {r.shingle_class for r in kept.collect()} == {"mine"}


def test_records_are_read_by_as_many_tasks_as_there_are_files(spark, tmp_path):
    docs = documents(spark, [f"text {i}" for i in range(400)]).repartition(6)
    manifest = token_records.write_token_records(docs, str(tmp_path), queries.BYTE_BPE, 2, part_bytes=200)
    found = token_records.read_token_records(manifest, str(tmp_path))
    assert found.count() == 400
    assert found.rdd.getNumPartitions() == manifest.count() > 1
