"""Secrets, languages, fingerprints, shingle links against brute force."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import random
import tarfile
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallymart.llm import fingerprints, language_id, secret_scan, shingle_join
from tallymart.llm.components import connected
from tests.llm.tables import DOCS, awkward, documents, empty, words

SECRET = "password = hunter22abc"


def _encoded(text: str, kind: str) -> str:
    if kind == "url":
        return urllib.parse.quote(text, safe="")
    if kind == "unicode":
        return "".join(f"\\u{ord(char):04x}" for char in text)
    if kind == "gzip":
        return base64.b64encode(gzip.compress(text.encode(), mtime=0)).decode()
    return base64.b64encode(text.encode()).decode()


@pytest.mark.parametrize("layers", [["url"], ["unicode"], ["base64"], ["gzip"], ["base64", "url"], ["url", "gzip"],
                                    ["unicode", "base64", "url"], ["base64", "base64", "base64"]])
def test_wrapped_secrets_map_to_their_place(layers):
    inner = SECRET
    for kind in layers:
        inner = _encoded(inner, kind)
    text = f"before {inner} after"
    found = secret_scan.scan(text)
    assert found.wrapped
    # The span holds the key and its value; behind base64 it is the whole segment.
    span = found.wrapped[0]
    assert text.index(inner) <= span.start < span.end <= text.index(inner) + len(inner)
    clean = secret_scan.redact(text, found.all())
    assert clean.startswith("before [assign]") and clean.endswith(" after")
    assert not secret_scan.scan(clean).all()


def test_plain_rules():
    # A match that is too short is dropped, and what it consumed is not searched again.
    text = "token=abc password = token: abcdef1 api-key SECRET: abcdef1 AKIA123 AKIA" + "A" * 16
    text += " " + "0a" * 12 + " " + "0a" * 11 + "g"
    found = secret_scan.plain_spans(text)
    assert [(kind, text[a:b]) for a, kind, b in found] == [
        (0, "SECRET: abcdef1"), (1, "AKIA" + "A" * 16), (2, "0a" * 12)
    ]


def test_compressed_data_is_scanned_to_its_end(monkeypatch):
    monkeypatch.setattr(secret_scan, "PIECE_BYTES", 1 << 16)
    long = b"a, b\n" * 4_000_000 + SECRET.encode()
    members = gzip.compress(b"first passw") + gzip.compress(b"ord = hunter22abc") + b"\0" * 9 + gzip.compress(b"x token: abcdef1")
    nested = gzip.compress(gzip.compress(random.Random(3).randbytes(300_000).hex().encode() + b"\n, " + SECRET.encode()))
    for data, kinds in ((gzip.compress(long), {0}), (members, {0}), (nested, {0, 2})):
        found = secret_scan.scan(f"before {base64.b64encode(data).decode()} after")
        assert {span.kind for span in found.wrapped} == kinds and not found.cut_short
    damaged = secret_scan.scan(base64.b64encode(gzip.compress(SECRET.encode())[:-6]).decode())
    assert damaged.wrapped and damaged.cut_short


def test_pieces_are_the_whole_and_end_at_breaks():
    rng = random.Random(6)
    for _ in range(200):
        data = b"".join(rng.choice([b"password = abcdef1", b"\n", b", ", b"AKIA" + b"Q" * 30, b"0a" * 40, b".\r\n"]) for _ in range(60))
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(secret_scan, "PIECE_BYTES", 50)
            pieces = list(secret_scan._pieces([data[i : i + 7] for i in range(0, len(data), 7)]))
        assert b"".join(pieces) == data
        found = [(kind, end - start) for piece in pieces for start, kind, end in secret_scan.plain_spans(piece.decode())]
        assert found == [(kind, end - start) for start, kind, end in secret_scan.plain_spans(data.decode())]


def _escapes(data: bytes, form: str) -> str:
    return "".join(form % byte for byte in data)


@pytest.mark.parametrize("inner", [
    base64.b64encode(b"HOME=/root\0" + SECRET.encode() + b"\0A=1").decode(),
    base64.b64encode("caf\u00e9 ".encode("latin-1") + SECRET.encode()).decode(),
    base64.b64encode(gzip.compress(b"name\0\xff\xfe" + SECRET.encode())).decode(),
    _escapes(b"\xe9" + SECRET.encode(), "%%%02X"),
    *(_escapes(gzip.compress(SECRET.encode()), form) for form in ("%%%02x", "\\x%02x", "\\u00%02X", "\\U000000%02x")),
    *(_escapes(zlib.compress(SECRET.encode()), form) for form in ("%%%02X", "\\x%02x")),
    urllib.parse.quote(gzip.compress(SECRET.encode()), safe=""),
    urllib.parse.quote("a " + urllib.parse.quote(zlib.compress(SECRET.encode()), safe=""), safe=""),
])
def test_odd_bytes_hide_nothing(inner):
    text = f"before {inner} after"
    found = secret_scan.scan(text)
    assert {span.kind for span in found.wrapped} == {0} and not found.cut_short
    clean = secret_scan.redact(text, found.all())
    assert clean.startswith("before ") and clean.endswith(" after") and not secret_scan.scan(clean).all()


def _wrapped_lines(data: bytes, end: str = "\n", width: int = 76) -> str:
    digits = base64.b64encode(data).decode()
    return end.join(digits[i : i + width] for i in range(0, len(digits), width))


LONG = b", ".join(b"%d" % (i * i) for i in range(700)) + b" " + SECRET.encode()


@pytest.mark.parametrize("inner", [
    *(_wrapped_lines(data, end) for end in ("\n", "\r\n", "\n    ", "\\n") for data in (LONG, gzip.compress(LONG))),
    _wrapped_lines(b"x" * 50 + SECRET.encode(), width=64),
    "-----BEGIN DATA-----\n" + _wrapped_lines(zlib.compress(LONG)) + "\n-----END DATA-----",
    *(prefix + base64.b64encode(data).decode() for prefix in ("https://h.example/v1/", "a", "ab", "abc", "name-", "x_y/")
      for data in (SECRET.encode(), gzip.compress(LONG), zlib.compress(LONG))),
    base64.urlsafe_b64encode(bytes(range(256)) + SECRET.encode()).decode(),
])
def test_base64_over_lines_and_behind_names(inner):
    text = f"before, {inner} , after"
    found = secret_scan.scan(text)
    assert {span.kind for span in found.wrapped} == {0} and not found.cut_short
    clean = secret_scan.redact(text, found.all())
    assert clean.startswith("before, ") and clean.endswith(" , after") and not secret_scan.scan(clean).all()


def test_parts_of_a_path_are_segments_of_their_own():
    text = "https://h.example/v1/" + base64.b64encode(SECRET.encode()).decode()
    assert (21, len(text)) in {(span.start, span.end) for span in secret_scan.scan(text).wrapped}


def test_scan_table(spark):
    docs = awkward(spark).union(documents(spark, [f"a {SECRET} b", f"{SECRET} {SECRET}"], 100))
    rows = {row.doc_id: row for row in secret_scan.scan_documents(docs).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert rows[0].base_sha256 == rows[1].base_sha256 == rows[7].base_sha256 == nothing
    assert (rows[100].n_assign, rows[100].spans) == (1, "assign:2:24") and rows[101].n_assign == 2
    assert rows[100].base_sha256 == hashlib.sha256(b"assign:2:24").hexdigest()
    assert secret_scan.scan_documents(empty(spark)).count() == 0
    clean = secret_scan.redact_documents(docs)
    assert clean.schema == docs.schema
    texts = {row.doc_id: row.text for row in clean.collect()}
    assert texts[100] == "a [assign] b" and texts[0] is None and texts[7] == "word " * 3000


def _code_length(text: bytes, counts, order: int) -> float:
    """Code length by following the definition, byte by byte."""
    padded, total = b" " * order + text, 0.0
    for at in range(order, len(padded)):
        for size in range(order, -1, -1):
            seen = counts.get(padded[at - size : at])
            if seen:
                t, d = sum(seen.values()), len(seen)
                if padded[at] in seen:
                    total -= math.log2(seen[padded[at]] / (t + d))
                    break
                total -= math.log2(d / (t + d))
        else:
            total += 8
    return total


def test_code_lengths_follow_the_definition():
    rng = random.Random(1)
    samples = {lang: " ".join(words(rng, 300)).encode() for lang in ("aa", "bb")}
    order = language_id.ORDER
    grams = []
    for number, text in enumerate(samples.values()):
        padded = b" " * order + text
        found = Counter(padded[i : i + order + 1] for i in range(len(text)))
        grams += [(number, int.from_bytes(gram, "big"), count) for gram, count in found.items()]
    columns = [np.array(x, np.int64) for x in zip(*grams, strict=True)]
    scorer = language_id.Scorer(language_id.Model(tuple(samples), *columns))
    tests = ["abc abd", "", "xyz!", " ".join(words(rng, 50)), "a"]
    got = scorer.code_lengths(*language_id.binary_values(pa.array(tests)))
    for number, text in enumerate(samples.values()):
        counts: dict[bytes, Counter] = {}
        padded = b" " * order + text
        for at in range(order, len(padded)):
            for size in range(order + 1):
                counts.setdefault(padded[at - size : at], Counter())[padded[at]] += 1
        expected = [_code_length(text.encode(), counts, order) for text in tests]
        assert got[:, number] == pytest.approx(expected, rel=1e-5)


def test_hundreds_of_languages_and_all_their_contexts(spark):
    # Each language writes with three letters of its own; one has more contexts than any fixed table holds.
    words = {f"l{i:03}": "".join(chr(0x4E00 + 3 * i + k) for k in (0, 1, 2, 1, 0, 2, 2)) for i in range(250)}
    draw = np.random.default_rng(1)
    mixed = "".join(chr(c) for c in draw.integers(0x20, 0x7F, 60_000))
    rows = [(word * 5, lang) for lang, word in words.items()] + [(mixed, "mixed")]
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.languages) == 251
    texts = [(i, word[2:] * 3) for i, word in enumerate(words.values())] + [(250, mixed[30_000:30_100])]
    got = language_id.predict(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert {row["doc_id"]: row["lang_pred"] for row in got} == dict(enumerate([*words, "mixed"]))
    scorer = language_id.Scorer(model)
    # The rows grow with what each language knows, not with the contexts of all times the languages.
    assert len(scorer.cost) // scorer.width < 2 * len(scorer.row_of)


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language_id.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([row.lang == row.lang_pred for row in found]) > 0.95
    assert all(0 <= row.score <= 1 for row in found)


def _counts(model, lang):
    return model.count[model.language == model.languages.index(lang)]


def test_sample_has_each_language_and_copies_once(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_BYTES", 3000)
    monkeypatch.setattr(language_id, "SAMPLE_LONGEST", 500)
    rng = random.Random(12)
    rows = [(f"{n} {i % 2} template words", f"t{n:02}") for n in range(12) for i in range(400)]
    rows += [("hot " * 100, "hot")] * 300 + [(" ".join(words(rng, 20)), "hot") for _ in range(30)]
    rows += [(" ".join(words(rng, 9000)), "long")] * 2 + [(None, "none"), ("", "none"), ("text", None)]
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert model.languages == tuple(sorted([f"t{n:02}" for n in range(12)] + ["hot", "long"]))
    for n in range(12):
        assert _counts(model, f"t{n:02}").sum() == sum(len(f"{n} {i} template words") for i in range(2))
    assert _counts(model, "hot").sum() == sum(len(text) for text, lang in set(rows) if lang == "hot")
    assert 2000 <= _counts(model, "long").sum() <= 3000


def test_hash_ranges_follow_the_hash():
    values = sorted([*range(2000), *(random.Random(1).getrandbits(63) >> i for i in range(60))])
    ranges = [language_id._hash_range(value) for value in values]
    assert ranges == sorted(ranges)
    assert language_id._last_ranges([(0, 7, 5_000_000), (0, 9, 1), (1, 3, 1), (1, 5, 2_999_999), (1, 6, 1)]) == {0: 7, 1: 5}


def test_languages_of_awkward_documents(spark):
    rows = {row.doc_id: row for row in language_id.identify(awkward(spark)).collect()}
    assert rows[0].lang_pred == rows[1].lang_pred == rows[3].lang_pred == "und" and rows[0].score == 0
    assert rows[4].lang_pred == "en"
    unlabelled = awkward(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {row.lang_pred for row in language_id.identify(unlabelled).collect()} == {"und"}
    assert language_id.identify(empty(spark)).count() == 0


def test_fingerprints_agree_inside_equal_substrings():
    rng = random.Random(2)
    middle = " ".join(words(rng, 400))
    texts = [f"{' '.join(words(rng, n))} {middle} {' '.join(words(rng, n))}" for n in (0, 3, 17, 40)]
    prints = fingerprints._of(texts)
    other = fingerprints._of([" ".join(words(rng, 400))])[0]
    for one in prints[1:]:
        assert fingerprints.likeness(prints[0], one) > 0.6
        assert fingerprints.likeness(one, other) < 0.2


def test_fingerprint_does_not_depend_on_the_batch():
    rng = random.Random(4)
    texts = [" ".join(words(rng, rng.randint(0, 60))) for _ in range(50)] + ["", "a", "aaaaaa", "ab" * 500]
    together = [fingerprints.written(x) for x in fingerprints._of(texts)]
    assert together == [fingerprints.written(fingerprints._of([text])[0]) for text in texts]


def test_fingerprints_of_awkward_documents(spark):
    docs = awkward(spark)
    rows = fingerprints.fingerprint_documents(docs).collect()
    assert len(rows) == docs.count()
    ordered = sorted(docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0))
    texts = [doc.text or "" for doc in ordered]
    expected = Counter(
        (doc.doc_id, len(text), hashlib.sha256(fingerprints.edited(text, after).encode()).hexdigest())
        for doc, text, after in zip(ordered, texts, texts[1:] + texts[:1], strict=True)
    )
    assert Counter((row.doc_id, row.n_chars, row.edited_sha256) for row in rows) == expected
    same = {row.fingerprint for row in rows if row.doc_id in (9, 10)}
    assert len(same) == 1
    assert fingerprints.fingerprint_documents(empty(spark)).count() == 0


def _brute_force(docs):
    """Component of each row by all pairs."""
    sets = []
    for _, text in docs:
        own = (text or "").encode().lower().split()
        sets.append({tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1))} if own else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((doc_id, len(sets[i]), least.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(docs))


def _family(rng, base, copies, changes):
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(len(own))] = "".join(rng.choices("xyz", k=3))
        yield " ".join(own)


def _tricky_texts():
    rng = random.Random(11)
    texts = []
    for size in (5, 6, 7, 8, 10, 12, 14, 16, 20, 30):  # small sets, both sides of the boundary
        base = words(rng, size)
        texts += _family(rng, base, 8, 1)
        texts += [" ".join(base[:cut]) for cut in range(max(1, size - 3), size)]
    texts += _family(rng, words(rng, 60), 70, 4)  # a group beyond a short list
    passage = " ".join(words(rng, 55))  # a passage that many texts share
    texts += [f"{' '.join(words(rng, rng.randint(5, 60)))} {passage}" for _ in range(60)]
    texts += ["Same Words Here", "same words  here", "other", "a b c d", "A b C d", "a b c", ""]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("limits", [{}, {"SHORT_LIST": 2, "RARE": 3, "ROUNDS": 1}])
def test_links_match_all_pairs(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(shingle_join, name, value)
    docs = documents(spark, _tricky_texts())
    got = shingle_join.link_documents(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == _brute_force([(row.doc_id, row.text) for row in docs.collect()])


def test_links_of_awkward_documents(spark):
    docs = awkward(spark)
    got = shingle_join.link_documents(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == _brute_force([(row.doc_id, row.text) for row in docs.collect()])
    assert shingle_join.link_documents(empty(spark)).count() == 0
    kept = shingle_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((row.doc_id for row in kept.collect()), key=repr) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, None]


def test_equal_ids_in_different_components_both_stay(spark):
    rows = [(5, "one two three four five six"), (5, "quite another text of seven words here"), (9, "one two three four five six")]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], DOCS)
    assert sorted(row.text for row in shingle_join.one_of_each(docs).collect()) == sorted(t for _, t in rows[:2])


def test_small_sets_share_a_subset_exactly_when_they_link():
    rng = random.Random(8)
    for _ in range(300):
        a = np.unique(np.array(rng.sample(range(14), rng.randint(1, 9)), np.uint64))
        b = np.unique(np.array(rng.sample(range(14), rng.randint(1, 9)), np.uint64))
        both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        keys = [{key for key, _ in shingle_join.subset_keys(x)} for x in (a, b)]
        assert bool(keys[0] & keys[1]) == (100 * both >= 75 * either)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[100 + i] == 100 for i in range(30))
    assert found[200] == found[199] == 199


def test_code_lengths_do_not_depend_on_windows(monkeypatch):
    rng = random.Random(8)
    sample = [bytes(rng.choices(b"abc \xc3\xa9", k=50)) for _ in range(20)]
    padded = [b" " * language_id.ORDER + text for text in sample]
    counts = {}
    for number, text in enumerate(padded):
        for at in range(language_id.ORDER, len(text)):
            key = number % 2, sum(text[at - i] << 8 * i for i in range(language_id.ORDER + 1))
            counts[key] = counts.get(key, 0) + 1
    columns = zip(*((lang, sequence, n) for (lang, sequence), n in sorted(counts.items())), strict=True)
    scorer = language_id.Scorer(language_id.Model(("x", "y"), *(np.array(c, np.int64) for c in columns)))
    texts = ["", "a", "abc " * 3000, "", "é" * 5000, "b", "c a" * 1700, ""]
    one = scorer.code_lengths(*language_id.binary_values(pa.array(texts)))
    alone = [scorer.code_lengths(*language_id.binary_values(pa.array([text])))[0] for text in texts]
    monkeypatch.setattr(language_id, "WINDOW", 1)  # windows of the least size
    assert np.allclose(one, alone)
    assert np.allclose(scorer.code_lengths(*language_id.binary_values(pa.array(texts))), one)


def _tar(data: bytes) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as archive:
        for name in ("a.gz", "b.gz"):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


NOISE = bytes(np.random.default_rng(7).integers(0, 256, 70_000, np.uint8))


@pytest.mark.parametrize(
    "wrap",
    [
        lambda s: gzip.compress(b"a line\n" + gzip.compress(s)),
        lambda s: gzip.compress(_tar(gzip.compress(s))),
        lambda s: gzip.compress(b"log\n" * 3000 + zlib.compress(b"x\n" + s) + b"tail"),
        lambda s: gzip.compress(NOISE + gzip.compress(b"y\n" * 9 + _tar(gzip.compress(NOISE + gzip.compress(s)))) + NOISE),
        lambda s: gzip.compress(b"- " + gzip.compress(s[:9]) + gzip.compress(s[9:])),
        lambda s: zlib.compress(b"- " + gzip.compress(b"not this\n") + b" - " + gzip.compress(s) + b" -"),
        lambda s: gzip.compress(b"- " + gzip.compress(base64.b64encode(gzip.compress(b"- " + gzip.compress(s))))),
        lambda s: s.decode().encode("utf-16-le"),
        lambda s: s.decode().encode("utf-16-be"),
        lambda s: gzip.compress(s.decode().encode("utf-16")),
    ],
)
def test_compressed_data_within_other_data_is_opened(wrap):
    text = f"see {base64.b64encode(wrap(b'password = hunter22abc')).decode()} end"
    found = secret_scan.scan(text)
    kinds = {(span.kind, span.start) for span in found.wrapped}
    assert (0, 4) in kinds and not found.cut_short


@pytest.mark.parametrize(
    "text",
    [
        "q=password+%3D+hunter22abc&x=1",
        "q=1&note=my+password%3A+hunter22abc",
        r"\u{70}assword = hunter22abc",
        "%u0070assword = hunter22abc",
        "%25u0070assword = hunter22abc",
    ],
)
def test_form_data_and_code_units(text):
    found = secret_scan.scan(text)
    assert [text[s.start : s.end].endswith("hunter22abc") for s in found.wrapped if s.kind == 0].count(True) >= 1


def test_plus_signs_of_plain_text_stay():
    assert not secret_scan.scan("password+=+hunter22abc, 50%+2").all()


def test_data_that_holds_itself_ends_and_damage_within_is_told():
    inner = gzip.compress(b"password = hunter22abc" + NOISE)
    found = secret_scan.scan(base64.b64encode(gzip.compress(b"- " + inner[:-20000])).decode())
    assert found.cut_short and any(span.kind == 0 for span in found.wrapped)
    deep = b"password = hunter22abc"
    for _ in range(300):
        deep = gzip.compress(b"- " + deep, 1)
    assert any(span.kind == 0 for span in secret_scan.scan(base64.b64encode(deep).decode()).wrapped)


def test_streams_within_do_not_depend_on_chunks():
    data = b"- " + gzip.compress(NOISE + zlib.compress(b"one\n") + gzip.compress(b"two\n")) + b" - " + gzip.compress(b"three\n")
    want = sorted(secret_scan._all_pieces([data], secret_scan.Opening()))
    for size in (1, 7, 600):
        if size == 1:
            chunks = [data[i : i + 1] for i in range(3000)] + [data[3000:]]
        else:
            chunks = [data[i : i + size] for i in range(0, len(data), size)]
        opening = secret_scan.Opening()
        assert sorted(secret_scan._all_pieces(chunks, opening)) == want and not opening.damaged
