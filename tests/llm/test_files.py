"""WARC archives and token files: exact round trips."""

import base64
import functools
import gzip
import hashlib
import io
import string
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civicframe.llm import tokens, warc
from civicframe.llm.common import shared_path

PAGES = "page_id long, url string, html string, record_type string"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def loaded(kind, *args):
    return kind(*args)


def expected_records(rows):
    largest = {}
    for page_id, _, html, _ in rows:
        if page_id is not None:
            largest[html or ""] = max(page_id, largest.get(html or "", page_id))
    out = []
    for page_id, _, html, _ in rows:
        data, top = (html or "").encode(), largest.get(html or "")
        kind = "response" if page_id == top else "revisit"
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, None if kind == "response" else top))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    rows = [(1, "http://a/x y\n", "<p>a</p>", "x"), (2, None, "<p>a</p>", "x"), (2, None, "<p>a</p>", "x"), (3, "u", None, "x"), (4, "u", "", None), (5, "u", "é" * 50_000, "x"), (None, "u", "<p>a</p>", "x"), (None, "u", "alone", "x")]
    files = warc.archive(spark.createDataFrame(rows, PAGES).repartition(3), shared_path(spark, "w"))
    for split in (64 << 20, 100, 7):
        back = [tuple(r)[:1] + tuple(r)[2:6] for r in warc.read_archives(files, split_bytes=split).collect()]
        assert sorted(back, key=str) == expected_records(rows)
    payloads = {r.payload_digest: bytes(r.payload) for r in warc.read_archives(files).collect() if r.record_type == "response"}
    assert "é".encode() * 50_000 in payloads.values()


def test_archives_of_nothing(spark):
    files = warc.archive(spark.createDataFrame([], PAGES), shared_path(spark, "w"))
    assert files.count() == 0 and warc.read_archives(files).count() == 0


def test_pages_round_trip(spark, sf_dir):
    from civicframe.llm.queries import op1_warc

    rows = [(r.page_id, r.url, r.html, None) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in op1_warc(spark, sf_dir).collect()), key=str) == expected_records(rows)


def test_an_archive_as_payload_starts_no_record():
    inner = warc.member(warc.record(1, "u", b"x", None), 6)
    for level in (0, 1, 6):
        data = warc.member(warc.record(2, "u", inner * 3, None), level)
        assert gzip.decompress(data) == warc.record(2, "u", inner * 3, None)
        f = io.BytesIO(data + inner)
        assert warc.first_member(f, 1, len(data)) is None
        assert warc.first_member(f, 1, len(data) + 1) == len(data)


def test_a_cut_or_damaged_archive_is_refused():
    data = warc.member(warc.record(1, "u", b"hello", None), 6)
    with pytest.raises((EOFError, zlib.error)):
        list(warc.members(io.BytesIO(data[:-9]), 0, 10))
    with pytest.raises(ValueError):
        warc.parsed(warc.record(1, "u", b"hello", None).replace(b"hello", b"jello"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 5), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_words_hold_all_ids(ids):
    array = np.array(ids, np.uint64)
    assert tokens.unpack(tokens.pack(array), len(ids)).tolist() == ids


def test_runs_of_zeros_and_escapes():
    ids = np.array([0] * 361 + [2**63, 15 << 60, 2**60, (15 << 60) + 1, 2**60 - 1] + [0] * 125, np.uint64)
    assert (tokens.unpack(tokens.pack(ids), len(ids)) == ids).all()
    assert len(tokens.pack(np.zeros(240, np.uint64))) == 1


def test_word_by_word_equals_whole_texts(spark, sf_dir):
    library = Tokenizer.from_file(VOCABULARY)
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["a<|endoftext|>b <|startoftext|>", "x́ ́y　z\x1cq\x85w\xa0e", "don't WE'LL ΑΣ ΑΣ. İI", "a\x00b", "photograph PHOTOGRAPHS.x photograph", ""]
    encode = tokens.word_encoder(VOCABULARY)
    assert [x.tolist() for x in encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_letters_that_normalising_takes_apart_equal_whole_texts():
    library = Tokenizer.from_file(VOCABULARY)
    unstable = [c for c in map(chr, range(128, 0x110000)) if not "\ud800" <= c <= "\udfff" and (len(unicodedata.normalize("NFC", c.lower())) > 1 or unicodedata.normalize("NFC", c.lower()) != c.lower())]
    assert {"\u0130", "\u09df", "\u095c", "\ufb1d"} <= set(unstable)
    texts = [f"{sign}{c}{sign} a{c}{sign}b {sign}{c}1" for c in unstable for sign in string.punctuation]
    latin = [chr(c) for c in range(33, 256)]
    texts += [" ".join(f"{a}{b} a{a}{b}1 {a}'s{b}" for b in latin) for a in latin]
    texts += ["BELED\u0130YES\u0130, ANKARA", "(\u0130)", "\u09b9\u09df, \u09b9\u09df\u0964", "a\u0130's \u0130'll"]
    encode = tokens.WordEncoder(VOCABULARY)
    for i in range(0, len(texts), 4096):
        part = texts[i : i + 4096]
        assert [x.tolist() for x in encode(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aAB  \n's1,\u0130")), max_size=40), max_size=8))
def test_another_vocabulary_equals_whole_texts(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert [x.tolist() for x in loaded(tokens.WordEncoder, path)(texts)] == [e.ids for e in loaded(Tokenizer.from_file, path).encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aAzZtThHwWyY's'reDll 19.,!&<|>\u0308\u0307\u030aİΣßéÉ\x1c\x85\xa0")), max_size=40), max_size=8))
def test_odd_words_equal_whole_texts(texts):
    library = loaded(Tokenizer.from_file, VOCABULARY)
    assert [x.tolist() for x in loaded(tokens.WordEncoder, VOCABULARY, 8)(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_rows_of_one_id_are_dealt_over_tasks(spark):
    docs = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    uri = shared_path(spark, "t")
    files = tokens.write_tokens(docs, uri, VOCABULARY, end_id=2, tasks=8)
    assert files.agg(F.max("docs")).first()[0] < 1200
    assert sorted(tuple(r) for r in tokens.read_tokens(files, uri).select("start", "n_tokens").collect())[-1][0] > 0


def expected_tokens(rows):
    library, out, start = Tokenizer.from_file(VOCABULARY), [], 0
    signed = lambda t: np.uint64(xxhash.xxh64((t or "").encode(), seed=42).intdigest()).astype(np.int64)
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1]))):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, sf_dir):
    from civicframe.llm.queries import op10_token_files

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in op10_token_files(spark, sf_dir).collect()) == expected_tokens(rows)


def test_token_files_of_odd_rows(spark):
    rows = [(3, None), (1, ""), (1, "b b"), (1, "b b"), (None, "x"), (-5, "word " * 30_000)]
    uri = shared_path(spark, "t")
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, start long, part string")
    back = tokens.read_tokens(tokens.write_tokens(docs, uri, VOCABULARY, end_id=2, tasks=3, block_docs=2), uri)
    assert sorted((tuple(r) for r in back.collect()), key=lambda r: r[1]) == expected_tokens(rows)
    none = tokens.write_tokens(docs.limit(0), uri, VOCABULARY, end_id=2)
    assert tokens.read_tokens(none, uri).count() == 0
