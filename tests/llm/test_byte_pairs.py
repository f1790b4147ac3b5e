"""Byte-level codes against the rank file's own library, on the small table and on odd texts."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rowloom.errors import DataError
from rowloom.llm import byte_pairs, queries

FOLDER = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = [
    (1, None),
    (2, ""),
    (3, "I'll  say\t\n it's  “é” \U0001f600\U0001f468‍\U0001f469 ß \x00\x1c\x85 end  "),
    (4, "日本語の文章 " * 50),
    (4, "日本語の文章 " * 50),
    (None, "   "),
    (5, "a" * 5000 + " " * 3000 + "\n" * 2000),
    (6, "word 'd 's <|endoftext|> 12345678"),
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_pairs.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("token", F.lit(1))


def digest(ids):
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_letters_are_one_to_one():
    letters = byte_pairs.byte_letters()
    assert len(set(letters)) == 256 and letters[ord("a")] == "a" and letters[ord(" ")] == "Ġ" and letters[ord("\n")] == "Ċ"


def test_whole_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_byte_pairs"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(ids))
        assert r.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_odd_rows_and_back(odd, library):
    rows = byte_pairs.encode_documents(odd, PATH, PATTERN, keep_ids=True, carry=["token"])
    back = byte_pairs.decode_documents(rows.drop("token"), PATH, PATTERN).collect()
    expected = sorted((str(i), library.encode_ordinary(t or ""), t or "") for i, t in ODD)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in back) == expected
    assert {r.token for r in rows.collect()} == {1}
    assert byte_pairs.encode_documents(odd.limit(0), PATH, PATTERN).isEmpty()


def test_offsets_are_the_librarys(odd):
    pairs = byte_pairs.load(PATH, PATTERN)
    for r in byte_pairs.encode_documents(odd, PATH, PATTERN, keep_ids=True).collect():
        text = next(t for i, t in ODD if i == r.doc_id) or ""
        assert list(zip(r.starts, r.ends)) == pairs.library.encode(text, add_special_tokens=False).offsets
        assert "".join(pairs.pieces_of(r.ids)) == text
        assert r.n_split == sum(pairs.bytes[i].as_py()[0] & 0xC0 == 0x80 for i in r.ids)


def test_decoding_of_split_and_unknown(spark):
    space = byte_pairs.read_ranks(PATH)
    halves = [space[b"\xe2"], space[b"\x82"], space[b"\xac"]]
    df = spark.createDataFrame([(1, halves), (2, halves[:2]), (3, None), (4, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in byte_pairs.decode_documents(df, PATH, PATTERN).collect()}
    assert got == {1: "€", 2: "�", 3: None, 4: ""}
    assert byte_pairs.load(PATH, PATTERN).pieces_of(halves) == ["", "", "€"]
    with pytest.raises(Exception, match="vocabulary"):
        byte_pairs.decode_documents(spark.createDataFrame([(1, [60000])], "doc_id long, ids array<int>"), PATH, PATTERN).collect()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text(" \n\t'sdll1a!é\x1c", max_size=80), max_size=4))
def test_any_text(texts):
    pairs = byte_pairs.load(PATH, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_pairs.read_ranks(PATH), special_tokens={})
    ids, bounds = pairs.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode_ordinary(t) for t in texts]
    assert [b.decode() for b in pairs.decode(ids, bounds).to_pylist()] == texts


@pytest.mark.parametrize("size", [1, 3, 10])
def test_cuts_change_nothing(library, size):
    for _, text in ODD:
        cut = byte_pairs.cuts(text or "", size)
        assert "".join(cut) == (text or "")
        assert [i for c in cut for i in library.encode_ordinary(c)] == library.encode_ordinary(text or "")


def test_very_long_text(spark, library, monkeypatch):
    text = "Grüße aus 2024, it's  fine\n\n" * 60_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = byte_pairs.encode_documents(df, PATH, PATTERN).first()
    assert row.ids_sha256 == digest(library.encode_ordinary(text))


def test_unknown_id_has_a_code():
    import numpy as np

    with pytest.raises(DataError) as error:
        byte_pairs.load(PATH, PATTERN).decode(np.array([-1]), np.array([0, 1]))
    assert error.value.code == "bpe_unknown_id"
