"""Ids and decoded texts against the tokenizers library, on test tables, edge cases and every kind of character."""

import hashlib
import os
import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

from tallygrid.llm import word_bpe  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def texts(seed=4):
    rng = random.Random(seed)
    alphabet = [chr(c) for c in (*range(0, 0x250), *range(0x300, 0x340), 0x3A3, 0x3C2, 0x130, 0x1E9E, 0x85, 0xA0, 0x2003, 0x3000, 0x200B, 0x1F642,
                                 0x1100, 0x1161, 0x11A8, 0xAC00, 0xFB01, 0x558, 0x660, 0x2160, 0x212B, 0xFFFD, 0x1D7CE, 0x10FFFF)]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))) for _ in range(300)]
    out += [" ".join("".join(rng.choice("abeiost'") for _ in range(rng.randrange(1, 9))) for _ in range(50)) for _ in range(50)]
    return out + [
        None, "", " \n\t ", "\x1c\x1d \x85 ", "one", "It's WE'LL i'd 'S ''s", "<|endoftext|>", "a<|startoftext|>b<|endoftext|><|endoftext|> <|END|>",
        "<|endof text|>", "x" * 30_000, "ab" * 5_000 + "!" * 5_000, "1234567890" * 300, "é e ́", "Σας ΣΑΣ", "rep eat " * 2000, "rep eat " * 2000]


def want(library, i, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (i, ids, decoded, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def frame(spark):
    rows = [*enumerate(texts()), (None, "null id"), (None, None), (3, "again"), (3, "again")]
    return rows, spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id bigint, text string, chunk int, bucket string, part int").repartition(5)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


@pytest.mark.parametrize("sizes", [(1 << 24, 1 << 24), (2_000, 3_000)])
def test_library(library, frame, sizes):
    rows, df = frame
    got = word_bpe.encode(df, PATH, chunk_bytes=sizes[0], bucket_bytes=sizes[1]).collect()
    assert ordered((r["doc_id"], r["ids"], r["decoded"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == ordered(want(library, *r) for r in rows)
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_documents(spark, library):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = word_bpe.encode(df, PATH, keep_ids=False, keep_text=False, chunk_bytes=100_000, bucket_bytes=100_000)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expect = [want(library, *r) for r in df.collect()]
    assert sorted(map(tuple, got.collect())) == sorted((i, len(ids), a, b) for i, ids, _, a, b in expect)


def test_decode(library, spark, frame):
    rows, df = frame
    encoded = word_bpe.encode(df, PATH).select("doc_id", "ids")
    got = word_bpe.decode(encoded, PATH).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["decoded"]) for r in got) == sorted((i is None, i, want(library, i, t)[2]) for i, t in rows)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [49406, -1, 99_999_999, 320])], "doc_id bigint, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in word_bpe.decode(odd, PATH).collect()} == {1: "", 2: "", 3: library.decode([49406, 320], skip_special_tokens=False)}


def test_empty_table(frame):
    assert word_bpe.encode(frame[1].where("false"), PATH).collect() == []


def test_other_files_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        word_bpe.Vocabulary(file.read())
