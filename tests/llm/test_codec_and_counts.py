"""Byte-level BPE and token counts against the libraries that read the same files."""

import base64
import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from corpusloom.llm.bpe_codec import Codec, decode, encode_decode
from corpusloom.llm.rank_queue import RankTable
from corpusloom.llm.token_counts import Counter, count_tokens

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "1", "é", "ß", "'s", "'", "漢字", "😀", "<|endoftext|>", ".", "\u0085", " ", "\x1c", "A",
         "the", " the", "!!!", " <|endoftext|>x", " word", " word2", " ", "﻿ "]


def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n, longest, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, longest))) for _ in range(n)]


def test_codec_equals_library():
    own, theirs = Codec(RANKS, public_tokenizers.PATTERN), library()
    for text in random_texts(3000, 20, 1):
        ids = list(array("i", own.encode(text)))
        assert ids == theirs.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 10_000, "".join(random.Random(3).choice("abcdefgh") for _ in range(60_000)), "漢字" * 9_000])
def test_codec_takes_very_long_pretokens(text):
    assert list(array("i", Codec(RANKS, public_tokenizers.PATTERN).encode(text))) == library().encode_ordinary(text)


def test_queue_prefers_low_ranks_that_appear_late():
    """A merge may make a pair of lower rank than its own; the queue goes back to it."""
    ranks = {bytes([b]): 100 + b for b in range(256)} | {b"ab": 9, b"abc": 1, b"cd": 5, b"de": 7, b"abcd": 0}
    table = RankTable(ranks)
    for piece in (b"abcde", b"ababcd", b"cdab", b"abcabcde"):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        assert table._merge(piece) == [ranks[p] for p in parts]
    assert not any(table._words) and not any(table._buckets)


def test_encode_decode_rows(spark):
    texts = [None, "", "a b", "a b", "x" * 50_000, " lead", "tail ", "two  gaps \n here"]
    df = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id int, text string, ids string")
    got = {r.doc_id: r for r in encode_decode(df, RANKS, public_tokenizers.PATTERN, carry=["doc_id"]).collect()}
    theirs = library()
    for i, text in enumerate(texts):
        assert got[i].ids == theirs.encode_ordinary(text or "") and bytes(got[i].decoded) == (text or "").encode()
    coded = encode_decode(df, RANKS, public_tokenizers.PATTERN, carry=["doc_id"], decoded=False)
    assert coded.columns == ["doc_id", "ids"]
    back = decode(coded.withColumn("ids", F.when(F.col("doc_id") != 2, F.col("ids"))), RANKS, public_tokenizers.PATTERN, carry=["doc_id"])
    assert {r.doc_id: r.decoded and bytes(r.decoded) for r in back.collect()} == {i: None if i == 2 else (t or "").encode() for i, t in enumerate(texts)} | {0: b"", 1: b""}
    assert encode_decode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_counts_equal_library():
    own = Counter(JSON)
    for text in random_texts(2000, 60, 2):
        expected = len(own.library.encode(text, add_special_tokens=False))
        assert own.count(text) == expected == len(own.ends(text)), text
        for chunk, overlap in ((8, 3), (16, 4), (40, 8)):
            if len(text) > chunk:
                assert own.count_long(text, chunk, overlap) == expected, (text, chunk, overlap)


def test_counts_widen_where_there_is_no_boundary():
    own = Counter(JSON)
    for text in ("x" * 5_000, "x" * 3_000 + " y " + "z" * 3_000, "漢" * 4_000, "a\n" * 3_000):
        assert own.count_long(text, 100, 10) == len(own.library.encode(text, add_special_tokens=False))


def test_count_tokens_rows(spark):
    texts = [None, "", "a b", "a b", "word " * 9_000, "<|endoftext|> x<|endoftext|>"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id int, text string, n_tokens int")
    own = Counter(JSON)
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, JSON, carry=["doc_id"], chunk_chars=1_000, overlap_chars=50).collect()}
    assert got == {i: len(own.library.encode(t or "", add_special_tokens=False)) for i, t in enumerate(texts)}
    assert count_tokens(df.limit(0), JSON).count() == 0
    with pytest.raises(ValueError):
        count_tokens(df, JSON, chunk_chars=10, overlap_chars=20)


def test_digest_columns(spark, tmp_path):
    from corpusloom.llm.queries import op1_byte_bpe, op8_token_counts

    docs = spark.createDataFrame([(1, "Hello there, wörld"), (2, None)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op1_byte_bpe(spark, str(tmp_path)).collect()}
    ids = library().encode_ordinary("Hello there, wörld")
    assert rows[1].n_tokens == len(ids) and rows[1].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert rows[1].decoded_sha256 == hashlib.sha256("Hello there, wörld".encode()).hexdigest()
    assert rows[2].n_tokens == 0 and rows[2].ids_sha256 == rows[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op8_token_counts(spark, str(tmp_path)).collect()}
    assert counts == {1: (19, len(ids), False), 2: (0, 0, False)}
