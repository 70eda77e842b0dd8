import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import frame, random_texts

from shelfcast.llm import bpe
from shelfcast.llm.queries import QUERIES, RANKS

ODD = ["", " ", "a  b\n\nc \t d", " lead", "trail  ", " x   y　", "don't I'll WE'LL 12ab", "\x1ca \x85b", "中文 字​🙂🙂",
       "a" * 3000, "ab" * 700 + "é" * 300, "qzxj" * 500, "<|endoftext|>", "\x00\x7f", "ﬀ" * 40, " " * 200, "12345678901234567890" * 9]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def lowest_first(piece, ranks):
    """Merge the leftmost pair of lowest rank until there is none."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 40:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_trees_merge_like_a_plain_search(ranks):
    rng = random.Random(3)
    # few letters: many ties, and pairs that overlap
    some = [bytes(rng.choice(b"aabetnhs\xc3\xa9 ") for _ in range(rng.randrange(1, 33))) for _ in range(600)]
    want = [lowest_first(p, ranks) for p in some]
    assert [bpe.merged(p, ranks) for p in some] == want
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    together = bpe.merged_together(some, codec.byte_ids, codec.pairs)
    assert [np.frombuffer(x, "<u4").tolist() for x in together] == want


def test_a_toy_vocabulary_takes_the_leftmost_of_equal_pairs():
    toy = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258}
    for piece in (b"aaaaa", b"aaab", b"aab", b"baaab", b"a"):
        assert bpe.merged(piece, toy) == lowest_first(piece, toy)


def test_query_equals_the_library(spark, library, tmp_path):
    texts = ODD + random_texts(60)
    docs = frame(spark, texts).union(spark.createDataFrame([(None, "no id", "s"), (3, "again", None), (3, "again", None)], "doc_id long, text string, source string"))
    docs = docs.selectExpr("*", "1 AS ids", "2 AS data", "3 AS n_tokens")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op11_byte_bpe"](spark, str(tmp_path)).collect())
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        assert library.decode_bytes(ids) == (r.text or "").encode()
        want.append((r.doc_id if r.doc_id is not None else -1, len(ids), hashlib.sha256(np.array(ids, "<u4")).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_ids_as_arrays_and_bytes_of_any_ids(spark, library):
    codec = bpe.ByteBPE(spark, RANKS, public_tokenizers.PATTERN)
    ids = codec.encoded(frame(spark, ["Hello there, thorannd", None, "x"]))
    assert {r.doc_id: r.ids for r in bpe.unpacked(ids).collect()} == {0: library.encode_ordinary("Hello there, thorannd"), 1: [], 2: library.encode_ordinary("x")}
    # half a character, and no ids at all
    own = spark.createDataFrame([(1, bytearray(np.array([library.encode_single_token(b"\xc3")], "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    assert {r.doc_id: bytes(r.data) for r in codec.decoded(own).collect()} == {1: b"\xc3", 2: b""}


def test_empty_table_and_blank_lines_in_the_vocabulary(spark, tmp_path, ranks):
    codec = bpe.ByteBPE(spark, RANKS, public_tokenizers.PATTERN)
    assert codec.decoded(codec.encoded(frame(spark, []))).count() == 0
    path = tmp_path / "own"
    path.write_bytes(b"\n" + b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items() if r < 300))
    assert bpe.read_ranks(str(path)) == {t: r for t, r in ranks.items() if r < 300}
