"""Ids at chunk joins, with mixed white space in front of every cut, equal the library's."""

import random

import pytest
import regex

from basetide.llm import byte_bpe, tokens

RANKS = tokens.default_path("byte_bpe_multi_50k.tiktoken")


def chunked(text, chunk, overlap):
    """Ids of a text from its chunks, joined as the operator joins them."""
    enc, pat = tokens.rank_encoding(RANKS, byte_bpe.default_pattern()), regex.compile(byte_bpe.default_pattern())
    spans = byte_bpe.cut_chunks(text, chunk, overlap)
    out, skip, held = [], 0, None
    for k, (s, e) in enumerate(spans):
        left = spans[k - 1][1] - s if k else -1
        right = spans[k + 1][0] - s if k + 1 < len(spans) else e - s + 1
        ids, lt, rt = byte_bpe.encode_chunk(text[s:e], enc, pat, left, right)
        if k:
            stop, begin = byte_bpe.join_place(held[1], [(p + s, n) for p, n in lt])
            out += held[0][skip:stop].tolist()
            skip = begin
        held = (ids, [(p + s, n) for p, n in rt[:-1]])
    return out + held[0][skip:].tolist(), len(spans)


def whole(text):
    return tokens.rank_encoding(RANKS, byte_bpe.default_pattern()).encode_ordinary(text)


def test_small_chunks_with_mixed_white_space():
    rng, joins = random.Random(1), 0
    parts = ["word", "the", " ", "  ", " ", "\u0085", " ", "　", "\n", "\r\n", "\t", "12345", "'s", "...", "é", "日本", "\x1c", "​"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(20, 200)))
        got, n = chunked(text, rng.choice([8, 16, 31]), rng.choice([1, 2, 4, 8]))
        joins += n - 1
        assert got == whole(text), repr(text)
    assert joins > 5000


@pytest.mark.parametrize("space", ["  ", "  ", "\n　 ", "  \u0085", "  "])
def test_default_chunks_with_white_space_around_the_cut(space):
    for before in range(byte_bpe.CHUNK - 6, byte_bpe.CHUNK + 5):
        text = "a" * before + space + "word x " * 6000 + space + "end"
        got, n = chunked(text, byte_bpe.CHUNK, byte_bpe.OVERLAP)
        assert n > 1 and got == whole(text)


def test_through_the_operator(spark):
    text = "a" * 32766 + "  " + "some words here " * 3000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pieces = sorted(byte_bpe.bpe_encode(df).collect(), key=lambda r: r.piece)
    assert len(pieces) > 1 and [i for r in pieces for i in tokens.widen(bytes(r.ids)).tolist()] == whole(text)
