"""Word ids of the registered queries against an unmodified tokenizer."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from basetide.llm import catalog, tokens

RNG = random.Random(5)
PATH = tokens.default_path("word_bpe_49k.json")
CASES = ["a <|endoftext|> b", "x<|startoftext|>y<|endoftext|>", "<|EndOfText|> <|endoftext |>", "<|endoftext|>", "H̱ ẖ",
         "T̈x J̌ ǰ", "Hְ̱", "Ḵ Ḵ", "ÁB̧'S", "plain, text", "É≠ ≮a"]
CASES += ["".join(RNG.choice(["H", "t", "J", "̱", "̈", "̌", "<|endoftext|>", "<|", "endoftext", "|>", " ", "'s", "é"])
                  for _ in range(40)) for _ in range(200)]


@pytest.mark.parametrize("added", [True, False])
def test_encoder_on_added_tokens_and_marks(added):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = not added
    for text, got in zip(CASES, tokens.WordEncoder(PATH, added).encode(CASES)):
        assert got.tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_queries_give_the_ids_of_the_plain_tokenizer(spark, tmp_path):
    tok = Tokenizer.from_file(PATH)
    docs = spark.createDataFrame(list(enumerate(CASES[:11])), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = {i: tok.encode(t, add_special_tokens=False).ids for i, t in enumerate(CASES[:11])}

    def crc(line):
        return zlib.crc32(np.array(line, "<u4").tobytes())

    got = catalog.op8_token_files(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.ids_crc32 for r in got} == {i: crc([*x, 1]) for i, x in ids.items()}
    for pieces in (catalog.op3_packing(spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, docs, "")):
        assert {r.doc_id: r.ids_crc32 for r in pieces.collect()} == {i: crc([*x, 2]) for i, x in ids.items()}
    # op5 searches for the end id, which no text may give
    got = catalog.op5_token_counts(spark, str(tmp_path)).collect()
    tok.encode_special_tokens = True
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(CASES[:11])}


def test_the_pipeline_hands_on_its_sequences(spark):
    docs = spark.createDataFrame(list(enumerate(CASES[:11])), "doc_id long, text string")
    got = corpus_pipeline.pack_sequences(spark, docs, "").collect()
    assert len(got) == 11
    for r in got:
        ids = tokens.widen(bytes(r.ids))
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32


def test_pieces_encoded_in_one_text_equal_single_calls():
    rnd = random.Random(11)
    letters = list("abXZ7733 '|<.-\n") + ["́", " ", "İ", "Σ", "７", "٧", "³", "一", "‍"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(9000)]
    encoder = tokens.WordEncoder(tokens.default_path("word_bpe_49k.json"))
    plain = tokens.json_tokenizer(tokens.default_path("word_bpe_49k.json"))
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(encoder.table) > tokens.JOINED and not encoder.table.new


def test_the_pipeline_leaves_no_word_table_in_its_workers(spark):
    """A table of some 800,000 pieces stayed in every worker, through all stages that followed."""
    import pyarrow as pa

    docs = spark.range(5_000).selectExpr("id AS doc_id", "concat('Word', id, ' and, others ', id * 7, ' of x', id) AS text").repartition(8)
    got = {(r.doc_id, r.start): r.ids_crc32 for r in corpus_pipeline.pack_sequences(spark, docs, "").collect()}

    def left(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(tokens.word_encoder(PATH, True).table)] * b.num_rows, pa.int64())], ["n"])

    assert max(r.n for r in spark.range(0, 64, numPartitions=8).mapInArrow(left, "n long").collect()) == 0
    tok = tokens.WordEncoder(PATH, True)
    texts = {r.doc_id: r.text for r in docs.collect()}
    whole = {i: zlib.crc32(np.append(ids, np.uint32(2)).astype("<u4").tobytes()) for i, ids in zip(texts, tok.encode(list(texts.values())))}
    cut = {i for i, s in got if s > 0}
    assert len({i for i, _ in got}) == 5_000 and len(cut) < 100
    assert {i: c for (i, s), c in got.items() if i not in cut} == {i: c for i, c in whole.items() if i not in cut}
    assert [x.tolist() for x in tok.encode(CASES, 0)] == [x.tolist() for x in tokens.WordEncoder(PATH, True).encode(CASES)]
