"""Operators on texts against brute force, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import tiktoken
import xxhash

from basetide.llm import (byte_bpe, common, packing, quality_rules, simhash, suffix_dedup, token_counts, token_files,
                          tokens)

RNG = random.Random(7)
WORDS = ["the", "of", "Über", "naïve", "it's", "a,b", "x&&&", "|", "12", "don't!", "ﬁn", "日本語", "Ångstrom", "<|endoftext|>",
         "K", "İ", "'s", "l'été", "$$$", "é", "..", "'", "we'll,'s"]
SPACES = [" ", " ", " ", "  ", "\n", "\t", " ", "　", "\x0b", "\x1c", "\r\n"]


def some_text(n, rng=RNG):
    return "".join(rng.choice(WORDS) + rng.choice(SPACES) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    passage = some_text(40)
    out = [(0, None), (1, ""), (2, " \n\t "), (3, "the"), (4, "one two three")]
    out += [(i, some_text(RNG.randrange(1, 120))) for i in range(5, 25)]
    out += [(25, some_text(30) + passage + some_text(20)), (26, passage), (27, passage + " x"), (28, "ab" * 400),
            (29, "a" * 700), (30, some_text(3000)), (31, out[10][1]), (32, out[10][1]), (None, "no id " * 30), (33, passage * 3)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Extra columns clash with names of the operators."""
    data = [(i, t, k, "x", "y", 1.0) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, text string, n long, ids string, id string, score double").repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def word_ids(text, end):
    tok = tokens.json_tokenizer(tokens.default_path("word_bpe_49k.json"))
    return [*tok.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_encoder_equals_the_library():
    enc = tokens.WordEncoder(tokens.default_path("word_bpe_49k.json"))
    cases = [some_text(n) for n in (1, 5, 50, 400)] + ["", " ", "a'b'c''d", "x.'s", "''", "́a", "á,b"]
    cases += ["".join(RNG.choice("ab'.,! \n12é́") for _ in range(60)) for _ in range(300)]
    for got, text in zip(enc.encode(cases), cases):
        assert got.tolist() == word_ids(text, 0)[:-1], repr(text)


def test_packing_places_every_id_once(docs, rows, empty):
    got = packing.pack(docs, seq_len=64).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    line = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in line:  # gapless, all sequences full but the last
        assert (r.sequence_id, r.offset) == divmod(at, 64)
        assert crc(tokens.widen(bytes(r.ids))) == r.ids_crc32
        at += r.length
    want = sorted(word_ids(t, 2) for _, t in rows)
    docs_back, held = [], []
    for r in line:
        assert r.start == len(held) and r.length > 0
        held += tokens.widen(bytes(r.ids)).tolist()
        if len(held) == r.doc_tokens:
            docs_back.append(held)
            held = []
    assert sorted(docs_back) == want
    assert packing.pack(empty).count() == 0
    seqs = packing.sequences(packing.pack(docs, seq_len=64)).collect()
    assert sorted(r.n_tokens for r in seqs)[1:] == [64] * (len(seqs) - 1)


@pytest.mark.parametrize("ids", [[], [0], [5] * 3000, list(range(5000)), [0] * 5000, [2 ** 60, 1, 2 ** 64 - 1, 0, 2 ** 63],
                                 [1] * 1023 + [2 ** 62] + [3] * 10, [2 ** 60] * 1030,
                                 [RNG.randrange(2 ** RNG.randrange(1, 64)) for _ in range(4000)]])
def test_word_aligned_coding_round_trip(ids):
    words, offsets = token_files.encode(np.array(ids, np.uint64))
    assert token_files.decode(words, offsets, len(ids)).tolist() == ids
    if len(ids) > 2 * token_files.BLOCK:  # one block by its offset alone
        some = token_files.decode(words[offsets[1]:offsets[2]], np.zeros(1, np.uint32), token_files.BLOCK)
        assert some.tolist() == ids[token_files.BLOCK:2 * token_files.BLOCK]


def test_token_files_in_order(docs, rows, empty):
    got = token_files.read_token_files(token_files.write_token_files(docs, 1, segment_ids=500)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at = {}
    start = 0
    for i, t in order:
        ids = word_ids(t, 1)
        at[i] = (start, len(ids), crc(ids))
        start += len(ids)
    assert {r.id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == at
    assert token_files.read_token_files(token_files.write_token_files(empty)).count() == 0


@pytest.mark.parametrize("block", [7, 64, 1 << 19])
def test_token_counts_from_separators(docs, rows, empty, block):
    files = token_counts.write_flat_files(docs, block_ids=block)
    found = token_counts.stitch(token_counts.scan_blocks(files), group_blocks=3)
    got = found.join(token_counts.document_names(files), ["file", "doc_no"]).collect()
    assert sorted((r.id is None, r.id, r.n_tokens) for r in got) == sorted((i is None, i, len(word_ids(t, 0))) for i, t in rows)
    assert all(r.closed for r in got)
    for file in {r.file for r in got}:
        line = sorted((r for r in got if r.file == file), key=lambda r: r.doc_no)
        assert [r.start for r in line] == [sum(x.n_tokens for x in line[:k]) for k in range(len(line))]
    assert token_counts.token_counts(token_counts.write_flat_files(empty)).count() == 0


def test_token_counts_open_end_and_runs_of_separators(spark):
    blocks = [(0, 0, [5, 9, 9]), (0, 1, [1, 2]), (0, 2, [3, 9, 4]), (0, 3, [6]), (1, 0, [7, 8]), (2, 0, [9])]
    files = spark.createDataFrame([(f, b, bytearray(tokens.narrow(np.array(x)))) for f, b, x in blocks], "file int, block long, ids binary")
    got = token_counts.stitch(token_counts.scan_blocks(files, 9), group_blocks=2).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0, 2, True), (0, 1, 2, 1, True), (0, 2, 3, 4, True), (0, 3, 7, 2, False),
                                       (1, 0, 0, 2, False), (2, 0, 0, 1, True)]


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 64), (50, 3), (9, 1)])
def test_byte_bpe(docs, rows, empty, chunk, overlap):
    enc = tokens.rank_encoding(tokens.default_path("byte_bpe_multi_50k.tiktoken"), byte_bpe.default_pattern())
    want = {}
    for i, t in rows:
        ids, raw = enc.encode_ordinary(t or ""), (t or "").encode()
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest())
    twice = docs.unionByName(docs.where("doc_id = 30"))
    got = byte_bpe.digests(byte_bpe.bpe_encode(twice, chunk=chunk, overlap=overlap)).collect()
    assert len(got) == len(rows) + 1
    assert {r.id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert byte_bpe.digests(byte_bpe.bpe_encode(empty)).count() == 0


def test_chunks_meet_at_every_cut():
    enc = tokens.rank_encoding(tokens.default_path("byte_bpe_multi_50k.tiktoken"), byte_bpe.default_pattern())
    import regex

    pat = regex.compile(byte_bpe.default_pattern())
    for k in range(150):
        rng = random.Random(k)
        text = "".join(rng.choice(["a", "B1", "'s", "  ", "\n\n", "　", "\x1c", "é", "!?", " 7", "\t ", "it's"]) for _ in range(120))
        spans = byte_bpe.cut_chunks(text, 13, 2)
        assert isinstance(enc, tiktoken.Encoding) and spans[-1][1] == len(text)
        for (s, e), (s2, _) in zip(spans, spans[1:]):
            one = set(byte_bpe.boundaries(text[s:e], pat)[:-1] + s)
            two = set(byte_bpe.boundaries(text[s2:], pat) + s2)
            true = set(byte_bpe.boundaries(text, pat).tolist())
            assert min(one & two) in true


def brute_quality(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_quality_rules(docs, rows, empty):
    got = quality_rules.quality_rules(docs.select("doc_id", "text", "n", "score")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_quality(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
    assert quality_rules.quality_rules(empty.select("doc_id", "text")).count() == 0


def test_quality_rules_stay_in_the_jvm(docs):
    plan = quality_rules.quality_rules(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """(id, fp) -> smallest id reachable"""
    left, out = list(range(len(prints))), {}
    while left:
        group, todo = [], [left.pop(0)]
        while todo:
            k = todo.pop()
            group.append(k)
            near = [j for j in left if (prints[j][1] ^ prints[k][1]).bit_count() <= 4]
            left = [j for j in left if j not in near]
            todo += near
        ids = [prints[k][0] for k in group if prints[k][0] is not None]
        out |= {k: min(ids, default=None) for k in group}
    return out


def test_simhash(docs, rows, empty):
    got = simhash.near_duplicates(docs, tile=4).collect()
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    roots = brute_components(prints)
    assert sorted((str(r.id), r.fp & (2 ** 64 - 1), r.component_id) for r in got) == sorted(
        (str(i), f, roots[k]) for k, (i, f) in enumerate(prints))
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_links_on_clustered_fingerprints(spark):
    rng = random.Random(3)
    prints = []
    for c in range(12):  # chains: each differs from the one before in up to 4 bits
        f = rng.getrandbits(64)
        for _ in range(25):
            prints.append((len(prints), f))
            for _ in range(rng.randrange(1, 5)):
                f ^= 1 << rng.randrange(64)
    rng.shuffle(prints)
    signed = [(f - 2 ** 64 if f >= 2 ** 63 else f,) for f in {f for _, f in prints}]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 4, tile=6)
    from basetide.llm.components import components

    root = {r.node: r.root for r in components(links).collect()}
    roots = brute_components(prints)
    groups = {}
    for k, (_, f) in enumerate(prints):
        f = f - 2 ** 64 if f >= 2 ** 63 else f
        groups.setdefault(roots[k], set()).add(root.get(f, f))
    assert all(len(x) == 1 for x in groups.values()) and len({next(iter(x)) for x in groups.values()}) == len(groups)


def test_components_of_a_long_chain_and_a_star(spark):
    from basetide.llm.components import components

    rng = random.Random(1)
    chain = list(range(1000, 1200))
    rng.shuffle(chain)
    links = [*zip(chain, chain[1:]), *((5, i) for i in range(6, 40)), (5, 5), (70, 70), (40, 39), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1000 for i in chain}, **{i: 5 for i in range(5, 41)}, 70: 70}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, length):
    """[(id, n_bytes, n_removed, n_spans, sha)] with equal rows as one document."""
    key = lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()) & 0x7FFFFFFF)
    seen, out = set(), {}
    for r in sorted(set(rows), key=key):
        raw = (r[1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        rest = bytes(np.frombuffer(raw, np.uint8)[~gone])
        n = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[r] = (len(raw), int(gone.sum()), n, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("length,slice_bytes", [(100, 1 << 20), (20, 1 << 20), (100, 300), (3, 50)])
def test_suffix_dedup(docs, rows, empty, length, slice_bytes, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", slice_bytes)
    want = brute_repeats([*rows, (40, rows[20][1]), (7, rows[21][1])], length)
    data = [(*r,) for r in rows] + [(40, rows[20][1]), (7, rows[21][1]), rows[25]]
    frame = docs.sparkSession.createDataFrame(data, "doc_id long, text string").repartition(6)
    got = suffix_dedup.dedup_digest(frame, length).collect()
    assert len(got) == len(data)
    assert {(r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {(r[0], *v) for r, v in want.items()}


def test_suffix_dedup_random_small_alphabet(spark):
    for k in range(3):
        rng = random.Random(k)
        rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(200)))) for i in range(30)]
        want = brute_repeats(rows, 12)
        got = suffix_dedup.dedup_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 12).collect()
        assert {(r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {(r[0], *v) for r, v in want.items()}


def test_suffix_dedup_keeps_valid_text(spark, empty):
    text = "äöüß" * 40
    got = suffix_dedup.dedup_text(spark.createDataFrame([(1, text), (2, "a" + text), (3, "x")], "doc_id long, text string"), 50).collect()
    by = {r.doc_id: r.text for r in got}
    assert by[3] == "x" and by[2].encode().decode() == by[2] and by[2].startswith("a") and len(by[2]) < 10
    assert suffix_dedup.dedup_digest(empty).count() == 0
    assert suffix_dedup.whole_characters("aäb".encode(), [(2, 4)]) == [(3, 4)]


def test_common_crc_split(spark):
    from pyspark.sql import functions as F

    df = spark.range(50).select("id", common.crc_mod(F.col("id"), 5).alias("m"))
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 5 for r in df.collect())
