"""The thin ``opN_<name>`` queries over the given tables, and their SQL texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basetide.llm import (byte_bpe, hard_negatives, katz, merkle, packing, page_text, preference, quality_rules, segment_search,
                          simhash, suffix_dedup, token_counts, token_files)
from basetide.llm.common import crc_mod, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 best rows for every 50th vector, by inner product of floor(256 x)."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"),
                                                     segment_search.scaled(F.col("embedding")).alias("v"))
    return segment_search.top_k(rows, rows.where(F.col("id") % 50 == 0), k=5)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by 100-byte strings that also start earlier."""
    return suffix_dedup.dedup_digest(table(spark, sf_dir, "documents"), 100).withColumnRenamed("id", "doc_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), 4096, 2, added=True).drop("ids").withColumnRenamed("id", "doc_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes they decode to, as digests."""
    pieces = byte_bpe.bpe_encode(table(spark, sf_dir, "documents"))
    return byte_bpe.digests(pieces).withColumnRenamed("id", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, from the separators of the flat files that hold them."""
    files = token_counts.write_flat_files(table(spark, sf_dir, "documents"))
    found = token_counts.token_counts(files)
    return (found.join(token_counts.document_names(files), ["file", "doc_no"], "left")
            .select(F.col("id").alias("doc_id"), "file", "doc_no", "start", "n_tokens", "closed"))


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels of four fifths of the ids."""
    docs = table(spark, sf_dir, "documents")
    ranker = preference.train(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    scored = preference.score_documents(docs.select("doc_id", "text"), ranker)
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the rule table for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs).drop("text")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from the token files."""
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), 1, added=True)
    return token_files.read_token_files(files).drop("ids").withColumnRenamed("id", "doc_id")


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under a Katz model of those whose crc32(doc_id) mod 7 is not 2."""
    scored = katz.score(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) != 2)
    return scored.select(F.col("id").alias("doc_id"), (~F.col("trained")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of their links within 4 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=4, shingle=4)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and folded proofs of all documents, by language; every third text is tampered with."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    leaves = merkle.document_leaves(table(spark, sf_dir, "documents"), crc % 3 == 0)
    proofs = merkle.prove(merkle.build(leaves, "group", "id", ["changed"]), "changed")
    return proofs.drop("group").withColumnRenamed("id", "doc_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 negatives in the band of 0.3 to 0.9 of each of 5 positives, for every 100th vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), label.alias("label"),
                                                     segment_search.scaled(F.col("embedding")).alias("v"))
    return hard_negatives.hard_negatives(rows, rows.where(F.col("id") % 100 == 0), 5, 10, hard_negatives.Band(30, 90, 100))


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return page_text.main_text(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_segment_search, op2_suffix_dedup, op3_packing, op4_byte_bpe, op5_token_counts, op6_preference, op7_quality_rules,
    op8_token_files, op9_katz, op10_simhash, op11_merkle, op12_hard_negatives, op13_page_text, pipeline)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def quality_counts_sql(source: str, keys: str = "doc_id") -> str:
    """Counts of ``source`` (doc_id, text); rows are told apart by a row number."""
    stops = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    return f"""
  r AS (SELECT row_number() OVER () AS rn, * FROM {source}),
  w AS (SELECT rn, {_WORDS} AS ws FROM r),
  t AS (SELECT rn, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
  g AS (SELECT rn, i, count(*) OVER (PARTITION BY rn, ws[i], ws[i + 1], ws[i + 2]) AS n FROM t),
  rep AS (SELECT rn, count(DISTINCT p) AS n_repeat_words
          FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY rn),
  ln AS (SELECT rn, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
         FROM (SELECT rn, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM r)
         WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rn),
  c AS (SELECT r.* EXCLUDE (rn), CAST(len(ws) AS BIGINT) AS n_words,
               CAST(length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
               CAST(len(list_filter(ws, lambda x: lower(x) IN ({stops}))) AS BIGINT) AS n_stop_words,
               CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
        FROM r JOIN w USING (rn) LEFT JOIN rep USING (rn) LEFT JOIN ln USING (rn)),
  f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               greatest(n_words, 1)::DOUBLE AS per_word, greatest(n_lines, 1)::DOUBLE AS per_line FROM c)"""


_MEASURES = {"word_length": "word_chars / per_word", "symbol_ratio": "n_symbols / per_word", "n_words": "n_words",
             "dup_line_ratio": "n_dup_lines / per_line", "stop_word_ratio": "n_stop_words / per_word",
             "repeat_ratio": "n_repeat_words / per_word"}


def rules_sql() -> str:
    parts = [f"{_MEASURES[r.measure]} {op} {v}" for r in quality_rules.RULES
             for op, v in ((">=", r.low), ("<=", r.high)) if v is not None]
    return " AND ".join(["NOT base_failed", *parts])


def merkle_sql(levels: int = 8, group_levels: int = 3) -> str:
    """Levels of all trees side by side; a tree of one node passes a level unchanged. ``levels`` bounds a group's rows by 8^levels."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    part = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, levels: int) -> str:
        out = ""
        for k in range(levels):
            out += f"""
  {name}r{k} AS (SELECT g, i // 8 AS i, list({{'i': i, 'h': h}} ORDER BY i) AS run, any_value(n) AS n FROM {name}{k} GROUP BY g, i // 8),
  {name}{k + 1} AS (SELECT g, i, count(*) OVER (PARTITION BY g) AS n, CASE WHEN n = 1 THEN run[1].h
      ELSE sha256(array_to_string(list_transform(run, lambda x: x.h), '')) END AS h FROM {name}r{k}),"""
        return out

    def climb(name: str, path: str, levels: int) -> str:
        out = ""
        for k in range(levels):
            out += f"""
  {path}{k + 1} AS (SELECT u, p.g, p.i // 8 AS i,
      CASE WHEN n = 1 THEN s ELSE s || array_to_string(list_transform(list_filter(run, lambda x: x.i <> p.i), lambda x: x.h), '') END AS s,
      CASE WHEN n = 1 THEN f ELSE sha256(array_to_string(list_transform(run, lambda x: CASE WHEN x.i = p.i THEN f ELSE x.h END), '')) END AS f
      FROM {path}{k} p JOIN {name}r{k} r ON p.g = r.g AND p.i // 8 = r.i),"""
        return out

    return f"""
WITH ct AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
                        ORDER BY i) AS t FROM range(256) r(i)),
  d0 AS (SELECT *, {leaf("text")} AS leaf, {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} AS low,
                xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c))),
                                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS crc FROM documents, ct),
  d AS (SELECT doc_id, leaf, CASE WHEN crc % 3 = 0 THEN low ELSE leaf END AS f,
               CAST(dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS BIGINT) AS g,
               CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS i FROM d0),
  a0 AS (SELECT g, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM d),{tree("a", levels)}
  b0 AS (SELECT 0::BIGINT AS g, g AS i, h, count(*) OVER () AS n FROM a{levels}),{tree("b", group_levels)}
  p0 AS (SELECT {{'g': g, 'i': i}} AS u, g, i, '' AS s, f FROM d),{climb("a", "p", levels)}
  q0 AS (SELECT u, 0::BIGINT AS g, g AS i, s, f FROM p{levels}),{climb("b", "q", group_levels)}
  o AS (SELECT doc_id, leaf, a.h AS subroot, b.h AS root, sha256(s) AS proof_sha256, q.f AS folded_root
        FROM d JOIN q{group_levels} q ON q.u = {{'g': d.g, 'i': d.i}} JOIN a{levels} a ON a.g = d.g CROSS JOIN b{group_levels} b)
SELECT *, folded_root = root AS verified FROM o"""


ORACLES: dict[str, str] = {
    "op1_segment_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op11_merkle": merkle_sql(),
    "op12_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
               CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
  p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same),
  n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.r AS positive_rank, s.vec_id AS negative_id, p.score AS positive_score,
               s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.r ORDER BY s.score DESC, s.vec_id) AS rank
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        WHERE p.r <= 5)
SELECT anchor_id, positive_id, CAST(positive_rank AS INTEGER) AS positive_rank, CAST(rank AS INTEGER) AS rank, negative_id,
       positive_score, negative_score FROM n WHERE rank <= 10""",
    "op7_quality_rules": f"""
WITH {quality_counts_sql("(SELECT doc_id, text FROM documents)")}
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_repeat_words, base_failed,
       {rules_sql()} AS kept FROM f""",
}
