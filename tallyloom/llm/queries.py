"""The registered queries of this subpackage: one thin query for each operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import decode_documents, encode_documents
from .edit_fingerprint import grouped_fingerprints
from .gif_media import read_back, with_gif
from .gumbel_pieces import sample_segmentations
from .html_blocks import extract_main_text
from .kneser_ney import classify_quality
from .license_rules import scan_licenses
from .pattern_packing import packed_documents
from .shared import table
from .simhash_groups import simhash_groups
from .spelling_variants import spelling_variants
from .substring_dedup import remove_repeats
from .suffix_tree import score_documents
from .token_alignment import align_tokens


def op1_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sample_segmentations(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "sample", "ids", F.size("ids").alias("n_pieces"), F.hex(F.xxhash64("ids")).alias("ids_hash"), "log_prob", "perturbed", "log_inclusion", "decoded")


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.withColumn("length", F.col("length").cast("long"))


def op3_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_fingerprints(table(spark, sf_dir, "documents"))


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_substring_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op9_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op10_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(with_gif(table(spark, sf_dir, "documents")))


def op11_trie_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = encode_documents(table(spark, sf_dir, "documents"), path)
    done = ids.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("ids_sha256", F.sha2(F.array_join("ids", ","), 256))
    out = decode_documents(done, path, columns=("doc_id", "n_tokens", "ids_sha256"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, ranks = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
    out = align_tokens(table(spark, sf_dir, "documents"), a, b, ranks_path=ranks)
    return out.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")


OP7_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS words FROM documents
), p AS (
  SELECT doc_id, words, unnest(range(0, len(words) - 34)) AS pos FROM w WHERE len(words) >= 35
), h AS (
  SELECT doc_id, pos, array_to_string(words[pos + 1 : pos + 35], ' ') AS passage FROM p
), r AS (
  SELECT doc_id, pos FROM h WHERE passage IN (SELECT passage FROM h GROUP BY passage HAVING count(*) > 1)
), gone AS (
  SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(pos, pos + 35)) AS i FROM r) GROUP BY doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(words, lambda x, i: gone IS NULL OR NOT list_contains(gone, i - 1)), ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""

# crc32 by its table; near words by what is left of both without one letter, at the same place.
OP11_SQL = """
WITH RECURSIVE steps AS (
  SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), keyed AS (
  SELECT id, run, count(*) AS times, list_transform(string_split(id || ':' || run, ''), lambda x: unicode(x)) AS points FROM runs GROUP BY id, run
), bytes AS (
  SELECT run, times, flatten(list_transform(points, lambda x: CASE WHEN x < 128 THEN [x::BIGINT] ELSE [(192 + x // 64)::BIGINT, (128 + x % 64)::BIGINT] END)) AS b FROM keyed
), hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS h FROM bytes, crc
), spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), less AS (
  SELECT DISTINCT word, n, place, substr(word, 1, place) || substr(word, place + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS place FROM words)
), pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, first(near_n ORDER BY near_n DESC, encode(near)) AS near_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.next = f.word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN chain USING (word) WHERE next IS NULL
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_gumbel_pieces, op2_pattern_packing, op3_edit_fingerprint, op4_suffix_tree, op5_kneser_ney, op6_license_rules, op7_substring_doubling, op8_simhash_gray, op9_html_blocks, op10_gif_media, op11_trie_variants, op12_byte_bpe, op13_token_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op7_substring_doubling": OP7_SQL, "op11_trie_variants": OP11_SQL}
