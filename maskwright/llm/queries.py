"""The training-data operators as queries over the synthetic tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import classify, decontaminate, fixity, minhash, packing, quality, sharding, sitetree, substring, suffix
from ._common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


#: Pages of one WARC file in the fixity query.
PAGES_PER_FILE = 512


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of one of many WARC files, and a second replica of them with faults: all pages of both are hashed and
    compared. By the digest of its id, a record of the replica has a byte changed (remainder 3 of 64), is cut short (7), is lost (11) or is followed by a stray byte (13)."""
    pages = table(spark, sf_dir, "pages")
    record = fixity.warc_record(F.col("url"), F.col("html"))
    fault = F.coalesce(F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 64, F.lit(0))
    changed = F.concat(F.expr("substring(r, 1, octet_length(r) - 5)"), F.lit(bytearray(b"~")), F.lit(bytearray(b"\r\n\r\n")))
    cut = F.expr("substring(r, 1, octet_length(r) - 5)")
    hashed = pages.select("page_id", "url", record.alias("r"), fault.alias("fault")).select(
        "page_id",
        "fault",
        F.octet_length("r").cast("long").alias("length"),
        F.sha2("r", 256).alias("digest"),
        F.when(F.col("fault") == 3, F.sha2(changed, 256)).when(F.col("fault") == 7, F.sha2(cut, 256)).otherwise(F.sha2("r", 256)).alias("b_digest"),
    )
    file = F.format_string("pages-%08d.warc", F.coalesce(F.floor(F.col("page_id") / PAGES_PER_FILE), F.lit(-1)).cast("long"))
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = hashed.withColumn("file", file).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    a = placed.select("file", "offset", "length", "digest")
    length: Column = F.when(F.col("fault") == 7, F.col("length") - 5).otherwise(F.col("length"))
    here = F.struct(F.col("offset"), length.alias("length"), F.col("b_digest").alias("digest"))
    stray = F.struct((F.col("offset") + F.col("length") - 1).alias("offset"), F.lit(1).cast("long").alias("length"), F.sha2(F.lit("\n"), 256).alias("digest"))
    b = placed.filter("fault <> 11").select("file", F.explode(F.when(F.col("fault") == 13, F.array(here, stray)).otherwise(F.array(here))).alias("x")).select("file", "x.*")
    return fixity.audit(a, b)


def op2_longest_previous_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeated_strings(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400, texts=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op4_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.main_texts(table(spark, sf_dir, "pages"))


def op5_fast_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), rule=minhash.Near(num=85, den=100, words=5)).drop("text_hash")


def op6_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13, period=7, texts=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_cgk_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of op3, which SQL can hold against."""
    return op3_distribution_divergence(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def shards_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of op10 without the checksums, which the SQL dialect lacks."""
    return op10_byte_shards(spark, sf_dir).select("doc_id", "size", "law", "shard", "slot")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_merkle_fixity": op1_merkle_fixity,
    "op2_longest_previous_factor": op2_longest_previous_factor,
    "op3_distribution_divergence": op3_distribution_divergence,
    "op4_site_style_tree": op4_site_style_tree,
    "op5_fast_similarity_sketch": op5_fast_similarity_sketch,
    "op6_quadratic_discriminant": op6_quadratic_discriminant,
    "op7_difference_cover": op7_difference_cover,
    "op8_cgk_embedding": op8_cgk_embedding,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_byte_shards": op10_byte_shards,
    "quality_base": quality_base,
    "shards_by_bytes": shards_by_bytes,
}

#: The pages table's template, where the article's markup is within reach of regular expressions; other markup is tested by tests/llm.
_OP4 = r"""
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM (
  SELECT page_id, url, coalesce(array_to_string(list_filter(list_transform(
    regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>'),
    lambda b: trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(replace(b, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))),
    lambda b: b <> ''), chr(10)), '') AS text
  FROM pages)
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
#: Windows of 13 words by their text; a document's words that none of a smaller id's windows covers stay.
_OP7 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
 g AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
 s AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 12), ' ')) AS k FROM g),
 m AS (SELECT k, min(doc_id) AS least FROM s GROUP BY k),
 c AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT s.doc_id, unnest(range(s.i, s.i + 13)) AS p FROM s JOIN m ON s.k = m.k WHERE s.doc_id > m.least) GROUP BY doc_id),
 f AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN c ON d.doc_id = c.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(array_to_string(list_filter(w, lambda x, j: NOT list_contains(gone, j)), ' ')) AS kept_sha256 FROM f
"""
#: Sizes in the order of ids; a row goes where its middle byte lies.
_OP10 = """
WITH d AS (SELECT doc_id, (strlen(coalesce(text, '')) + 8)::BIGINT AS size FROM documents),
 p AS (SELECT *, sum(size) OVER (ORDER BY doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM d),
 s AS (SELECT doc_id, size, least(23, ((2 * before + size) * 24) // (2 * total))::INTEGER AS shard FROM p)
SELECT doc_id, size, 'bytes' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot FROM s
"""
#: Links over full sets of shingles, and the least id that is reached.
_OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))] ELSE list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(list_slice(w, i, i + 4), ' '))) END) AS s FROM d),
 e AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM sets),
 l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
 r AS (SELECT doc_id AS node, doc_id AS reached FROM d UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.reached) AS component_id, min(r.reached) = s.doc_id AS kept FROM sets s JOIN r ON r.node = s.doc_id GROUP BY s.doc_id, s.s
"""
#: All records of both replicas against each other, by file and offset.
_RECORD = "'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"
#: By the digest of its id, a record of the replica is changed (3), cut short (7), lost (11) or followed by a stray byte (13).
_FAULT = "('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8))::BIGINT % 64"
_OP1 = f"""
WITH r AS (SELECT page_id, {_RECORD} AS r, {_FAULT} AS fault FROM pages),
 h AS (SELECT page_id, fault, printf('pages-%08d.warc', page_id // {PAGES_PER_FILE}) AS file, strlen(r)::BIGINT AS length, sha256(r) AS digest,
  CASE fault WHEN 3 THEN sha256(left(r, length(r) - 5) || '~' || chr(13) || chr(10) || chr(13) || chr(10)) WHEN 7 THEN sha256(left(r, length(r) - 5)) ELSE sha256(r) END AS b_digest FROM r),
 p AS (SELECT *, (sum(length) OVER (PARTITION BY file ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING) - length)::BIGINT AS "offset" FROM h)
SELECT file, "offset", CASE fault WHEN 11 THEN 'missing' ELSE 'changed' END AS status, length AS a_length, digest AS a_digest, CASE fault WHEN 7 THEN length - 5 WHEN 3 THEN length END::BIGINT AS b_length, CASE WHEN fault <> 11 THEN b_digest END AS b_digest, 1::BIGINT AS a_copies, CASE WHEN fault = 11 THEN 0 ELSE 1 END::BIGINT AS b_copies FROM p WHERE fault IN (3, 7, 11)
UNION ALL SELECT file, "offset" + length - 1, 'extra', NULL, NULL, 1, sha256(chr(10)), 0, 1 FROM p WHERE fault = 13
"""
_BASE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
 g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
 t AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT g.doc_id, unnest(range(g.i, g.i + 3)) AS p FROM g JOIN (SELECT doc_id, k FROM g GROUP BY ALL HAVING count(*) > 1) x ON g.doc_id = x.doc_id AND g.k = x.k) GROUP BY doc_id),
 b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(t.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN t ON d.doc_id = t.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b
"""
ORACLES: dict[str, str] = {"op1_merkle_fixity": _OP1, "op4_site_style_tree": _OP4, "op5_fast_similarity_sketch": _OP5, "op7_difference_cover": _OP7, "quality_base": _BASE, "shards_by_bytes": _OP10}
