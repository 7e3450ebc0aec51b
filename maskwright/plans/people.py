"""Identities, names and secrets: labels that stay, rules that are made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import detect, patterns as P, redact
from ..operators import identity
from ..session import table
from .registry import query

#: Commits: an order's customer is the author, and the customer before it in number the committer.
_COMMITS = "SELECT o_orderkey, 'Customer' || CAST(o_custkey AS VARCHAR) AS author_name, 'c' || CAST(o_custkey AS VARCHAR) || '@corp.example' AS author_email, 'Customer' || CAST(o_custkey - 1 AS VARCHAR) AS committer_name, 'c' || CAST(o_custkey - 1 AS VARCHAR) || '@corp.example' AS committer_email FROM orders"
_IDENTITIES = f"(WITH c AS ({_COMMITS}) SELECT author_name || ' <' || author_email || '>' AS identity, o_orderkey FROM c UNION ALL SELECT committer_name || ' <' || committer_email || '>', o_orderkey FROM c)"
_KEY = f"(SELECT identity, row_number() OVER (ORDER BY identity) AS n FROM (SELECT DISTINCT identity FROM {_IDENTITIES}))"


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    name = lambda c: F.concat(F.lit("Customer"), c.cast("string"))
    mail = lambda c: F.concat(F.lit("c"), c.cast("string"), F.lit("@corp.example"))
    key = F.col("o_custkey")
    return orders.select("o_orderkey", name(key).alias("author_name"), mail(key).alias("author_email"), name(key - 1).alias("committer_name"), mail(key - 1).alias("committer_email"))


def _key(spark: SparkSession, seen: DataFrame) -> DataFrame:
    return identity.extended_key(spark.createDataFrame([], "identity string, n long"), seen)


@query(f"SELECT identity, n, 'Contributor ' || CAST(n AS VARCHAR) AS label, 'contributor' || CAST(n AS VARCHAR) || '@example.com' AS email FROM {_KEY}")
def persona_numbering(spark, sf_dir):
    return identity.labelled(_key(spark, identity.identities(_commits(spark, sf_dir))))


@query(f"WITH old AS (SELECT identity, row_number() OVER (ORDER BY identity) AS n FROM (SELECT DISTINCT identity FROM {_IDENTITIES} WHERE o_orderkey % 2 = 0)), new AS (SELECT DISTINCT identity FROM {_IDENTITIES} WHERE identity NOT IN (SELECT identity FROM old)) SELECT * FROM old UNION ALL SELECT identity, row_number() OVER (ORDER BY identity) + (SELECT max(n) FROM old) FROM new")
def persona_extend(spark, sf_dir):
    commits = _commits(spark, sf_dir)
    old = _key(spark, identity.identities(commits.filter("o_orderkey % 2 = 0")))
    return identity.extended_key(old, identity.identities(commits))


@query(f"SELECT n, 'Contributor ' || CAST(n AS VARCHAR) || ' <contributor' || CAST(n AS VARCHAR) || '@example.com> ' || identity AS line FROM {_KEY}")
def mailmap_lines(spark, sf_dir):
    return identity.mailmap(_key(spark, identity.identities(_commits(spark, sf_dir))))


@query("SELECT DISTINCT CASE WHEN c_custkey % 9 = 0 THEN c_name ELSE 'Contributor ' || CAST(c_custkey AS VARCHAR) END AS name FROM customer WHERE c_custkey % 9 = 0")
def residual_names(spark, sf_dir):
    name = F.when(F.col("c_custkey") % 9 == 0, F.col("c_name")).otherwise(F.concat(F.lit("Contributor "), F.col("c_custkey").cast("string")))
    return identity.residual(table(spark, sf_dir, "customer").select(name.alias("name")))


@query(f"SELECT count(DISTINCT identity) AS identities, count(DISTINCT identity) AS labels, count(*) AS commits FROM {_IDENTITIES}")
def distinct_authors_preserved(spark, sf_dir):
    commits = _commits(spark, sf_dir)
    key = identity.labelled(_key(spark, identity.identities(commits)))
    both = commits.select(F.explode(F.array(identity.identity(F.col("author_name"), F.col("author_email")), identity.identity(F.col("committer_name"), F.col("committer_email")))).alias("identity"))
    return both.join(key, "identity").agg(F.count_distinct("identity").alias("identities"), F.count_distinct("label").alias("labels"), F.count(F.lit(1)).alias("commits"))


#: Two-part names for parts' words.
_NAMES = "SELECT DISTINCT upper(substr(md5(CAST(s_suppkey AS VARCHAR)), 1, 1)) || 'name ' || translate(substr(md5(s_name), 1, 8), '0123456789', 'ghijklmnop') || ' <x@y>' AS identity FROM supplier"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.upper(F.substring(F.md5(F.col("s_suppkey").cast("string").cast("binary")), 1, 1))
    last = F.translate(F.substring(F.md5(F.col("s_name").cast("binary")), 1, 8), "0123456789", "ghijklmnop")
    return table(spark, sf_dir, "supplier").select(F.concat(first, F.lit("name "), last, F.lit(" <x@y>")).alias("identity")).distinct()


@query(f"SELECT name, length(name) >= 5 AS is_full, token FROM (SELECT name, unnest(CASE WHEN regexp_matches(split_part(name, ' ', 1), '^[A-Za-z]+$') THEN [split_part(name, ' ', 1), split_part(name, ' ', 2)] ELSE [] END) AS token FROM (SELECT trim(regexp_replace(identity, '\\s*<.*$', '')) AS name FROM ({_NAMES})))".replace("\\\\", "\\"))
def name_tokens(spark, sf_dir):
    return identity.name_parts(_names(spark, sf_dir)).select("name", "is_full", F.explode("tokens").alias("token"))


#: Words of the fixtures' prose that serve as names, and their merged rule.
_FULL, _TOKENS = ["the of"], ["Then", "tion", "EREN"]


@query(r"SELECT doc_id, md5(replace(regexp_replace(regexp_replace(text, '([^A-Za-z0-9_])', chr(1) || '\1' || chr(1), 'g'), '(^|\x01)(?i:the\x01 \x01of|EREN|Then|tion)(\x01|$)', '\1Contributor\2', 'g'), chr(1), '')) AS redacted FROM documents")
def name_rule_redact(spark, sf_dir):
    """Boundaries are those of bytes; the SQL marks both sides of each character that is none of a word, so that neighbouring names don't share a mark."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.regexp_replace("text", redact.merged_name_pattern(_FULL, _TOKENS), "Contributor").cast("binary")).alias("redacted"))


@query("SELECT source, token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT source, doc_id, lower(unnest(regexp_extract_all(text, '(?i)erth|ingan|stea'))) AS token FROM documents) GROUP BY ALL")
def name_token_hits(spark, sf_dir):
    hits = table(spark, sf_dir, "documents").select("source", "doc_id", F.explode(detect.found(F.col("text"), "(?i)erth|ingan|stea")).alias("m"))
    return hits.groupBy("source", F.lower("m").alias("token")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("SELECT source, docs, place FROM (SELECT source, docs, row_number() OVER (ORDER BY docs DESC, source) AS place FROM (SELECT source, count(*) AS docs FROM documents WHERE regexp_matches(text, '(?i)ingan') GROUP BY source)) WHERE place <= 3")
def top_sources(spark, sf_dir):
    """A report of the three sources with most hits; only they meet in one task, which Spark keeps as a heap."""
    from pyspark.sql import Window

    top = table(spark, sf_dir, "documents").filter(F.col("text").rlike("(?i)ingan")).groupBy("source").agg(F.count(F.lit(1)).alias("docs")).orderBy(F.desc("docs"), "source").limit(3)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("docs"), "source")).cast("long"))


#: Secrets of many kinds, from numbers.
_SECRETS = "SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN md5(CAST(o_orderkey AS VARCHAR)) WHEN 1 THEN 'short' || CAST(o_orderkey % 10 AS VARCHAR) WHEN 2 THEN 'test-' || md5(CAST(o_orderkey AS VARCHAR)) WHEN 3 THEN 'AKIA' || upper(substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 16)) WHEN 4 THEN 'has a space in it' WHEN 5 THEN 'Your_Key_' || CAST(o_orderkey AS VARCHAR) WHEN 6 THEN 'xoxb-' || CAST(o_orderkey AS VARCHAR) || '==>plain' ELSE 'p0000000000' || CAST(o_orderkey AS VARCHAR) END AS secret FROM orders"


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    hashed = F.md5(key.cast("binary"))
    kinds = [hashed, F.concat(F.lit("short"), (F.col("o_orderkey") % 10).cast("string")), F.concat(F.lit("test-"), hashed), F.concat(F.lit("AKIA"), F.upper(F.substring(hashed, 1, 16))), F.lit("has a space in it"), F.concat(F.lit("Your_Key_"), key), F.concat(F.lit("xoxb-"), key, F.lit("==>plain"))]
    secret = F.concat(F.lit("p0000000000"), key)
    for i, kind in enumerate(kinds):
        secret = F.when(F.col("o_orderkey") % 8 == i, kind).otherwise(secret)
    return table(spark, sf_dir, "orders").select("o_orderkey", secret.alias("secret"))


def _false_sql(parts: tuple[str, ...]) -> str:
    return "(length(secret) < 12 OR contains(secret, ' ') OR " + " OR ".join(f"contains(lower(secret), '{p}')" for p in parts) + ")"


@query(f"SELECT {_false_sql(P.FALSE_SECRET_PARTS)} AS is_false, {_false_sql(P.FALSE_SECRET_PARTS_B64)} AS is_junk, regexp_matches(secret, '{P.STRUCTURED_SECRET}') AS structured, NOT contains(secret, '==>') AND NOT contains(secret, chr(10)) AS admissible, count(*) AS n FROM ({_SECRETS}) GROUP BY ALL")
def false_positive_secrets(spark, sf_dir):
    s = F.col("secret")
    kinds = [detect.is_false_secret(s).alias("is_false"), detect.is_false_secret(s, P.FALSE_SECRET_PARTS_B64).alias("is_junk"), s.rlike(P.STRUCTURED_SECRET).alias("structured"), detect.is_admissible_rule(s).alias("admissible")]
    return _secrets(spark, sf_dir).groupBy(*kinds).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, md5(replace(replace(text, ' the ', ' <A> '), 'tion', '$1')) AS redacted FROM documents")
def literal_list(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(redact.redact_literals(F.col("text"), [(" the ", " <A> "), ("tion", "$1")]).cast("binary")).alias("redacted"))


@query("SELECT lhs, min(ordinal) AS ordinal FROM (SELECT p_name AS lhs, p_partkey AS ordinal FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_name, 1000000 + p_partkey FROM part) GROUP BY lhs")
def rule_merge_dedup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    old = part.filter("p_partkey % 3 = 0").select(F.col("p_name").alias("lhs"), F.col("p_partkey").alias("ordinal"))
    new = part.select(F.col("p_name").alias("lhs"), (1_000_000 + F.col("p_partkey")).alias("ordinal"))
    return identity.merged_rules(old, new)


def _variant_sql(pad: int) -> str:
    zeros = "\\x00" * pad
    cut = f"substr(to_base64('{zeros}'::BLOB || encode(secret)), {[1, 3, 4][pad]})"
    return f"CASE WHEN length({cut}) > 8 THEN substr({cut}, 1, length({cut}) - CASE WHEN length({cut}) % 4 = 0 THEN 4 ELSE length({cut}) % 4 END) ELSE {cut} END"



@query(f"SELECT o_orderkey, unnest(list_filter([{', '.join(map(_variant_sql, range(3)))}], lambda v: length(v) >= 16)) AS variant FROM ({_SECRETS}) WHERE NOT {_false_sql(P.FALSE_SECRET_PARTS_B64)}")
def b64_variants(spark, sf_dir):
    """What secrets look like inside base64 at all alignments."""
    real = _secrets(spark, sf_dir).filter(~detect.is_false_secret(F.col("secret"), P.FALSE_SECRET_PARTS_B64))
    return real.select("o_orderkey", F.explode(redact.base64_variants(F.col("secret"))).alias("variant"))


@query("SELECT c_custkey, md5(replace(replace(c_name || ' JOHN-smith / acme corp', 'JOHN-smith', 'Person A'), 'acme corp', 'Company B')) AS masked FROM customer")
def mask_map(spark, sf_dir):
    mask = redact.map_masker({"John Smith": "Person A", "Smith": "Person C", "Acme Corp": "Company B"})
    return table(spark, sf_dir, "customer").select("c_custkey", mask(F.concat("c_name", F.lit(" JOHN-smith / acme corp"))).alias("m")).select("c_custkey", F.md5(F.col("m").cast("binary")).alias("masked"))


@query("SELECT s_suppkey, repeat('X', CAST(length('212-555-' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0')) AS INT)) || ' and on' AS masked FROM supplier")
def phone_blank(spark, sf_dir):
    text = F.concat(F.lit("212-555-"), F.lpad((F.col("s_suppkey") % 10000).cast("string"), 4, "0"), F.lit(" and on"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", redact.blank_matches(text, P.OPS_PHONE).alias("masked"))
