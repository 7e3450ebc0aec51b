"""Detectors, findings and redactions over documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import detect, patterns as P, redact
from ..operators import gates, history, pseudonym
from ..session import table
from .registry import query

#: SQL of a card number's tests, for a string of digits d.
_LUHN = "list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 0 THEN (CAST(substr(d, length(d) + 1 - i, 1) AS INT) * 2) // 10 + (CAST(substr(d, length(d) + 1 - i, 1) AS INT) * 2) % 10 ELSE CAST(substr(d, length(d) + 1 - i, 1) AS INT) END)) % 10 = 0"
_IS_CARD = f"length(d) IN (13,14,15,16,19) AND d NOT IN ({', '.join(repr(c) for c in P.TEST_CARDS)}) AND len(list_distinct(string_split(d, ''))) > 4 AND {_LUHN} AND substr(d,1,1) IN ('3','4','5','6')"
_CARDS = f"SELECT doc_id, lang, source, d FROM (SELECT doc_id, lang, source, regexp_replace(m, '[ -]', '', 'g') AS d FROM (SELECT doc_id, lang, source, unnest(regexp_extract_all(text, '\\b(?:\\d[ -]?){{12,18}}\\d\\b')) AS m FROM documents)) WHERE {_IS_CARD}"
_CREDENTIAL = r"""(?i)(?:password|passwd|pwd|secret|api[_-]?key|token|storepassword|keypassword)["'']?\s*[:=]\s*["'']([^"''\s${}<>]{8,80})["'']"""
_URL_CREDENTIAL = r"""(?i)\b[a-z][a-z0-9+.-]{2,15}://[^\s:@/"'']{1,40}:([^\s:@/"'']{4,60})@"""
_PHONE = r"\b(?:\+?1[ -]?)?\(?[2-9]\d{2}\)?[ -]?\d{3}[ -]?\d{4}\b"
_EMAIL = P.EMAIL
#: Appended to texts, as the fixtures hold no credentials: every format follows from the id.
_KEYS = {
    "sk-ant-": "md5(k)", "sk-proj-": "md5(k)", "sk-": "md5(k)", "EAAA": "md5(k)", "AKIA": "upper(substr(md5(k),1,16))", "AIza": "concat(md5(k),'abc')", "ghp_": "concat(md5(k),'abcd')", "xoxb-": "md5(k)", "sk_live_": "md5(k)", "SK": "md5(k)", "AC": "md5(k)",
}
_INJECTED = "concat(text, ' ', " + ", ' ', ".join(f"'{prefix}', {body}" for prefix, body in _KEYS.items()) + ", ' eyJ', md5(k), '.eyJ', md5(k), '.', md5(k))"
_PEM = "concat(text, chr(10), '-----BEGIN RSA PRIVATE KEY-----', chr(10), md5(k), chr(10), md5(k), chr(10), '-----END RSA PRIVATE KEY-----', chr(10), 'after')"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).withColumn("k", F.col("doc_id").cast("string")).withColumn("text", F.expr(_INJECTED))


_WITH_KEYS = f"(SELECT doc_id, {_INJECTED} AS text FROM (SELECT doc_id, text, CAST(doc_id AS VARCHAR) AS k FROM documents))"


@query(f"SELECT lang, count(*) AS pans, count(DISTINCT doc_id) AS docs FROM ({_CARDS}) GROUP BY lang")
def pan_by_lang(spark, sf_dir):
    cards = _docs(spark, sf_dir).select("lang", "doc_id", F.explode(detect.card_numbers(F.col("text"))).alias("d"))
    return cards.groupBy("lang").agg(F.count(F.lit(1)).alias("pans"), F.count_distinct("doc_id").alias("docs"))


@query(f"SELECT doc_id, unnest(regexp_extract_all(text, '{P.EMAIL}')) AS email FROM documents")
def email_extract(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.explode(detect.found(F.col("text"), P.EMAIL)).alias("email"))


@query(f"SELECT page_id, unnest(regexp_extract_all(html, '{_PHONE}')) AS phone FROM pages UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '{_PHONE}')) FROM documents")
def phone_nanp(spark, sf_dir):
    of = lambda df, key, text: df.select(F.col(key).alias("page_id"), F.explode(detect.found(F.col(text), P.PHONE)).alias("phone"))
    return of(table(spark, sf_dir, "pages"), "page_id", "html").union(of(_docs(spark, sf_dir), "doc_id", "text"))


#: Digits beyond ASCII, which the fixtures lack: Devanagari and full-width ones.
_OTHER_DIGITS = "' \u0967\u0968\u0969\u096a\u096b\u096c\u096d\u096e\u096f\u0966 \uff12\uff11\uff12-555-\uff11\uff12\uff13\uff14 x'"
#: The text with a mark on both sides of each character that is no digit, full stop or hyphen, so that neighbouring matches don't share a boundary.
_MARKED = f"regexp_replace(concat(text, {_OTHER_DIGITS}), '([^\\p{{Nd}}.\\-])', chr(1) || '\\1' || chr(1), 'g')".replace("\\\\", "\\")
_OPS_PHONE_SQL = r"(?:^|\x01)((?:(?:\x01\+\x01)?\p{Nd}{1,3}(?:\x01 \x01|-)?)?(?:\x01\(\x01)?\p{Nd}{3}(?:\x01\)\x01)?(?:\x01 \x01|-)?\p{Nd}{3}(?:\x01 \x01|-)?\p{Nd}{4})(?:\x01|$)"


def _with_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).withColumn("text", F.concat("text", F.expr(_OTHER_DIGITS)))


@query(f"SELECT doc_id, m AS number FROM (SELECT doc_id, unnest(regexp_extract_all(concat(text, {_OTHER_DIGITS}), '[\\p{{Nd}}.]+')) AS m FROM documents) WHERE regexp_full_match(m, '\\p{{Nd}}{{9,19}}')".replace("\\\\", "\\"))
def longnum_extract(spark, sf_dir):
    return _with_digits(spark, sf_dir).select("doc_id", F.explode(detect.found(F.col("text"), P.OPS_LONG_NUMBER)).alias("number"))


@query(f"SELECT doc_id, replace(unnest(regexp_extract_all({_MARKED}, '{_OPS_PHONE_SQL}', 1)), chr(1), '') AS phone FROM documents")
def phone_ops(spark, sf_dir):
    return _with_digits(spark, sf_dir).select("doc_id", F.explode(detect.found(F.col("text"), P.OPS_PHONE)).alias("phone"))


@query(f"SELECT doc_id, unnest(regexp_extract_all(text, '{_CREDENTIAL}', 1)) AS value FROM documents")
def credential_plain(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.explode(detect.found(F.col("text"), P.QUOTED_CREDENTIAL, 1)).alias("value"))


@query(f"SELECT regexp_matches(value, '{P.PLACEHOLDER}') AS placeholder, count(*) AS n FROM (SELECT unnest(regexp_extract_all(concat(text, ' password = \"', md5(CAST(doc_id AS VARCHAR)), 'Z\"'), '{_CREDENTIAL}', 1)) AS value FROM documents) GROUP BY 1")
def placeholder_filter(spark, sf_dir):
    text = F.concat("text", F.lit(' password = "'), F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit('Z"'))
    values = _docs(spark, sf_dir).select(F.explode(detect.found(text, P.QUOTED_CREDENTIAL, 1)).alias("value"))
    return values.groupBy(detect.is_placeholder(F.col("value")).alias("placeholder")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, value FROM (SELECT doc_id, unnest(regexp_extract_all(concat(text, ' postgres://app:', substr(md5(CAST(doc_id AS VARCHAR)),1,6), 'Q@db/x ftp://u:changeme@h'), '{_URL_CREDENTIAL}', 1)) AS value FROM documents) WHERE NOT regexp_matches(value, '{P.PLACEHOLDER}')")
def url_credential(spark, sf_dir):
    text = F.concat("text", F.lit(" postgres://app:"), F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 6), F.lit("Q@db/x ftp://u:changeme@h"))
    return _docs(spark, sf_dir).select("doc_id", F.explode(detect.url_credentials(text)).alias("value"))


@query("""SELECT source, sum(len(regexp_extract_all(concat(text, ' "CVV": "', CAST(100 + doc_id % 900 AS VARCHAR), '" cvv2=', CAST(doc_id % 10 AS VARCHAR)), '(?i)["'']?cvv2?["'']?\\s*[:=]\\s*["'']?\\d{3,4}["'']?')))::BIGINT AS n FROM documents GROUP BY source""".replace("\\\\", "\\"))
def cvv_fields(spark, sf_dir):
    text = F.concat("text", F.lit(' "CVV": "'), (100 + F.col("doc_id") % 900).cast("string"), F.lit('" cvv2='), (F.col("doc_id") % 10).cast("string"))
    return _docs(spark, sf_dir).groupBy("source").agg(F.sum(F.regexp_count(text, F.lit(P.CVV))).alias("n"))


@query(r"""SELECT doc_id % 3 = 0 AS is_binary, sum(CASE WHEN doc_id % 3 = 0 THEN len(regexp_extract_all(t, '[A-Za-z]:\\[A-Za-z0-9 _.\\-]{6,120}')) ELSE 0 END)::BIGINT AS windows_paths, sum(CASE WHEN doc_id % 3 = 0 THEN len(regexp_extract_all(t, '(?:/Users/|/home/)[A-Za-z][A-Za-z0-9._-]{2,20}')) ELSE 0 END)::BIGINT AS home_paths FROM (SELECT doc_id, concat('C:\Users\dev\x', CAST(doc_id AS VARCHAR), '.pdb|/home/dev', CAST(doc_id AS VARCHAR), '|', text) AS t FROM documents) GROUP BY 1""")
def paths_in_binary(spark, sf_dir):
    text = F.concat(F.lit("C:\\Users\\dev\\x"), F.col("doc_id").cast("string"), F.lit(".pdb|/home/dev"), F.col("doc_id").cast("string"), F.lit("|"), "text")
    content = F.concat(F.when(F.col("doc_id") % 3 == 0, F.lit(bytearray(b"\x00"))).otherwise(F.lit(bytearray())), text.cast("binary"))
    blobs = _docs(spark, sf_dir).select(content.alias("content")).withColumn("is_binary", detect.is_binary(F.col("content"))).withColumn("t", F.decode("content", "ISO-8859-1"))
    n = lambda p: F.sum(F.when(F.col("is_binary"), F.regexp_count("t", F.lit(p))).otherwise(0))
    return blobs.groupBy("is_binary").agg(n(P.WINDOWS_PATH).alias("windows_paths"), n(P.HOME_PATH).alias("home_paths"))


_FORMAT_SUMS = ", ".join(f"sum(len(regexp_extract_all(text, '{p}')))::BIGINT AS f{i}" for i, (p, _) in enumerate(P.CREDENTIAL_FORMATS))


@query(f"SELECT count(*) AS docs, {_FORMAT_SUMS} FROM {_WITH_KEYS}")
def credential_formats(spark, sf_dir):
    marked = _with_keys(spark, sf_dir).filter(detect.has_any(F.col("text"), P.MARKERS))
    return marked.agg(F.count(F.lit(1)).alias("docs"), *(F.sum(F.regexp_count("text", F.lit(p))).alias(f"f{i}") for i, (p, _) in enumerate(P.CREDENTIAL_FORMATS)))


_REDACTED_SQL = "text"
for _p, _mark in P.CREDENTIAL_FORMATS:
    _REDACTED_SQL = f"regexp_replace({_REDACTED_SQL}, '{_p}', '{_mark}', 'g')"


@query(f"SELECT doc_id, md5({_REDACTED_SQL}) AS redacted FROM {_WITH_KEYS}")
def redact_formats(spark, sf_dir):
    return _with_keys(spark, sf_dir).select("doc_id", F.md5(redact.redact_credentials(F.col("text")).cast("binary")).alias("redacted"))


@query(f"SELECT doc_id, md5(concat(text, chr(10), 'REDACTED_PRIVATE_KEY', chr(10), chr(10), chr(10), chr(10), 'after')) AS redacted, (length(text) - length(replace(text, chr(10), '')) + 5)::BIGINT AS lines FROM documents")
def pem_redaction(spark, sf_dir):
    out = _docs(spark, sf_dir).withColumn("k", F.col("doc_id").cast("string")).withColumn("text", redact.redact_private_keys(F.expr(_PEM)))
    return out.select("doc_id", F.md5(F.col("text").cast("binary")).alias("redacted"), detect.newlines(F.col("text")).cast("long").alias("lines"))


#: Documents as blobs of repositories by language; paths of two kinds.
_PATH = "concat(source, CASE WHEN doc_id % 2 = 0 THEN '/dumps/' ELSE '/src/' END, 'f', CAST(doc_id % 7 AS STRING), CASE WHEN doc_id % 5 = 0 THEN '.sql' WHEN doc_id % 11 = 0 THEN '.p12' ELSE '.txt' END)"
_TEXT = "concat(text, ' pwd=\"x', md5(CAST(doc_id AS STRING)), 'Z\"')"
_FOUND_SQL = f"""
(WITH b AS (SELECT doc_id, lang AS repo, {_PATH} AS path, {_TEXT} AS text FROM documents),
 c AS (SELECT repo, path, 'card number' AS class, CAST(count(*) AS BIGINT) AS n FROM (SELECT b.repo, b.path, b.doc_id, regexp_replace(m, '[ -]', '', 'g') AS d FROM (SELECT *, unnest(regexp_extract_all(text, '\\b(?:\\d[ -]?){{12,18}}\\d\\b')) AS m FROM b) b) WHERE {_IS_CARD} GROUP BY repo, path, doc_id
 UNION ALL SELECT repo, path, 'credential', count(*) FROM (SELECT repo, path, doc_id, unnest(regexp_extract_all(text, '{_CREDENTIAL}', 1)) AS v FROM b) WHERE NOT regexp_matches(v, '{P.PLACEHOLDER}') GROUP BY repo, path, doc_id
 UNION ALL SELECT repo, path, 'artefact', 1 FROM b WHERE regexp_matches(path, '{P.ARTEFACT_PATH}')
 UNION ALL SELECT repo, path, 'cvv', len(regexp_extract_all(text, '(?i)cvv')) FROM b WHERE false)
 SELECT * FROM c)"""


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    blobs = _docs(spark, sf_dir).select(F.col("lang").alias("repo"), F.expr(_PATH).alias("path"), F.expr(_TEXT).alias("text"))
    return history.findings(blobs, history.class_counts(F.col("text"), F.col("path")), ["repo", "path"])


@query(f"SELECT repo, class, CAST(sum(n) AS BIGINT) AS n, count(DISTINCT path) AS paths FROM {_FOUND_SQL} GROUP BY ROLLUP(repo, class)")
def findings_rollup(spark, sf_dir):
    return history.rolled_up(_found(spark, sf_dir))


@query(f"SELECT repo, class, path, n, place FROM (SELECT *, row_number() OVER (PARTITION BY repo, class ORDER BY n DESC, path) AS place FROM (SELECT repo, class, path, CAST(sum(n) AS BIGINT) AS n FROM {_FOUND_SQL} GROUP BY ALL)) WHERE place <= 6")
def top_paths(spark, sf_dir):
    return history.top_paths(_found(spark, sf_dir))


@query(f"""SELECT source, lines, people, lines > 200 AND people > 20 AS bulk FROM (SELECT source, (length(t) - length(replace(t, chr(10), '')))::BIGINT AS lines, (len(list_distinct(regexp_extract_all(t, '{_EMAIL}'))) + len(list_distinct(regexp_extract_all(t, '{_PHONE}'))))::BIGINT AS people FROM (SELECT source, string_agg(concat(text, chr(10), 'u', CAST(doc_id AS VARCHAR), '@mail.example'), chr(10) ORDER BY doc_id) AS t FROM documents GROUP BY source))""")
def bulk_personal(spark, sf_dir):
    """A source's documents as one dump."""
    rows = _docs(spark, sf_dir).select("source", F.concat("text", F.lit("\nu"), F.col("doc_id").cast("string"), F.lit("@mail.example")).alias("t"))
    return history.bulk_dumps(rows, "source", "t")


@query(f"SELECT doc_id, unnest(regexp_extract_all(text, '{P.OPS_API_KEY}')) AS key FROM {_WITH_KEYS}")
def api_keys_ops(spark, sf_dir):
    return _with_keys(spark, sf_dir).select("doc_id", F.explode(detect.found(F.col("text"), P.OPS_API_KEY)).alias("key"))


@query(r"""SELECT doc_id, md5(regexp_replace(concat(text, ' Password is "', md5(CAST(doc_id AS VARCHAR)), '", pass: abc'), '(?i)((?:password|passwd|pwd|pass)\s*(?:is|:|=|-)\s*["'']?)([^\s"''\\,;<>]{6,40})', '\1REDACTED_CREDENTIAL', 'g')) AS redacted FROM documents""")
def spoken_password(spark, sf_dir):
    text = F.concat("text", F.lit(' Password is "'), F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit('", pass: abc'))
    return _docs(spark, sf_dir).select("doc_id", F.md5(redact.redact_ops_passwords(text).cast("binary")).alias("redacted"))


@query(r"""SELECT page_id, regexp_replace(concat(url, CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END, 'token=', md5(url), '&z=1'), '(https?://[^\s"''<>]*?[?&](?:key|token|auth|password|secret|session)=)[^\s"''<>&]+', '\1REDACTED', 'g') AS url FROM pages""")
def token_url(spark, sf_dir):
    url = F.concat("url", F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("token="), F.md5(F.col("url").cast("binary")), F.lit("&z=1"))
    return table(spark, sf_dir, "pages").select("page_id", redact.redact_token_urls(url).alias("url"))


@query(f"SELECT regexp_matches(path, '{P.BULK_PATH}') AS bulk, regexp_matches(path, '{P.ARTEFACT_PATH}') AS artefact, count(*) AS n FROM (SELECT {_PATH} AS path FROM documents) GROUP BY ALL")
def path_classes(spark, sf_dir):
    path = F.col("path")
    return _docs(spark, sf_dir).select(F.expr(_PATH).alias("path")).groupBy(path.rlike(P.BULK_PATH).alias("bulk"), path.rlike(P.ARTEFACT_PATH).alias("artefact")).agg(F.count(F.lit(1)).alias("n"))


_TREE = "concat(CASE WHEN doc_id % 4 = 0 THEN 'app/vendor/' WHEN doc_id % 4 = 1 THEN 'src/' ELSE '' END, 'm', CAST(doc_id AS STRING), CASE WHEN doc_id % 3 = 0 THEN '.PY' WHEN doc_id % 3 = 1 THEN '.exe' ELSE '' END)"


@query(f"SELECT doc_id, path FROM (SELECT doc_id, {_TREE} AS path, strlen(text) AS size FROM documents) WHERE path NOT LIKE '%vendor/%' AND NOT path LIKE '%.exe' AND size <= 2000000")
def tree_filter(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.expr(_TREE).alias("path"), F.octet_length("text").alias("size")).filter(detect.is_read_source(F.col("path"), F.col("size"))).select("doc_id", "path")


@query(f"SELECT doc_id, replace(regexp_extract(text, '(?s).{{0,40}}(?:{P.EMAIL}).{{0,40}}'), chr(10), ' ') AS snippet FROM documents WHERE regexp_matches(text, '{P.EMAIL}')")
def context_snippet(spark, sf_dir):
    return _docs(spark, sf_dir).filter(F.col("text").rlike(P.EMAIL)).select("doc_id", detect.context_snippet(F.col("text"), P.EMAIL).alias("snippet"))


_FIRST_SEEN = """SELECT value, row_number() OVER (ORDER BY doc_id, pos) AS n FROM (SELECT {key} AS value, min(doc_id) AS doc_id, arg_min(pos, (doc_id, pos)) AS pos FROM (SELECT doc_id, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS pos FROM (SELECT doc_id, {ms} AS ms FROM documents)) GROUP BY 1)"""
_EMAIL_SEEN = _FIRST_SEEN.format(key="lower(m)", ms=f"regexp_extract_all(text, '{P.EMAIL}')")
_NUMBER_SEEN = _FIRST_SEEN.format(key="m", ms="list_filter(regexp_extract_all(text, '[0-9.]+'), lambda x: regexp_full_match(x, '[0-9]{9,19}'))")


@query(f"SELECT value, 'person' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END || '@example.com' AS replacement FROM ({_EMAIL_SEEN})")
def email_pseudonym(spark, sf_dir):
    return pseudonym.email_names(_docs(spark, sf_dir), "doc_id", "text")


@query(f"SELECT value, CAST(CAST(rpad('1', CAST(length(value) AS INT), '0') AS HUGEINT) + n - 1 AS VARCHAR) AS replacement FROM ({_NUMBER_SEEN})")
def number_mint(spark, sf_dir):
    return pseudonym.minted_numbers(_docs(spark, sf_dir), "doc_id", "text")


@query()  # steps with look-around; tested against a plain version row by row
def mask_pipeline(spark, sf_dir):
    return pseudonym.mask_exports(_docs(spark, sf_dir).select("doc_id", "text"), "doc_id", "text").select("doc_id", F.md5(F.col("text").cast("binary")).alias("masked"))


@query(r"SELECT page_id, host, 'host' || CAST(dense_rank() OVER (ORDER BY host) AS VARCHAR) || '.invalid' AS replacement FROM (SELECT page_id, lower(regexp_extract(url, '(?i)https?://([A-Za-z0-9.-]+)', 1)) AS host FROM pages) WHERE host NOT LIKE 'www.%'")
def host_pseudonyms(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    host = F.lower(F.regexp_extract("url", r"(?i)https?://([A-Za-z0-9.-]+)", 1))
    allowed = pages.select(host.alias("host")).filter(F.col("host").startswith("www.")).distinct()
    names = pseudonym.unlisted_hosts(pages, "url", allowed)
    return pages.select("page_id", host.alias("host")).join(names, "host").select("page_id", "host", "replacement")


_CANON = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"


@query(f"SELECT doc_id, md5({_CANON.format('text')}) AS canon FROM documents")
def canonical_form(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(detect.canonical(F.col("text")).cast("binary")).alias("canon"))


@query(f"SELECT DISTINCT b.text AS value, d.doc_id AS doc FROM benchmark b JOIN documents d ON contains({_CANON.format('d.text')}, {_CANON.format('b.text')}) WHERE length(regexp_replace(b.text, '[^A-Za-z0-9]', '', 'g')) >= 5")
def output_search_loose(spark, sf_dir):
    return gates.needle_hits(_docs(spark, sf_dir), "doc_id", "text", table(spark, sf_dir, "benchmark"), "text", mode="loose").select("value", "doc")


_ANCHORED = "'(?i)(?:^|[^A-Za-z0-9])' || array_to_string(regexp_extract_all(value, '[A-Za-z0-9]+'), '[^A-Za-z0-9]{0,3}') || '(?:$|[^A-Za-z0-9])'"


@query(f"SELECT value, doc FROM (SELECT DISTINCT b.text AS value, d.doc_id AS doc, d.text AS body FROM benchmark b JOIN documents d ON contains({_CANON.format('d.text')}, {_CANON.format('b.text')}) WHERE length(regexp_replace(b.text, '[^A-Za-z0-9]', '', 'g')) >= 5) WHERE regexp_matches(body, {_ANCHORED})")
def output_search_anchored(spark, sf_dir):
    return gates.needle_hits(_docs(spark, sf_dir), "doc_id", "text", table(spark, sf_dir, "benchmark"), "text").select("value", "doc")


@query(f"SELECT 'card number' AS gate, count(*) AS checked, count_if(doc_id IN (SELECT doc_id FROM ({_CARDS})))::BIGINT AS violations, 'FAIL' AS verdict FROM documents UNION ALL SELECT 'no documents', 0, 0, 'UNPROVEN' UNION ALL SELECT 'replacement character', count(*), 0, 'PASS' FROM documents")
def gate_verdicts(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    cards = gates.gate("card number", docs, F.size(detect.card_numbers(F.col("text"))) > 0)
    none = gates.gate("no documents", docs.filter("doc_id < 0"), F.lit(True))
    return cards.union(none).union(gates.gate("replacement character", docs, F.col("text").contains("\ufffd")))
