"""Histories, medical records, archives, sound and pictures from end to end, and the verdicts on them. Each verdict has violations seeded in what it checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import detect, patterns as P, redact
from ..operators import audio, delivery, gates, history, images, records, speech
from ..session import cut_lineage, spread, table
from .delivery import SECRET
from .registry import ORACLES, query
from .speech import _WORDS, _gazetteer, _words, script_quality
from .text import _CARDS, _IS_CARD

# --- histories --------------------------------------------------------------------------------------------
_OBJECTS = "(SELECT DISTINCT lang AS repo, md5(text) AS sha, text FROM documents WHERE doc_id % 13 <> 0 AND doc_id % 17 <> 0)"
_PATHS = "(SELECT lang AS repo, md5(text) AS sha, min(source || '/f' || CAST(doc_id % 7 AS VARCHAR)) AS path FROM documents WHERE doc_id % 3 <> 0 GROUP BY ALL)"


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as objects by the digest of their text; some are trees, some too large, some without a path."""
    docs = table(spark, sf_dir, "documents")
    size = F.when(F.col("doc_id") % 17 == 0, P.MOST_BLOB_BYTES + 1).otherwise(F.octet_length("text")).cast("long")
    own = docs.select(F.col("lang").alias("repo"), F.md5(F.col("text").cast("binary")).alias("sha"), F.when(F.col("doc_id") % 13 == 0, "tree").otherwise("blob").alias("type"), size.alias("size"), F.col("text").cast("binary").alias("content"))
    paths = docs.filter("doc_id % 3 <> 0").select(F.col("lang").alias("repo"), F.md5(F.col("text").cast("binary")).alias("sha"), F.concat("source", F.lit("/f"), (F.col("doc_id") % 7).cast("string")).alias("path"))
    return history.with_paths(history.readable_blobs(own), paths)


@query(f"SELECT repo, path, count(*) AS n FROM (SELECT o.repo, coalesce(p.path, '<unreachable>') AS path, regexp_replace(m, '[ -]', '', 'g') AS d FROM (SELECT *, unnest(regexp_extract_all(text, '\\b(?:\\d[ -]?){{12,18}}\\d\\b')) AS m FROM {_OBJECTS}) o LEFT JOIN {_PATHS} p ON o.repo = p.repo AND o.sha = p.sha) WHERE {_IS_CARD} GROUP BY ALL")
def history_scan(spark, sf_dir):
    """Objects of a history, each content once, joined to their paths and scanned; the SQL holds the card numbers."""
    blobs = _history(spark, sf_dir).withColumn("text", F.col("content").cast("string"))
    found = history.findings(blobs, history.class_counts(F.col("text"), F.col("path"), detect.is_binary(F.col("content"))), ["repo", "path"])
    return found.filter("class = 'card number'").groupBy("repo", "path").agg(F.sum("n").alias("n"))


_MESSAGES = "(SELECT o_orderkey, o_orderpriority AS repo, 'Merge ' || o_orderpriority || ' by Ann Lee, lee and Leeds; key ' || CASE WHEN o_orderkey % 5 = 0 THEN 'hunter22hunter' ELSE 'none' END AS message FROM orders)"


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("o_orderkey") % 5 == 0, "hunter22hunter").otherwise("none")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("repo"), F.concat(F.lit("Merge "), "o_orderpriority", F.lit(" by Ann Lee, lee and Leeds; key "), key).alias("message"))


@query(f"SELECT o_orderkey, regexp_replace(replace(message, 'hunter22hunter', '***'), '(?i)\\b(?:Ann Lee|Lee)\\b', 'Contributor', 'g') AS message FROM {_MESSAGES}".replace("\\\\", "\\"))
def message_rewrite(spark, sf_dir):
    pattern = redact.merged_name_pattern(["Ann Lee"], ["Lee"])
    return history.rewritten_messages(_messages(spark, sf_dir), "message", pattern, "Contributor", [("hunter22hunter", "***")]).select("o_orderkey", "message")


@query(f"SELECT repo, lower(m) AS token, count(*) AS n FROM (SELECT repo, unnest(regexp_extract_all(message, '(?i)ann|lee|urgent')) AS m FROM {_MESSAGES}) GROUP BY ALL")
def message_names(spark, sf_dir):
    return history.name_tokens(_messages(spark, sf_dir), "message", ["ann", "lee", "urgent"], "repo")


_FILES = "concat(source, '/d', CAST(doc_id % 5 AS STRING), CASE WHEN doc_id % 4 = 0 THEN '/vendor' ELSE '' END, '/', CASE WHEN doc_id % 3 = 0 THEN 'John' ELSE 'm' END, CAST(doc_id AS STRING), '.txt')"


@query(f"SELECT repo, count(*) AS n FROM (SELECT DISTINCT source AS repo, array_to_string(list_slice(parts, 1, i), '/') AS place, parts[i] AS name FROM (SELECT source, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT source, string_split({_FILES}, '/') AS parts FROM documents))) WHERE regexp_matches(name, '(?i)john|d3') AND NOT contains(place, 'vendor') GROUP BY repo ORDER BY n DESC, repo LIMIT 3")
def token_paths(spark, sf_dir):
    """The three sources with most names in paths: a report."""
    return history.token_paths(table(spark, sf_dir, "documents").select(F.col("source").alias("repo"), F.expr(_FILES).alias("path")), ["john", "d3"], most=3)


# --- verdicts on deliveries -------------------------------------------------------------------------------
@query("SELECT 'clones' AS gate, count(*) AS checked, count_if(c_nationkey = 0 OR n IS NULL)::BIGINT AS violations, CASE WHEN count_if(c_nationkey = 0 OR n IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey UNION ALL SELECT 'clones', 0, 0, 'UNPROVEN'")
def gate_clones(spark, sf_dir):
    commits = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("commits"))
    repos = table(spark, sf_dir, "customer").join(commits, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("repo"), F.col("c_nationkey").alias("refs"), F.coalesce("commits", F.lit(0)).alias("commits"))
    return gates.clone_gate(repos).union(gates.clone_gate(repos.filter("repo < 0")))


_COMMITS = "(SELECT 'r' || CAST(o_custkey % 40 AS VARCHAR) AS repo, CASE WHEN o_custkey % 40 = 7 THEN 'Real Name' || CAST(o_custkey % 3 AS VARCHAR) ELSE 'Contributor ' || CAST(o_custkey AS VARCHAR) END AS author FROM orders)"


@query(f"SELECT repo, count(*) AS commits, count(DISTINCT author) AS authors, count(DISTINCT CASE WHEN author NOT LIKE 'Contributor %' THEN author END) AS residual, CASE WHEN repo = 'r9' THEN 2 ELSE 0 END::BIGINT AS remotes, CASE WHEN repo = 'r9' OR count(CASE WHEN author NOT LIKE 'Contributor %' THEN 1 END) > 0 THEN 'REVIEW' ELSE 'OK' END AS status FROM {_COMMITS} GROUP BY repo")
def package_manifest(spark, sf_dir):
    key = F.col("o_custkey")
    repo = F.concat(F.lit("r"), (key % 40).cast("string"))
    author = F.when(key % 40 == 7, F.concat(F.lit("Real Name"), (key % 3).cast("string"))).otherwise(F.concat(F.lit("Contributor "), key.cast("string")))
    commits = table(spark, sf_dir, "orders").select(repo.alias("repo"), author.alias("author"))
    from ..operators.identity import LABEL

    residual = commits.filter(~F.col("author").rlike(LABEL)).select("repo", F.col("author").alias("name"))
    return delivery.manifest(commits, residual, spark.createDataFrame([("r9",), ("r9",)], "repo string"))


@query("""WITH n AS (SELECT count(*) AS docs FROM documents), h AS (SELECT coalesce(sum(len(regexp_extract_all(text, '(?i)ingan'))), 0) AS hits FROM documents), p AS (SELECT count(DISTINCT doc_id) AS hits FROM documents WHERE doc_id % 3 = 0 AND doc_id % 4 <> 0),
 c AS (SELECT count(*) AS checked, count_if(b.n IS NULL OR a.n <> b.n) AS bad FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY 1) b ON a.o_custkey = b.o_custkey)
SELECT 'names' AS gate, docs AS checked, hits::BIGINT AS violations, CASE WHEN hits > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM n, h UNION ALL SELECT 'integrity', checked, bad::BIGINT, CASE WHEN bad > 0 THEN 'FAIL' ELSE 'PASS' END FROM c UNION ALL SELECT 'syntax', 0, 0, 'UNPROVEN' UNION ALL SELECT 'paths', docs, hits, CASE WHEN hits > 0 THEN 'FAIL' ELSE 'PASS' END FROM n, p""")
def gate_delivery(spark, sf_dir):
    docs, orders = table(spark, sf_dir, "documents"), table(spark, sf_dir, "orders")
    by_repo = lambda df: df.groupBy(F.col("o_custkey").alias("repo")).agg(F.count(F.lit(1)).alias("commits"))
    names = history.name_tokens(docs, "text", ["ingan"])
    paths = history.token_paths(docs.select(F.col("source").alias("repo"), F.expr(_FILES).alias("path")), ["john"])
    return gates.delivery_gates(names, docs, gates.commit_counts(by_repo(orders), by_repo(orders.filter("o_orderkey % 50 <> 0"))), paths)


@query(f"SELECT 'history' AS gate, (SELECT count(*) FROM documents) AS checked, count(*) AS violations, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM ({_CARDS}) UNION ALL SELECT 'secrets', count(*), 0, 'PASS' FROM documents UNION ALL SELECT 'secrets', 0, 0, 'UNPROVEN'")
def gate_history(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = lambda n: docs.select(n.cast("long").alias("n"))
    pem = found(F.regexp_count("text", F.lit(P.PEM)))
    none = docs.filter("doc_id < 0")
    return gates.findings_gate("history", docs, found(F.size(detect.card_numbers(F.col("text"))))).union(gates.findings_gate("secrets", docs, pem)).union(gates.findings_gate("secrets", none, pem.filter("n < 0")))


# --- medical records --------------------------------------------------------------------------------------
def _record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer as a record: names at two depths, UIDs of several kinds and values, a date, a private element, a repeated original."""
    e = lambda tag, vr, keyword, value: F.concat(F.lit(f'"{tag}":{{"vr":"{vr}","keyword":"{keyword}","Value":['), value, F.lit("]}"))
    text = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    k = F.col("c_custkey")
    name = F.concat(F.lit('{"Alphabetic":"'), "c_name", F.lit('"}'))
    uids = F.concat(text(F.lit("1.2.3."), (k + 1).cast("string")), F.lit(","), text(F.lit("1.2.3."), (k + 2).cast("string")))
    item = F.concat(F.lit("{"), e("00081155", "UI", "ReferencedSOPInstanceUID", text(F.lit("1.2.3."), (k + 1).cast("string"))), F.lit(","), e("00100010", "PN", "PatientName", name), F.lit("}"))
    whole = F.concat(
        F.lit("{"), e("00100010", "PN", "PatientName", name), F.lit(","), e("00080016", "UI", "SOPClassUID", F.when(k % 3 == 0, text(F.lit(P.SECONDARY_CAPTURE[0]))).otherwise(text(F.lit("1.2.840.10008.5.1.4.1.1.2")))), F.lit(","),
        e("00080018", "UI", "SOPInstanceUID", text(F.lit("1.2.3."), k.cast("string"))), F.lit(","), e("0020000D", "UI", "StudyInstanceUID", uids), F.lit(","), e("00080020", "DA", "StudyDate", text(F.lit("20200131"))), F.lit(","),
        F.lit('"00290010":{"vr":"LO","keyword":"PrivateCreator","Value":["x"]},'), e("0040A730", "SQ", "ContentSequence", item), F.lit(","), e("04000561", "SQ", "OriginalAttributesSequence", item), F.lit("}"),
    )
    return spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey").select(F.concat(F.lit("p"), k.cast("string"), F.lit("/scan.dcm")).alias("file"), k.cast("string").alias("patient"), whole.alias("content"))


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.flattened(_record(spark, sf_dir), "content", "file", "patient")


_NEW = "'2.25.1' || " + " || ".join(f"lpad(CAST(('0x' || substr(md5('{SECRET}' || {{0}}), {a}, 8))::BIGINT AS VARCHAR), 10, '0')" for a in (1, 9, 17))
_K = "CAST(c_custkey AS VARCHAR)"
_ID = "'CT-' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END"
_BACK = f"(-365 - CAST(('0x' || substr(md5('{SECRET}' || {_K}), 1, 8))::BIGINT % 3286 AS INT))"
_SHIFTED_DATE = f"strftime(DATE '2020-01-31' + {_BACK}, '%Y%m%d')"
_CLASS = f"CASE WHEN c_custkey % 3 = 0 THEN '{P.SECONDARY_CAPTURE[0]}' ELSE '1.2.840.10008.5.1.4.1.1.2' END"
_U = "'1.2.3.' || CAST(c_custkey + {} AS VARCHAR)"


def _rows_sql(rows: list[tuple[str, str, int, str]]) -> str:
    return ", ".join(f"{{'path': '{p}', 'vr': '{vr}', 'grp': {g}, 'value': {v}}}" for p, vr, g, v in rows)


@query(f"SELECT 'p' || {_K} || '/scan.dcm' AS file, x.path AS path, x.vr AS vr, x.grp AS grp, x.value AS value FROM (SELECT c_custkey, unnest([{_rows_sql([('PatientName', 'PN', 16, 'c_name'), ('SOPClassUID', 'UI', 8, _CLASS), ('SOPInstanceUID', 'UI', 8, _U.format(0)), ('StudyInstanceUID', 'UI', 32, _U.format(1) + ' || chr(92) || ' + _U.format(2)), ('StudyDate', 'DA', 8, repr('20200131')), ('PrivateCreator', 'LO', 41, repr('x')), ('ContentSequence/0/ReferencedSOPInstanceUID', 'UI', 8, _U.format(1)), ('ContentSequence/0/PatientName', 'PN', 16, 'c_name')])}]) AS x FROM customer)")
def records_flat(spark, sf_dir):
    return _flat(spark, sf_dir).select("file", "path", "vr", "grp", "value")


def _final(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> DataFrame:
    flat = _flat(spark, sf_dir) if flat is None else flat
    return records.deidentified(flat, records.patients(flat.select("patient"), SECRET), SECRET)


@query(f"SELECT 'p' || {_K} || '/scan.dcm' AS file, x.path AS path, x.value AS value FROM (SELECT c_custkey, unnest([{_rows_sql([('PatientName', 'PN', 16, _ID), ('SOPClassUID', 'UI', 8, _CLASS), ('SOPInstanceUID', 'UI', 8, _NEW.format(_U.format(0))), ('StudyInstanceUID', 'UI', 32, _NEW.format(_U.format(1)) + ' || chr(92) || ' + _NEW.format(_U.format(2))), ('StudyDate', 'DA', 8, _SHIFTED_DATE), ('ContentSequence/0/ReferencedSOPInstanceUID', 'UI', 8, _NEW.format(_U.format(1))), ('ContentSequence/0/PatientName', 'PN', 16, repr('')), ('PatientIdentityRemoved', 'CS', 18, repr('YES')), ('DeidentificationMethod', 'LO', 18, repr(P.DEIDENTIFICATION_METHOD))])}]) AS x FROM (SELECT *, row_number() OVER (ORDER BY {_K}) AS n FROM customer))")
def records_final(spark, sf_dir):
    return _final(spark, sf_dir).select("file", "path", "value")


@query("SELECT 'p' || CAST(c_custkey AS VARCHAR) || '/scan.dcm' AS file FROM customer WHERE c_custkey % 3 = 0")
def secondary_captures(spark, sf_dir):
    return records.secondary_captures(_flat(spark, sf_dir))


@query("""SELECT 'known strings' AS gate, count(*) AS checked, count(DISTINCT CASE WHEN c_custkey % 50 = 0 THEN c_name END) AS violations, 'FAIL' AS verdict FROM customer
UNION ALL SELECT 'references', count(*), 0, 'PASS' FROM customer UNION ALL SELECT 'private elements', count(*), count_if(c_custkey % 40 = 0)::BIGINT, 'FAIL' FROM customer UNION ALL SELECT 'pictures', 0, 0, 'UNPROVEN'""")
def record_checks(spark, sf_dir):
    """Finished records in which some names and some private elements were left."""
    before = cut_lineage(_flat(spark, sf_dir))  # read by a dozen branches
    after = _final(spark, sf_dir, before)
    number = F.col("patient").cast("long")
    left = before.filter((number % 40 == 0) & (F.col("grp") == 41))
    told = before.filter((number % 50 == 0) & (F.col("path") == "PatientName")).withColumn("path", F.lit("StudyComments")).withColumn("keyword", F.lit("StudyComments")).withColumn("value", F.lower("value"))
    columns = after.columns
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("value"))
    return records.checks(before, after.union(left.select(columns)).union(told.select(columns)), names)


@query("SELECT 'references' AS gate, count(*) AS checked, 1::BIGINT AS violations, 'FAIL' AS verdict FROM customer")
def record_links_broken(spark, sf_dir):
    """The same where a map has missed the references: as many as before, but they lead nowhere."""
    before = cut_lineage(_flat(spark, sf_dir))  # read by a dozen branches
    after = _final(spark, sf_dir, before)
    own = F.col("keyword") == "ReferencedSOPInstanceUID"
    broken = after.filter(~own).union(before.filter(own).select(after.columns))
    names = table(spark, sf_dir, "customer").filter("c_custkey < 0").select(F.col("c_name").alias("value"))
    return records.checks(before, broken, names).filter("gate = 'references'")


# --- archives ---------------------------------------------------------------------------------------------
def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = F.when(F.col("page_id") % 3 == 0, ".png").when(F.col("page_id") % 3 == 1, ".JPG").otherwise(".txt")
    return pages.select((F.col("page_id") % 9).cast("string").alias("archive"), F.col("page_id").alias("ordinal"), F.concat(F.lit("a/b/i"), (F.col("page_id") % 50).cast("string"), kind).alias("entry"), F.col("html").cast("binary").alias("content"))


def _masked_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A masked version of two images in three, in two folders of which the first counts."""
    pages = table(spark, sf_dir, "pages").filter("page_id < 50 AND page_id % 3 <> 2")
    made = lambda folder, mark: pages.select(F.concat(F.lit(folder), F.lit("/i"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 3 == 0, ".png").otherwise(".JPG")).alias("path"), F.concat(F.lit(mark), F.col("page_id").cast("string")).cast("binary").alias("content"))
    return made("m1", "first").union(made("m2", "second"))


_ENTRIES = "(SELECT page_id, CAST(page_id % 9 AS VARCHAR) AS archive, page_id AS ordinal, 'i' || CAST(page_id % 50 AS VARCHAR) || CASE page_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' ELSE '.txt' END AS name, html FROM pages)"
_SWAPPED = f"(SELECT e.*, CASE WHEN e.name LIKE '%.txt' THEN 'kept' WHEN m.name IS NULL THEN 'missing' ELSE 'swapped' END AS status, m.id FROM {_ENTRIES} e LEFT JOIN (SELECT DISTINCT page_id AS id, 'i' || CAST(page_id AS VARCHAR) || CASE page_id % 3 WHEN 0 THEN '.png' ELSE '.JPG' END AS name FROM pages WHERE page_id < 50 AND page_id % 3 <> 2) m ON e.name = m.name AND e.name NOT LIKE '%.txt')"


@query(f"SELECT archive, ordinal, status, md5(CASE WHEN status = 'swapped' THEN 'first' || CAST(id AS VARCHAR) ELSE html END) AS digest FROM {_SWAPPED}")
def archive_images(spark, sf_dir):
    out = delivery.with_masked_images(_entries(spark, sf_dir), _masked_images(spark, sf_dir))
    return out.select("archive", "ordinal", "status", F.md5("content").alias("digest"))


@query(f"SELECT 'masked images' AS gate, count_if(status <> 'kept')::BIGINT AS checked, count_if(status = 'missing')::BIGINT AS violations, CASE WHEN count_if(status = 'missing') > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM {_SWAPPED} UNION ALL SELECT 'identical entries', count(*), count_if(status <> 'swapped' AND page_id % 2 = 0)::BIGINT, CASE WHEN count_if(status <> 'swapped' AND page_id % 2 = 0) > 0 THEN 'FAIL' ELSE 'PASS' END FROM (SELECT s.* REPLACE (CASE WHEN s.html IN (SELECT html FROM pages WHERE page_id % 2 = 0) THEN 0 ELSE 1 END AS page_id) FROM {_SWAPPED} s)")
def gate_archives(spark, sf_dir):
    """Rebuilt archives against the originals of every other page."""
    out = delivery.with_masked_images(_entries(spark, sf_dir), _masked_images(spark, sf_dir))
    return delivery.archive_gate(out, table(spark, sf_dir, "pages").filter("page_id % 2 = 0").select(F.col("html").cast("binary").alias("content")))


# --- search of the output ---------------------------------------------------------------------------------
_ANCHORED = "'(?i)(?:^|[^A-Za-z0-9])' || array_to_string(regexp_extract_all(b.text, '[A-Za-z0-9]+'), '[^A-Za-z0-9]{0,3}') || '(?:$|[^A-Za-z0-9])'"
#: Texts and, as further rows, their paths; the values are benchmark items and a part of the paths.
_SEARCHED = "(SELECT 'f/' || CAST(doc_id AS VARCHAR) AS path, text FROM documents UNION ALL SELECT 'f/' || CAST(doc_id AS VARCHAR), 'f/' || CAST(doc_id AS VARCHAR) FROM documents)"
_HITS = f"(SELECT DISTINCT b.text AS value, d.path AS doc FROM (SELECT *, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS canon FROM (SELECT text FROM benchmark UNION SELECT 'f-00' || CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 97 = 0 UNION SELECT 'f/' || CAST(doc_id AS VARCHAR) || '00000' FROM documents WHERE doc_id % 89 = 0)) b JOIN (SELECT *, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS canon FROM {_SEARCHED}) d ON contains(d.canon, b.canon) WHERE CASE WHEN contains(d.canon, b.canon) THEN regexp_matches(d.text, {_ANCHORED}) END AND length(regexp_replace(b.text, '[^A-Za-z0-9]', '', 'g')) >= 5)"


def _hits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("f/"), F.col("doc_id").cast("string")).alias("path"), "text")
    key = F.col("doc_id").cast("string")
    ids = table(spark, sf_dir, "documents")
    values = table(spark, sf_dir, "benchmark").select("text").union(ids.filter("doc_id % 97 = 0").select(F.concat(F.lit("f-00"), key))).union(ids.filter("doc_id % 89 = 0").select(F.concat(F.lit("f/"), key, F.lit("00000"))))
    searched = gates.with_paths(docs, "path", "text")
    return searched, gates.needle_hits(searched, "path", "text", values, "text")


@query(f"SELECT value, count(DISTINCT doc) AS files, min(doc) AS first FROM {_HITS} GROUP BY value")
def output_report(spark, sf_dir):
    return gates.search_report(_hits(spark, sf_dir)[1]).select("value", "files", "first")


@query(f"SELECT 'output search' AS gate, (SELECT count(*) FROM {_SEARCHED}) AS checked, count(DISTINCT value) AS violations, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM {_HITS}")
def gate_output(spark, sf_dir):
    return gates.output_gate(*_hits(spark, sf_dir))


@query("""SELECT 'screenshots' AS gate, count(*) AS checked, count_if(EXISTS (SELECT 1 FROM benchmark b WHERE length(regexp_replace(b.text, '[^A-Za-z0-9]', '', 'g')) >= 5 AND contains(c, regexp_replace(lower(b.text), '[^a-z0-9]', '', 'g'))))::BIGINT AS violations, CASE WHEN count_if(EXISTS (SELECT 1 FROM benchmark b WHERE contains(c, regexp_replace(lower(b.text), '[^a-z0-9]', '', 'g')))) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM (SELECT regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS c FROM documents WHERE doc_id % 4 <> 0) UNION ALL SELECT 'photographs', 0, 0, 'UNPROVEN'""")
def gate_images(spark, sf_dir):
    read = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("image"), "text", (F.col("doc_id") % 4 == 0).alias("photo"))
    return gates.image_gate(read, table(spark, sf_dir, "benchmark"), "text")


# --- sound ------------------------------------------------------------------------------------------------
#: A recording of 5 seconds at 4000 samples a second, loud in the first half of each second; two planned spans of a loud stretch, and a word just before the second of them in some.
_BASE = "(1 + CAST(conv_id AS BIGINT) % 3)"


def _recordings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    conv = table(spark, sf_dir, "conversations").select("conv_id").distinct().withColumn("file", F.col("conv_id").cast("string"))
    sound = F.transform(F.sequence(F.lit(0), F.lit(19999)), lambda i: F.when(F.floor(i / 2000) % 2 == 0, F.when(i % 2 == 0, 3000).otherwise(-3000)).otherwise(0).cast("short"))
    base = 1 + F.col("conv_id") % 3
    span = lambda a, b, heard: F.struct((base + a).cast("double").alias("start"), (base + b).cast("double").alias("end"), F.lit("r").alias("reason"), F.lit(heard).alias("heard"))
    spans = conv.select("file", F.inline(F.array(span(0.125, 0.25, "one"), span(0.25, 0.375, "two"))))
    ws = conv.filter("conv_id % 2 = 0").select("file", (base + 0.0).cast("double").alias("s"), (base + 0.125).cast("double").alias("e"))
    return spread(conv, "file").select("file", F.lit(4000).alias("sr"), sound.alias("samples")), spans, ws


@query(f"""SELECT CAST(conv_id AS VARCHAR) AS file, {_BASE} + CASE WHEN conv_id % 2 = 0 THEN 0.125 ELSE -0.175 END::DOUBLE AS "start", {_BASE} + 0.675::DOUBLE AS "end", 'one two' AS heard, {_BASE} + 0.125::DOUBLE AS orig_start FROM (SELECT DISTINCT conv_id FROM conversations)""")
def finished_audio(spark, sf_dir):
    """Spans of recordings, grown to the next silence of nine frames or to the word before, and merged."""
    spans = audio.final_spans(audio.finished(*_recordings(spark, sf_dir)))
    return spans.select("file", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "heard", "orig_start")


@query(f"SELECT CAST(conv_id AS VARCHAR) AS file, round(0.675 - CASE WHEN conv_id % 2 = 0 THEN 0.125 ELSE -0.175 END, 6)::DOUBLE AS seconds, 0::BIGINT AS unconfirmed FROM (SELECT DISTINCT conv_id FROM conversations)")
def tones_confirmed(spark, sf_dir):
    done = audio.finished(*_recordings(spark, sf_dir))
    bad = audio.unconfirmed_tones(done).groupBy("file").agg(F.count(F.lit(1)).alias("unconfirmed"))
    return done.join(bad, "file", "left").select("file", F.round("seconds", 6).alias("seconds"), F.coalesce("unconfirmed", F.lit(0)).cast("long").alias("unconfirmed"))


# --- pictures ---------------------------------------------------------------------------------------------
#: Line items as films: an order's lines are rows of pixels, bright where a separator stands.
_PIXELS = "(SELECT l_suppkey % 4 AS image, (l_orderkey * 7 + l_linenumber) % 1200 AS y, CASE WHEN (l_orderkey * 7 + l_linenumber) % 1200 IN (90, 400, 401, 800, 1100) THEN 1000.0 ELSE CAST(l_quantity AS DOUBLE) END AS value FROM lineitem)"


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 1200
    return table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 4).alias("image"), y.alias("y"), F.when(y.isin(90, 400, 401, 800, 1100), 1000.0).otherwise(F.col("l_quantity").cast("double")).alias("value"))


_MEANS = f"(SELECT image, y, avg(value) AS mean FROM {_PIXELS} GROUP BY ALL)"
_BRIGHT = f"(SELECT m.image, m.y FROM {_MEANS} m JOIN (SELECT image, quantile_cont(mean, 0.99) AS b FROM {_MEANS} GROUP BY 1) q ON m.image = q.image WHERE m.mean > b)"
_CENTRES = f"(SELECT image, (min(y) + max(y)) // 2 AS centre FROM (SELECT *, sum(fresh) OVER (PARTITION BY image ORDER BY y ROWS UNBOUNDED PRECEDING) AS c FROM (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY image ORDER BY y) <= 40 THEN 0 ELSE 1 END AS fresh FROM {_BRIGHT})) GROUP BY image, c)"


@query(f"SELECT image, round(sum(mean), 4) AS total, count(*) AS rows FROM {_MEANS} GROUP BY image")
def row_means(spark, sf_dir):
    return images.row_means(_pixels(spark, sf_dir)).groupBy("image").agg(F.round(F.sum("mean"), 4).alias("total"), F.count(F.lit(1)).alias("rows"))


@query(f"SELECT image, centre::BIGINT AS centre FROM {_CENTRES} WHERE centre > 200 AND centre < 1000")
def film_separators(spark, sf_dir):
    return images.separators(images.row_means(_pixels(spark, sf_dir)), 1200)


@query(f"SELECT image, (2 + count(centre))::BIGINT AS boxes, (162 + 162 + coalesce(sum(centre + 1), 0))::BIGINT AS tops FROM (SELECT DISTINCT image FROM {_PIXELS}) LEFT JOIN (SELECT * FROM {_CENTRES} WHERE centre > 200 AND centre < 1000) USING (image) GROUP BY image")
def film_bands(spark, sf_dir):
    """Number of boxes of each film, and the sum of the banner's lower end and the bands' upper ends."""
    pixels = _pixels(spark, sf_dir)
    films = pixels.select("image").distinct().withColumn("width", F.lit(3200)).withColumn("height", F.lit(1200))
    boxes = images.band_boxes(images.separators(images.row_means(pixels), 1200), films)
    top = F.aggregate("boxes", F.lit(0).cast("long"), lambda a, b: a + F.when(b["y0"] == 0, b["y1"]).otherwise(b["y0"]))
    return boxes.select("image", F.size("boxes").cast("long").alias("boxes"), top.alias("tops"))


@query("SELECT p_partkey AS image, CASE WHEN p_size > 30 THEN 71 WHEN p_size > 20 THEN 1 ELSE 0 END::BIGINT AS boxes, CASE WHEN p_size > 30 THEN 3000 + p_size + list_sum(list_transform(range(0, 35), lambda i: (i % 5) * ((3000 + p_size) // 5) + 300 + (i % 5 + 1) * ((3000 + p_size) // 5))) WHEN p_size > 20 THEN 3000 + p_size ELSE 0 END::BIGINT AS rights FROM part")
def capture_boxes(spark, sf_dir):
    """Boxes of films of tiles and of dose reports, and the sum of their right ends."""
    size = F.col("p_size")
    captures = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("image"), F.when(size > 30, "an Electronic film").when(size > 20, "Dose Report").otherwise("other").alias("description"), (3000 + size).alias("width"), F.lit(4000).alias("height"))
    right = F.aggregate("boxes", F.lit(0).cast("long"), lambda a, b: a + b["x1"])
    return images.capture_boxes(captures).select("image", F.size("boxes").cast("long").alias("boxes"), right.alias("rights"))


@query(f"SELECT image, sum(CASE WHEN y < 162 OR (y >= 162 AND y < 262) THEN 5 ELSE value END) AS total FROM {_PIXELS} GROUP BY image")
def masked_pixels(spark, sf_dir):
    pixels = _pixels(spark, sf_dir).withColumn("x", F.lit(10))
    films = pixels.select("image").distinct().withColumn("width", F.lit(100)).withColumn("height", F.lit(1200)).withColumn("fill", F.lit(5.0))
    boxes = images.band_boxes(films.select("image", F.lit(0).cast("long").alias("centre")).filter("image < 0"), films)
    return images.masked(pixels, boxes, films).groupBy("image").agg(F.sum("value").alias("total"))


# --- transcripts ------------------------------------------------------------------------------------------
@query("""SELECT file, sum(spans)::BIGINT AS spans, sum(seconds) AS seconds, CASE WHEN sum(duration) > 0 THEN round(100 * sum(seconds) / sum(duration), 2) ELSE 0 END::DOUBLE AS percent FROM (SELECT CAST(conv_id AS VARCHAR) AS file, count_if(turn % 2 = 0) AS spans, coalesce(sum(CASE WHEN turn % 2 = 0 THEN 1.5 END), 0)::DOUBLE AS seconds, max(turn + 1) * 10.0 AS duration FROM conversations GROUP BY 1) GROUP BY ROLLUP(file)""")
def recording_totals(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").withColumn("file", F.col("conv_id").cast("string"))
    spans = conv.filter("turn % 2 = 0").select("file", (F.col("turn") * 3.0).alias("start"), (F.col("turn") * 3.0 + 1.5).alias("end"))
    return speech.totals(spans, conv.groupBy("file").agg((F.max("turn") + 1).alias("_n")).select("file", (F.col("_n") * 10.0).alias("duration")))


@query(f"SELECT 'transcripts' AS gate, count(*) AS checked, count_if(NOT passed)::BIGINT AS violations, CASE WHEN count_if(NOT passed) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM ({ORACLES['script_quality']})")
def gate_transcripts(spark, sf_dir):
    return gates.gate("transcripts", script_quality(spark, sf_dir), ~F.col("passed"))


@query(f"SELECT 'recordings' AS gate, (SELECT count(DISTINCT file) FROM ({_WORDS})) AS checked, count(*) AS violations, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM ({ORACLES['survivors']})")
def gate_recordings(spark, sf_dir):
    """What is still heard in finished recordings."""
    ws = _words(spark, sf_dir)
    found = speech.survivors(ws, _gazetteer(spark, sf_dir)).agg(F.count(F.lit(1)).alias("violations"))
    return gates.counted("recordings", ws.agg(F.count_distinct("file").alias("checked")).crossJoin(found))  # one row each


_GRID = "(SELECT l_suppkey % 4 AS image, l_orderkey % 100 AS x, l_linenumber + 10 * (l_orderkey % 5) AS y, max(CAST(l_quantity AS DOUBLE)) AS value FROM lineitem GROUP BY ALL)"


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy((F.col("l_suppkey") % 4).alias("image"), (F.col("l_orderkey") % 100).alias("x"), (F.col("l_linenumber") + 10 * (F.col("l_orderkey") % 5)).alias("y")).agg(F.max(F.col("l_quantity").cast("double")).alias("value"))


@query(f"SELECT image, x, y, round(avg(value) OVER (PARTITION BY image, x // 7, y // 7), 6) AS value FROM {_GRID}")
def coarse_photos(spark, sf_dir):
    pixels = _grid(spark, sf_dir)
    sizes = pixels.select("image").distinct().withColumn("width", F.lit(100)).withColumn("height", F.lit(60))
    return images.coarse(pixels, sizes).withColumn("value", F.round("value", 6))


@query(f"SELECT g.image, g.x, g.y, CASE WHEN g.x BETWEEN 21 AND 47 AND g.y BETWEEN 1 AND 33 THEN coalesce(f.value, 255.0) ELSE g.value END AS value FROM {_GRID} g LEFT JOIN (SELECT image, value FROM {_GRID} WHERE x = 21 AND y = 17) f ON g.image = f.image")
def painted_words(spark, sf_dir):
    pixels = _grid(spark, sf_dir)
    box = [F.lit(n).alias(c) for c, n in (("x", 24), ("y", 4), ("w", 20), ("h", 26))]
    return images.painted(pixels, pixels.select("image").distinct().select("image", *box))


@query(f"SELECT 'p' || {_K} || '/scan.dcm' AS file, 'BurnedInAnnotation' AS path, 'NO' AS value FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'p' || {_K} || '/scan.dcm', 'TransferSyntaxUID', '1.2.840.10008.1.2.1' FROM customer WHERE c_custkey % 3 = 0")
def pixel_flags(spark, sf_dir):
    flat = _flat(spark, sf_dir)
    return records.pixels_masked(flat, records.secondary_captures(flat)).filter(F.col("path").isin("BurnedInAnnotation", "TransferSyntaxUID")).select("file", "path", "value")


@query("SELECT p_partkey, url_encode(p_brand || '/' || p_type || ' *~é') AS path FROM part")
def encoded_paths(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", delivery.encoded_path(F.concat("p_brand", F.lit("/"), "p_type", F.lit(" *~é"))).alias("path"))
