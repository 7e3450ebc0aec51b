"""Records, references and deliveries over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media, patterns as P, redact
from ..operators import audio, delivery, gates, images, ranking, records
from ..session import table
from .registry import query

SECRET = "a secret of the caller"
_DAYS = f"(-365 - CAST(('0x' || substr(md5('{SECRET}' || CAST(o_custkey AS VARCHAR)), 1, 8))::BIGINT % 3286 AS INT))"
_UID = "'2.25.1' || " + " || ".join(f"lpad(CAST(('0x' || substr(md5('{SECRET}' || {{0}}), {a}, 8))::BIGINT AS VARCHAR), 10, '0')" for a in (1, 9, 17))


def _shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.patients(table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("patient")), SECRET)


_SHIFTED = f"(SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE strftime(CAST(o_orderdate AS DATE) + {_DAYS}, '%Y%m%d') || CASE WHEN o_orderkey % 3 = 0 THEN '101500' ELSE '' END END AS shifted FROM orders)"


def _shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("o_orderkey") % 5 == 0, F.lit("2024XX01")).otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.when(F.col("o_orderkey") % 3 == 0, "101500").otherwise("")))
    orders = table(spark, sf_dir, "orders").withColumn("patient", F.col("o_custkey").cast("string"))
    return orders.join(_shifts(spark, sf_dir), "patient").select("o_orderkey", "o_custkey", "o_orderdate", records.shifted_date(value, F.col("shift_days")).alias("shifted"))


@query(f"SELECT o_orderkey, shifted FROM {_SHIFTED}")
def date_shift(spark, sf_dir):
    return _shifted(spark, sf_dir).select("o_orderkey", "shifted")


@query("SELECT o_custkey, date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)))::BIGINT AS days FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY o_custkey")
def interval_preserved(spark, sf_dir):
    """Days between the first and last shifted dates of a customer; the SQL takes them from the dates as they were."""
    day = F.to_date(F.substring("shifted", 1, 8), "yyyyMMdd")
    return _shifted(spark, sf_dir).filter("shifted <> ''").groupBy("o_custkey").agg(F.date_diff(F.max(day), F.min(day)).cast("long").alias("days"))


@query(f"SELECT CAST(o_custkey AS VARCHAR) AS patient, 'CT-' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS pseudo_id, {_DAYS} AS shift_days FROM (SELECT o_custkey, row_number() OVER (ORDER BY CAST(o_custkey AS VARCHAR)) AS n FROM (SELECT DISTINCT o_custkey FROM orders))")
def patient_key(spark, sf_dir):
    return _shifts(spark, sf_dir)


@query(f"SELECT l_linenumber, count(*) AS n, count(DISTINCT u) AS uids, min(u) AS least FROM (SELECT l_linenumber, {_UID.format('CAST(l_orderkey AS VARCHAR)')} AS u FROM lineitem) GROUP BY l_linenumber")
def uid_remap(spark, sf_dir):
    uid = records.uid(F.col("l_orderkey").cast("string"), SECRET)
    return table(spark, sf_dir, "lineitem").select("l_linenumber", uid.alias("u")).groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("uids"), F.min("u").alias("least"))


@query("SELECT count(*) AS total, count_if(o_orderkey IS NULL)::BIGINT AS dangling FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 3) ON l_orderkey = o_orderkey")
def dangling_refs(spark, sf_dir):
    defined = table(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("uid"))
    return records.dangling(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("uid")), defined)


@query("WITH r AS (SELECT count(*) AS total, count_if(o_orderkey IS NULL)::BIGINT AS dangling FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 3) ON l_orderkey = o_orderkey) SELECT total AS total_before, dangling AS dangling_before, total AS total_after, dangling AS dangling_after, true AS equal FROM r")
def ref_integrity(spark, sf_dir):
    """Totals before the UIDs are mapped and after: mapping must change neither."""
    defined = table(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 3").select(F.col("o_orderkey").cast("string").alias("uid"))
    refs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("uid"))
    mapped = [df.select(records.uid(F.col("uid"), SECRET).alias("uid")) for df in (refs, defined)]
    before, after = records.dangling(refs, defined), records.dangling(*mapped)
    both = before.select(F.col("total").alias("total_before"), F.col("dangling").alias("dangling_before")).crossJoin(after.select(F.col("total").alias("total_after"), F.col("dangling").alias("dangling_after")))  # one row each
    return both.withColumn("equal", (F.col("total_before") == F.col("total_after")) & (F.col("dangling_before") == F.col("dangling_after")))


#: Elements of records: a customer is a file and patient with a name, a free text, a nested name and a private element.
_ELEMENTS = "SELECT c_custkey, unnest([{'path': 'PatientName', 'keyword': 'PatientName', 'vr': 'PN', 'grp': 16, 'value': c_name}, {'path': 'StudyDescription', 'keyword': 'StudyDescription', 'vr': 'LO', 'grp': 8, 'value': c_mktsegment}, {'path': 'Seq/0/StationName', 'keyword': 'StationName', 'vr': 'SH', 'grp': 8, 'value': 'CT1'}, {'path': 'Seq/0/Rows', 'keyword': 'Rows', 'vr': 'US', 'grp': 40, 'value': c_mktsegment}, {'path': 'Private', 'keyword': 'Private', 'vr': 'LO', 'grp': 41, 'value': 'x'}]) AS x FROM customer"


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = lambda path, keyword, vr, grp, value: F.struct(F.lit(path).alias("path"), F.lit(keyword).alias("keyword"), F.lit(vr).alias("vr"), F.lit(grp).alias("grp"), value.alias("value"))
    rows = F.array(row("PatientName", "PatientName", "PN", 16, F.col("c_name")), row("StudyDescription", "StudyDescription", "LO", 8, F.col("c_mktsegment")), row("Seq/0/StationName", "StationName", "SH", 8, F.lit("CT1")), row("Seq/0/Rows", "Rows", "US", 40, F.col("c_mktsegment")), row("Private", "Private", "LO", 41, F.lit("x")))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("file"), F.col("c_custkey").cast("string").alias("patient"), F.explode(rows).alias("x")).select("file", "patient", "x.*")


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS file, x.path AS path, CASE WHEN x.keyword IN ({', '.join(repr(t) for t in P.BLANKED_TAGS)}) OR (x.vr IN ({', '.join(repr(v) for v in P.FREE_TEXT_VRS)}) AND contains(x.value, 'BUILD')) THEN '' ELSE x.value END AS value FROM ({_ELEMENTS}) WHERE x.grp % 2 = 0")
def tag_blanking(spark, sf_dir):
    return records.blanked(records.without_private(_elements(spark, sf_dir)), ["BUILD"]).select("file", "path", "value")


@query("SELECT CAST(c_custkey AS VARCHAR) AS file, 'Private' AS path FROM customer")
def private_tags(spark, sf_dir):
    return records.private_elements(_elements(spark, sf_dir)).select("file", "path")


_URL_NAME = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]*$')"


@query(f"SELECT basename, min(path) AS path, count(*) AS n FROM (SELECT regexp_replace(url, '[?#].*$', '') AS path, {_URL_NAME} AS basename FROM pages) GROUP BY basename")
def image_basename_pick(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("path"))
    return delivery.first_by_basename(files, "path")


@query("SELECT count(*) AS entries, count_if(page_id % 4 = 0)::BIGINT AS identical, count_if(page_id % 4 <> 0)::BIGINT AS swapped FROM pages")
def entry_identical(spark, sf_dir):
    """Entries of a rebuilt archive whose digest is still that of an original; every fourth was left as it was."""
    pages = table(spark, sf_dir, "pages")
    rebuilt = pages.select(F.when(F.col("page_id") % 4 == 0, F.col("html")).otherwise(F.concat("html", F.lit("masked"), F.col("page_id").cast("string"))).cast("binary").alias("content"))
    same = delivery.still_original(rebuilt, pages.select(F.col("html").cast("binary").alias("content"))).agg(F.count(F.lit(1)).alias("identical"))
    return rebuilt.agg(F.count(F.lit(1)).alias("entries")).crossJoin(same).withColumn("swapped", F.col("entries") - F.col("identical"))  # one row each


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, '' AS region, o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def schema_projection(spark, sf_dir):
    return delivery.projected(table(spark, sf_dir, "orders"), ["o_orderkey", "region", "o_orderpriority", "o_custkey"])


@query("SELECT 1::BIGINT AS o_orderstatus, count(DISTINCT o_orderpriority) AS o_orderpriority FROM orders")
def constant_columns(spark, sf_dir):
    """One column was masked and one was forgotten."""
    masked = delivery.constant(table(spark, sf_dir, "orders"), {"o_orderstatus": "A"})
    return delivery.not_constant(masked, ["o_orderstatus", "o_orderpriority"])


@query("SELECT count_if(o_orderkey % 2 <> 0 AND o_orderkey % 3 <> 0)::BIGINT AS missing, count_if(o_orderkey % 100 = 0)::BIGINT AS extra, count_if(o_orderkey % 6 = 0)::BIGINT AS repeated, sum(o_custkey)::BIGINT AS whole_sum, sum(o_custkey * (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END))::BIGINT + sum(CASE WHEN o_orderkey % 100 = 0 THEN 5 ELSE 0 END)::BIGINT AS parts_sum FROM orders")
def reconcile(spark, sf_dir):
    """Parts that lack some orders, share others, and hold some that never were."""
    orders = table(spark, sf_dir, "orders")
    extra = orders.filter("o_orderkey % 100 = 0").select((-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit(5).cast("long").alias("o_custkey"))
    return delivery.reconciled(orders, [orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 3 = 0"), extra], "o_orderkey", "o_custkey")


@query("SELECT item, string_agg(recipient, ',' ORDER BY recipient) AS recipients, count(*) AS n FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS item, l_returnflag || l_linestatus AS recipient FROM lineitem) GROUP BY item HAVING count(*) > 1")
def ledger_overlap(spark, sf_dir):
    return delivery.ledger_overlap(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("item"), F.concat("l_returnflag", "l_linestatus").alias("recipient")))


@query("SELECT count(*) AS checked, count_if(l_orderkey % 10 <> 3)::BIGINT AS matched FROM lineitem")
def commit_join_rate(spark, sf_dir):
    mapped = table(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("sha"))
    return delivery.match_rate(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sha")), mapped, "sha")


@query("SELECT count(*) AS rows, count_if(event_id % 100 = 7)::BIGINT AS wrong FROM events")
def positional_pairing(spark, sf_dir):
    """Original and masked rows paired by position, and checked on a column that masking should have left but hasn't everywhere."""
    events = table(spark, sf_dir, "events")
    left = ranking.numbered(events.select("event_id", "event_type"), ["event_id"])
    right = ranking.numbered(events.select("event_id", F.when(F.col("event_id") % 100 == 7, "?").otherwise(F.col("event_type")).alias("masked_type"), F.sha2(F.col("user_id").cast("string"), 256).alias("user")), ["event_id"])
    return left.join(right.drop("event_id"), "n").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_type") != F.col("masked_type")).alias("wrong"))


@query("""SELECT doc_id, sha256('{"id":' || CAST(doc_id AS VARCHAR) || ',"source":"' || source || '"}') AS digest FROM documents""")
def reseal_digest(spark, sf_dir):
    bundle = F.to_json(F.struct("source", F.struct(F.lit("sha256").alias("algo")).alias("integrity"), F.col("doc_id").alias("id")))
    return table(spark, sf_dir, "documents").select("doc_id", delivery.sealed_digest(bundle).alias("digest"))


@query("SELECT CAST(user_id AS VARCHAR) AS film, floor((min(pos) + max(pos)) / 2.0)::BIGINT AS centre, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cluster FROM (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY user_id ORDER BY pos) <= 400 THEN 0 ELSE 1 END AS fresh FROM (SELECT DISTINCT user_id, floor(epoch(ts))::BIGINT % 100000 AS pos FROM events))) GROUP BY user_id, cluster")
def separator_cluster(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("film"), (F.unix_seconds(F.col("ts").cast("timestamp")) % 100000).alias("at")).distinct()
    return records.clusters(rows, "film", "at", 400).drop("cluster")


@query("SELECT l_shipmode_page AS image, count(DISTINCT l_quantity) AS colours, count(*) AS pixels, count(DISTINCT l_quantity) * 1.0::DOUBLE / count(*) > 0.05 AS photo FROM (SELECT l_quantity, l_suppkey AS l_shipmode_page FROM lineitem) GROUP BY 1")
def photo_ratio(spark, sf_dir):
    """Line items as pixels of a supplier's image."""
    return images.photos(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("image"), F.col("l_quantity").alias("rgb")))


@query("SELECT event_id % 50 AS image, floor(quantile_cont(v, 0.01))::BIGINT AS fill, floor(quantile_cont(v, 0.99))::BIGINT AS bright FROM (SELECT event_id, floor(abs(value) * 10)::DOUBLE AS v FROM events) GROUP BY 1")
def percentile_fill(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select((F.col("event_id") % 50).alias("image"), F.floor(F.abs("value") * 10).cast("double").alias("value"))
    return images.percentiles(rows, fill=0.01, bright=0.99)


@query("SELECT event_id // 20 AS frame, round(20 * log10(sqrt(avg(v * v)) / 32768 + 1e-12), 6) AS db FROM (SELECT event_id, floor(value * 10)::DOUBLE AS v FROM events) GROUP BY 1")
def frame_levels(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 20).alias("frame"), F.floor(F.col("value") * 10).cast("double").alias("v"))
    return audio.frame_levels(rows, "v", "frame")


@query("SELECT source, doc_id, (floor((r - 1) / 12) + 1)::BIGINT AS sheet, ((r - 1) % 12)::BIGINT AS place FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents)")
def contact_pages(spark, sf_dir):
    return delivery.pages_of(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id")


@query("SELECT coalesce(a.repo, b.repo) AS repo, source_commits, delivered_commits, CASE WHEN a.repo IS NULL THEN 'not in source' WHEN b.repo IS NULL THEN 'not delivered' WHEN source_commits <> delivered_commits THEN 'changed' ELSE 'equal' END AS status FROM (SELECT CAST(o_custkey AS VARCHAR) AS repo, count(*) AS source_commits FROM orders WHERE o_custkey % 11 <> 0 GROUP BY 1) a FULL JOIN (SELECT CAST(o_custkey AS VARCHAR) AS repo, count(*) AS delivered_commits FROM orders WHERE o_custkey % 7 <> 0 AND o_orderkey % 20 <> 1 GROUP BY 1) b ON a.repo = b.repo")
def integrity_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    by_repo = lambda df: df.groupBy(F.col("o_custkey").cast("string").alias("repo")).agg(F.count(F.lit(1)).alias("commits"))
    return gates.commit_counts(by_repo(orders.filter("o_custkey % 11 <> 0")), by_repo(orders.filter("o_custkey % 7 <> 0 AND o_orderkey % 20 <> 1")))


@query("WITH r AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'Mx. Mask-me/' ELSE 'plain/' END AS folder, o_orderkey FROM orders) SELECT replace(folder, 'Mx. Mask-me', 'Person A') || CAST(o_orderkey AS VARCHAR) || '.csv' AS path, 'by ' || CASE WHEN o_orderkey % 3 = 0 THEN 'Person A' ELSE 'none' END AS text FROM r")
def masked_paths(spark, sf_dir):
    hit = F.col("o_orderkey") % 3 == 0
    texts = table(spark, sf_dir, "orders").select(F.concat(F.when(hit, "Mx. Mask-me/").otherwise("plain/"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("path"), F.concat(F.lit("by "), F.when(hit, "MX MASK ME").otherwise("none")).alias("text"))
    return delivery.masked_paths(texts, redact.map_masker({"Mx Mask Me": "Person A"}))


def _chunk(kind: bytes, body) -> F.Column:
    size = F.unhex(F.lpad(F.hex(F.octet_length(body)), 8, "0"))
    return F.concat(size, F.lit(bytearray(kind)), body, F.lit(bytearray(4)))


@query("SELECT doc_id, (8 + 12 + 12 + 12 + 4)::BIGINT AS n_bytes, (8 + 12 + 12 + 12 + 4 + 12 + strlen(source))::BIGINT AS n_before FROM documents")
def png_strip(spark, sf_dir):
    """Small PNG files that carry a text chunk."""
    docs = table(spark, sf_dir, "documents")
    ints = F.lit(bytearray(b"\x00\x01\x02\x03"))
    png = F.concat(F.lit(bytearray(b"\x89PNG\r\n\x1a\n")), _chunk(b"IHDR", F.lit(bytearray())), _chunk(b"tEXt", F.col("source").cast("binary")), _chunk(b"IDAT", ints), _chunk(b"IEND", F.lit(bytearray())))
    return docs.select("doc_id", png.alias("png")).select("doc_id", F.octet_length(media.strip_image_metadata("png")).cast("long").alias("n_bytes"), F.octet_length("png").cast("long").alias("n_before"))


@query("SELECT archive, entry, strlen(content)::BIGINT AS n_bytes FROM (SELECT source AS archive, 'e' || CAST(doc_id AS VARCHAR) || '.txt' AS entry, text AS content FROM documents)")
def zip_entries(spark, sf_dir):
    """Documents packed into an archive for each thousand ids of a source, and read out of it again."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("source", F.floor(F.col("doc_id") / 1000).alias("part"), F.struct("doc_id", F.concat(F.lit("e"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.col("text").cast("binary").alias("content")).alias("e"))
    packed = rows.groupBy("source", "part").agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: F.struct(e["name"].alias("name"), e["content"].alias("content"))).alias("entries"))
    out = packed.select("source", F.explode(media.zip_entries(media.zip_of("entries"))).alias("e"))
    return out.select(F.col("source").alias("archive"), F.col("e.name").alias("entry"), F.octet_length("e.content").cast("long").alias("n_bytes"))
