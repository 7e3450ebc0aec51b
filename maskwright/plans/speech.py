"""Transcripts made from conversations: a conversation is a recording, a turn a segment, a word 0.4 seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import detect, patterns as P
from ..operators import speech
from ..session import table
from .registry import query

#: What is added to turns, as the fixtures hold no such speech.
_SPOKEN = "CASE turn % 7 WHEN 0 THEN ' my card is four one one one two' WHEN 1 THEN ' may I have your name' WHEN 2 THEN ' this is Zorblat speaking to mr Quentin' WHEN 3 THEN ' it is m o r a and K-e-e-n' WHEN 4 THEN ' call 555-1234 or two three' WHEN 5 THEN ' my name is Vexley, the doctor' ELSE ' pin code \uff19\uff18 nine' END"
_SEGS = f"SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS file, turn AS seg, turn * 100.0::DOUBLE AS start, trim(regexp_replace(text || {_SPOKEN}, '\\s+', ' ', 'g')) AS text FROM conversations".replace("\\\\", "\\")
_STRIP = """regexp_replace(regexp_replace(w, '^[.,!?;:"''()\\[\\]।॥]+', ''), '[.,!?;:"''()\\[\\]।॥]+$', '')"""
_IN_NUMBERS = ", ".join(f"'{w}'" for w in P.NUMBER_WORDS)
_IN_COMMON = ", ".join("'" + w.replace("'", "''") + "'" for w in P.COMMON_WORDS)
_WORDS = f"SELECT file, seg, text, pos, w, round(start + pos * 0.4::DOUBLE, 3) AS s, round(start + pos * 0.4::DOUBLE + 0.3::DOUBLE, 3) AS e, c, CASE WHEN regexp_matches(c, '[0-9]') AND regexp_full_match(c, '[0-9\\-.\\s()]+') THEN length(regexp_replace(c, '[^0-9]', '', 'g')) WHEN c IN ({_IN_NUMBERS}) THEN 1 ELSE 0 END AS n FROM (SELECT *, translate(lower({_STRIP}), '\uff19\uff18', '98') AS c FROM (SELECT file, seg, start, text, unnest(string_split(text, ' ')) AS w, unnest(range(0, len(string_split(text, ' ')))) AS pos FROM ({_SEGS})))".replace("\\\\", "\\")
_CONTEXTS = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p.replace('(?iU)', '(?i)')}') THEN '{name}'" for name, p in P.SEGMENT_CONTEXTS) + " END"


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.trim(F.regexp_replace(F.concat("text", F.expr(_SPOKEN)), r"\s+", " "))
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("file"), F.col("turn").alias("seg"), (F.col("turn") * 100.0).alias("start"), text.alias("text"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = _segments(spark, sf_dir)
    at = lambda i: F.round(F.col("start") + i * 0.4, 3)
    end = lambda i: F.round(F.col("start") + i * 0.4 + 0.3, 3)
    listed = F.transform(F.split("text", " "), lambda w, i: F.struct(w.alias("w"), at(i).alias("s"), end(i).alias("e")))
    return speech.words(segs.withColumn("words", listed))


@query(f"SELECT file, seg, s, e, total, size, heard FROM (SELECT file, seg, min(s) AS s, max(e) AS e, CAST(sum(n) AS BIGINT) AS total, count(*) AS size, string_agg(w, ' ' ORDER BY pos) AS heard FROM (SELECT *, pos - row_number() OVER (PARTITION BY file, seg ORDER BY pos) AS island FROM ({_WORDS}) WHERE n > 0) GROUP BY file, seg, island)")
def number_runs(spark, sf_dir):
    return speech.runs(_words(spark, sf_dir), F.col("n") > 0).select("file", "seg", "s", "e", "total", "size", "heard")


@query(f"SELECT file, s, e, coalesce(ctx, 'number sequence (' || CAST(total AS VARCHAR) || ' digits)') AS reason, heard FROM (SELECT file, min(s) AS s, max(e) AS e, sum(n) AS total, any_value({_CONTEXTS}) AS ctx, string_agg(w, ' ' ORDER BY pos) AS heard FROM (SELECT *, pos - row_number() OVER (PARTITION BY file, seg ORDER BY pos) AS island FROM ({_WORDS}) WHERE n > 0) GROUP BY file, seg, island) WHERE total >= 4 OR ctx IS NOT NULL")
def number_spans(spark, sf_dir):
    return speech.number_spans(_words(spark, sf_dir))


@query(f"SELECT file, s, e, 'spelled out letter by letter' AS reason, w AS heard FROM ({_WORDS}) WHERE regexp_full_match(c, '(?:[a-z][-\\s]){{2,}}[a-z]') UNION ALL SELECT file, min(s), max(e), 'spelled out letter by letter', string_agg(w, ' ' ORDER BY pos) FROM (SELECT *, pos - row_number() OVER (PARTITION BY file, seg ORDER BY pos) AS island FROM ({_WORDS}) WHERE regexp_full_match(c, '[a-z]')) GROUP BY file, seg, island HAVING count(*) >= 3".replace("\\\\", "\\"))
def spelled_runs(spark, sf_dir):
    return speech.spelled_spans(_words(spark, sf_dir))


@query(f"SELECT file, s, e, 'name after title' AS reason, w AS heard FROM (SELECT *, lag(c) OVER (PARTITION BY file, seg ORDER BY pos) AS b FROM ({_WORDS})) WHERE regexp_matches(b, '(?i)^(mr|mrs|ms|miss|dr|prof|shri|smt)\\.?$') AND c NOT IN ({_IN_COMMON})".replace("\\\\", "\\"))
def after_title(spark, sf_dir):
    return speech.title_spans(_words(spark, sf_dir))


@query(f"SELECT file, s, e, 'name after naming cue' AS reason, w AS heard FROM (SELECT *, lag(c, 1) OVER o AS b1, lag(c, 2) OVER o AS b2, lag(c, 3) OVER o AS b3 FROM ({_WORDS}) WINDOW o AS (PARTITION BY file, seg ORDER BY pos)) WHERE ((b3 = 'my' AND b2 = 'name' AND starts_with(b1, 'is')) OR (b2 = 'this' AND b1 = 'is')) AND c <> '' AND c NOT IN ({_IN_COMMON}) AND n = 0 AND length(c) > 2")
def name_cue(spark, sf_dir):
    return speech.cue_spans(_words(spark, sf_dir))


@query(f"SELECT w.file, w.s, w.e, 'answer to a name question' AS reason, w.w AS heard FROM ({_WORDS}) w JOIN ({_SEGS}) q ON w.file = q.file AND w.seg BETWEEN q.seg + 1 AND q.seg + 2 WHERE regexp_matches(q.text, '{P.NAME_QUESTION}') AND w.pos < 6 AND w.c <> '' AND w.c NOT IN ({_IN_COMMON}) AND w.n = 0 AND length(w.c) > 1")
def name_answers(spark, sf_dir):
    return speech.answer_spans(_segments(spark, sf_dir), _words(spark, sf_dir))


@query(f"SELECT coalesce({_CONTEXTS}, 'none') AS context, count(*) AS n FROM ({_SEGS}) GROUP BY 1")
def segment_context(spark, sf_dir):
    return _segments(spark, sf_dir).groupBy(F.coalesce(detect.segment_context(F.col("text")), F.lit("none")).alias("context")).agg(F.count(F.lit(1)).alias("n"))


_GAZETTEER = "(SELECT DISTINCT lower(substr(p_name, 1, 5)) AS name FROM part UNION SELECT 'zorblat' UNION SELECT 'quentin')"


def _gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.lower(F.substring("p_name", 1, 5)).alias("name")).union(spark.createDataFrame([("zorblat",), ("quentin",)], "name string")).distinct()


@query(f"SELECT file, s, e, 'known given name' AS reason, w AS heard FROM (SELECT *, l AND ((lag(l, 1, false) OVER o AND lag(l, 2, false) OVER o) OR (lead(l, 1, false) OVER o AND lead(l, 2, false) OVER o) OR (lag(l, 1, false) OVER o AND lead(l, 1, false) OVER o)) AS spelled FROM (SELECT *, regexp_full_match(c, '[a-z]') AS l FROM ({_WORDS})) WINDOW o AS (PARTITION BY file, seg ORDER BY pos)) WHERE NOT spelled AND n = 0 AND NOT regexp_full_match(c, '(?:[a-z][-\\s]){{2,}}[a-z]') AND c IN (SELECT name FROM {_GAZETTEER} UNION SELECT 'nine' UNION SELECT 'm')".replace("\\\\", "\\"))
def given_names(spark, sf_dir):
    """With two words on the list that also stand in numbers and in what is spelled."""
    return speech.given_name_spans(_words(spark, sf_dir), _gazetteer(spark, sf_dir).union(spark.createDataFrame([("nine",), ("m",)], "name string")))


_TOKENS = f"""(SELECT file, seg, pos, s, w, lower(regexp_replace(regexp_replace(w, '^[.,!?;:"'']+', ''), '[.,!?;:"'']+$', '')) AS c FROM ({_WORDS}))"""


@query(f"SELECT DISTINCT file, s, w, 'name/digits' AS why FROM {_TOKENS} WHERE c IN (SELECT name FROM {_GAZETTEER}) OR length(regexp_replace(c, '[^0-9]', '', 'g')) >= 4 UNION ALL SELECT file, min(s), string_agg(w, ' ' ORDER BY pos), 'spoken number' FROM (SELECT *, pos - row_number() OVER (PARTITION BY file, seg ORDER BY pos) AS island FROM {_TOKENS} WHERE c IN ({', '.join(repr(w) for w in P.VERIFIER_NUMBER_WORDS)})) GROUP BY file, seg, island HAVING count(*) >= 3")
def survivors(spark, sf_dir):
    return speech.survivors(_words(spark, sf_dir), _gazetteer(spark, sf_dir))


_SPANS = "(SELECT CAST(user_id AS VARCHAR) AS file, (floor(epoch(ts))::BIGINT % 100000)::DOUBLE AS \"start\", (floor(epoch(ts))::BIGINT % 100000 + CAST(floor(abs(value)) AS BIGINT) % 300)::DOUBLE AS \"end\", event_type AS reason, CAST(event_id AS VARCHAR) AS heard FROM events)"


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.unix_seconds(F.col("ts").cast("timestamp")) % 100000
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("file"), (start * 1.0).cast("double").alias("start"), (start + F.floor(F.abs("value")) % 300).cast("double").alias("end"), F.col("event_type").alias("reason"), F.col("event_id").cast("string").alias("heard"))


def _merged_sql(pad: float, gap: float) -> str:
    return f"""SELECT file, min(s) AS "start", max(e) AS "end", count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY file ORDER BY s, e, reason, heard ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY file ORDER BY s, e, reason, heard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 0 ELSE 1 END AS fresh FROM (SELECT file, greatest(0.0::DOUBLE, "start"::DOUBLE - {pad}::DOUBLE) AS s, "end"::DOUBLE + {pad}::DOUBLE AS e, reason, heard FROM {_SPANS}))) GROUP BY file, island"""


@query(_merged_sql(0.25, 0.5))
def span_merge(spark, sf_dir):
    """Pads and gaps that binary fractions hold exactly, so that both engines agree in the last digit."""
    return speech.islands(_spans(spark, sf_dir), 0.25, 0.5).groupBy("file", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n")).drop("island")


@query(_merged_sql(0, 0))
def span_merge_overlap(spark, sf_dir):
    return speech.islands(_spans(spark, sf_dir), 0, 0).groupBy("file", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n")).drop("island")


@query("""SELECT file, "start", "end", list_reduce(list_transform(own, lambda x: x.reason), lambda a, r: CASE WHEN contains(a, r) THEN a ELSE a || ' + ' || r END) AS reason, array_to_string(list_transform(own, lambda x: x.heard), ' ') AS heard FROM (SELECT file, min(s) AS "start", max(e) AS "end", list({'reason': reason, 'heard': heard} ORDER BY s, e, reason, heard) AS own FROM (SELECT *, sum(fresh) OVER (PARTITION BY file ORDER BY s, e, reason, heard ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY file ORDER BY s, e, reason, heard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 0.6::DOUBLE THEN 0 ELSE 1 END AS fresh FROM (SELECT file, greatest(0.0::DOUBLE, "start" - 0.3::DOUBLE) AS s, "end" + 0.3::DOUBLE AS e, reason, heard FROM """ + _SPANS + """))) GROUP BY file, island)""")
def span_reasons(spark, sf_dir):
    return speech.merged_spans(_spans(spark, sf_dir))


@query(f"""SELECT file, count(*) AS spans, sum("end" - "start") AS seconds FROM ({_merged_sql(0, 0)}) GROUP BY file""")
def span_totals(spark, sf_dir):
    merged = speech.islands(_spans(spark, sf_dir), 0, 0).groupBy("file", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.groupBy("file").agg(F.count(F.lit(1)).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("seconds"))


@query("""WITH sp AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS file, turn * 3.0::DOUBLE AS "start", turn * 3.0::DOUBLE + 2 AS "end" FROM conversations WHERE turn % 2 = 0), ws AS (SELECT CAST(conv_id AS VARCHAR) AS file, turn * 2.0::DOUBLE AS s, turn * 2.0::DOUBLE + 1.5 AS e FROM conversations)
SELECT sp.file, sp."start", sp."end", greatest(0.0, coalesce((SELECT max(e) FROM ws WHERE ws.file = sp.file AND ws.e <= sp."start" + 0.0625), 0.0)) AS lo, coalesce((SELECT min(s) FROM ws WHERE ws.file = sp.file AND ws.s >= sp."end" - 0.0625), 1e9) AS hi FROM sp""")
def neighbour_bounds(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("file"), "turn")
    spans = conv.filter("turn % 2 = 0").select("file", (F.col("turn") * 3.0).alias("start"), (F.col("turn") * 3.0 + 2).alias("end"))
    ws = conv.select("file", (F.col("turn") * 2.0).alias("s"), (F.col("turn") * 2.0 + 1.5).alias("e"))
    return speech.neighbour_bounds(spans, ws, 0.0625)


_COUNTS = ", ".join(f"length(regexp_replace(text, '[^\\x{{{lo:X}}}-\\x{{{hi:X}}}]', '', 'g')) AS {name}" for name, lo, hi in P.SCRIPTS)
_NAMES = [name for name, _, _ in P.SCRIPTS]


#: Other scripts, words of two, and invalid characters, which the fixtures lack.
_SCRIPTED = "concat(CASE doc_id % 5 WHEN 0 THEN repeat('\u0928\u092e\u0938\u094d\u0924\u0947 ', 600) WHEN 1 THEN repeat('\u041f\u0440\u0438\u0432\u0435\u0442 ', 40) ELSE '' END, text, CASE WHEN doc_id % 6 = 0 THEN ' \u041faypal x\u0645\u0645 \u0938\u041f' ELSE '' END, CASE WHEN doc_id % 7 = 0 THEN '\ufffd\ue123' ELSE '' END)"
_SUMMED = " + ".join(f"CASE WHEN regexp_matches(w, '[\\x{{{lo:X}}}-\\x{{{hi:X}}}]') THEN 1 ELSE 0 END" for _, lo, hi in P.SCRIPTS).replace("\\\\", "\\")
_MAIN = "CASE " + " ".join(f"WHEN {n} > 0 AND {n} = greatest({', '.join(_NAMES)}) THEN '{n}'" for n in sorted(_NAMES)) + " END"


@query(f"SELECT CAST(doc_id AS VARCHAR) AS file, {_MAIN} AS script, CASE WHEN {' + '.join(_NAMES)} > 0 THEN round(100.0 * greatest({', '.join(_NAMES)}) / ({' + '.join(_NAMES)}), 2) ELSE 0.0 END::DOUBLE AS purity, (CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 0 END)::BIGINT AS invalid, mixed, 0.0::DOUBLE AS dead_seconds, round(100.0 * greatest({', '.join(_NAMES)}) / ({' + '.join(_NAMES)}), 2) >= 95 AND doc_id % 7 <> 0 AND mixed = 0 AS passed FROM (SELECT doc_id, {_COUNTS}, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: {_SUMMED} > 1))::BIGINT AS mixed FROM (SELECT doc_id, {_SCRIPTED} AS text FROM documents))".replace("\\\\", "\\"))
def script_quality(spark, sf_dir):
    segs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file"), F.lit(0.0).alias("start"), F.lit(10.0).alias("end"), F.expr(_SCRIPTED).alias("text"))
    out = speech.quality(segs)
    return out.withColumn("purity", F.col("purity").cast("double"))


@query("SELECT doc_id, count_if(regexp_matches(w, '[A-z]') AND regexp_matches(w, '[Ѐ-ӿ]'))::BIGINT AS mixed FROM (SELECT doc_id, unnest(regexp_split_to_array(text || ' Пaypal иван', '\\s+')) AS w FROM documents) GROUP BY doc_id".replace("\\\\", "\\"))
def mixed_words(spark, sf_dir):
    text = F.concat("text", F.lit(" Пaypal иван"))
    return table(spark, sf_dir, "documents").select("doc_id", detect.mixed_words(detect.script_marks(text)).cast("long").alias("mixed"))


@query("SELECT CAST(conv_id AS VARCHAR) AS file, sum(CASE WHEN len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) / 2.0 < 40 THEN 120.0 ELSE 0 END)::DOUBLE AS dead_seconds FROM conversations GROUP BY conv_id".replace("\\\\", "\\"))
def dead_segments(spark, sf_dir):
    segs = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("file"), (F.col("turn") * 120.0).alias("start"), (F.col("turn") * 120.0 + 120).alias("end"), "text")
    return speech.quality(segs).select("file", "dead_seconds")
