"""Spoken personal data: words of transcripts to time spans, by windows that all partition by file and segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import detect, patterns as P
from ..functions.unicode import nfkc

#: Schema of a transcript file.
TRANSCRIPT = "file string, detected_language string, folder_language string, duration double, n_words long, segments array<struct<start: double, end: double, text: string, words: array<struct<w: string, s: double, e: double>>>>"


def segments(transcripts: DataFrame) -> DataFrame:
    return transcripts.select("file", F.posexplode("segments").alias("seg", "_s")).select("file", "seg", F.col("_s.start").alias("start"), F.col("_s.end").alias("end"), F.col("_s.text").alias("text"), F.col("_s.words").alias("words"))


def words(segs: DataFrame) -> DataFrame:
    """file, seg, text, pos, w, s, e, and the cleaned word c with its number weight n."""
    flat = segs.select("file", "seg", "text", F.posexplode("words").alias("pos", "_w")).select("file", "seg", "text", "pos", F.col("_w.w").alias("w"), F.col("_w.s").alias("s"), F.col("_w.e").alias("e"))
    return flat.withColumn("c", detect.clean_word(nfkc("w"))).withColumn("n", detect.number_weight(F.col("c")))


def runs(ws: DataFrame, member: Column) -> DataFrame:
    """Unbroken runs of words for which `member` holds: file, seg, first, size, total (of n), s, e, heard."""
    by = Window.partitionBy("file", "seg").orderBy("pos")
    own = ws.filter(member).withColumn("_island", F.col("pos") - F.row_number().over(by))
    heard = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "w"))), lambda x: x["w"]), " ")
    return own.groupBy("file", "seg", "_island").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("size"), F.sum("n").cast("long").alias("total"), F.min("s").alias("s"), F.max("e").alias("e"), F.trim(heard).alias("heard"), F.first("text").alias("text")).drop("_island")


def number_spans(ws: DataFrame) -> DataFrame:
    """Runs of four digits or more, or of any number where the segment has a context."""
    found = runs(ws, F.col("n") > 0).withColumn("context", detect.segment_context(F.col("text")))
    reason = F.coalesce("context", F.concat(F.lit("number sequence ("), F.col("total").cast("string"), F.lit(" digits)")))
    return found.filter((F.col("total") >= 4) | F.col("context").isNotNull()).select("file", "s", "e", reason.alias("reason"), "heard")


def is_letter(c: Column) -> Column:
    return c.rlike("^[a-z]$")


def spelled_spans(ws: DataFrame) -> DataFrame:
    """Words spelled with hyphens, and runs of three single letters or more."""
    whole = ws.filter(detect.is_spelled(F.col("c"))).select("file", "s", "e", F.trim("w").alias("heard"))
    letters = runs(ws, is_letter(F.col("c"))).filter("size >= 3").select("file", "s", "e", "heard")
    return whole.union(letters).select("file", "s", "e", F.lit("spelled out letter by letter").alias("reason"), "heard")


def title_spans(ws: DataFrame) -> DataFrame:
    by = Window.partitionBy("file", "seg").orderBy("pos")
    before = F.lag("c").over(by)
    return ws.withColumn("_before", before).filter(F.col("_before").rlike(P.TITLE) & ~detect.one_of(F.col("c"), P.COMMON_WORDS)).select("file", "s", "e", F.lit("name after title").alias("reason"), F.trim("w").alias("heard"))


def is_name(c: Column, n: Column, longer_than: int) -> Column:
    return (c != "") & ~detect.one_of(c, P.COMMON_WORDS) & (n == 0) & (F.length(c) > longer_than)


def cue_spans(ws: DataFrame) -> DataFrame:
    """The one word after "my name is", where the third word may go on, or after "this is"."""
    by = Window.partitionBy("file", "seg").orderBy("pos")
    b = [F.lag("c", k).over(by) for k in (1, 2, 3)]
    out = ws.withColumn("_1", b[0]).withColumn("_2", b[1]).withColumn("_3", b[2])
    my_name = (F.col("_3") == "my") & (F.col("_2") == "name") & F.col("_1").startswith("is")
    this_is = (F.col("_2") == "this") & (F.col("_1") == "is")
    return out.filter((my_name | this_is) & is_name(F.col("c"), F.col("n"), 2)).select("file", "s", "e", F.lit("name after naming cue").alias("reason"), F.trim("w").alias("heard"))


def answer_spans(segs: DataFrame, ws: DataFrame) -> DataFrame:
    """Names among the first six words of the two segments after a question for a name; one row for each question that a word answers."""
    asked = segs.filter(F.col("text").rlike(P.NAME_QUESTION)).select("file", F.explode(F.array(F.col("seg") + 1, F.col("seg") + 2)).alias("seg"))
    early = ws.filter((F.col("pos") < 6) & is_name(F.col("c"), F.col("n"), 1))
    return early.join(asked, ["file", "seg"]).select("file", "s", "e", F.lit("answer to a name question").alias("reason"), F.trim("w").alias("heard"))


def given_name_spans(ws: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Words of a list of given names (name, lower case) that stand outside of numbers and of what is spelled; Spark broadcasts the list where its size allows."""
    by = Window.partitionBy("file", "seg").orderBy("pos")
    single = is_letter(F.col("c"))
    # a letter in a run of three or more: two more before, two more after, or one on either side
    before, after = [F.coalesce(is_letter(F.lag("c", k).over(by)), F.lit(False)) for k in (1, 2)], [F.coalesce(is_letter(F.lead("c", k).over(by)), F.lit(False)) for k in (1, 2)]
    spelled = single & (before[0] & before[1] | after[0] & after[1] | before[0] & after[0])
    ws = ws.withColumn("_spelled", spelled | detect.is_spelled(F.col("c"))).filter(~F.col("_spelled") & (F.col("n") == 0))
    return ws.join(gazetteer.select(F.col("name").alias("c")), "c", "left_semi").select("file", "s", "e", F.lit("known given name").alias("reason"), F.trim("w").alias("heard"))


def health_spans(segs: DataFrame) -> DataFrame:
    return segs.filter(detect.segment_context(F.col("text")) == "health information").select("file", F.col("start").alias("s"), F.col("end").alias("e"), F.lit("health information").alias("reason"), F.substring(F.trim("text"), 1, 60).alias("heard"))


def planned_spans(transcripts: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """All rules over transcripts, merged: file, start, end, reason, heard."""
    segs = segments(transcripts)
    ws = words(segs)
    every = [health_spans(segs), number_spans(ws), spelled_spans(ws), given_name_spans(ws, gazetteer), title_spans(ws), cue_spans(ws), answer_spans(segs, ws)]
    out = every[0]
    for x in every[1:]:
        out = out.union(x)
    return merged_spans(out.select("file", F.col("s").alias("start"), F.col("e").alias("end"), "reason", "heard"))


def islands(spans: DataFrame, pad: float, gap: float) -> DataFrame:
    """spans with their padded ends and the number of the merged span that they belong to, in each file."""
    padded = spans.withColumn("start", F.greatest(F.lit(0.0), F.col("start") - pad)).withColumn("end", F.col("end") + pad)
    order = Window.partitionBy("file").orderBy("start", "end", *(c for c in ("reason", "heard") if c in spans.columns))
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = padded.withColumn("_new", F.when(F.col("start") <= reach + gap, 0).otherwise(1))
    return new.withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def merged_spans(spans: DataFrame, pad: float = P.PAD_SECONDS, gap: float = P.MERGE_GAP_SECONDS) -> DataFrame:
    """Padded spans that lie within `gap` of each other become one. A reason is added unless what is there already holds it; all that was heard is kept."""
    own = F.array_sort(F.collect_list(F.struct("start", "end", "reason", "heard")))
    joined = islands(spans, pad, gap).groupBy("file", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), own.alias("_own"))
    reason = F.aggregate("_own", F.lit(""), lambda a, x: F.when(a == "", x["reason"]).when(a.contains(x["reason"]), a).otherwise(F.concat(a, F.lit(" + "), x["reason"])))
    heard = F.trim(F.array_join(F.transform("_own", lambda x: x["heard"]), " "))
    return joined.select("file", "start", "end", reason.alias("reason"), heard.alias("heard"))


def neighbour_bounds(spans: DataFrame, ws: DataFrame, slack: float = 0.05) -> DataFrame:
    """spans (file, start, end) with lo, the end of the last word before, and hi, the start of the first word after.

    As words come in order, one sort of words and span edges in each file answers all spans; no pairs are made. Spans of files without words get 0 and 1e9.
    """
    low = spans.select("file", "start", "end", (F.col("start") + slack).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("double").alias("_v"))
    low = low.union(ws.select("file", F.lit(None).cast("double"), F.lit(None).cast("double"), "e", F.lit(0), "e"))
    upto = Window.partitionBy("file").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    low = low.withColumn("lo", F.greatest(F.lit(0.0), F.coalesce(F.max("_v").over(upto), F.lit(0.0)))).filter("_kind = 1").select("file", "start", "end", "lo")
    high = spans.select("file", "start", "end", (F.col("end") - slack).alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast("double").alias("_v"))
    high = high.union(ws.select("file", F.lit(None).cast("double"), F.lit(None).cast("double"), "s", F.lit(1), "s"))
    after = Window.partitionBy("file").orderBy("_at", "_kind").rowsBetween(0, Window.unboundedFollowing)
    high = high.withColumn("hi", F.coalesce(F.min("_v").over(after), F.lit(1e9))).filter("_kind = 0").select("file", "start", "end", "hi")
    return low.distinct().join(high.distinct(), ["file", "start", "end"])


def quality(segs: DataFrame) -> DataFrame:
    """Script purity and what makes a transcript unfit, for each file; dead seconds are told but don't decide."""
    segs = segs.withColumn("_marks", detect.script_marks(F.col("text")))
    counts = detect.mark_counts(F.col("_marks"))
    per_word = detect.mixed_words(F.col("_marks"))
    long_ = F.col("end") - F.col("start")
    spoken = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    dead = F.when((long_ > P.DEAD_SECONDS) & (spoken / (long_ / 60) < P.DEAD_WORDS_A_MINUTE), long_).otherwise(0.0)
    sums = segs.groupBy("file").agg(*(F.sum(c).alias(k) for k, c in counts.items()), F.sum(detect.invalid_characters(F.col("text"))).alias("invalid"), F.sum(per_word).alias("mixed"), F.sum(dead).alias("dead_seconds"))
    total = sum((F.col(k) for k in counts), F.lit(0))
    most = F.greatest(*(F.col(k) for k in counts))
    purity = F.when(total > 0, F.round(100.0 * most / total, 2)).otherwise(0.0)
    main = F.coalesce(*(F.when((F.col(k) == most) & (most > 0), k) for k in sorted(counts)))
    out = sums.select("file", main.alias("script"), purity.alias("purity"), "invalid", "mixed", "dead_seconds")
    return out.withColumn("passed", (F.col("purity") >= 95) & (F.col("invalid") == 0) & (F.col("mixed") == 0))


def survivors(ws: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Words of finished audio that are names, or numbers of four digits or more, or in runs of three number words or more."""
    token = ws.withColumn("c", F.lower(F.regexp_replace(F.trim("w"), r"""^[.,!?;:"']+|[.,!?;:"']+$""", "")))
    digits = F.length(F.regexp_replace("c", "[^0-9]", "")) >= 4
    names = token.join(gazetteer.select(F.col("name").alias("c")), "c", "left_semi").select("file", "s", "w")
    numbers = token.filter(digits).select("file", "s", "w")
    spoken = runs(token, detect.one_of(F.col("c"), P.VERIFIER_NUMBER_WORDS)).filter("size >= 3").select("file", "s", F.col("heard").alias("w"))
    return names.union(numbers).distinct().withColumn("why", F.lit("name/digits")).union(spoken.withColumn("why", F.lit("spoken number")))


def totals(spans: DataFrame, recordings: DataFrame) -> DataFrame:
    """Spans, seconds and their share of the recording (file, duration), for each file and, with a null file, for all."""
    own = spans.groupBy("file").agg(F.count(F.lit(1)).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("seconds"))
    each = recordings.select("file", "duration").join(own, "file", "left").fillna(0, ["spans", "seconds"])
    summed = each.rollup("file").agg(F.sum("spans").alias("spans"), F.sum("seconds").alias("seconds"), F.sum("duration").alias("_duration"))
    return summed.select("file", "spans", "seconds", F.when(F.col("_duration") > 0, F.round(100 * F.col("seconds") / F.col("_duration"), 2)).otherwise(0.0).alias("percent"))


def survivor_transcripts(segs: DataFrame, found: DataFrame) -> DataFrame:
    """file, segments, survivors: what is written beside each finished recording. A file's segments are one row, as they are one file."""
    of = lambda df, *columns: df.groupBy("file").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("_l"))
    told = of(found, "s", "w", "why").withColumnRenamed("_l", "survivors")
    return of(segs, "seg", "text").withColumnRenamed("_l", "segments").join(told, "file", "left")
