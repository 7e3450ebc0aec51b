"""Rules for flattened medical records: one row per element, nested ones by their path. Rules hold at every path, nested or not.

elements: file, patient, path, keyword, vr, grp (group number), value.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from .gates import needle_hits
from .ranking import numbered


ELEMENT = (("path", pa.string()), ("keyword", pa.string()), ("vr", pa.string()), ("grp", pa.int32()), ("value", pa.string()))
#: Characters of records that are taken apart before their elements are given back.
STRETCH = 1 << 22


def _elements(text: str | None) -> Iterator[tuple]:
    """path, keyword, vr, group and value of each element of a record; none if it is no record."""
    try:
        whole = json.loads(text)
    except (TypeError, ValueError):
        return
    if not isinstance(whole, dict):
        return
    open_ = [("", whole)]
    while open_:
        above, record = open_.pop()
        for tag, e in record.items():
            if not isinstance(e, dict) or not (len(tag) == 8 and all(c in "0123456789abcdefABCDEF" for c in tag)):
                continue
            keyword, values = e.get("keyword") or tag, e.get("Value") or []
            path = above + keyword
            vr = e.get("vr")
            if vr == "SQ":
                open_ += [(f"{path}/{i}/", item) for i, item in enumerate(values) if isinstance(item, dict)]
                continue
            plain = [v.get("Alphabetic", "") if isinstance(v, dict) else str(v) for v in values]
            yield path, keyword, vr if vr is None or isinstance(vr, str) else str(vr), int(tag[:4], 16), "\\".join(plain)


def flattened(records: DataFrame, content: str, *keep: str) -> DataFrame:
    """Rows of elements from records in the JSON model of the DICOM standard (tag -> vr, Value, and a keyword), with the columns of `keep`. Items of sequences, however
    deep, get their place in the path; several values are joined by a backslash; what is no record gives no rows. Elements of OriginalAttributesSequence are left out, as they repeat what was there before."""
    types = {"grp": T.IntegerType()}
    rows = records.select(*keep, F.col(content).alias("_content"))
    schema = T.StructType([f for f in rows.schema if f.name != "_content"] + [T.StructField(c, types.get(c, T.StringType())) for c, _ in ELEMENT])

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found, size = [], [], 0
            for i in range(batch.num_rows):
                text = batch["_content"][i].as_py()
                before = len(found)
                found.extend(_elements(text))
                at += [i] * (len(found) - before)
                size += len(text or "")
                if size >= STRETCH or i == batch.num_rows - 1:
                    places, columns = pa.array(at, pa.int64()), list(zip(*found)) or [()] * len(ELEMENT)
                    yield pa.RecordBatch.from_arrays([*(batch[c].take(places) for c in keep), *(pa.array(v, kind) for v, (_, kind) in zip(columns, ELEMENT, strict=True))], names=schema.names)
                    at, found, size = [], [], 0

    return rows.mapInArrow(flat, schema).filter(~F.col("path").rlike("(^|/)OriginalAttributesSequence/"))


def blanked(elements: DataFrame, device_texts: list[str] = ()) -> DataFrame:
    """Identifying elements, and free texts that name a device, become empty."""
    device = F.lit(False)
    for text in device_texts:
        device = device | F.col("value").contains(text)
    gone = F.col("keyword").isin(*P.BLANKED_TAGS) | (F.col("vr").isin(*P.FREE_TEXT_VRS) & device)
    return elements.withColumn("value", F.when(gone, "").otherwise(F.col("value")))


def without_private(elements: DataFrame) -> DataFrame:
    return elements.filter(F.pmod("grp", F.lit(2)) == 0)


def private_elements(elements: DataFrame) -> DataFrame:
    return elements.filter(F.pmod("grp", F.lit(2)) == 1)


def patients(elements: DataFrame, secret: str) -> DataFrame:
    """patient, pseudo_id in the order of names, and a shift of 365 to 3650 days back that follows from the secret."""
    ids = numbered(elements.select("patient").distinct().filter("patient is not null"), ["patient"])
    days = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(secret), "patient").cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(3286))
    return ids.select("patient", F.concat(F.lit("CT-"), F.when(F.col("n") < 1000, F.lpad(F.col("n").cast("string"), 3, "0")).otherwise(F.col("n").cast("string"))).alias("pseudo_id"), (-365 - days).cast("int").alias("shift_days"))


def shifted_date(value: Column, days: Column) -> Column:
    """yyyyMMdd, with any suffix kept, moved by days; what is no date becomes empty."""
    date = F.to_date(F.try_to_timestamp(F.substring(value, 1, 8), F.lit("yyyyMMdd")))
    moved = F.date_format(F.date_add(date, days), "yyyyMMdd")
    return F.when(date.isNull() | ~F.substring(value, 1, 8).rlike("^[0-9]{8}$"), "").otherwise(F.concat(moved, F.substring(value, 9, 1 << 30)))


def uid(old: Column, secret: str) -> Column:
    """A new UID that follows from the old one and the secret, under the root for UUIDs; equal wherever it stands, so references hold."""
    hex_ = F.md5(F.concat(F.lit(secret), old).cast("binary"))
    number = lambda a: F.lpad(F.conv(F.substring(hex_, a, 8), 16, 10), 10, "0")
    return F.concat(F.lit("2.25.1"), number(1), number(9), number(17))


def remapped(elements: DataFrame, secret: str) -> DataFrame:
    """Elements with all UIDs, at any depth, mapped by `uid`, each of several values by itself; those that name a class or a syntax stay."""
    each = F.array_join(F.transform(F.split("value", r"\\"), lambda v: F.when(v == "", "").otherwise(uid(v, secret))), "\\")
    mapped = (F.col("vr") == "UI") & (F.col("value") != "") & ~F.col("keyword").isin(*P.EXEMPT_UIDS)
    return elements.withColumn("value", F.when(mapped, each).otherwise(F.col("value")))


def dangling(references: DataFrame, defined: DataFrame) -> DataFrame:
    """references (uid) that nothing defines: (total, dangling) in one row."""
    marked = references.select("uid").join(defined.select("uid").distinct().withColumn("_there", F.lit(1)), "uid", "left")
    return marked.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("_there").isNull()).alias("dangling"))


def stamped(elements: DataFrame, key: DataFrame) -> DataFrame:
    """Names and ids of patients become their pseudonym, dates are shifted, private elements go. key: patient, pseudo_id, shift_days; a patient without a key gets empty names and dates."""
    out = without_private(elements).join(key, "patient", "left")
    value = F.when(F.col("path").isin("PatientName", "PatientID"), F.coalesce("pseudo_id", F.lit(""))).when(F.col("vr").isin("DA", "DT"), F.coalesce(shifted_date(F.col("value"), F.col("shift_days")), F.lit(""))).otherwise(F.col("value"))
    return out.withColumn("value", value).drop("pseudo_id", "shift_days")


def clusters(rows: DataFrame, group: str, at: str, gap: int = 40) -> DataFrame:
    """Groups of places at most `gap` apart, with the midpoint of each: the bright lines between the tiles of a film."""
    from pyspark.sql import Window

    order = Window.partitionBy(group).orderBy(at)
    new = rows.withColumn("_new", F.when(F.col(at) - F.lag(at).over(order) <= gap, 0).otherwise(1))
    marked = new.withColumn("cluster", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(group, "cluster").agg(F.floor((F.min(at) + F.max(at)) / 2).cast("long").alias("centre"), F.count(F.lit(1)).alias("n"))


#: What every finished file says of itself: keyword, vr, group, value.
FLAGS = (("PatientIdentityRemoved", "CS", 0x12, "YES"), ("DeidentificationMethod", "LO", 0x12, P.DEIDENTIFICATION_METHOD))


def deidentified(elements: DataFrame, key: DataFrame, secret: str, device_texts: list[str] = ()) -> DataFrame:
    """Elements (file, patient, path, keyword, vr, grp, value) of finished files: private ones gone, identifying ones empty at any depth, UIDs mapped, dates shifted, pseudonyms and flags set."""
    named = ~F.col("path").isin(*(f[0] for f in FLAGS))
    out = stamped(remapped(blanked(elements.filter(named), device_texts), secret), key)
    flag = F.array(*(F.struct(F.lit(k).alias("path"), F.lit(k).alias("keyword"), F.lit(vr).alias("vr"), F.lit(grp).alias("grp"), F.lit(value).alias("value")) for k, vr, grp, value in FLAGS))
    flags = elements.select("file", "patient").distinct().select("file", "patient", F.inline(flag))
    columns = ["file", "patient", "path", "keyword", "vr", "grp", "value"]
    return out.select(*columns).union(flags.select(*columns))


def delivered_path(file: Column, pseudo_id: Column) -> Column:
    """Where a patient's file is written: below the pseudonym, with its path inside the patient's folder."""
    return F.concat(pseudo_id, F.lit("/"), F.regexp_replace(file, "^[^/]*/", ""))


def known_strings(elements: DataFrame, strings: DataFrame, value: str = "value") -> DataFrame:
    """value, files: strings that must not be there and the number of files in which an element still holds them, in any case of letters."""
    hits = needle_hits(elements, "file", "value", strings, value, mode="upper", least=1)
    return hits.select("value", "doc").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("files"))


def secondary_captures(elements: DataFrame) -> DataFrame:
    """Files whose class says that their pixels are a capture of a screen or film."""
    return elements.filter((F.col("path") == "SOPClassUID") & F.col("value").isin(*P.SECONDARY_CAPTURE)).select("file").distinct()


def references(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UIDs that elements refer to at any depth, and those that files define."""
    uids = lambda keyword: elements.filter(F.col("keyword") == keyword).select(F.col("value").alias("uid"))
    return uids("ReferencedSOPInstanceUID"), uids("SOPInstanceUID")


def checks(before: DataFrame, after: DataFrame, strings: DataFrame, read_texts: DataFrame | None = None) -> DataFrame:
    """The verdicts on finished files: known strings, references that must hold as they did, private elements, and known strings in what was read in their pictures (file, value)."""
    from . import gates

    n_files = after.select(F.countDistinct("file").alias("checked"))
    hits = known_strings(after, strings).agg(F.count(F.lit(1)).alias("violations"))
    counts = []
    for side, df in (("b", before), ("a", after)):
        counts.append(dangling(*references(df)).select(F.col("total").alias(f"{side}_total"), F.col("dangling").alias(f"{side}_dangling")))
    both = counts[0].crossJoin(counts[1])  # one row each
    links = both.select(F.greatest("a_total", "b_total").alias("checked"), ((F.col("a_total") != F.col("b_total")) | (F.col("a_dangling") != F.col("b_dangling"))).cast("long").alias("violations"))
    private = n_files.crossJoin(private_elements(after).agg(F.countDistinct("file").alias("violations")))
    rows = [gates.counted("known strings", n_files.crossJoin(hits)), gates.counted("references", links), gates.counted("private elements", private)]
    if read_texts is None:
        rows.append(gates.counted("pictures", n_files.select(F.lit(0).cast("long").alias("checked"), F.lit(0).cast("long").alias("violations"))))
    else:
        shown = known_strings(read_texts, strings).agg(F.count(F.lit(1)).alias("violations"))
        rows.append(gates.counted("pictures", read_texts.agg(F.countDistinct("file").alias("checked")).crossJoin(shown)))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


#: What a file whose pixels were masked says of them: not burned in any more, and not compressed.
PIXEL_FLAGS = (("BurnedInAnnotation", "CS", 0x28, "NO"), ("TransferSyntaxUID", "UI", 0x02, "1.2.840.10008.1.2.1"))


def pixels_masked(elements: DataFrame, files: DataFrame) -> DataFrame:
    """Elements with the flags of masked pixels set in the given files (file); the others' stay."""
    marked = elements.join(files.select("file").distinct().withColumn("_masked", F.lit(1)), "file", "left")
    columns = ["file", "patient", "path", "keyword", "vr", "grp", "value"]
    flag = F.array(*(F.struct(F.lit(k).alias("path"), F.lit(k).alias("keyword"), F.lit(vr).alias("vr"), F.lit(grp).alias("grp"), F.lit(value).alias("value")) for k, vr, grp, value in PIXEL_FLAGS))
    kept = marked.filter(F.col("_masked").isNull() | ~F.col("path").isin(*(f[0] for f in PIXEL_FLAGS)))
    return kept.select(*columns).union(marked.filter("_masked = 1").select("file", "patient").distinct().select("file", "patient", F.inline(flag)).select(*columns))
