"""Stable pseudonyms by order of first appearance: found values are ranked once, then written back by a map for each document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.detect import found
from ..functions.redact import blank_matches, redact_ops_keys, redact_ops_passwords, redact_token_urls, swap_matches
from ..session import cut_lineage
from .ranking import numbered


def first_seen(df: DataFrame, doc: str, text: str, pattern: str, key: Callable[[Column], Column] = lambda m: m) -> DataFrame:
    """Different values of a pattern, numbered from 1 by the document and place where they first stand: value, n."""
    each = df.select(F.col(doc).alias("_doc"), F.posexplode(found(F.col(text), pattern)).alias("_at", "_m"))
    values = each.select(key(F.col("_m")).alias("value"), F.struct("_doc", "_at").alias("_first")).groupBy("value").agg(F.min("_first").alias("_first"))
    flat = values.select("value", F.col("_first._doc").alias("_doc"), F.col("_first._at").alias("_at"))
    return numbered(flat, ["_doc", "_at"]).select("value", "n")


def email_names(df: DataFrame, doc: str, text: str) -> DataFrame:
    """value (lower case), replacement of each address."""
    seen = first_seen(df, doc, text, P.EMAIL, F.lower)
    return seen.select("value", email_label(F.col("n")).alias("replacement"))


def email_label(n: Column) -> Column:
    return F.concat(F.lit("person"), F.when(n < 1000, F.lpad(n.cast("string"), 3, "0")).otherwise(n.cast("string")), F.lit("@example.com"))


def minted_numbers(df: DataFrame, doc: str, text: str) -> DataFrame:
    """value, replacement of each long number: as long, and no number that was there by intent."""
    seen = first_seen(df, doc, text, P.OPS_LONG_NUMBER)
    return seen.select("value", minted(F.col("value"), F.col("n")).alias("replacement"))


def minted(value: Column, n: Column) -> Column:
    return (F.rpad(F.lit("1"), F.length(value), F.lit("0")).cast("decimal(38,0)") + n - 1).cast("string")


def mask_exports(df: DataFrame, doc: str, text: str, mask_names: Callable[[Column], Column] = lambda t: t) -> DataFrame:
    """The masking of exported texts in its fixed order: names, keys, passwords, token URLs, e-mails, long numbers, phones.

    The order is part of the meaning: a number that is minted with ten to thirteen digits looks like a phone and is blanked by the last step.
    """
    out = df.withColumn(text, redact_token_urls(redact_ops_passwords(redact_ops_keys(mask_names(F.col(text))))))
    # both kinds are found in one reading; an address is out of the way before numbers are looked for, and what stands for it has none
    listed = lambda ms, kind: F.transform(ms, lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), m.alias("value")))
    emails = F.transform(found(F.col(text), P.EMAIL), F.lower)
    numbers = found(F.regexp_replace(text, P.EMAIL, "a@example.com"), P.OPS_LONG_NUMBER)
    each = cut_lineage(out.select(F.col(doc).alias("_doc"), F.inline(F.concat(listed(emails, "email"), listed(numbers, "number")))))
    firsts = each.groupBy("kind", "value").agg(F.min(F.struct("_doc", "at")).alias("_first"))
    of = lambda kind: numbered(firsts.filter(F.col("kind") == kind).select("kind", "value", F.col("_first._doc").alias("_doc"), F.col("_first.at").alias("at")), ["_doc", "at"])
    names = of("email").select("kind", "value", email_label(F.col("n")).alias("replacement")).union(of("number").select("kind", "value", minted(F.col("value"), F.col("n")).alias("replacement")))
    own = each.select("_doc", "kind", "value").distinct().join(names, ["kind", "value"])
    pairs = lambda kind: F.map_from_entries(F.collect_list(F.when(F.col("kind") == kind, F.struct("value", "replacement")))).alias(f"_{kind}")
    maps = own.groupBy("_doc").agg(pairs("email"), pairs("number"))
    joined = out.join(maps, F.col(doc) == F.col("_doc"), "left")
    masked = swap_matches(swap_matches(F.col(text), P.EMAIL, F.col("_email"), F.lower), P.OPS_LONG_NUMBER, F.col("_number"))
    return joined.withColumn(text, blank_matches(masked, P.OPS_PHONE)).drop("_doc", "_email", "_number")


def unlisted_hosts(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Hosts that no entry of `allowed` (host) covers, with a stable pseudonym in the order of their names: host, replacement."""
    hosts = df.select(F.explode(F.array_distinct(found(F.col(column), r"(?i)https?://([A-Za-z0-9.-]+)", 1))).alias("host")).select(F.lower("host").alias("host")).distinct()
    rest = hosts.join(allowed.select("host"), "host", "left_anti")
    return numbered(rest, ["host"]).select("host", F.concat(F.lit("host"), F.col("n").cast("string"), F.lit(".invalid")).alias("replacement"))
