"""Findings over the objects of a history: which class of leak, in which path, how often."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import detect, patterns as P
from ..functions.redact import java_literal, redact_literals

UNREACHABLE = "<unreachable>"


def readable_blobs(objects: DataFrame) -> DataFrame:
    """Blobs that aren't too large, each content once for its repository. objects: repo, sha, type, size, content."""
    return objects.filter((F.col("type") == "blob") & (F.col("size") <= P.MOST_BLOB_BYTES)).dropDuplicates(["repo", "sha"])


def with_paths(objects: DataFrame, paths: DataFrame) -> DataFrame:
    """Objects with a path, or the mark of those that no commit reaches; an object of several paths gets the least."""
    one = paths.groupBy("repo", "sha").agg(F.min("path").alias("path"))
    return objects.join(one, ["repo", "sha"], "left").withColumn("path", F.coalesce("path", F.lit(UNREACHABLE)))


def name_tokens(texts: DataFrame, text: str, tokens: list[str], *by: str) -> DataFrame:
    """Occurrences of names in texts, by the columns of `by` and the token in lower case: token, n. A name counts wherever it stands, inside of words too; the first of the list that fits counts.

    The list is part of the plan, as it is a client's list of names; an empty one finds nothing and must not pass for a check."""
    if not tokens:
        raise ValueError("no names to look for")
    each = texts.select(*by, F.explode(detect.found(F.col(text), token_pattern(tokens))).alias("_m"))
    return each.groupBy(*by, F.lower("_m").alias("token")).agg(F.count(F.lit(1)).alias("n"))


def token_pattern(tokens: list[str]) -> str:
    return "(?iu)" + "|".join(java_literal(t) for t in tokens)


def token_paths(files: DataFrame, tokens: list[str], group: str = "repo", most: int | None = None) -> DataFrame:
    """Parts of paths that hold a name, outside of pruned folders: group, n; with `most` only the groups with most of them. files: group, path. A folder counts once however many files it holds."""
    parts = F.split("path", "/")
    upto = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    places = files.select(group, F.explode(upto).alias("_place")).distinct()
    names = F.split("_place", "/")
    pruned = F.exists(names, lambda n: detect.one_of(n, P.PRUNED_FOLDERS))
    hit = F.element_at(names, -1).rlike(token_pattern(tokens))
    out = places.filter(hit & ~pruned).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), group).limit(most) if most else out


def rewritten_messages(commits: DataFrame, message: str, names: str | None, label: str, literals: list[tuple[str, str]] = ()) -> DataFrame:
    """Commit messages with literals and then names replaced. Each commit stays a row, so counts and the graph are as they were."""
    out = redact_literals(F.col(message), list(literals))
    return commits.withColumn(message, F.regexp_replace(out, names, label) if names else out)


def class_counts(text: Column, path: Column, binary: Column | None = None) -> dict[str, Column]:
    """Hits of each class of finding. Text classes count in text, path classes of machine traces in binary content. Patterns are tried only where the text has what any match must hold."""
    emails, phones = detect.found(text, P.EMAIL), detect.found(text, P.PHONE)
    people = F.size(F.array_distinct(emails)) + F.size(F.array_distinct(phones))
    where = lambda held, n: F.when(held, n).otherwise(0)
    quoted = (text.contains('"') | text.contains("'")) & (text.contains("=") | text.contains(":"))
    in_text = {
        "card number": F.size(detect.card_numbers(text)),
        "cvv": where(F.lower(text).contains("cvv"), F.regexp_count(text, F.lit(P.CVV))),
        "credential": where(quoted, F.size(detect.quoted_credentials(text))),
        "url credential": where(text.contains("://") & text.contains("@"), F.size(detect.url_credentials(text))),
        "bulk personal data": where(path.rlike(P.BULK_PATH) & (detect.newlines(text) > 200), where(people > 20, people)),
    }
    in_binary = {
        "windows path": where(text.contains(":\\"), F.regexp_count(text, F.lit(P.WINDOWS_PATH))),
        "home path": where(text.contains("/Users/") | text.contains("/home/"), F.regexp_count(text, F.lit(P.HOME_PATH))),
    }
    out = {}
    for own, when in ((in_text, False), (in_binary, True)):
        for name, n in own.items():
            out[name] = n if binary is None else F.when(binary == F.lit(when), n).otherwise(0)
    out["artefact"] = path.rlike(P.ARTEFACT_PATH).cast("int")
    return out


def bulk_dumps(rows: DataFrame, group: str, text: str) -> DataFrame:
    """Dumps that come in rows: group, lines, people (different addresses and phones), bulk. Lines add up over rows and people over the whole, so a dump is never put together; texts are read once."""
    who = F.concat(detect.found(F.col(text), P.EMAIL), detect.found(F.col(text), P.PHONE))
    each = rows.select(group, (detect.newlines(F.col(text)) + 1).alias("_lines"), F.explode_outer(F.concat(F.array(F.lit(None).cast("string")), F.array_distinct(who))).alias("_who"))
    # the row without a name carries the lines
    once = each.groupBy(group, "_who").agg(F.sum(F.when(F.col("_who").isNull(), F.col("_lines"))).alias("_lines"))
    out = once.groupBy(group).agg((F.sum("_lines") - 1).alias("lines"), F.count("_who").alias("people"))
    return out.withColumn("bulk", (F.col("lines") > 200) & (F.col("people") > 20))


def findings(df: DataFrame, counts: dict[str, Column], keep: list[str]) -> DataFrame:
    """Long table of findings: the columns of keep, class, n. One pass over the text; rows without a finding give none."""
    cells = F.array(*(F.struct(F.lit(k).alias("class"), n.cast("long").alias("n")) for k, n in counts.items()))
    hit = F.filter(cells, lambda c: c["n"] > 0)
    return df.select(*keep, F.explode(hit).alias("_c")).select(*keep, "_c.class", "_c.n")


def rolled_up(found: DataFrame, group: str = "repo") -> DataFrame:
    """Totals by group and class, by group, and of all: with number of different paths."""
    return found.rollup(group, "class").agg(F.sum("n").alias("n"), F.count_distinct("path").alias("paths")).select(group, "class", "n", "paths")


def top_paths(found: DataFrame, group: str = "repo", most: int = 6) -> DataFrame:
    """The paths with most hits of each class, ties by path."""
    by_path = found.groupBy(group, "class", "path").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy(group, "class").orderBy(F.desc("n"), "path"))
    return by_path.withColumn("place", place.cast("long")).filter(F.col("place") <= most)
