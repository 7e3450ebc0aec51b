"""Identities of commits, their stable labels, and rules made from their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import numbered

LABEL = r"^Contributor [0-9]+$"


def identity(name: Column, email: Column) -> Column:
    return F.concat(name, F.lit(" <"), email, F.lit(">"))


def identities(commits: DataFrame) -> DataFrame:
    """Different authors and committers. commits: author_name, author_email, committer_name, committer_email."""
    both = F.array(identity(F.col("author_name"), F.col("author_email")), identity(F.col("committer_name"), F.col("committer_email")))
    return commits.select(F.explode(both).alias("identity")).filter("identity is not null").distinct()


def extended_key(known: DataFrame, seen: DataFrame) -> DataFrame:
    """The key (identity, n) with numbers for the new identities of `seen`, in their order, after the largest known one. Known numbers stay."""
    new = seen.select("identity").distinct().join(known.select("identity"), "identity", "left_anti")
    top = known.agg(F.coalesce(F.max("n"), F.lit(0)).alias("_top"))  # one row
    fresh = numbered(new, ["identity"]).crossJoin(F.broadcast(top)).select("identity", (F.col("n") + F.col("_top")).alias("n"))
    return known.select("identity", F.col("n").cast("long")).union(fresh)


def labelled(key: DataFrame) -> DataFrame:
    n = F.col("n").cast("string")
    return key.select("identity", "n", F.concat(F.lit("Contributor "), n).alias("label"), F.concat(F.lit("contributor"), n, F.lit("@example.com")).alias("email"))


def mailmap(key: DataFrame) -> DataFrame:
    """Lines of a mail map with the number that orders them."""
    return labelled(key).select("n", F.concat("label", F.lit(" <"), "email", F.lit("> "), "identity").alias("line"))


def residual(names: DataFrame, column: str = "name") -> DataFrame:
    """Different names that are not a label."""
    return names.select(column).distinct().filter((F.col(column) != "") & ~F.col(column).rlike(LABEL))


def merged_rules(*lists: DataFrame) -> DataFrame:
    """Rules (lhs, ordinal) of several lists, each left side once with its least ordinal, so that what an earlier list has stays where it was."""
    out = lists[0].select("lhs", "ordinal")
    for other in lists[1:]:
        out = out.union(other.select("lhs", "ordinal"))
    return out.groupBy("lhs").agg(F.min("ordinal").alias("ordinal"))


def name_rule(parts: DataFrame, extra: list[str] = (), exclude: list[str] = ()) -> tuple[list[str], list[str]]:
    """Full names and tokens of a merged rule, from name_parts. Further names are taken as they are, whatever their length; excluded ones are dropped from the tokens alone.

    The names come to the driver, as the rule is one pattern: they are the people of a delivery, not its rows."""
    full = {r.name for r in parts.filter("is_full").select("name").distinct().toLocalIterator()} | {x for x in extra if " " in x}
    tokens = {r.t for r in parts.select(F.explode("tokens").alias("t")).distinct().toLocalIterator()} | {x for x in extra if " " not in x}
    drop = {x.lower() for x in exclude}
    order = lambda names: sorted(names, key=lambda n: (-len(n), n))
    return order(full), order(t for t in tokens if t.lower() not in drop)


def name_parts(ids: DataFrame, least: int = 4) -> DataFrame:
    """Name of each identity, whether it is a full name, and the tokens that stand for it: its first and last long alphabetic parts, if it has two."""
    name = F.trim(F.regexp_replace(F.trim("identity"), r"^(.*?)\s*<.*$", "$1"))
    parts = F.filter(F.split(F.col("name"), r"\s+"), lambda p: p.rlike(r"^\p{L}+$") & (F.length(p) >= least))
    tokens = F.when(F.size("_parts") >= 2, F.array_distinct(F.array(F.element_at("_parts", 1), F.element_at("_parts", -1)))).otherwise(F.array().cast("array<string>"))
    return ids.withColumn("name", name).withColumn("_parts", parts).select("identity", "name", (F.col("name").contains(" ") & (F.length("name") >= 5)).alias("is_full"), tokens.alias("tokens"))
