"""Redactions as column expressions; only a replacement that depends on each match needs a Python worker."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .detect import found, has_any


def redact_private_keys(text: Column) -> Column:
    """Each PEM block becomes a mark and as many line ends as it had: texts around the blocks and marks are zipped."""
    blocks = found(text, P.PEM)
    marks = F.transform(blocks, lambda b: F.concat(F.lit(P.PEM_MARK), F.repeat(F.lit("\n"), (F.length(b) - F.length(F.replace(b, F.lit("\n"), F.lit("")))).cast("int"))))
    around = F.split(text, P.PEM, -1)
    joined = F.zip_with(around, marks, lambda a, m: F.concat(a, F.coalesce(m, F.lit(""))))
    return F.when(text.contains("PRIVATE KEY"), F.array_join(joined, "")).otherwise(text)


def redact_credentials(text: Column) -> Column:
    """All credential formats in their order; texts without any marker are passed on unread."""
    out = redact_private_keys(text)
    for pattern, mark in P.CREDENTIAL_FORMATS:
        out = F.regexp_replace(out, pattern, mark)
    return F.when(has_any(text, P.MARKERS), out).otherwise(text)


def redact_literals(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Literal rules, each after the one before."""
    for left, right in rules:
        text = F.replace(text, F.lit(left), F.lit(right))
    return text


def redact_ops_keys(text: Column) -> Column:
    return F.regexp_replace(text, P.OPS_API_KEY, P.OPS_KEY_MARK)


def redact_ops_passwords(text: Column) -> Column:
    return F.regexp_replace(text, P.OPS_PASSWORD, "$1" + P.OPS_SECRET_MARK)


def redact_token_urls(text: Column) -> Column:
    return F.regexp_replace(text, P.OPS_TOKEN_URL, "$1" + P.OPS_URL_MARK)


def blank_matches(text: Column, pattern: str) -> Column:
    """Each match becomes as many X."""
    marks = F.transform(found(text, pattern), lambda m: F.repeat(F.lit("X"), F.length(m)))
    return F.array_join(F.zip_with(F.split(text, pattern, -1), marks, lambda a, m: F.concat(a, F.coalesce(m, F.lit("")))), "")


def swap_matches(text: Column, pattern: str, replaced: Column, key=lambda m: m) -> Column:
    """Each match becomes what the map column `replaced` has for its key; a match without an entry stays."""
    marks = F.transform(found(text, pattern), lambda m: F.coalesce(F.try_element_at(replaced, key(m)), m))
    joined = F.array_join(F.zip_with(F.split(text, pattern, -1), marks, lambda a, m: F.concat(a, F.coalesce(m, F.lit("")))), "")
    return F.when(replaced.isNull(), text).otherwise(joined)


def merged_name_pattern(full_names: list[str], tokens: list[str]) -> str | None:
    """One alternation for all names: full names first, then tokens, longest first; None without any."""
    order = lambda names: sorted({n for n in names if n}, key=lambda n: (-len(n), n))
    every = [*order(full_names), *order(tokens)]
    return r"(?i)" + P.LEFT + "(?:" + "|".join(map(java_literal, every)) + ")" + P.RIGHT if every else None


def java_literal(value: str) -> str:
    return re.sub(r"([^A-Za-z0-9_ \x80-\U0010ffff])", r"\\\1", value)


def map_masker(mapping: dict[str, str]):
    """A function of a text column that replaces each key, however its runs are joined or cased, by its value; None for an empty map.

    The map is part of the task, so it is meant for a client's list of names, not for a table that grows with the corpus.
    """
    canon = {re.sub("[^a-z0-9]", "", k.lower()): v for k, v in mapping.items()}
    canon.pop("", None)
    keys = sorted((k for k in mapping if re.search("[A-Za-z0-9]", k)), key=lambda k: (-len(k), k))
    if not keys:
        return lambda text: text
    pattern = re.compile(r"(?i)(?<![A-Za-z0-9])(?:" + "|".join("[^A-Za-z0-9]{0,3}".join(re.findall("[A-Za-z0-9]+", k)) for k in keys) + r")(?![A-Za-z0-9])")

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else pattern.sub(lambda m: canon.get(re.sub("[^a-z0-9]", "", m[0].lower()), m[0]), t), na_action="ignore")

    return mask


def base64_variant(value: Column, pad: int) -> Column:
    """What a value looks like inside base64 after 0, 1 or 2 bytes more than whole groups; null if it is shorter than 16."""
    whole = F.regexp_replace(F.base64(F.concat(F.repeat(F.lit("\x00"), F.lit(pad)), value).cast("binary")), "\r\n", "")
    cut = F.substring(whole, [1, 3, 4][pad], 1 << 30)
    tail = F.when(F.length(cut) % 4 == 0, 4).otherwise(F.length(cut) % 4)
    core = F.when(F.length(cut) > 8, F.substring(cut, F.lit(1), F.length(cut) - tail)).otherwise(cut)
    return F.when(F.length(core) >= 16, core)


def base64_variants(value: Column) -> Column:
    """The variants at all alignments."""
    return F.array_compact(F.array(*(base64_variant(value, p) for p in range(3))))
