"""Detectors as column expressions: all run in the JVM, none needs a Python worker."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern, as an array."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def one_of(value: Column, values: tuple[str, ...]) -> Column:
    return value.isin(*values)


def has_any(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether a literal part occurs; Parquet can skip row groups by such filters."""
    return reduce(lambda a, b: a | b, (text.contains(p) for p in parts))


def is_card_number(digits: Column) -> Column:
    """A payment-card number: length, no test number, more than four different digits, checksum, first digit."""
    return (
        F.length(digits).isin(13, 14, 15, 16, 19)
        & ~one_of(digits, P.TEST_CARDS)
        & (F.size(F.array_distinct(F.split(digits, ""))) > 4)
        & F.call_function("luhn_check", digits)
        & F.substring(digits, 1, 1).isin("3", "4", "5", "6")
    )


def card_numbers(text: Column) -> Column:
    """Real card numbers of a text, without separators."""
    bare = F.transform(found(text, P.CARD), lambda m: F.regexp_replace(m, "[ -]", ""))
    return F.filter(bare, is_card_number)


def is_placeholder(value: Column) -> Column:
    return value.rlike(P.PLACEHOLDER)


def quoted_credentials(text: Column) -> Column:
    return F.filter(found(text, P.QUOTED_CREDENTIAL, 1), lambda v: ~is_placeholder(v))


def url_credentials(text: Column) -> Column:
    return F.filter(found(text, P.URL_CREDENTIAL, 1), lambda v: ~is_placeholder(v))


def is_binary(content: Column) -> Column:
    """A zero byte in the first 8000."""
    return F.instr(F.substring(content, 1, 8000), F.lit(bytearray(b"\x00"))) > 0


def newlines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def is_false_secret(value: Column, parts: tuple[str, ...] = P.FALSE_SECRET_PARTS) -> Column:
    return value.isNull() | (F.length(value) < 12) | has_any(F.lower(value), parts) | value.contains(" ")


def is_admissible_rule(value: Column) -> Column:
    return ~value.contains("==>") & ~value.contains("\n")


def canonical(value: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(value), "[^a-z0-9]", "")


def is_searchable(value: Column, least: int = 5) -> Column:
    return F.length(F.regexp_replace(value, "[^A-Za-z0-9]", "")) >= least


def context_snippet(text: Column, pattern: str, width: int = 40) -> Column:
    """The first match with the characters around it; line ends become spaces."""
    return F.replace(F.regexp_extract(text, f"(?s).{{0,{width}}}(?:{pattern}).{{0,{width}}}", 0), F.lit("\n"), F.lit(" "))


def path_suffix(path: Column) -> Column:
    """The last suffix of a file name, lower-cased; empty if it has none."""
    name = F.substring_index(path, "/", -1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]*)$", 1))


def is_read_source(path: Column, size: Column) -> Column:
    """A source text outside of pruned folders that isn't too large."""
    parts = F.split(path, "/")
    folders = ~F.arrays_overlap(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), F.array(*(F.lit(p) for p in P.PRUNED_FOLDERS)))
    return folders & one_of(path_suffix(path), P.SOURCE_SUFFIXES) & (size <= P.MOST_TEXT_BYTES)


#: A character of private use stands for each script where texts are counted.
_MARKS = [chr(0xE000 + i) for i in range(len(P.SCRIPTS))]
_ANY_MARK = f"{_MARKS[0]}-{_MARKS[-1]}"
#: A word with marks of two scripts or more.
_MIXED = rf"(?<!\S)[^\s{_ANY_MARK}]*([{_ANY_MARK}])(?:\1|[^\s{_ANY_MARK}])*(?!\1)[{_ANY_MARK}]\S*"


def script_marks(text: Column) -> Column:
    """The text with each character of a script as the script's mark. A script is a plain range of code points, so Latin has some marks and no accented letters. One pass, after which scripts are counted and words judged without looking at ranges again."""
    every = "".join(chr(c) for _, lo, hi in P.SCRIPTS for c in range(lo, hi + 1))
    marks = "".join(m * (hi - lo + 1) for m, (_, lo, hi) in zip(_MARKS, P.SCRIPTS, strict=True))
    return F.translate(F.regexp_replace(text, r"\p{Co}", ""), every, marks)


def mark_counts(marks: Column) -> dict[str, Column]:
    """Characters of each script in a marked text."""
    return {name: F.length(marks) - F.length(F.replace(marks, F.lit(m), F.lit(""))) for m, (name, _, _) in zip(_MARKS, P.SCRIPTS, strict=True)}


def mixed_words(marks: Column) -> Column:
    """Words of a marked text that have characters of several scripts."""
    return F.regexp_count(marks, F.lit(_MIXED))


def invalid_characters(text: Column) -> Column:
    """Replacement characters and those of private use."""
    return F.regexp_count(text, F.lit(r"\x{FFFD}")) + F.regexp_count(text, F.lit(r"\p{Co}"))


def clean_word(word: Column) -> Column:
    """Edges without punctuation, lower case. Compatibility forms are folded before, by functions.unicode.nfkc."""
    return F.lower(F.regexp_replace(F.trim(word), r"""^[.,!?;:"'()\[\]।॥]+|[.,!?;:"'()\[\]।॥]+$""", ""))


def number_weight(clean: Column) -> Column:
    """Digits of a number, 1 for a number word, else 0; takes a cleaned word."""
    digits = F.regexp_replace(clean, "[^0-9]", "")
    return F.when((digits != "") & clean.rlike(r"^[0-9\-.\s()]+$"), F.length(digits)).when(one_of(clean, P.NUMBER_WORDS), 1).otherwise(0)


def is_spelled(clean: Column) -> Column:
    return clean.rlike(r"^(?:[a-z][-\s]){2,}[a-z]$")


def segment_context(text: Column) -> Column:
    """The first context that the text shows, or null."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(P.SEGMENT_CONTEXTS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out
