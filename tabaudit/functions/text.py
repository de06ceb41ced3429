"""Column expressions on text. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace and word characters as the audited systems understand them.
WHITESPACE = r"[\s\x1c-\x1f]"
NOT_WORD = r"[^\p{L}\p{N}_]"
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\s\x1c-\x1f]"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Remove whitespace of any kind at both ends (``trim`` only removes blanks)."""
    return F.regexp_replace(text, rf"(?U)^{WHITESPACE}+|{WHITESPACE}+\z", "")


def squash_whitespace(text: Column) -> Column:
    """Strip both ends and turn every inner run of whitespace into one blank."""
    return F.trim(F.regexp_replace(text, rf"(?U){WHITESPACE}+", " "))


def is_blank(text: Column) -> Column:
    """Nothing but whitespace; NULL for NULL."""
    return text.rlike(rf"(?U)^{WHITESPACE}*\z")


def typed_json(row: Column, bare: Column) -> Column:
    """A row as JSON text. Values of the keys in ``bare`` are JSON already and keep their text; all others are written as strings."""

    def quoted(text: Column) -> Column:
        json = F.to_json(F.array(text))
        plain = ~text.rlike(r'["\\\x00-\x1f]') & F.is_valid_utf8(text)  # most need no escapes, and a JSON writer for each is slow
        return F.when(plain, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.substr(json, F.lit(2), F.length(json) - 2))

    def entry(e: Column) -> Column:
        value = F.when(e["value"].isNull(), "null").when(F.array_contains(bare, e["key"]), e["value"]).otherwise(quoted(e["value"]))
        return F.concat(quoted(e["key"]), F.lit(":"), value)

    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(row), entry), ","), F.lit("}"))


def normalize_title(title: Column) -> Column:
    """Lower case, punctuation removed, whitespace squashed."""
    return squash_whitespace(F.regexp_replace(F.lower(title), f"(?U){NOT_WORD_OR_SPACE}", ""))


def sort_tokens(text: Column) -> Column:
    """Lower-cased words in code-point order, joined by one blank: the form that title scores compare."""
    words = F.split(F.regexp_replace(F.lower(text), NOT_WORD, " "), " +")
    return F.array_join(F.array_sort(F.filter(words, lambda word: word != "")), " ")


def format_region_code(code: Column) -> Column:
    """Digits-only codes of four or more digits get their dots; everything else stays as it is."""
    two, inside = r"(\p{Nd}{2})", code
    for groups, rest in ((2, r"\p{Nd}?"), (3, r"\p{Nd}?"), (3, r"(\p{Nd}{2,})")):  # 4 or 5 digits, 6 or 7, more
        parts = ".".join(f"${n + 1}" for n in range(groups + rest.startswith("(")))
        inside = F.regexp_replace(inside, rf"(?U)^{WHITESPACE}*{two * groups}{rest}{WHITESPACE}*\z", parts)
    return inside


def is_undotted_code(code: Column) -> Column:
    """Whether :func:`format_region_code` changes the code; NULL for NULL."""
    return code.rlike(rf"(?U)^{WHITESPACE}*\p{{Nd}}{{4,}}{WHITESPACE}*\z")


def parse_number(text: Column) -> Column:
    """Plain decimal or scientific notation as DOUBLE, anything else NULL."""
    stripped = strip(text)
    return F.when(stripped.rlike(NUMBER), stripped.try_cast("double"))


def parse_year(text: Column) -> Column:
    """Whole year, fraction cut off; NULL for absent, unreadable or zero years."""
    year = parse_number(text).try_cast("int")
    return F.when(year != 0, year)
