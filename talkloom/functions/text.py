"""Text functions with the white space of the original tools: Unicode's, and U+001C to U+001F."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"


def text_of(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column | str) -> Column:
    """White space off both ends; null counts as empty."""
    return F.regexp_replace(text_of(c), rf"(?U)^{SPACE}+|{SPACE}+$", "")


def words(c: Column | str) -> Column:
    return F.array_remove(F.split(text_of(c), rf"(?U){SPACE}+"), "")


def word_count(c: Column | str) -> Column:
    return F.size(words(c)).cast("long")


def _tag_pattern(tag: str) -> str:
    name = re.escape(tag)
    return rf"(?sU)<{name}>{SPACE}*(.*?){SPACE}*</{name}>"


def tag(c: Column | str, name: str) -> Column:
    """Trimmed content of the first ``<name>`` element, empty if there is none."""
    return F.regexp_extract(text_of(c), _tag_pattern(name), 1)


def has_tag(c: Column | str, name: str) -> Column:
    return F.regexp_like(text_of(c), F.lit(_tag_pattern(name)))


def tag_or_all(c: Column | str, name: str) -> Column:
    """The element's content, or the whole trimmed text without that element."""
    return F.when(has_tag(c, name), tag(c, name)).otherwise(strip(c))


def from_first(c: Column | str, marker: str) -> Column:
    """The text from the first marker on, or all of it without one."""
    at = F.instr(text_of(c), marker)
    return F.when(at == 0, text_of(c)).otherwise(F.substring(text_of(c), at, F.length(text_of(c))))


def strip_fence(c: Column | str) -> Column:
    """A reply without its Markdown code fence."""
    opened = F.regexp_replace(strip(c), rf"(?U)^```(?:json)?{SPACE}*", "")
    return F.regexp_replace(opened, rf"(?U){SPACE}*```$", "")


def or_else(c: Column | str, default: str) -> Column:
    """The text, or a default for null and empty."""
    return F.coalesce(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")), F.lit(default))


def render(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places of a template; ``{{`` and ``}}`` are literal braces.

    The template is cut once, so braces inside values stay as they are.
    """
    parts: list[Column] = []
    for piece in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        if piece in ("{{", "}}"):
            parts.append(F.lit(piece[0]))
        elif re.fullmatch(r"\{\w+\}", piece):
            parts.append(text_of(values[piece[1:-1]]))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def valid_utf8(c: Column | str) -> Column:
    """Bytes as text, invalid ones as U+FFFD."""
    return F.make_valid_utf8((F.col(c) if isinstance(c, str) else c).cast("string"))


def ngram_repeats(c: Column | str, n: int = 8) -> Column:
    """struct(repeated, places): distinct n-grams of words that come more than
    once, and all their places; counted within the row.

    Words are cut once and bound by a lambda, as Spark would cut them again for
    every n-gram; equal n-grams stand next to each other once sorted.
    """

    def counted(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.transform(F.array(F.sort_array(grams)), runs)[0]

    def runs(g: Column) -> Column:
        same = F.transform(F.sequence(F.lit(1), F.size(g)), lambda i: F.coalesce(F.try_element_at(g, i + 1) == F.element_at(g, i), F.lit(False)))
        return F.transform(F.array(same), ends)[0]

    def ends(same: Column) -> Column:
        last = F.filter(same, lambda s, i: s & ~F.coalesce(F.get(same, i + 1), F.lit(False)))
        repeated = F.size(last).cast("long")
        places = F.size(F.filter(same, lambda s: s)).cast("long") + repeated
        return F.struct(repeated.alias("repeated"), places.alias("places"))

    none = F.struct(F.lit(0).cast("long").alias("repeated"), F.lit(0).cast("long").alias("places"))
    return F.transform(F.array(words(c)), lambda w: F.when(F.size(w) >= n, counted(w)).otherwise(none))[0]


def word_ratio(output: Column | str, given: Column | str) -> Column:
    """Words of an output for each word given, null where none is given."""
    return F.try_divide(word_count(output).cast("double"), word_count(given).cast("double"))


def compact_stamp(c: Column) -> Column:
    """A time as it stands in file names; the session's time zone is UTC."""
    return F.date_format(c, "yyyyMMdd_HHmmss")


def md5_int(c: Column) -> Column:
    """The first eight hex digits of the MD5 as a number; the same in other engines."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")
