"""Fill-in-middle transformation of texts, and its inverse.

A text is cut into units, runs of ASCII letters and single other characters.
Digests of the document's id choose two borders between units and the form:
prefix, suffix and middle in one of two orders behind marks of their own, or the
text as it is.  An Arrow-batched pandas function does it: the ends of all units
go to a compact array, two look-ups of which slice the text.  ``restored`` is a
second one, which takes marks and order apart again.

Both are maps: rows never leave their partition, and a worker holds one batch
and the offsets of one text, four bytes a unit.

Defined cases: null text counts as empty; texts that are empty or hold a mark
stay plain, so every output can be restored; a null id is hashed as no digits;
texts of any length are cut whole; repeated rows come out alike for equal ids;
an empty table gives an empty result; ``keep`` passes other columns through,
result columns that clash with them, or with each other, getting an underscore.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import free_names

UNIT = regex.compile(r"[A-Za-z]+|[^A-Za-z]")
#: Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = regex.compile(f"{PREFIX}|{SUFFIX}|{MIDDLE}")
#: Of 100 texts so many get a form, and of 100 of those so many the one with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
SEED = "1:"

RESULTS = ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
_SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"


def numbers(key: str, seed: str = SEED) -> list[int]:
    """The first four groups of eight hex digits of the digest of seed and key."""
    digest = hashlib.sha256((seed + key).encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def transform_text(text: str, key: str, seed: str, rate: int, suffix_first: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = array("L" if len(text) >= 1 << 32 else "I", (unit.end() for unit in UNIT.finditer(text)))
    n = len(ends)
    h1, h2, h3, h4 = numbers(key, seed)
    if not n or h3 % 100 >= rate or MARK.search(text):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a = ends[first - 1] if first else 0
    b = ends[second - 1] if second else 0
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore_text(output: str, form: str) -> str:
    """The text again: no piece holds a mark, so the first place of each is its own."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(first):
        raise ValueError(f"not an output of form {form}")
    one, found, rest = output[len(first) :].partition(second)
    other, also, middle = rest.partition(MIDDLE)
    if not (found and also):
        raise ValueError(f"not an output of form {form}")
    prefix, suffix = (one, other) if form == "psm" else (other, one)
    return prefix + middle + suffix


def fill_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
    seed: str = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """The kept columns (the id by default) with n, form, prefix_chars, middle_chars, output, output_sha256."""

    @pandas_udf(_SCHEMA)
    def transformed(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [transform_text(t, i, seed, rate, suffix_first) for i, t in zip(ids, texts)]
        out = pd.DataFrame(rows, columns=RESULTS[:-1])
        for c in ("prefix_chars", "middle_chars"):
            out[c] = out[c].astype("Int64")
        return out.assign(output_sha256=[sha256(row[-1]) for row in rows])

    kept = [id_col] if keep is None else keep
    empty = F.lit("")
    key = F.coalesce(F.col(id_col).cast("string"), empty)
    made = free_names(docs.columns, ["made"])[0]
    rows = docs.withColumn(made, transformed(key, F.coalesce(text_col, empty)))
    names = free_names(kept, RESULTS)
    return rows.select(*kept, *(F.col(made)[r].alias(n) for r, n in zip(RESULTS, names)))


def restored(output: Column | str, form: Column | str) -> Column:
    """A struct of the text from which an output of some form was made, and its digest."""

    @pandas_udf("restored string, restored_sha256 string")
    def back(outputs: pd.Series, forms: pd.Series) -> pd.DataFrame:
        texts = [restore_text(o, f) for o, f in zip(outputs, forms)]
        return pd.DataFrame({"restored": texts, "restored_sha256": [sha256(t) for t in texts]})

    return back(output, form)
