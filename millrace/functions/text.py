"""Texts of the views: labels, shortened texts, percentages, escapes."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


#: What counts as white space at a text's ends.
WHITE_SPACE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column) -> Column:
    """Without white space, of any kind, at either end.

    Most texts have spaces alone there; only others go through the whole list, which takes ten times as long.
    """
    bare = F.trim(text)
    return F.when(_plain(bare) & _plain(F.right(bare, F.lit(1))), bare).otherwise(F.btrim(bare, F.lit(WHITE_SPACE)))


def _plain(text: Column) -> Column:
    """Begins with an ASCII character that is no white space; the text has no space at its start."""
    return (text >= "!") & (text < "\x80")


def filled(text: Column) -> Column:
    """Null where the text is empty."""
    return F.nullif(text, F.lit(""))


def label(name: Column, technical: Column) -> Column:
    """name (technical), or the technical name where there is no name."""
    return F.when(filled(name).isNotNull(), F.concat(name, F.lit(" ("), technical, F.lit(")"))).otherwise(technical)


def truncated(text: Column, most: int, keep: int | None = None) -> Column:
    """At most ``most`` characters; longer texts keep ``keep`` (one less by default) and an ellipsis."""
    keep = most - 1 if keep is None else keep
    return F.when(text.isNull(), "").when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, keep), F.lit("…")))


def short_description(text: Column) -> Column:
    """Stripped, 77 characters and an ellipsis if longer than 80; a mark where there is none."""
    bare = strip(F.coalesce(text, F.lit("")))
    return F.when(bare == "", "(missing description)").otherwise(truncated(bare, 80, 77))


def escaped(text: Column) -> Column:
    """For HTML; null is empty."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return F.coalesce(text, F.lit(""))


def _fixed(value: float, decimals: int) -> str:
    return f"{Decimal(value).quantize(Decimal(1).scaleb(-decimals), ROUND_HALF_UP):f}"


@F.pandas_udf(StringType())
def to_fixed(values: pd.Series, decimals: pd.Series) -> pd.Series:
    """A number with so many decimals; halves of the exact binary value go up, which no built-in does."""
    return pd.Series([None if pd.isna(v) else _fixed(v, int(d)) for v, d in zip(values, decimals, strict=True)])


def percent(value: Column, decimals: int = 2, most: int = 8) -> Column:
    """'0%' for none; under 0.01 as many decimals as two digits take, ``most`` at most, without zeros at the end."""
    size = F.abs(value)
    small = F.least(F.lit(most), F.greatest(F.lit(2), F.ceil(-F.log10(size)).cast("int") + 1))
    text = to_fixed(value, F.when(size >= 0.01, F.lit(decimals)).otherwise(F.coalesce(small, F.lit(2))))
    bare = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?[1-9])0+$", "$1"), r"\.0+$", "")
    shown = F.concat(F.when(size >= 0.01, text).otherwise(bare), F.lit("%"))
    none = value.isNull() | F.isnan(value) | (value == 0) | (size == float("inf"))
    return F.when(none, "0%").otherwise(shown)


def tier(pct: Column) -> Column:
    """How common an attribute is."""
    return F.when(pct >= 100, "required").when(pct >= 10, "common").otherwise("rare")


def url_component(text: Column) -> Column:
    """As in a path: a space is %20; what needs no escape in a component stays."""
    coded = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    for code, raw in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        coded = F.replace(coded, F.lit(code), F.lit(raw))
    return coded


def rgba(text: Column) -> Column:
    """The four numbers of an rgb() or rgba() colour; alpha is 1 by default; no colour is black."""
    inside = F.regexp_extract(text, r"rgba?\(([^)]+)\)", 1)
    parts = F.transform(F.split(inside, ","), lambda x: F.trim(x).cast("double"))
    padded = F.slice(F.concat(parts, F.array_repeat(F.lit(1.0), 3)), 1, 4)
    none = F.array(*[F.lit(float(x)) for x in (0, 0, 0, 1)])
    return F.when(F.coalesce(inside, F.lit("")) == "", none).otherwise(padded)
