"""Text functions on columns, with the semantics of Python strings where the engine's own differ."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Link texts of the page's own interface, compared before digits go.
UNWANTED_LINKS = ["...vis mere", "...vis mindre", "Læs mere om Den Danske Begrebsordbog"]
#: Fixed value: an inflection written as a suffix.
SUFFIX = "^-[A-Za-zæøåÆØÅ]{1,6}$"


def truthy(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def strip(c: Column) -> Column:
    """Without white space at either end (trim() takes spaces alone)."""
    return F.regexp_replace(c, r"(?U)^\s+|(?U)\s+$", "")


def strip_set(c: Column, characters: str) -> Column:
    """Without any of the characters at either end."""
    return F.btrim(c, F.lit(characters))


def rstrip_set(c: Column, characters: str) -> Column:
    return F.rtrim(c, F.lit(characters))


def sanitize(c: Column) -> Column:
    """Without braces and outer white space; null becomes empty."""
    return strip(F.translate(F.coalesce(c, F.lit("")), "{}", ""))


def strip_digits(c: Column) -> Column:
    """Without digits at the end, of any script."""
    return F.regexp_replace(c, r"(?U)\d+$", "")


def expand_suffixes(headword: Column, forms: Column) -> Column:
    """`-en` becomes the headword with that ending; other forms stay."""
    return F.transform(forms, lambda f: F.when(f.rlike(SUFFIX), F.concat(headword, F.substring(f, 2, 1 << 30))).otherwise(f))


def split_forms(c: Column) -> Column:
    """Parts between commas, stripped, without empty ones."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")


def clean_links(texts: Column, unwanted: list[str] = UNWANTED_LINKS) -> Column:
    """Link texts without the page's own, without digits at the end, without empty ones."""
    wanted = F.filter(F.transform(texts, strip), lambda x: ~x.isin(unwanted))
    return F.filter(F.transform(wanted, strip_digits), lambda x: x != "")


def ellipsis(raw: Column, limit: int = 120, always: bool = False) -> Column:
    """The first `limit` characters of the cleaned text; marked if the raw text is longer, or always unless there is none."""
    clean = sanitize(raw)
    cut = F.concat(F.substring(clean, 1, limit), F.lit("…"))
    return F.when(truthy(raw), cut).otherwise("") if always else F.when(F.length(raw) > limit, cut).otherwise(clean)


def rank_text(rank: Column) -> Column:
    """Five digits at least; empty for no rank."""
    return F.when(rank.isNull(), "").otherwise(F.format_string("%05d", rank))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_extract(basename(path), r"^(.+?)(?:\.[^.]*)?$", 1)


def strip_fence(c: Column) -> Column:
    """Without the code fence around a reply."""
    return strip(F.regexp_replace(strip(c), r"(?i)^```(?:json)?|```$", ""))


def json_value(c: Column) -> Column:
    """The JSON value that the whole text is, as a variant; null otherwise. (The parser alone takes a value with anything behind it.)"""
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))


def join_safe(items: Column, separator: str = "; ", keep_empty: bool = False) -> Column:
    items = F.coalesce(items, F.array().cast("array<string>"))
    clean = items if keep_empty else F.filter(F.transform(items, sanitize), lambda x: x != "")
    return F.array_join(clean, separator)


def first_nonempty(items: Column) -> Column:
    """The first item that is neither null nor empty; empty if there is none."""
    return F.coalesce(F.try_element_at(F.filter(items, truthy), F.lit(1)), F.lit(""))


def guid(*parts: Column) -> Column:
    """A stable identifier of the parts."""
    return F.substring(F.sha2(F.concat_ws("\u001f", *[F.coalesce(p, F.lit("")) for p in parts]), 256), 1, 20)


def adler32(c: Column) -> Column:
    """Adler-32 over the UTF-8 bytes, without the sign bit."""
    data = F.hex(F.encode(c, "UTF-8"))
    places = F.when(F.length(data) > 0, F.sequence(F.lit(1), F.length(data) - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    values = F.transform(places, lambda i: F.conv(F.substr(data, i, F.lit(2)), 16, 10).cast("bigint"))
    start = F.struct(F.lit(1).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    step = lambda s, v: F.struct(((s.a + v) % 65521).alias("a"), ((s.b + s.a + v) % 65521).alias("b"))
    return F.aggregate(values, start, step, lambda s: (s.b * 65536 + s.a).bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint")))


@F.pandas_udf(T.StringType())
def nfc(c: pd.Series) -> pd.Series:
    """Unicode NFC; the engine has no function for it."""
    return c.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def ordered_text(items: Column, separator: str) -> Column:
    """Joins collected structs (position, text) in the order of positions."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: x.s), separator)
