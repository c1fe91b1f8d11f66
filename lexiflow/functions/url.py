"""URL functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def query_param(url: Column, name: str) -> Column:
    """The first value of a parameter, decoded; null if it is lacking or blank."""
    return F.nullif(F.try_url_decode(F.try_parse_url(F.replace(url, F.lit(" "), F.lit("%20")), F.lit("QUERY"), F.lit(name))), F.lit(""))


def percent_encoded(word: Column) -> Column:
    """As a path component: blanks as %20, slashes stay."""
    return F.replace(F.replace(F.url_encode(word), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def media_name(disposition: Column, url: Column) -> Column:
    """The file name that the header gives, else the last part of the URL's path; blanks become dots."""
    given = F.nullif(F.regexp_extract(F.coalesce(disposition, F.lit("")), "filename\\*?=(?:UTF-8'')?\"?([^\";]+)\"?", 1), F.lit(""))
    path = F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.replace(F.coalesce(given, F.regexp_extract(path, "([^/]*)$", 1)), F.lit(" "), F.lit("."))


def absolute(href: Column, site: str) -> Column:
    return F.when(href.startswith("/"), F.concat(F.lit(site), href)).otherwise(href)


def selects(href: Column, headword: Column) -> Column:
    """Whether the link selects a version of this headword."""
    return F.coalesce(F.split_part(query_param(href, "select"), F.lit(","), F.lit(1)) == headword, F.lit(False))
