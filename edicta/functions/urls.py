"""Addresses as column expressions. Every function gives null for null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_URL = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, _URL, 1))


def host(c: Column) -> Column:
    """Host without port, lower case."""
    return F.regexp_replace(F.lower(F.regexp_extract(c, _URL, 2)), r":\d+$", "")


def root_host(c: Column) -> Column:
    """Host without port and leading www."""
    return F.regexp_replace(host(c), r"^www\.", "")


def path(c: Column) -> Column:
    return F.regexp_extract(c, _URL, 3)


def query_string(c: Column) -> Column:
    return F.regexp_extract(c, _URL, 4)


def parameter(c: Column, name: str) -> Column:
    """Value of a query parameter, null if absent."""
    return F.nullif(F.regexp_extract(query_string(c), rf"(?:^|&){name}=([^&]*)", 1), F.lit(""))


def normalized_url(c: Column) -> Column:
    """https where no scheme is given, scheme and host in lower case, doubled slashes of the path collapsed, fragment dropped."""
    full = F.when(c.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), c).otherwise(F.concat(F.lit("https://"), c))
    q = query_string(full)
    return F.concat(scheme(full), F.lit("://"), F.lower(F.regexp_extract(full, _URL, 2)), F.regexp_replace(path(full), "/{2,}", "/"), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def to_https(c: Column) -> Column:
    return F.regexp_replace(c, "^http://", "https://")


def file_name(c: Column) -> Column:
    """Last segment of the path with escapes of spaces undone, null if the path ends in a slash."""
    return F.nullif(F.replace(F.regexp_extract(path(c), "([^/]*)$", 1), F.lit("%20"), F.lit(" ")), F.lit(""))


def unquoted(c: Column) -> Column:
    """Escapes undone; a plus stays a plus."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def pdf_like(c: Column) -> Column:
    """Whether an address points to a document: by its path, or by a parameter that names one."""
    return F.lower(path(c)).rlike(r"\.pdf$") | F.lower(query_string(c)).rlike(r"\.pdf|(^|&)(doc|file|pdf|documento)=") | F.lower(path(c)).rlike("/(firma|ver|bajar)")


def same_site(a: Column, b: Column) -> Column:
    """Equal root hosts, or one a subdomain of the other."""
    x, y = root_host(a), root_host(b)
    return (x == y) | F.endswith(x, F.concat(F.lit("."), y)) | F.endswith(y, F.concat(F.lit("."), x))


def page_number(c: Column) -> Column:
    """Page of a listing address, by path (/page/n, /listado/x/n) or parameter; 1 where none is stated."""
    n = F.coalesce(F.nullif(F.regexp_extract(c, r"/(?:page|pagina)/(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"[?&](?:page|p|m)=(\d+)", 1), F.lit("")), F.lit("1"))
    return n.cast("int")


def typed_web(c: Column) -> Column:
    """An address typed by hand: null for the words that say there is none, http where no scheme is given, closing slashes off."""
    bare = F.regexp_replace(c, "/+$", "")
    none = F.lower(F.trim(c)).isin("", "-", "s/i", "no", "no tiene")
    return F.when(c.isNull() | none, F.lit(None).cast("string")).when(c.rlike("^https?://"), bare).otherwise(F.concat(F.lit("http://"), bare))
