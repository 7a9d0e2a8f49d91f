"""Address parts as Columns; tolerant of case, port, user info and missing schemes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def site_of(url: Column) -> Column:
    """Host without case, port and leading www.; null for null or an address without a host."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _AUTHORITY, 1)), r"^www\.", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path without query, fragment and trailing slash; '' where there is none."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.regexp_replace(path, r"/+$", ""), F.lit(""))


def host_of(url: Column) -> Column:
    """Network location in lower case with its port, as written otherwise."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
