"""URL and path functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_path(url: Column) -> Column:
    """Path part of a URL, empty when there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def last_segment(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/?$", 1)


def file_stem(name: Column) -> Column:
    """Name without its last suffix; a leading dot is part of the name."""
    return F.regexp_replace(name, r"^(.+)\.[^.]*$", "$1")


def swap_suffix(name: Column, new_suffix: Column | str) -> Column:
    """Replace the last suffix, or append one when the name has none."""
    suffix = F.lit(new_suffix) if isinstance(new_suffix, str) else new_suffix
    return F.concat(file_stem(name), suffix)


def join_root(root: str, link: Column) -> Column:
    """Absolute links stay, rooted links get the host, others the root folder."""
    base = root.rstrip("/")
    host = "/".join(base.split("/", 3)[:3])
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("/"), F.concat(F.lit(host), link))
        .otherwise(F.concat(F.lit(base + "/"), link))
    )


def quote(text: Column) -> Column:
    """Percent-encode everything except letters, digits, ``_.-~`` and ``/``."""
    encoded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def with_level_parameter(url: Column, level: Column) -> Column:
    """Put ``v=<level>`` into the query of a table URL.

    It replaces the second parameter if the first one names a dataset
    (``d=...``), else the first one.
    """
    parts = F.split(url, r"\?")
    params = F.split(parts[1], "&")
    choice = F.concat(F.lit("v="), level)
    tail_of = lambda start: F.slice(params, start, F.greatest(F.size(params) - start + 1, F.lit(0)))
    rewritten = F.when(
        params[0].startswith("d="),
        F.concat(F.array(params[0], choice), tail_of(3)),
    ).otherwise(F.concat(F.array(choice), tail_of(2)))
    return F.concat_ws("?", parts[0], F.array_join(rewritten, "&"))


def archive_member_for_level(archive_name: Column, level: Column) -> Column:
    """``census2021-ts009.zip`` and ``ltla`` -> ``census2021-ts009-ltla.csv``."""
    return F.concat(file_stem(archive_name), F.lit("-"), level, F.lit(".csv"))


def double_dot_variant(member: Column) -> Column:
    """``name.csv`` -> ``name..csv``, a naming slip seen in some archives."""
    return swap_suffix(member, "..csv")


def bulk_documentation_url(table_id: Column) -> Column:
    return F.concat(F.lit("https://www.nomisweb.co.uk/datasets/c2021"), F.lower(table_id))
