"""URL functions on columns."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import ship_active

#: Search feeds are told by their host.
SEARCH_HOST = "news.google.com"
SEARCH_FEED = f"https://{SEARCH_HOST}/rss/search?q=%s&hl=en"


def search_url(query: Column, template: str = SEARCH_FEED) -> Column:
    """A search feed's URL; the query is form-encoded (space to ``+``)."""
    head, tail = template.split("%s")
    return F.concat(F.lit(head), F.url_encode(query), F.lit(tail))


def absolutise(href: Column, base: str) -> Column:
    """Root-relative links get the base's scheme and host; within code generation."""
    root = "/".join(base.split("/")[:3])
    return F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("/"), F.concat(F.lit(root), href)).otherwise(F.concat(F.lit(base.rsplit("/", 1)[0] + "/"), href))


def resolve(href: Column, base: Column) -> Column:
    """Full RFC 3986 resolution, as a pandas UDF."""
    ship_active()

    @F.pandas_udf("string")
    def run(h: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else urljoin(y or "", x) for x, y in zip(h, b, strict=True)], dtype=object)

    return run(href, base)


def dataset_code(link: Column, title: Column, description: Column) -> Column:
    """Code at the title's start, else the link's last segment, else one in brackets; lower case, null without one."""
    some = lambda c: F.nullif(c, F.lit(""))
    segment = F.lower(F.element_at(F.filter(F.split(F.coalesce(link, F.lit("")), "/"), lambda s: F.trim(s) != ""), -1))
    return F.coalesce(
        some(F.lower(F.regexp_extract(title, r"^([A-Za-z0-9_]+)\s*-\s*", 1))),
        F.when(segment.rlike("^[a-z][a-z0-9_]{1,30}$"), segment),
        some(F.lower(F.regexp_extract(F.concat_ws(" ", title, description), r"\[([A-Za-z0-9_]{3,25})\]", 1))),
    )


def dataset_url(code: Column, template: str = "https://data.example/view/%s/default/table") -> Column:
    return F.format_string(template, F.upper(code))


def report_stem(url: Column) -> Column:
    """A file's identity without its ending, so that one report in several formats is one."""
    return F.regexp_replace(F.lower(url), r"\.(pdf|xlsx?|csv)$", "")


def title_from_url(url: Column) -> Column:
    name = F.regexp_replace(F.element_at(F.split(url, "/"), -1), r"(?i)\.(pdf|xlsx?|csv)$", "")
    return F.initcap(F.trim(F.regexp_replace(name, r"[-_]+", " ")))
