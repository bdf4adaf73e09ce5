"""Column functions over URLs, as native expressions; one helper for relative links needs Python."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parts(c: Column) -> tuple[Column, Column, Column]:
    """Scheme with //, authority, and the rest without fragment."""
    bare = F.regexp_replace(F.trim(c), "#.*$", "")
    return F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)", 1)), F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*(.*)$", 1)


def normalize_url(c: str | Column) -> Column:
    """Scheme and host in lower case, no user, no default port, no fragment, and / for an empty path; null if not absolute."""
    scheme, host, rest = _parts(_c(c))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when((scheme != "") & (host != ""), F.concat(scheme, F.lit("://"), host, rest))


def query_param(c: str | Column, key: str) -> Column:
    """The first value of a query key, decoded; null if there is none."""
    raw = F.regexp_extract(F.regexp_replace(_c(c), "#.*$", ""), r"[?&]" + key + "=([^&]*)", 1)
    return F.when(_c(c).rlike(r"[?&]" + key + "="), F.try_url_decode(raw))


def public_url(c: str | Column, hosts: Sequence[str] | str, paths: str, keys: Sequence[str]) -> Column:
    """struct(value, error): an https URL of an official host and an allowed path, with allowed query keys only, sorted.

    hosts: the official ones, or a pattern that they match.
    """
    scheme, host, rest = _parts(_c(c))
    path, query = F.regexp_extract(rest, r"^([^?]*)", 1), F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1).isin(*keys)))
    value = F.concat(F.lit("https://"), host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    error = F.when(F.coalesce(scheme, F.lit("")) != "https", "scheme").when(~(host.rlike(hosts) if isinstance(hosts, str) else host.isin(*hosts)), "host").when(~path.rlike(paths), "path")
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))


def redact_url(c: str | Column, keys: Sequence[str]) -> Column:
    """The values of sensitive query keys are replaced; the fragment stays."""
    url, fragment = F.regexp_extract(_c(c), r"^([^#]*)", 1), F.regexp_extract(_c(c), r"(?s)(#.*)$", 1)
    head, query = F.substring_index(url, "?", 1), F.regexp_extract(url, r"\?(.*)$", 1)
    clean = F.transform(F.split(query, "&"), lambda p: F.when(F.lower(F.substring_index(p, "=", 1)).isin(*keys), F.concat(F.substring_index(p, "=", 1), F.lit("=[REDACTED]"))).otherwise(p))
    return F.when(query == "", _c(c)).otherwise(F.concat(head, F.lit("?"), F.array_join(clean, "&"), fragment))


def in_scope(url: str | Column, seed: str | Column) -> Column:
    """Same authority, and a path below that of the seed."""
    (_, h, r), (_, sh, sr) = _parts(_c(url)), _parts(_c(seed))
    base = F.regexp_replace(F.regexp_extract(sr, r"^([^?]*)", 1), "/+$", "")
    path = F.regexp_extract(r, r"^([^?]*)", 1)
    return (h == sh) & ((base == "") | (path == base) | path.startswith(F.concat(base, F.lit("/"))))


def canonical_unit_url(url: str | Column, uid: str | Column, grammar: str, key: str = "uid") -> Column:
    """Whether a URL follows the grammar, names the key exactly once, and names this uid."""
    u = _c(url)
    once = F.regexp_count(u, F.lit(r"[?&]" + key + "=")) == 1
    return F.coalesce(u.rlike("^(?:" + grammar + ")$") & once & (F.regexp_extract(u, r"[?&]" + key + r"=([^&#]*)", 1) == _c(uid).cast("string")), F.lit(False))


def brand_from_url(url: str | Column) -> Column:
    """The first segment of the path."""
    return F.nullif(F.regexp_extract(_c(url), r"^[A-Za-z]+://[^/?#]+/([^/?#]+)", 1), F.lit(""))


def landing_redirect(asked: str | Column, landed: str | Column) -> Column:
    """Whether a request for something below a brand ended on the brand's own page."""
    depth = lambda u: F.size(F.filter(F.split(F.regexp_extract(u, r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1), "/"), lambda p: p != ""))
    return (brand_from_url(asked) == brand_from_url(landed)) & (depth(_c(asked)) > 1) & (depth(_c(landed)) == 1)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _resolve(base: pd.Series, hrefs: pd.Series) -> pd.Series:
    from urllib.parse import urljoin

    return pd.Series([None if b is None or hs is None else [urljoin(b, h) for h in hs] for b, hs in zip(base, hrefs, strict=True)])


def resolve_links(base: str | Column, hrefs: str | Column) -> Column:
    """Absolute normalised http(s) links, each once, without script, mail, telephone and fragment links.

    Joining relative links is the one step in Python; it runs on Arrow batches.
    """
    wanted = F.filter(_c(hrefs), lambda h: ~F.lower(F.trim(h)).rlike("^(#|javascript:|mailto:|tel:)") & (F.trim(h) != ""))
    links = F.filter(_resolve(_c(base), wanted), lambda u: F.lower(u).rlike("^https?://"))
    return F.array_distinct(F.filter(F.transform(links, normalize_url), lambda u: u.isNotNull()))


def page_links(html: str | Column) -> Column:
    """What a page links to: href, data-href, data-url, action, option values with a path, meta refresh and script locations."""
    h = _c(html)
    found = [
        F.regexp_extract_all(h, F.lit(r"""(?i)\s(?:href|data-href|data-url|action)\s*=\s*["']([^"']*)["']"""), F.lit(1)),
        F.regexp_extract_all(h, F.lit(r"""(?i)<option[^>]*\svalue\s*=\s*["'](/[^"']*|https?://[^"']*)["']"""), F.lit(1)),
        F.regexp_extract_all(h, F.lit(r"""(?i)<meta[^>]*content\s*=\s*["'][0-9]+;\s*url=([^"']*)["']"""), F.lit(1)),
        F.regexp_extract_all(h, F.lit(r"""(?i)location(?:\.href)?\s*=\s*["']([^"']*)["']"""), F.lit(1)),
    ]
    return F.array_distinct(F.concat(*found))
