"""Column functions over JSON, digests and classifications."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import error_codes, is_blank, let


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_text(c: str | Column, path: str) -> Column:
    """A field's text; a missing field and a JSON null are both null."""
    return F.get_json_object(_c(c), "$." + path)


def json_number(c: str | Column, path: str, kind: str = "double") -> Column:
    return json_text(c, path).try_cast(kind)


def json_fields(c: str | Column) -> Column:
    """An object as a map from field to the JSON text of its value, so that an explicit null is kept as text."""
    return F.from_json(_c(c), "map<string,string>")


def overlay(source: Column, override: Column) -> Column:
    """Fields of the override win, those that are null too."""
    kept = F.map_filter(source, lambda k, v: ~F.map_contains_key(override, k))
    return F.coalesce(F.map_concat(kept, override), source, override)


def overlay_diff(source: Column, edited: Column) -> Column:
    """Only the edited fields that differ from the source."""
    return F.map_filter(edited, lambda k, v: ~F.map_contains_key(source, k) | ~F.element_at(source, k).eqNullSafe(v))


def canonical_json(columns: Sequence[str]) -> Column:
    """Fields in the order of their names, no spaces, nulls kept."""
    return F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in sorted(columns))), {"ignoreNullFields": "false"})


def record_digest(columns: Sequence[str]) -> Column:
    return F.sha2(canonical_json(columns), 256)


def natural_key(columns: Sequence[str | Column]) -> Column:
    """Trimmed identity fields joined by the unit separator; null if all are empty, which rejects the row."""
    parts = [F.coalesce(F.trim(_c(c).cast("string")), F.lit("")) for c in columns]
    return F.when(F.concat(*parts) != "", F.concat_ws("\u001f", *parts))


def length_prefixed(columns: Sequence[str | Column], by_chars: bool = False) -> Column:
    """Fields with their lengths in bytes (or characters) in front, so that no two lists of fields give one text."""
    size = F.char_length if by_chars else F.octet_length
    texts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in columns]
    return F.concat(*(x for t in texts for x in (size(t).cast("string"), F.lit(":"), t)))


def identity_hash(columns: Sequence[str | Column]) -> Column:
    return F.sha2(length_prefixed(columns), 256)


#: The fields that make a vehicle's identity, in order; tokens and links are no part of it (fixed values).
VEHICLE_IDENTITY = ("model_id", "model_code", "name", "description", "options", "prod_period", "grade", "market", "engine", "transmission", "body_style")


def vehicle_identity() -> Column:
    """The identity hash of a row with the columns of VEHICLE_IDENTITY."""
    return identity_hash(VEHICLE_IDENTITY)


def entry_key(columns: Sequence[str | Column]) -> Column:
    """The key of a manual entry: fields trimmed and in upper case with their character counts."""
    return F.sha2(length_prefixed([F.upper(F.trim(_c(c).cast("string"))) for c in columns], by_chars=True), 256)


def content_fingerprint(columns: Sequence[str]) -> Column:
    """sha256 of the fields as a JSON array of texts, nulls kept."""
    return F.sha2(F.to_json(F.array(*(F.col(c).cast("string") for c in columns))), 256)


def schema_fingerprint(fields: Sequence[str]) -> str:
    """sha256 of a list of field names as compact JSON, in their order: drift shows as another digest."""
    return hashlib.sha256(json.dumps(list(fields), ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def undecodable_kind(error_code: str | Column, make: str | Column, model_year: str | Column) -> Column:
    """Why a VIN has no usable decode; null if make and model year are there.

    Code 7 goes before 8, and both before codes that are only 1, 11 or 400; whatever else lacks a make or a year has no
    detail data.
    """
    codes = error_codes(error_code)
    only_bad = (F.size(codes) > 0) & (F.size(F.array_except(codes, F.array(F.lit(1), F.lit(11), F.lit(400)))) == 0)
    kind = F.when(F.array_contains(codes, 7), "nhtsa_unregistered").when(F.array_contains(codes, 8), "no_detail_data").when(only_bad, "invalid_vin").otherwise("no_detail_data")
    return F.when(is_blank(make) | is_blank(model_year), kind)


def undecodable_note(kind: Column, error_code: Column, suggested: Column) -> Column:
    """A readable reason of at most 400 characters: the kind, the error code and the VIN that was suggested, if any."""
    code, other = F.trim(F.coalesce(error_code, F.lit(""))), F.trim(F.coalesce(suggested, F.lit("")))
    note = F.concat_ws(
        "; ",
        F.concat(F.lit("NHTSA reports no usable decode ("), kind, F.lit(")")),
        F.when(code != "", F.concat(F.lit("ErrorCode='"), F.substring(code, 1, 120), F.lit("'"))),
        F.when(other != "", F.concat(F.lit("SuggestedVIN='"), F.substring(other, 1, 32), F.lit("'"))),
    )
    return F.when(kind.isNotNull(), F.substring(note, 1, 400))


def decode_status(error_code: str | Column) -> Column:
    return F.when(_c(error_code) == "0", "decoded").otherwise("decoded_with_warning")


def decode_completeness(error_code: Column, model: Column, engine: Column, trim: Column) -> Column:
    """How much a decode tells: no detail data (code 8), then what is missing, then whether the code is 0."""
    listed = F.split(F.replace(F.substring_index(F.coalesce(error_code, F.lit("")), "-", 1), F.lit(" "), F.lit("")), ",")
    return (
        F.when(F.array_contains(listed, "8"), "partial_no_detail_data").when(is_blank(model), "partial_missing_model").when(is_blank(engine) | is_blank(trim), "partial_missing_powertrain_or_trim")
        .when(error_code == "0", "decoded_complete").otherwise("decoded_complete_with_warning")
    )


def fitment_verdict(start: Column, end: Column, published: Column) -> Column:
    """struct(is_verified, derivation, confidence) of a fitment with these bounds: an empty window is never verified."""
    empty, known = F.coalesce(start > end, F.lit(False)), F.coalesce(published, F.lit(False))
    return F.struct(
        (~empty & known).alias("is_verified"),
        F.when(empty, "invalid_date_intersection").when(known, "verified_current_catalog").otherwise("normalized_unpublished").alias("derivation"),
        F.when(empty, F.lit(0.0)).when(known, F.lit(1.0)).otherwise(F.lit(0.5)).cast("decimal(4,3)").alias("confidence"),
    )


#: Texts that tell a challenge page (fixed values).
CHALLENGE_MARKERS = ("just a moment", "enable javascript and cookies to continue", "/cdn-cgi/challenge-platform/", "managed challenge", "cf-chl-")
#: The same for the start of a page (fixed values).
CHALLENGE_STARTS = ("Just a moment", "請稍候", "cf_chl")


def header_value(headers: Column, name: str) -> Column:
    """A header's value whatever the case of its name, in lower case; empty if there is none."""
    same = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name)
    return F.lower(F.coalesce(F.try_element_at(F.transform(same, lambda e: e["value"]), F.lit(-1)), F.lit("")))


def detect_challenge(status: Column, headers: Column, body: Column) -> Column:
    """struct(flag, reason): whether a response asks for proof of a human, by header, by text or by a refusal."""
    guarded = F.contains(header_value(headers, "server"), F.lit("cloudflare"))

    def reason(text: Column) -> Column:
        marked = reduce(lambda a, b: a | b, [text.contains(m) for m in CHALLENGE_MARKERS])
        return (
            F.when(header_value(headers, "cf-mitigated") == "challenge", "cloudflare_challenge").when(marked & guarded, "cloudflare_challenge").when(marked, "access_denied")
            .when((status == 403) & (guarded | text.contains("access denied")), "access_denied")
        )

    found = let(F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 1_000_000)), reason)
    return let(found, lambda r: F.struct(r.isNotNull().alias("flag"), r.alias("reason")))


def starts_as_challenge(html: Column) -> Column:
    """The short form: markers within the first 8,000 characters."""
    head = F.substring(F.coalesce(html, F.lit("")), 1, 8000)
    return reduce(lambda a, b: a | b, [head.contains(m) for m in CHALLENGE_STARTS])


#: What takes the place of a secret value; further distinct ones are numbered (__REDACTED_2__ and so on).
REDACTED = "__REDACTED__"
#: Patterns of secret material (fixed values).
SECRET_PATTERNS = (
    r"""(?iU)\bssd\s*=\s*(?!__REDACTED(?:_(?:[2-9]|[1-9][0-9]+))?__(?:[&\s"'<>]|$))[^&#\s"'<>]+""",
    r"(?iU)\b(?:cf_clearance|phpsessid|set-cookie|authorization)\b",
    r"(?i)__cf_chl_[A-Za-z0-9_-]+",
)


def unquoted(c: Column) -> Column:
    """One round of percent-decoding; what is no escape stays as it is, and so does a plus."""
    escaped = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(c.contains("%"), F.coalesce(F.try_url_decode(escaped), c)).otherwise(c)


def has_secret(c: str | Column) -> Column:
    """Whether a text, or what up to three rounds of percent-decoding make of it, holds secret material."""

    def held(x: Column, rounds: int) -> Column:
        own = reduce(lambda a, b: a | b, [x.rlike(p) for p in SECRET_PATTERNS])
        return own if rounds == 0 else own | let(unquoted(x), lambda y: held(y, rounds - 1))

    return F.coalesce(let(_c(c), lambda x: held(x, 3)), F.lit(False))


#: Form fields that hold secrets (fixed values).
SECRET_FIELDS = ("authorization", "cookie", "cf_clearance", "php_sessid", "phpsessid", "set-cookie", "ssd")


def scrub(html: str | Column, token: str = "ssd") -> Column:
    """struct(html, sha256, bytes, scrubbed_bytes): a page without scripts, comments, meta elements, secret inputs and event attributes.

    Each distinct value of the token in links gets an alias of the page's own, in the order in which they come.
    """
    page = _c(html)
    out = F.regexp_replace(F.regexp_replace(page, r"(?is)<script\b.*?</script\s*>", ""), r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?is)<meta\b[^>]*>", "")
    out = F.regexp_replace(out, r"""(?is)<input\b[^>]*\bname\s*=\s*["']?(?:""" + "|".join(SECRET_FIELDS) + r""")["'\s>/][^>]*>?""", "")
    out = F.regexp_replace(out, r"""(?is)\son[a-z]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", "")
    values = F.array_distinct(F.regexp_extract_all(out, F.lit(rf"""(?i)\b{token}=([^&#\s"'<>]+)"""), 1))
    named = F.transform(values, lambda v, i: F.struct(v.alias("value"), F.when(i == 0, REDACTED).otherwise(F.concat(F.lit(REDACTED[:-2] + "_"), (i + 1).cast("string"), F.lit("__"))).alias("alias")))
    # Longer values first, so that none is replaced as the start of another.
    ordered = F.transform(F.sort_array(F.transform(named, lambda x: F.struct(F.char_length(x["value"]).alias("n"), x.alias("x"))), asc=False), lambda y: y["x"])
    clean = F.aggregate(ordered, out, lambda text, x: F.replace(text, F.concat(F.lit(f"{token}="), x["value"]), F.concat(F.lit(f"{token}="), x["alias"])))
    return F.struct(clean.alias("html"), F.sha2(clean, 256).alias("sha256"), F.octet_length(page).alias("bytes"), F.octet_length(clean).alias("scrubbed_bytes"))


#: Last path parts that name a page's kind (fixed values).
ROUTES = ("locate", "pick", "vehicle", "groups", "unit", "parts", "diagram")


def _texts_in(html: Column, tag: str) -> Column:
    inner = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), 1)
    return F.lower(F.array_join(F.transform(inner, lambda x: F.regexp_replace(x, "<[^>]*>", " ")), " "))


def classify_page(url: str | Column, html: str | Column, search_path: str = "/en/search/all", root_path: str = "/en/catalog/genuine") -> Column:
    """A page's kind: by its path, else by the words of its headings and column heads, else by its query."""
    bare = F.regexp_replace(_c(url), "#.*$", "")
    path = F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?]*)?([^?]*)", 1)
    route = F.regexp_extract(F.regexp_replace(path, "/+$", ""), "([^/]*)$", 1)
    page = F.coalesce(_c(html), F.lit(""))
    labels = F.concat_ws(" ", _texts_in(page, "h1"), _texts_in(page, "h2"), _texts_in(page, "th"))

    def by_labels(label: Column) -> Column:
        has = label.contains
        return (
            F.when(has("part number") | (has("callout") & has("quantity")), "parts").when(has("diagram") & ~has("model"), "diagram")
            .when(has("prod period") | has("sales code") | has("chassis") | has("engine"), "vehicle")
        )

    by_path = (
        F.when(path.endswith(".xml") | path.endswith(".xml.gz") | path.contains("sitemap"), "sitemap").when(path == "/robots.txt", "robots").when(path == search_path, "search")
        .when(route.isin(*ROUTES), route).when(F.trim(page) == "", "unknown")
    )
    by_query = (
        F.when(bare.rlike(r"[?&]q=[^&]"), "search").when(F.regexp_replace(path, "/+$", "") == root_path, "genuine_root").otherwise("generic")
    )
    return F.coalesce(by_path, let(labels, by_labels), by_query)
