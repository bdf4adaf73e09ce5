"""Catalog links of pages, by endpoint and context: brands, models, categories and part groups, with what is malformed.

A link counts if it leads to an endpoint of the site. Of what should lead somewhere, a candidate (the parameters that
tell links apart), at least one link must be sound; candidates without one are malformed. Links of other vehicles or brands
are navigation: they are passed over and counted as skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import category_name

# The endpoints, the form of a group's text, and the names of categories that have one.
LOCATE, PICK, VEHICLE, UNIT = "/en/catalog/genuine/locate", "/en/catalog/genuine/pick", "/en/catalog/genuine/vehicle", "/en/catalog/genuine/unit"
GROUP_TEXT = r"^([0-9A-Z]+\s+[0-9]+|[0-9]{3,4}):\s*(.*)$"
CATEGORIES = {1: "ENGINE/FUEL/TOOL", 2: "POWER TRAIN/CHASSIS", 3: "BODY/INTERIOR", 4: "ELECTRICAL"}


def first_param(href: Column, key: str) -> Column:
    """The first value of a query key that is not blank, decoded; null if there is none."""
    raw = F.regexp_extract(F.regexp_replace(href, "#.*$", ""), rf"\?(?:.*&)??{key}=([^&]+)", 1)
    return F.nullif(F.coalesce(F.try_url_decode(raw), raw), F.lit(""))


def leads_to(href: Column, endpoint: str, site: str) -> Column:
    """Whether a link is relative to the site or names it, on a usual port, and has the endpoint's path."""
    scheme, rest = F.lower(F.regexp_extract(href, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)), F.regexp_replace(href, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    net = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    host, port = F.lower(F.regexp_extract(net, r"^(?:.*@)?([^:]*)", 1)), F.regexp_extract(net, r"^(?:.*@)?[^:]*:(.*)$", 1)
    path = F.regexp_replace(F.regexp_extract(F.regexp_replace(rest, r"^//[^/?#]*", ""), r"^([^?#]*)", 1), "/+$", "")
    ours = F.when(net != "", (host == site) & port.isin("", "80", "443")).otherwise(scheme == "")
    return scheme.isin("", "http", "https") & ours & (path == endpoint)


def links(parsed: DataFrame, endpoint: str, site: str, keys: Sequence[str]) -> DataFrame:
    """(page_id, place, listed, href, text, one column for each key) of the links that lead to an endpoint."""
    rows = parsed.select("page_id", F.posexplode("anchors").alias("place", "a")).select("page_id", "place", F.col("a.listed").alias("listed"), F.col("a.href").alias("href"), F.col("a.label").alias("text"))
    return rows.filter(leads_to(F.col("href"), endpoint, site)).select("*", *(first_param(F.col("href"), k).alias(k) for k in keys))


def _candidate(keys: Sequence[str], required: str) -> Column:
    """What tells links apart: their parameters, and the whole link where the required one is missing."""
    return F.struct(*keys, F.when(F.col(required).isNull(), F.col("href")).alias("rest"))


def _malformed(rows: DataFrame) -> DataFrame:
    """(page_id, unsound): the candidates of each page that no sound link has; rows: page_id, candidate, sound."""
    each = rows.groupBy("page_id", "candidate").agg(F.bool_or("sound").alias("sound"))
    return each.groupBy("page_id").agg(F.count_if(~F.col("sound")).alias("unsound"))


def _first(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    w = Window.partitionBy("page_id", *keys).orderBy("place")
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def _first_of(column: str, keys: Sequence[str]) -> Column:
    return F.first(column, ignorenulls=True).over(Window.partitionBy("page_id", *keys).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def extract_brands(parsed: DataFrame, site: str) -> tuple[DataFrame, DataFrame]:
    """(brands, diagnostics): page_id, brand and url of the list links to a brand's page, each name once, the first kept; page_id and malformed."""
    rows = links(parsed, LOCATE, site, ["c"]).filter("listed").withColumn("sound", F.col("c").isNotNull() & (F.col("text") != "")).withColumn("candidate", _candidate(["c"], "c"))
    brands = _first(rows.filter("sound"), ["text"]).select("page_id", F.col("text").alias("brand"), F.col("href").alias("url"))
    return brands, _malformed(rows).select("page_id", F.col("unsound").alias("malformed"))


def extract_models(parsed: DataFrame, pages: DataFrame, site: str) -> tuple[DataFrame, DataFrame]:
    """(models, diagnostics): page_id, model, ssd and url of the links of the page's own brand; page_id and malformed. pages: page_id, brand."""
    rows = links(parsed, PICK, site, ["c", "model", "ssd"]).join(pages.select("page_id", "brand"), "page_id").filter(F.col("c").isNull() | (F.col("c") == F.col("brand")))
    rows = rows.withColumn("sound", F.col("text") != "").withColumn("candidate", _candidate(["c", "model", "ssd"], "model"))
    return rows.filter("sound").select("page_id", "place", F.col("text").alias("model"), "ssd", F.col("href").alias("url")), _malformed(rows).select("page_id", F.col("unsound").alias("malformed"))


def _in_context(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """rows with the page's brand and vid and `own`: neither names another brand, nor another vehicle where the page's is known."""
    j = rows.join(pages, "page_id")
    return j.withColumn("own", (F.col("c").isNull() | (F.col("c") == F.col("brand"))) & (F.col("page_vid").isNull() | F.coalesce(F.col("vid") == F.col("page_vid"), F.lit(False))))


def extract_categories(parsed: DataFrame, pages: DataFrame, site: str) -> tuple[DataFrame, DataFrame]:
    """(categories, diagnostics): page_id, cid, name, ssd, vid and url, the first of each cid; page_id, malformed and skipped.

    pages: page_id, brand, page_vid. A further name of a cid is malformed; links without text need one that has it.
    """
    rows = _in_context(links(parsed, VEHICLE, site, ["c", "ssd", "vid", "cid", "cname"]), pages.select("page_id", "brand", "page_vid"))
    rows = rows.withColumn("used", F.col("own") & F.col("cid").isNotNull())
    skipped = rows.groupBy("page_id").agg(F.count_if(~F.col("used")).alias("skipped"))
    named = rows.filter("used").withColumn("name", F.when(F.col("text") != "", F.coalesce(F.coalesce(F.try_url_decode(F.replace("cname", F.lit("+"), F.lit("%2B"))), "cname"), "text")))
    named = named.withColumns({"other": F.col("name") != _first_of("name", ["cid"]), "candidate": _candidate(["c", "ssd", "vid", "cid"], "cid")}).withColumn("sound", F.coalesce(~F.col("other"), F.lit(False)))
    conflicts = named.groupBy("page_id").agg(F.count_if("other").alias("conflicts"))
    diagnostics = skipped.join(conflicts, "page_id", "left").join(_malformed(named), "page_id", "left")
    diagnostics = diagnostics.select("page_id", (F.coalesce("conflicts", F.lit(0)) + F.coalesce("unsound", F.lit(0))).alias("malformed"), "skipped")
    return _first(named.filter("name is not null"), ["cid"]).select("page_id", "cid", "name", "ssd", "vid", F.col("href").alias("url")), diagnostics


def extract_groups(parsed: DataFrame, pages: DataFrame, site: str, default_cid: str = "1") -> tuple[DataFrame, DataFrame]:
    """(groups, diagnostics): page_id, cid, code, uid, name, category_name, ssd, vid and url; page_id, malformed, skipped and image_only.

    pages: page_id, brand, page_vid and page_cid (null: any). Text is `CODE: NAME`; a code's groups differ by uid. A link without
    text is a group with an empty code if no text link has its cid and uid; image_only counts those that came before one. A
    candidate with a second text and a group with a second name are malformed, and so are candidates of another category.
    """
    rows = _in_context(links(parsed, UNIT, site, ["c", "ssd", "vid", "cid", "uid"]), pages.select("page_id", "brand", "page_vid", "page_cid"))
    skipped = rows.groupBy("page_id").agg(F.count_if(~F.col("own")).alias("skipped"))
    rows = rows.filter("own").withColumn("candidate", _candidate(["c", "ssd", "vid", "cid", "uid"], "uid")).withColumn("cid", F.coalesce("cid", F.lit(default_cid)))
    meant = F.col("uid").isNotNull() & (F.col("page_cid").isNull() | (F.col("cid") == F.col("page_cid")))
    code, name = F.regexp_extract("text", GROUP_TEXT, 1), F.trim(F.regexp_extract("text", GROUP_TEXT, 2))
    rows = rows.withColumn("image", meant & (F.col("text") == "")).withColumn("spec", F.when(meant & (code != "") & (name != ""), F.struct(code.alias("code"), name.alias("name"))))
    rows = rows.withColumn("second", F.col("spec") != _first_of("spec", ["candidate"]))
    rows = rows.withColumn("sound", F.col("image") | F.coalesce(~F.col("second"), F.lit(False)))
    texts = rows.filter("sound and not image").select("*", F.col("spec.code").alias("code"), F.col("spec.name").alias("name"))
    texts = texts.withColumn("renamed", F.col("name") != _first_of("name", ["cid", "code", "uid"]))
    counts = rows.groupBy("page_id").agg(F.count_if("second").alias("seconds")).join(texts.groupBy("page_id").agg(F.count_if("renamed").alias("renamed")), "page_id", "left")
    first_text = texts.groupBy("page_id", "cid", "uid").agg(F.min("place").alias("_text_at"))
    images = _first(rows.filter("image"), ["cid", "uid"]).join(first_text, ["page_id", "cid", "uid"], "left")
    shown = images.groupBy("page_id").agg(F.count_if(F.col("_text_at").isNull() | (F.col("place") < F.col("_text_at"))).alias("image_only"))
    shape = ["page_id", "cid", "code", "uid", "name", category_name("cid", CATEGORIES).alias("category_name"), "ssd", "vid", F.col("href").alias("url")]
    groups = _first(texts, ["cid", "code", "uid"]).select(*shape).unionByName(images.filter("_text_at is null").withColumns({"code": F.lit(""), "name": F.lit("")}).select(*shape))
    zero = F.lit(0)
    diagnostics = skipped.join(counts, "page_id", "left").join(_malformed(rows), "page_id", "left").join(shown, "page_id", "left")
    total = F.coalesce("seconds", zero) + F.coalesce("renamed", zero) + F.coalesce("unsound", zero)
    return groups, diagnostics.select("page_id", total.alias("malformed"), "skipped", F.coalesce("image_only", zero).alias("image_only"))
