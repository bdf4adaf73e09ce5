"""Stored pages as rows: tables by header names, metadata, breadcrumbs, register rows and vehicle names.

One pass over the pages turns html into nested rows (tables, metadata, breadcrumb); what the catalog levels need is
taken from those by native expressions. Write the parsed pages once when several levels are read from them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_range
from ..functions.text import WHITE, clean_text, is_blank, let, part_key
from ..functions.urls import query_param

PARSED = "page_id long, title string, heading string, breadcrumb array<string>, metadata map<string,string>, anchors array<struct<href:string,text:string,data:map<string,string>,label:string,listed:boolean>>, tables array<struct<header:array<string>,classes:array<string>,rows:array<struct<cells:array<string>,links:array<string>>>>>"


class _Page(HTMLParser):
    """Collects tables (not nested ones), definition lists, data attributes, breadcrumb and headings."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title = self.heading = ""
        self.crumbs: list[str] = []
        self.meta: dict[str, str] = {}
        self.tables: list[dict] = []
        self._depth = 0
        self._row: list[list] | None = None
        self._th = 0
        self._into: str | None = None
        self._text = ""
        self._term = ""
        self._crumb_depth = 0
        self.anchors: list[dict] = []
        self._link: dict | None = None
        self._lists: list[bool] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        for k, v in a.items():
            if k.startswith("data-") and v and k not in ("data-href", "data-url"):
                self.meta.setdefault(k[5:], v.strip())
        if tag == "a":
            data = {k[5:]: v or "" for k, v in a.items() if k.startswith("data-")}
            self._link = {"href": a.get("href") or "", "text": "", "data": data, "label": "", "listed": any(self._lists)}
            self.anchors.append(self._link)
        if tag in ("ul", "ol"):
            self._lists.append(False)
        elif tag == "li":
            self._lists = [*self._lists[:-1], True]  # an item ends the one before it
        if "breadcrumb" in (a.get("class") or ""):
            self._crumb_depth = self._crumb_depth or 1
        if tag == "table":
            self._depth += 1
            if self._depth == 1:
                self.tables.append({"header": None, "classes": [], "rows": []})
        elif self._depth == 1 and tag == "tr":
            self._row, self._th = [], 0
        elif self._depth == 1 and tag in ("td", "th") and self._row is not None:
            self._row.append(["", "", a.get("class") or ""])
            self._th += tag == "th"
        elif self._depth == 1 and tag == "a" and self._row:
            self._row[-1][1] = self._row[-1][1] or (a.get("href") or "")
        elif tag in ("title", "h1", "dt", "dd", "li"):
            self._into, self._text = tag, ""

    def handle_data(self, data: str) -> None:
        if self._depth == 1 and self._row:
            self._row[-1][0] += data
        if self._into:
            self._text += data
        if self._link is not None:
            self._link["text"] += data
            self._link["label"] += data.strip()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("ul", "ol", "li") and self._lists:
            self._lists = self._lists[:-1] if tag != "li" else [*self._lists[:-1], False]
        if tag == "table" and self._depth:
            self._depth -= 1
        elif tag == "tr" and self._depth == 1 and self._row is not None:
            cells = [" ".join(x[0].split()) for x in self._row]
            table = self.tables[-1]
            if table["header"] is None and self._th and self._th == len(cells):
                table["header"], table["classes"] = cells, [x[2] for x in self._row]
            elif any(cells):
                table["rows"].append({"cells": cells, "links": [x[1] for x in self._row]})
                if len(cells) == 2:
                    self.meta.setdefault(cells[0].rstrip(":"), cells[1])
            self._row = None
        elif tag == "a" and self._link is not None:
            self._link["text"] = " ".join(self._link["text"].split())
            self._link = None
        elif tag == self._into:
            text = " ".join(self._text.split())
            if tag == "title":
                self.title = text
            elif tag == "h1":
                self.heading = self.heading or text
            elif tag == "dt":
                self._term = text.rstrip(":")
            elif tag == "dd" and self._term:
                self.meta.setdefault(self._term, text)
            elif tag == "li" and self._crumb_depth:
                self.crumbs.append(text)
            self._into = None
        if tag in ("ul", "ol", "nav") and self._crumb_depth:
            self._crumb_depth = 0


def parse_pages(pages: DataFrame) -> DataFrame:
    """(page_id, html) to nested rows; a null or broken page gives empty ones. Header names are kept as they stand."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for page_id, html in zip(pdf["page_id"], pdf["html"], strict=True):
                p = _Page()
                p.feed(html or "")
                p.close()
                tables = [{"header": t["header"] or [], "classes": t["classes"], "rows": t["rows"]} for t in p.tables]
                out.append((page_id, p.title, p.heading, p.crumbs, p.meta, p.anchors, tables))
            yield pd.DataFrame(out, columns=["page_id", "title", "heading", "breadcrumb", "metadata", "anchors", "tables"])

    return pages.select("page_id", "html").mapInPandas(run, PARSED)


def table_rows(parsed: DataFrame, aliases: Mapping[str, Sequence[str]], needed: Sequence[str]) -> DataFrame:
    """(page_id, table_no, row_no, <role>, <role>_link): rows of tables whose header has the needed roles, by alias in lower case."""
    rows = parsed.select("page_id", F.posexplode("tables").alias("table_no", "t")).withColumn("h", F.transform("t.header", lambda x: F.lower(F.trim(x))))
    at = {role: F.array_max(F.transform(F.array(*(F.lit(a) for a in names)), lambda a: F.array_position(F.col("h"), a))) for role, names in aliases.items()}
    rows = rows.withColumns({f"_{r}": p for r, p in at.items()})
    for r in needed:
        rows = rows.filter(F.col(f"_{r}") > 0)
    rows = rows.select("page_id", "table_no", *(f"_{r}" for r in aliases), F.posexplode("t.rows").alias("row_no", "r"))
    cell = lambda r, part: F.when(F.col(f"_{r}") > 0, F.nullif(F.get(F.col(f"r.{part}"), (F.col(f"_{r}") - 1).cast("int")), F.lit("")))
    return rows.select("page_id", "table_no", "row_no", *(cell(r, "cells").alias(r) for r in aliases), *(cell(r, "links").alias(f"{r}_link") for r in aliases))


#: Which column of a vehicle table is which: role, parts of the head's class as it stands, parts of the class in lower
#: case, texts as they stand, texts in lower case; the first role that fits counts (fixed values).
VEHICLE_ROLES = (
    ("name", ("n_name",), (), ("Name",), ()),
    ("description", ("__description",), (), ("Description",), ()),
    ("grade", ("__grade",), (), (), ()),
    ("market", ("__market",), (), (), ()),
    ("year_from", ("__modelyearfrom",), (), (), ()),
    ("year_to", ("__modelyearto",), (), (), ()),
    ("model_code", ("__model",), (), ("Model",), ()),
    ("engine", (), ("__engine",), (), ("engine",)),
    ("prod_period", ("__prodPeriod",), ("prod",), (), ()),
    ("options", ("__options",), (), ("Options",), ()),
    ("transmission", (), ("__transmission", "__gearbox"), (), ("transmission", "gearbox")),
    ("body_style", (), ("__bodystyle",), (), ("body style",)),
)
#: The fields that tell vehicles apart; tokens and links are none of them.
VEHICLE_SPEC = ("model_code", "name", "description", "options", "prod_period", "grade", "market", "engine", "transmission", "body_style")


def vehicle_role(css: Column, head: Column) -> Column:
    """The role of a column by its head's class and text; null if it has none."""
    text, lower = F.trim(head), F.lower(css)
    chain = None
    for role, raw, low, texts, lows in VEHICLE_ROLES:
        fits = [css.contains(x) for x in raw] + [lower.contains(x) for x in low] + [text == x for x in texts] + [F.lower(text) == x for x in lows]
        hit = reduce(lambda a, b: a | b, fits)
        chain = F.when(hit, role) if chain is None else chain.when(hit, role)
    return chain


def extract_vehicles(parsed: DataFrame, brands: DataFrame, path: str = "/en/catalog/genuine/vehicle") -> tuple[DataFrame, DataFrame]:
    """(vehicles, malformed): rows of vehicle tables with a link to a vehicle of the page's brand, each specification once.

    brands: (page_id, brand), the code in the links' c; links without one count as the page's own. A table counts if one
    of its columns is a name. A period that is missing is made of the years. malformed: (page_id, n) counts links that
    two rows give different specifications, and vehicle links of the page that no row has.
    """
    own = parsed.join(brands, "page_id")
    mine = lambda link, brand: F.regexp_extract(link, r"^(?:https?://[^/?#]+)?([^?#]*)", 1).eqNullSafe(F.lit(path)) & (F.coalesce(query_param(link, "c"), F.lit("")).isin("") | (query_param(link, "c") == brand))
    identity = lambda link: F.struct(*(query_param(link, k).alias(k) for k in ("c", "ssd", "vid")))
    tables = own.select("page_id", "brand", F.posexplode("tables").alias("table_no", "t")).withColumn("roles", F.transform(F.arrays_zip("t.header", "t.classes"), lambda x: vehicle_role(x["classes"], x["header"])))
    rows = tables.filter(F.array_contains("roles", "name")).select("page_id", "brand", "table_no", "roles", F.posexplode("t.rows").alias("row_no", "r")).filter(F.size("r.cells") > 1)
    rows = rows.withColumn("links", F.filter("r.links", lambda x: (x != "") & mine(x, F.col("brand")))).filter(F.size("links") > 0)
    at = lambda role: F.array_max(F.transform("roles", lambda x, i: F.when((x == role) & (i < F.size("r.cells")), i)))
    cell = {role: F.coalesce(F.get(F.col("r.cells"), at(role)), F.lit("")) for role, *_ in VEHICLE_ROLES}
    rows = rows.select("page_id", "table_no", "row_no", "links", *(c.alias(k) for k, c in cell.items()))
    period = F.when(F.col("prod_period") != "", F.col("prod_period")).when((F.col("year_from") != "") & (F.col("year_to") != ""), F.concat_ws(" - ", "year_from", "year_to"))
    rows = rows.withColumn("prod_period", F.coalesce(period.when(F.col("year_from") != "", F.concat("year_from", F.lit(" -"))).when(F.col("year_to") != "", F.concat(F.lit("- "), "year_to")), F.lit("")))
    rows = rows.filter(F.concat(*VEHICLE_SPEC) != "").withColumn("spec", F.struct(*VEHICLE_SPEC)).withColumn("place", F.struct("table_no", "row_no"))
    first = Window.partitionBy("page_id", "spec").orderBy("place")
    kept = rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").withColumns({"range": parse_range("prod_period"), "url": F.get("links", F.lit(0))})
    vehicles = kept.select("page_id", *VEHICLE_SPEC, F.col("range.start").alias("production_from"), F.col("range.end").alias("production_to"), query_param("url", "ssd").alias("ssd"), query_param("url", "vid").alias("vid"), "url")
    named = rows.select("page_id", "spec", "place", F.explode(F.array_distinct(F.transform("links", identity))).alias("candidate"))
    by_candidate = Window.partitionBy("page_id", "candidate").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    conflicts = named.withColumn("_first", F.first("spec").over(by_candidate)).filter("spec <> _first").select("page_id")
    linked = own.select("page_id", "brand", F.explode("anchors.href").alias("link")).filter(mine(F.col("link"), F.col("brand"))).select("page_id", identity(F.col("link")).alias("candidate")).distinct()
    lost = linked.join(named.select("page_id", "candidate").distinct(), ["page_id", "candidate"], "left_anti").select("page_id")
    return vehicles, conflicts.unionByName(lost).groupBy("page_id").agg(F.count("*").alias("n"))


def empty_parts_table(parsed: DataFrame) -> DataFrame:
    """(page_id, empty): whether the first table headed Number, Name and more has no row; a page without one is not empty."""
    shells = F.filter("tables", lambda t: (F.size(t["header"]) >= 3) & (F.get(t["header"], 0) == "Number") & (F.get(t["header"], 1) == "Name"))
    return parsed.select("page_id", F.coalesce(F.size(F.get(shells, F.lit(0))["rows"]) == 0, F.lit(False)).alias("empty"))


#: Column heads of a unit page's parts, without other characters than letters and figures, and what they hold (fixed values).
UNIT_HEADS = {
    "number": "part_number", "part number": "part_number", "name": "name", "part name": "name", "code": "code", "quantity": "quantity", "qty": "quantity", "qty required": "quantity",
    "range": "range", "part range": "range", "prod period": "range", "production period": "range",
}
#: Heads whose cells are merged into the note (fixed values).
NOTE_HEADS = ("note", "unified", "filter note", "specification")
#: The columns of a table without heads, in order.
PLAIN_COLUMNS = ("part_number", "name", "code", "note", "quantity", "range")


def extract_unit_parts(parsed: DataFrame, search_path: str = "/en/search/all") -> tuple[DataFrame, DataFrame]:
    """(parts, rejects) of unit pages: rows whose first cell links to a search are candidates.

    A candidate is malformed if its table's heads lack number, name or code, if it has more or fewer cells than heads (or
    not six where there are none), or if the search is for another number than the one shown. A row without a name is
    nameless, and malformed if it has no code or any cell that is no number, code, quantity, range or note. Only a range
    column gives a range; a lone Note is the note, and several note columns are merged under their heads. Of rows with
    one (number, range) on a page the last counts.
    """
    tables = parsed.select("page_id", F.posexplode("tables").alias("table_no", "t"))
    known = F.create_map(*(F.lit(x) for kv in UNIT_HEADS.items() for x in kv))
    labels = F.transform("t.header", lambda h: F.trim(F.regexp_replace(F.lower(h), "[^a-z0-9]+", " ")))
    tables = tables.withColumn("labels", labels).withColumn("roles", F.when(F.size("labels") > 0, F.transform("labels", lambda h: F.when(h.isin(*NOTE_HEADS), "note").otherwise(F.try_element_at(known, h)))).otherwise(F.array(*(F.lit(c) for c in PLAIN_COLUMNS))))
    rows = tables.select("page_id", "table_no", "roles", F.col("t.header").alias("header"), "labels", F.posexplode("t.rows").alias("row_no", "r"))
    link = F.get("r.links", F.lit(0))
    rows = rows.filter(F.regexp_replace(F.regexp_extract(link, r"^(?:https?://[^/?#]+)?([^?#]*)", 1), "/+$", "") == search_path)
    at = lambda role: F.array_max(F.transform("roles", lambda x, i: F.when(x == role, i)))
    cell = {c: F.coalesce(F.get("r.cells", at(c)), F.lit("")) for c in ("part_number", "name", "code", "quantity", "range")}
    notes = F.filter(F.transform("roles", lambda x, i: F.when(x == "note", i)), lambda i: i.isNotNull())
    under = F.transform(F.filter(notes, lambda i: F.coalesce(F.get("r.cells", i), F.lit("")) != ""), lambda i: F.concat(F.get("header", i), F.lit(": "), F.get("r.cells", i)))
    alone = (F.size(notes) == 1) & ((F.size("labels") == 0) | (F.get("labels", F.get(notes, F.lit(0))) == "note"))
    note = F.when(alone, F.coalesce(F.get("r.cells", F.get(notes, F.lit(0))), F.lit(""))).otherwise(F.array_join(under, "; "))
    wide = rows.select("page_id", "table_no", "row_no", F.size("r.cells").alias("n"), F.size("roles").alias("heads"), "roles", F.col("r.cells").alias("cells"), query_param(link, "q").alias("q"), *(c.alias(k) for k, c in cell.items()), note.alias("note"), F.transform(notes, lambda i: F.get("r.cells", i)).alias("note_cells"))
    usable = F.array_contains("roles", "part_number") & F.array_contains("roles", "name") & F.array_contains("roles", "code")
    strange = F.exists("cells", lambda c: (c != "") & ~F.array_contains(F.concat(F.array("part_number", "code", "quantity", "range"), "note_cells"), c))
    bad = ~usable | (F.col("n") != F.col("heads")) | F.coalesce(F.col("q") != F.col("part_number"), F.lit(True)) | (F.col("q") == "") | ((F.col("name") == "") & ((F.col("code") == "") | strange))
    wide = wide.withColumn("error", F.when(bad, "malformed").when(F.col("name") == "", "nameless"))
    last = Window.partitionBy("page_id", "part_number", "range").orderBy(F.desc("table_no"), F.desc("row_no"))
    good = wide.filter("error is null").withColumn("_n", F.row_number().over(last)).filter("_n = 1").withColumn("months", parse_range("range"))
    fields = ["page_id", "part_number", "name", "code", "quantity", "range", "note"]
    return good.select(*fields, F.col("months.start").alias("part_from"), F.col("months.end").alias("part_to")), wide.filter("error is not null").select("table_no", "row_no", *fields, "error")


PART_ALIASES = {"number": ("number", "part number", "oem"), "name": ("name", "description"), "code": ("code", "ref"), "quantity": ("quantity", "qty"), "range": ("unified", "range", "production"), "note": ("note", "filter note")}


def extract_parts(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parts, rejects): rows with a number and a name; rows without a name go to quarantine, without a number are malformed.

    Of rows with one (number, range) key on a page the last wins.
    """
    rows = table_rows(parsed, PART_ALIASES, ["number"]).withColumn("part_number", part_key("number"))
    error = F.when(is_blank("number"), "malformed").when(is_blank("name"), "nameless")
    rows = rows.withColumn("error", error)
    w = Window.partitionBy("page_id", "part_number", F.coalesce("range", F.lit(""))).orderBy(F.desc("table_no"), F.desc("row_no"))
    good = rows.filter("error is null").withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    return good.select("page_id", "part_number", "number", "name", "code", "quantity", "range", "note"), rows.filter("error is not null").select("page_id", "table_no", "row_no", "number", "name", "error")


def _anchors(parsed: DataFrame) -> DataFrame:
    rows = parsed.select("page_id", F.posexplode("anchors").alias("place", "a"))
    return rows.select("page_id", "place", F.col("a.href").alias("href"), clean_text("a.text").alias("text"), F.col("a.data").alias("data"))


def extract_hints(parsed: DataFrame, field: str) -> DataFrame:
    """(page_id, place, value): what links carry in a data attribute, such as compatibility hints or related numbers."""
    return _anchors(parsed).withColumn("value", F.element_at("data", field)).filter(~is_blank("value")).select("page_id", "place", "value")


def diagram_of(parsed: DataFrame, fields: Sequence[str] = ("Diagram", "diagram")) -> DataFrame:
    """(page_id, diagram): from the metadata, else the heading."""
    return parsed.select("page_id", F.coalesce(*(clean_text(F.element_at("metadata", f)) for f in fields), clean_text("heading")).alias("diagram"))


def replay_diff(stored: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Digests that a replay lacks, or has besides those stored: (keys, record_sha256, side). Equal runs give no rows."""
    on = [*keys, "record_sha256"]
    gone = stored.select(*on).join(fresh.select(*on), on, "left_anti").withColumn("side", F.lit("missing"))
    return gone.unionByName(fresh.select(*on).join(stored.select(*on), on, "left_anti").withColumn("side", F.lit("unexpected")))


def taxonomy(parsed: DataFrame) -> DataFrame:
    """(page_id, depth, name, path, parent_path): one node for each depth of the breadcrumb."""
    step = F.transform(F.col("breadcrumb"), lambda name, i: F.struct(i.alias("depth"), name.alias("name"), F.array_join(F.slice("breadcrumb", F.lit(1), i + 1), " > ").alias("path"), F.when(i > 0, F.array_join(F.slice("breadcrumb", F.lit(1), i), " > ")).alias("parent_path")))
    return parsed.select("page_id", F.explode(step).alias("n")).select("page_id", "n.*")


def adapt_vehicle(metadata: Column, aliases: Mapping[str, Sequence[str]]) -> Column:
    """struct of fields, each the first alias that the metadata has."""
    return F.struct(*(F.coalesce(*(clean_text(F.element_at(metadata, a)) for a in names)).alias(f) for f, names in aliases.items()))


#: Names that a field of a vehicle goes by (fixed values).
VEHICLE_ALIASES = {
    "brand": ("brand", "make"), "name": ("name", "vehicle", "vehicle name"), "model": ("model", "model code", "sales code", "npl"), "description": ("description",), "options": ("options", "option"),
    "prod_period": ("prod period", "production period", "prod range", "manufactured"), "catalog_code": ("catalog", "catalog code"), "vehicle_external_id": ("vehicle id", "vid", "uid"),
}
#: The same for brands that have names of their own, in the order in which they are looked for (fixed values).
BRAND_FIELDS = {
    "toyota": {"model": ("model", "model code", "frame", "frame code"), "description": ("description", "grade"), "options": ("options", "engine", "transmission", "destination")},
    "audi": {"model": ("model", "model designation", "sales type"), "prod_period": ("prod period", "model year", "production period")},
    "renault": {"model": ("model", "vehicle type", "type", "model code"), "options": ("options", "engine", "gearbox")},
}


def vehicle_record(metadata: Column) -> Column:
    """struct of a vehicle's fields, its months and how exact they are, by the names that its brand uses; null if nothing tells a vehicle.

    Names are compared trimmed, in lower case and without colons at the end; of names that are one then, the last counts. A field
    is the value of the first name that is there, be it empty. It takes a brand, a name, a model or a period that is not empty.
    """
    plain = lambda k: F.regexp_replace(F.lower(F.regexp_replace(k, f"^{WHITE}|{WHITE}$", "")), ":+$", "")
    entries = F.transform(F.coalesce(F.map_entries(metadata), F.array().cast("array<struct<key:string,value:string>>")), lambda e: F.struct(plain(e["key"]).alias("key"), F.coalesce(e["value"], F.lit("")).alias("value")))

    def fields(e: Column) -> Column:
        named = lambda n: F.try_element_at(F.filter(e, lambda x: x["key"] == n), F.lit(-1))["value"]
        first = lambda names: F.coalesce(*(named(n) for n in names))
        brand = F.lower(F.coalesce(F.nullif(named("brand"), F.lit("")), named("make"), F.lit("")))

        def of(field: str) -> Column:
            own = [(b, names[field]) for b, names in BRAND_FIELDS.items() if field in names]
            known = [b for b in BRAND_FIELDS]
            out = first(VEHICLE_ALIASES[field])
            for b, names in reversed(own):
                # The first brand that is found decides, also where it has no names of its own for this field.
                before = known[: known.index(b)]
                mine = F.contains(brand, F.lit(b))
                for other in before:
                    mine = mine & ~F.contains(brand, F.lit(other))
                out = F.when(mine, first(names)).otherwise(out)
            return out

        return F.struct(*(of(f).alias(f) for f in VEHICLE_ALIASES))

    def record(v: Column) -> Column:
        told = F.greatest(*(F.coalesce(F.length(v[f]), F.lit(0)) for f in ("brand", "name", "model", "prod_period"))) > 0
        months = lambda r: F.struct(*(v[f].alias(f) for f in VEHICLE_ALIASES), F.upper(F.nullif(v["brand"], F.lit(""))).alias("brand_normalized"), r["start"].alias("production_from"), r["end"].alias("production_to"), r["precision"].alias("production_precision"))
        return F.when(told, let(parse_range(v["prod_period"]), months))

    return let(let(entries, fields), record)


def register_rows(parsed: DataFrame, header: Sequence[str], excluded: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of register tables with exactly this header (kind, name, code, year first of all by position).

    Rows are padded or cut to the header; a code beyond 32 of A-Z, 0-9 and hyphen, a blank name, or a year outside
    1900-2100 is malformed; excluded kinds are left out.
    """
    rows = parsed.select("page_id", F.posexplode("tables").alias("table_no", "t")).filter(F.col("t.header") == F.array(*(F.lit(h) for h in header)))
    rows = rows.select("page_id", "table_no", F.posexplode("t.rows").alias("row_no", "r"))
    rows = rows.select("page_id", "table_no", "row_no", *(F.coalesce(F.get(F.col("r.cells"), F.lit(i)), F.lit("")).alias(h) for i, h in enumerate(header)))
    kind, name, code, year = header[:4]
    rows = rows.filter(~F.col(kind).isin(*excluded)) if excluded else rows
    ok = ~is_blank(name) & F.col(code).rlike("^[A-Z0-9-]{1,32}$") & F.coalesce(F.col(year).try_cast("int").between(1900, 2100), F.lit(False))
    return rows.filter(ok), rows.filter(~ok)


#: Words of vehicle names (fixed values).
BRANDS = (
    "AUDI", "BENTLEY", "BMW", "BUICK", "CADILLAC", "CHERY", "CHEVROLET", "CHRYSLER", "CITROEN", "CMC", "DACIA", "DAIHATSU", "DATSUN", "DS", "FERRARI", "FIAT", "FORD", "GENESIS", "GMC", "HONDA", "HYUNDAI", "INFINITI",
    "ISUZU", "JAGUAR", "JEEP", "KIA", "LAMBORGHINI", "LANCIA", "LEXUS", "LINCOLN", "LUXGEN", "MASERATI", "MAZDA", "MCLAREN", "MERCEDES-BENZ", "MG", "MINI", "MITSUBISHI", "NISSAN", "OPEL", "PEUGEOT", "PORSCHE",
    "RENAULT", "ROLLS-ROYCE", "SAAB", "SEAT", "SKODA", "SMART", "SSANGYONG", "SUBARU", "SUZUKI", "TESLA", "TOYOTA", "VOLKSWAGEN", "VOLVO",
)
TWO_WORD_BRANDS = ("LAND ROVER", "ALFA ROMEO", "ASTON MARTIN", "MERCEDES BENZ")
BRAND_ALIASES = {"BENZ": "MERCEDES-BENZ", "MERCEDES": "MERCEDES-BENZ", "MERCEDES BENZ": "MERCEDES-BENZ"}
#: Patterns and what they say, in the order they are tried (fixed values).
TRANSMISSIONS = (
    ("自動手排", "AMT"), (r"(?iU)\bCVT\b", "CVT"), (r"(?iU)\bDCT\b", "DCT"), (r"(?iU)\bAMT\b", "AMT"), (r"(?i)(?<![A-Za-z])AT(?![A-Za-z])", "AT"), (r"(?i)(?<![A-Za-z])MT(?![A-Za-z])", "MT"),
    ("自排", "AT"), ("手排", "MT"), ("無段變速|無段", "CVT"),
)
STYLES = (("TURBO|渦輪", "Turbo"), ("HYBRID|油電", "Hybrid"), (r"(?U)\bEV\b|純電", "EV"))
BODIES = (
    ("SUV|休旅", "SUV"), (r"(?U)\bMPV\b", "MPV"), (r"(?U)\bVAN\b|廂型|箱型", "VAN"), ("WAGON|旅行車", "WAGON"), ("COUPE|轎跑", "COUPE"), ("PICKUP|皮卡", "PICKUP"), ("TRUCK|貨車", "TRUCK"), (r"(?U)\bBUS\b|客車|巴士", "BUS"),
)
LEAST_CC, MOST_CC = 600, 7000


def _first_label(c: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """The label of the first pattern that a text has; null if it has none."""
    return F.coalesce(*(F.when(c.rlike(p), F.lit(label)) for p, label in patterns))


def parse_vehicle_name(name: Column) -> Column:
    """struct(brand, model_raw, displacement_cc, body_rule, transmission, doors, style) of a vehicle's name.

    The brand is the first word, or a known pair, under its usual name. Of the other words, nD is doors (the last
    counts), four figures with CC are a displacement, as is the first bare number of 600 to 7000 if none came before
    it (the first displacement counts); then come styles (all), transmissions (the first), and the rest is the model.
    The body is looked for in the whole text.
    """
    text = F.coalesce(clean_text(name), F.lit(""))
    split = F.filter(F.split(text, " "), lambda t: t != "")
    return let(F.struct(text.alias("text"), split.alias("words")), _vehicle_of)


def _vehicle_of(name: Column) -> Column:
    words = name["words"]
    pair = F.upper(F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1))))
    first = F.get(words, F.lit(0))
    two = pair.isin(*TWO_WORD_BRANDS) & (F.size(words) > 1)
    usual = F.create_map(*(F.lit(x) for kv in BRAND_ALIASES.items() for x in kv))
    known = F.upper(first).isin(*BRANDS, *BRAND_ALIASES)
    named = F.when(two, pair).when(known, F.upper(first)).otherwise(F.coalesce(first, F.lit("")))
    brand = let(F.struct(named.alias("b"), (two | known).alias("k")), lambda x: F.when(x["k"], F.coalesce(F.try_element_at(usual, x["b"]), x["b"])).otherwise(x["b"]))
    with_unit = lambda t: t.rlike(r"(?i)^[1-9]\d{3}(?:C\.?C\.?|㏄)$")
    bare = lambda t: F.coalesce(t.rlike(r"^[1-9]\d{2,3}$") & F.when(t.rlike(r"^\d{3,4}$"), t).try_cast("int").between(LEAST_CC, MOST_CC), F.lit(False))

    def sorted_out(rest: Column) -> Column:
        """(cc, kinds): the displacement's word, and each word with what it is."""
        at = F.array_min(F.filter(F.transform(rest, lambda t, i: F.when(with_unit(t) | bare(t), i)), lambda i: i.isNotNull()))
        kinds = lambda cc: F.transform(
            rest,
            lambda t, i: F.struct(
                t.alias("t"),
                F.when(t.rlike("(?i)^[2-7][-~]?D$"), "door").when(with_unit(t) | F.coalesce(i == cc, F.lit(False)), "cc").when(_first_label(F.upper(t), STYLES).isNotNull(), "style")
                .when(_first_label(t, TRANSMISSIONS).isNotNull(), "box").otherwise("model").alias("kind"),
            ),
        )
        return let(at, lambda cc: F.struct(F.get(rest, cc).alias("cc"), kinds(cc).alias("kinds")))

    def fields(found: Column) -> Column:
        of = lambda kind: F.transform(F.filter(found["kinds"], lambda k: k["kind"] == kind), lambda k: k["t"])
        styles = F.transform(of("style"), lambda t: _first_label(F.upper(t), STYLES))
        return F.struct(
            brand.alias("brand"), F.array_join(of("model"), " ").alias("model_raw"), F.regexp_extract(found["cc"], r"^(\d+)", 1).try_cast("int").alias("displacement_cc"), let(F.upper(name["text"]), lambda t: _first_label(t, BODIES)).alias("body_rule"),
            let(F.get(of("box"), F.lit(0)), lambda t: _first_label(t, TRANSMISSIONS)).alias("transmission"), F.substring(F.try_element_at(of("door"), F.lit(-1)), 1, 1).try_cast("int").alias("doors"), F.nullif(F.array_join(styles, " "), F.lit("")).alias("style"),
        )

    rest = F.slice(words, F.when(two, 3).otherwise(2), F.size(words) + 1)
    return let(let(rest, sorted_out), fields)
