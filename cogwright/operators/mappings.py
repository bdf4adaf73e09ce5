"""Reviewed links of decoded VINs to catalog vehicles: whether each still holds, the parts that fit by it, and names of parts in two languages.

A link holds by the policy of its source. By name: what the reviewer saw is what the decode says, letter by letter. Of a sparse decode: what the
decode lacks is the vehicle's, and what it has agrees. Any other source: make, model, engine and trim agree as keys in all three, and
just one vehicle of the catalog agrees. The manual ones need a reference, and all need the model year that was reviewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fitment_window, month_year, ordered, year_in
from ..functions.records import decode_completeness, decode_status
from ..functions.text import alnum_key, is_blank, pair_id, part_key, vin_surrogate

#: Sources of links that a person decided (fixed values).
BY_NAME, SPARSE = "manual-name-override", "manual-sparse-override"
FIELDS = ("make", "model", "engine", "trim")
_FORM = ("vehicle_id", *FIELDS, "production_from", "production_to")


def _and(*tests: Column) -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))


def _with_keys(df: DataFrame, name: str) -> DataFrame:
    """df as one struct column, with the key of each field beside it."""
    return df.select(F.struct(*df.columns, *(alnum_key(f).alias(f"{f}_key") for f in FIELDS)).alias(name))


def _form_key() -> Column:
    """The digest of a vehicle's description: 32 bytes in each part row and link that is joined by it, not the description itself."""
    return F.unhex(F.sha2(F.to_json(F.struct(*_FORM)), 256))


def vehicle_forms(snapshot: DataFrame) -> DataFrame:
    """(form, and the columns of a vehicle): each vehicle as its part rows describe it, once; `form` names the description."""
    return snapshot.filter("vehicle_id is not null").select(*_FORM).distinct().withColumn("form", _form_key())


def only_ones(decodes: DataFrame, forms: DataFrame) -> DataFrame:
    """(make_key, model_key, engine_key, trim_key, model_year) of decodes that just one vehicle with known months agrees with.

    What decodes ask for is made distinct first, so a popular vehicle costs one row.
    """
    keys = [f"{f}_key" for f in FIELDS]
    asked = decodes.select("model_year", *(alnum_key(f).alias(f"{f}_key") for f in FIELDS)).distinct()
    dated = forms.filter("production_from is not null or production_to is not null").select("vehicle_id", "production_from", "production_to", *(alnum_key(f).alias(f"{f}_key") for f in FIELDS)).distinct()
    met = asked.join(dated, keys).filter(year_in(F.col("model_year"), F.col("production_from"), F.col("production_to")))
    return met.groupBy(*keys, "model_year").agg(F.countDistinct("vehicle_id").alias("_n")).filter("_n = 1").drop("_n")


def _holds(loose: bool) -> Column:
    """Whether link m of decode d holds for form c; loose lets a link speak where the catalog is blank, and asks a name for make and model."""
    d, m, c = F.col("d"), F.col("m"), F.col("c")
    manual = _and(~is_blank(m["reference"]), m["model_year"].eqNullSafe(d["model_year"]), c["make_key"] == d["make_key"])

    def filled(f: str) -> Column:
        said = F.nullif(F.trim(d[f]), F.lit(""))
        agrees = F.coalesce(said.isNull() | (c[f"{f}_key"] == d[f"{f}_key"]), F.lit(False))
        spoken = is_blank(c[f]) & ~is_blank(m[f]) if loose else F.lit(False)
        return m[f].eqNullSafe(F.coalesce(said, c[f])) & (agrees | spoken)

    sparse = _and(manual, m["make"].eqNullSafe(d["make"]), *(filled(f) for f in FIELDS[1:]))
    named = _and(manual, *(m[f].eqNullSafe(d[f]) for f in FIELDS), *((d["make"].isNotNull(), d["model"].isNotNull()) if loose else ()))
    keys = [_and(m[f"{f}_key"] == d[f"{f}_key"], c[f"{f}_key"] == d[f"{f}_key"]) for f in FIELDS]
    exact = _and(F.col("_only"), m["model_year"].eqNullSafe(d["model_year"]), *(~is_blank(d[f]) for f in FIELDS[1:]), *keys)
    return F.when(m["source"] == SPARSE, sparse).when(m["source"] == BY_NAME, named).otherwise(exact)


def _linked(decodes: DataFrame, links: DataFrame, forms: DataFrame) -> DataFrame:
    """(d, m, c, _only): each link with its decode and the forms of its vehicle."""
    pairs = _with_keys(decodes.select("vin", "model_year", *FIELDS), "d").join(_with_keys(links, "m"), F.col("d.vin") == F.col("m.vin"))
    wanted = only_ones(decodes, forms).withColumn("_only", F.lit(True))
    pairs = pairs.join(wanted, [*(F.col(f"d.{f}_key") == F.col(f"{f}_key") for f in FIELDS), F.col("d.model_year") == F.col("model_year")], "left").select("d", "m", "_only")
    return pairs.join(_with_keys(forms, "c"), F.col("m.vehicle_id") == F.col("c.vehicle_id"))


def mapping_view(decodes: DataFrame, links: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Each decode with its link, if any, and whether that holds: id, vin, mapping_id, vehicle_id, mapping_status, decode_status, completeness.

    decodes: vin, make, model, engine, trim, model_year, error_code; links: mapping_id, vin, vehicle_id, make, model, engine, trim,
    model_year, source, reference; snapshot: vehicle_id, make, model, engine, trim, production_from, production_to. A decode with several
    links has a row each. unmapped: no link or none to a vehicle; stale: the snapshot lacks the vehicle or the policy fails.
    """
    j = _linked(decodes, links, vehicle_forms(snapshot))
    first, last = F.col("c.production_from"), F.col("c.production_to")
    dated = F.when(F.col("m.source").isin(BY_NAME, SPARSE), first.isNotNull() | last.isNotNull()).otherwise(True)
    live = j.filter(_holds(False) & dated & year_in(F.col("d.model_year"), first, last)).select(F.col("m.mapping_id").alias("mapping_id")).distinct().withColumn("_live", F.lit(True))
    every = decodes.join(links.select("vin", "mapping_id", "vehicle_id", "source"), "vin", "left").join(live, "mapping_id", "left")
    status = F.when(F.col("vehicle_id").isNull(), "unmapped").when(F.col("_live").isNull(), "stale").when(F.col("source").isin(BY_NAME, SPARSE), "confirmed_manual_override").otherwise("confirmed")
    return every.select(vin_surrogate("vin").alias("id"), "vin", "mapping_id", "vehicle_id", status.alias("mapping_status"), decode_status("error_code").alias("decode_status"), decode_completeness(F.col("error_code"), F.col("model"), F.col("engine"), F.col("trim")).alias("completeness"))


def fitments_by_link(decodes: DataFrame, links: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(id, mapping_id, part_id, vehicle_id, vin, fitment_from, fitment_to, derivation): parts that fit each decoded VIN by its link.

    snapshot has part_id, part_name, part_range, part_from and part_to too. A part fits if its vehicle's months are known, its own
    range could be read, it has a name, and the model year lies in the months that both share. Policies are decided by forms of vehicles and
    not by part rows; then links and parts meet by year.
    """
    forms = vehicle_forms(snapshot)
    live = _linked(decodes, links, forms).filter(_holds(True)).select(F.col("m.mapping_id").alias("mapping_id"), "d.vin", F.col("d.model_year").alias("model_year"), F.col("m.source").alias("source"), F.col("c.form").alias("form")).distinct()
    read = is_blank("part_range") | F.col("part_from").isNotNull() | F.col("part_to").isNotNull()
    first, last = fitment_window(F.col("production_from"), F.col("production_to"), F.col("part_from"), F.col("part_to"))
    parts = snapshot.filter("vehicle_id is not null and (production_from is not null or production_to is not null)").filter(read & ~is_blank("part_name"))
    parts = parts.select("part_id", "vehicle_id", first.alias("fitment_from"), last.alias("fitment_to"), _form_key().alias("form")).filter(ordered(F.col("fitment_from"), F.col("fitment_to")))
    a, b = month_year(F.col("fitment_from")), month_year(F.col("fitment_to"))
    closed = parts.filter(a <= b).withColumn("model_year", F.explode(F.sequence(a, b)))
    still = parts.filter(a.isNull() | b.isNull())
    derivation = F.when(F.col("source").isin(BY_NAME, SPARSE), "manual_vehicle_override").otherwise("compatible_by_model_year_engine_trim")
    columns = [pair_id("mapping_id", "part_id").alias("id"), "mapping_id", "part_id", "vehicle_id", "vin", "fitment_from", "fitment_to", derivation.alias("derivation")]
    by_year = live.withColumn("model_year", F.col("model_year").cast("int")).join(closed, ["form", "model_year"]).select(*columns)
    return by_year.unionByName(live.join(still, "form").filter(year_in(F.col("model_year"), F.col("fitment_from"), F.col("fitment_to"))).select(*columns))


def term_view(terms: DataFrame, parts: DataFrame) -> DataFrame:
    """Names of parts in two languages: id, part_number_id (the least part of that name), the names, and the common names as a list.

    terms: id, english, chinese, common, source, reference; parts: id, name.
    """
    named = parts.join(terms.select(F.col("english").alias("name")).distinct(), "name", "left_semi").groupBy(F.col("name").alias("english")).agg(F.min("id").alias("part_number_id"))
    common = F.when(is_blank("common"), F.array().cast("array<string>")).otherwise(F.array("common"))
    return terms.join(named, "english", "left").select(
        "id", "part_number_id", F.col("english").alias("name_en_raw"), F.upper(F.trim("english")).alias("name_en_normalized"), F.col("chinese").alias("name_zh_tw"), F.to_json(common).alias("common_names_zh_tw"), F.lit("confirmed").alias("mapping_status"),
        F.col("source").alias("source_kind"), F.lit(1.0).cast("decimal(4,3)").alias("confidence"), F.col("reference").alias("source_url"),
    )


def part_fitments(snapshot: DataFrame, heads: DataFrame, manual: DataFrame) -> DataFrame:
    """(number, kind, and the columns of a fitment): what each part number fits, by the catalog as edited and by hand.

    snapshot: part_id, part_number, part_name, make, model, year_from, year_to; heads: part_id, number, name (null: not edited), status,
    revision; manual: part_number, part_name, make, model, year_from, year_to. `number` is the normalised one to look for. An edited number is
    found only while its head is active, and the number before it no more; parts that a head retires, and numbers of which nothing is left, are left out.
    """
    h = heads.select("part_id", F.col("number").alias("_number"), F.col("name").alias("_name"), "status", "revision")
    j = snapshot.join(h, "part_id", "left").filter(F.coalesce("status", F.lit("active")) != "retired")
    found = F.when(F.col("_number").isNull(), part_key("part_number")).when(F.col("status") == "active", part_key("_number"))
    rest = ["make", "model", "year_from", "year_to"]
    catalog = j.select(found.alias("number"), F.lit("catalog").alias("kind"), F.coalesce("_number", "part_number").alias("part_number"), F.coalesce("_name", "part_name").alias("part_name"), *rest, F.coalesce("revision", F.lit(0)).alias("revision"))
    by_hand = manual.select(part_key("part_number").alias("number"), F.lit("manual").alias("kind"), "part_number", "part_name", *rest, F.lit(0).alias("revision"))
    return catalog.unionByName(by_hand).filter("number <> ''")
