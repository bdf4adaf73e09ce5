"""Entity views, reviewed links of VINs, terms, part fitments with manual rows, and vehicles by the names their brands use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import entities, mappings, overlay
from ..sources.pages import vehicle_record
from .base import once, query, table

# Lines as a parts catalog: categories are return flags of a supplier, groups are line states in them. One row an order line; of repeated ones the least.
_LINES = """SELECT l_orderkey * 10 + l_linenumber AS part_id, min(l_suppkey) AS vehicle_id, min(l_returnflag) AS c, min(l_linestatus) AS g, min(l_quantity) AS q, min(l_partkey) AS p, min(l_shipdate) AS shipped FROM lineitem GROUP BY 1"""
_LEAST = {"vehicle_id": "l_suppkey", "c": "l_returnflag", "g": "l_linestatus", "q": "l_quantity", "p": "l_partkey", "shipped": "l_shipdate"}
_IDS = "vehicle_id * 100 + ascii(c) AS category_id, vehicle_id * 10000 + ascii(c) * 100 + ascii(g) AS group_id"
_CATEGORIES = f"SELECT DISTINCT vehicle_id * 100 + ascii(c) AS category_id, vehicle_id, CASE WHEN c <> 'N' THEN 'cid' || vehicle_id END AS cid FROM ({_LINES}) x"
_GROUPS = f"SELECT DISTINCT {_IDS}, g AS code, CASE WHEN vehicle_id % 3 > 0 THEN 'group ' || g END AS name, 'u' || vehicle_id AS uid, 'http://s/g/' || vehicle_id AS url FROM ({_LINES}) x"
_PARTS = f"SELECT part_id, {_IDS.split(', ')[1]}, 'k' || (part_id % 10) AS code, CAST(CAST(q AS INT) AS VARCHAR(9)) AS quantity, CASE WHEN p % 4 > 0 THEN 'r' || (p % 4) END AS range, CASE WHEN p % 3 > 0 THEN MONTH_OF(shipped) END AS part_from, CASE WHEN p % 5 > 0 THEN YEAR_OF(shipped) || '-12' END AS part_to, CASE WHEN p % 7 = 0 THEN 'note' END AS note, CASE WHEN p % 2 = 0 THEN 'http://s/p/' || p END AS url FROM ({_LINES}) x"


def _duck(sql: str) -> str:
    return sql.replace("MONTH_OF(shipped)", "strftime(shipped, '%Y-%m')").replace("YEAR_OF(shipped)", "strftime(shipped, '%Y')")


def _frame(spark: SparkSession, d: str, sql: str, *names: str) -> DataFrame:
    """A query over fixture tables, named as in the SQL twin."""
    views = {name: table(spark, d, name) for name in names}
    if f"({_LINES})" in sql:
        keyed = views["lineitem"].select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("part_id"), *(F.col(c).alias(k) for k, c in _LEAST.items()))
        views["taken"] = once(keyed, ["part_id"], list(_LEAST))
    text = sql.replace(f"({_LINES})", "{taken}").replace("MONTH_OF(shipped)", "date_format(shipped, 'yyyy-MM')").replace("YEAR_OF(shipped)", "date_format(shipped, 'yyyy')").replace("VARCHAR(9)", "STRING").replace("VARCHAR", "STRING")
    for name in names:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(text, **{name: df for name, df in views.items() if "{" + name + "}" in text})


_JSON_ID = "'{\"category_id\":' || category_id || ',\"category_cid\":' || coalesce('\"' || cid || '\"', 'null')"


@query("e1_diagrams", f"WITH k AS ({_CATEGORIES}), g AS ({_GROUPS}) SELECT group_id AS id, vehicle_id, group_id * 2 + 1 AS taxonomy_node_id, code AS diagram_code_raw, coalesce(name, '') AS diagram_name_raw, {_JSON_ID} || ',\"group_uid\":\"' || uid || '\"}}' AS metadata_json, url AS source_url FROM g JOIN k USING (category_id)")
def e1_diagrams(spark: SparkSession, d: str) -> DataFrame:
    """Groups as diagrams."""
    return entities.diagrams(_frame(spark, d, _GROUPS, "lineitem"), _frame(spark, d, _CATEGORIES, "lineitem"))


_OCCURRENCES = f"k AS ({_CATEGORIES}), g AS ({_GROUPS}), p AS ({_duck(_PARTS)}), o AS (SELECT part_id AS id, part_id AS part_number_id, group_id AS diagram_id, vehicle_id, p.code AS callout_raw, quantity AS quantity_raw, range AS part_range_raw, part_from, part_to, note AS note_raw, {_JSON_ID} || ',\"group_code\":\"' || g.code || '\",\"group_uid\":\"' || uid || '\"}}' AS row_metadata_json, coalesce(p.url, g.url) AS source_url FROM p JOIN g USING (group_id) JOIN k USING (category_id))"


@query("e1_occurrences", f"WITH {_OCCURRENCES} SELECT * FROM o")
def e1_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """Part rows as occurrences in diagrams."""
    return entities.occurrences(_frame(spark, d, _PARTS, "lineitem"), _frame(spark, d, _GROUPS, "lineitem"), _frame(spark, d, _CATEGORIES, "lineitem"))


@query("e2_sample_occurrences", f"WITH {_OCCURRENCES}, r AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) SELECT o.* FROM o WHERE id // 10 IN (SELECT o_orderkey FROM r)")
def e2_sample(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences that the last sample run saw; runs are orders."""
    view = e1_occurrences(spark, d)
    runs = table(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "sample").otherwise("full").alias("status"), F.col("o_orderdate").alias("started_at"))
    return entities.of_last_sample(view, view.select("id", (F.col("id") / 10).cast("long").alias("run_id")), runs)


_SNAPSHOT = f"""SELECT part_id, vehicle_id, vehicle_id % 25 AS model_id, ' brand ' || (vehicle_id % 5) AS brand, 'v' || vehicle_id AS vehicle_name, 'm' || (vehicle_id % 25) AS model, CASE WHEN vehicle_id % 2 = 0 THEN 'period' END AS prod_period,
CASE WHEN vehicle_id % 3 > 0 THEN '1993-05' END AS production_from, CASE WHEN vehicle_id % 4 > 0 THEN '1997-' || (10 + part_id % 3) END AS production_to, 'vc' || vehicle_id AS vehicle_code, CASE WHEN vehicle_id % 6 = 0 THEN 'vid' END AS vehicle_vid, CASE WHEN vehicle_id % 7 > 0 THEN 'E' || (vehicle_id % 4) END AS engine, 'T' AS trim_name,
{_IDS}, CASE WHEN c <> 'N' THEN 'cid' || vehicle_id END AS category_cid, c AS category_main, g AS group_code, CASE WHEN vehicle_id % 3 > 0 THEN 'group ' || g END AS category_group, 'u' || vehicle_id AS group_uid, 'http://s/' || part_id AS source_url,
CASE WHEN p % 3 > 0 THEN MONTH_OF(shipped) END AS part_from, CASE WHEN p % 5 > 0 THEN YEAR_OF(shipped) || '-12' END AS part_to, shipped AS snapshot_at FROM ({_LINES}) x"""


@query("e2_formal_vehicles", f"WITH s AS ({_duck(_SNAPSHOT)}) SELECT vehicle_id AS id, min(model_id) AS catalog_model_id, min(brand) AS brand_raw, upper(trim(min(brand))) AS brand_normalized, min(vehicle_name) AS name_raw, min(model) AS model_raw, min(prod_period) AS prod_period_raw, min(production_from) AS production_from, max(production_to) AS production_to, CASE WHEN min(production_from) IS NOT NULL OR max(production_to) IS NOT NULL THEN 'month' END AS production_precision, min(vehicle_code) AS catalog_code, min(vehicle_vid) AS vehicle_external_id, '{{\"model_id\":' || min(model_id) || ',\"engine\":' || coalesce('\"' || min(engine) || '\"', 'null') || ',\"trim_name\":\"' || min(trim_name) || '\"}}' AS metadata_json, min(source_url) AS source_url, min(snapshot_at) AS created_at, max(snapshot_at) AS updated_at FROM s GROUP BY vehicle_id")
def e2_vehicles(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot's vehicles."""
    return entities.formal_vehicles(_frame(spark, d, _SNAPSHOT, "lineitem"))


@query("e2_formal_taxonomy", f"WITH s AS ({_duck(_SNAPSHOT)}) SELECT category_id * 2 AS id, min(vehicle_id) AS vehicle_id, CAST(NULL AS BIGINT) AS parent_id, 1 AS depth, coalesce(min(category_cid), '') AS code_raw, min(category_main) AS name_raw, min(category_main) AS path_raw, min(source_url) AS source_url FROM s GROUP BY category_id UNION ALL SELECT group_id * 2 + 1, min(vehicle_id), min(category_id) * 2, 2, min(group_code), coalesce(min(category_group), ''), min(category_main) || ' / ' || coalesce(min(category_group), min(group_code)), min(source_url) FROM s GROUP BY group_id")
def e2_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot's categories and groups as one tree."""
    return entities.formal_taxonomy(_frame(spark, d, _SNAPSHOT, "lineitem"))


@query("e2_formal_diagrams", f"WITH s AS ({_duck(_SNAPSHOT)}), m AS (SELECT group_id, min(vehicle_id) AS vehicle_id, min(group_code) AS code, min(category_group) AS name, min(category_id) AS category_id, min(category_cid) AS cid, min(group_uid) AS uid, min(source_url) AS url FROM s GROUP BY 1) SELECT group_id AS id, vehicle_id, group_id * 2 + 1 AS taxonomy_node_id, code AS diagram_code_raw, coalesce(name, '') AS diagram_name_raw, {_JSON_ID} || ',\"group_uid\":\"' || uid || '\"}}' AS metadata_json, url AS source_url FROM m")
def e2_diagrams(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot's groups as diagrams."""
    return entities.formal_diagrams(_frame(spark, d, _SNAPSHOT, "lineitem"))


@query("e2_formal_fitments", f"WITH s AS ({_duck(_SNAPSHOT)}), w AS (SELECT *, greatest(production_from, part_from) AS a, least(production_to, part_to) AS b FROM s) SELECT part_id AS id, vehicle_id, group_id AS diagram_id, NOT coalesce(a > b, false) AS is_verified, CASE WHEN a > b THEN 'invalid_date_intersection' ELSE 'verified_current_catalog' END AS derivation, CAST(CASE WHEN a > b THEN 0 ELSE 1 END AS DECIMAL(4, 3)) AS confidence, a AS effective_from, b AS effective_to, source_url FROM w")
def e2_fitments(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot's part rows as fitments."""
    return entities.formal_fitments(_frame(spark, d, _SNAPSHOT, "lineitem"))


# Orders as decodes of VINs and as links; suppliers as vehicles, of which some are alike and some have no months.
_FORMS = "SELECT s_suppkey AS vehicle_id, 'BRAND 1' || (s_suppkey % 5) AS make, CASE WHEN s_suppkey % 8 > 0 THEN 'M-' || (s_suppkey % 3) END AS model, CASE WHEN s_suppkey % 4 > 0 THEN 'E' || (s_suppkey % 4) END AS engine, 't ' || (s_suppkey % 2) AS trim, CASE WHEN s_suppkey % 3 > 0 THEN '1993-05' END AS production_from, CASE WHEN s_suppkey % 2 > 0 THEN '1996-09' END AS production_to FROM supplier"
_SEEN = "SELECT *, o_custkey % 120 + 1 AS v, CASE WHEN o_orderkey % 31 > 0 THEN o_custkey % 120 + 1 END AS linked FROM orders"
_DECODES = f"SELECT DISTINCT 'VIN' || o_orderkey AS vin, 'brand#1' || ((v + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END) % 5) AS make, CASE WHEN o_orderkey % 17 > 0 THEN 'm ' || (v % 3) END AS model, CASE WHEN o_orderkey % 3 > 0 THEN 'e-' || (v % 4) END AS engine, CASE WHEN o_orderkey % 5 > 0 THEN ' T' || (v % 2) ELSE ' ' END AS trim, CAST(year(o_orderdate) AS INT) AS model_year, CASE o_orderkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '0,8 - x' WHEN 2 THEN '1' END AS error_code FROM ({_SEEN}) o"
_LINKS = f"""SELECT o.o_orderkey AS mapping_id, d.vin, linked AS vehicle_id, CASE WHEN o_orderkey % 4 < 2 THEN d.make ELSE 'Brand1' || (v % 5) END AS make,
CASE o_orderkey % 4 WHEN 0 THEN coalesce(nullif(trim(d.model), ''), f.model, 'other') WHEN 1 THEN CASE WHEN o_orderkey % 19 > 0 THEN d.model ELSE 'M' END ELSE 'M' || (v % 3) END AS model, CASE o_orderkey % 4 WHEN 0 THEN coalesce(nullif(trim(d.engine), ''), f.engine) WHEN 1 THEN d.engine ELSE 'E' || (v % 4) END AS engine,
CASE o_orderkey % 4 WHEN 0 THEN coalesce(nullif(trim(d.trim), ''), f.trim) WHEN 1 THEN d.trim ELSE 'T' || (v % 2) END AS trim, CAST(year(o_orderdate) AS INT) + CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS model_year, CASE o_orderkey % 4 WHEN 0 THEN '{mappings.SPARSE}' WHEN 1 THEN '{mappings.BY_NAME}' ELSE 'vpic' END AS source, CASE WHEN o_orderkey % 29 > 0 THEN 'ref' ELSE ' ' END AS reference
FROM ({_SEEN}) o JOIN ({_DECODES}) d ON d.vin = 'VIN' || o.o_orderkey LEFT JOIN ({_FORMS}) f ON f.vehicle_id = o.v WHERE o_orderkey % 9 > 0"""
_AL = "regexp_replace(upper({0}), '[^A-Z0-9]', '', 'g')"
_IN_YEAR = "(c.{a} IS NULL OR d.model_year >= CAST(left(c.{a}, 4) AS INT)) AND (c.{b} IS NULL OR d.model_year <= CAST(left(c.{b}, 4) AS INT))"


def _policy_sql(loose: bool) -> str:
    """The policies in SQL, over d, m, c and n (how many vehicles agree with the decode)."""
    same = lambda a, b, f: f"{_AL.format(f'{a}.{f}')} = {_AL.format(f'{b}.{f}')}"
    spoken = lambda f: f" OR coalesce(trim(c.{f}), '') = '' AND coalesce(trim(m.{f}), '') <> ''" if loose else ""
    three, four = ("model", "engine", "trim"), mappings.FIELDS
    manual = f"trim(m.reference) <> '' AND m.model_year IS NOT DISTINCT FROM d.model_year AND {same('c', 'd', 'make')}"
    sparse = " AND ".join([manual, "m.make IS NOT DISTINCT FROM d.make", *(f"m.{f} IS NOT DISTINCT FROM coalesce(nullif(trim(d.{f}), ''), c.{f}) AND (coalesce(trim(d.{f}), '') = '' OR {same('c', 'd', f)}{spoken(f)})" for f in three)])
    named = " AND ".join([manual, *(f"m.{f} IS NOT DISTINCT FROM d.{f}" for f in four), *(["d.make IS NOT NULL AND d.model IS NOT NULL"] if loose else [])])
    exact = " AND ".join(["m.model_year IS NOT DISTINCT FROM d.model_year AND n.n = 1", *(f"trim(d.{f}) <> ''" for f in three), *(f"{same('m', 'd', f)} AND {same('c', 'd', f)}" for f in four)])
    return f"coalesce(CASE m.source WHEN '{mappings.SPARSE}' THEN {sparse} WHEN '{mappings.BY_NAME}' THEN {named} ELSE {exact} END, false)"


_AGREE = " AND ".join(f"{_AL.format(f'd.{f}')} = {_AL.format(f'c.{f}')}" for f in mappings.FIELDS)
_COUNTS = f"n AS (SELECT d.vin, count(DISTINCT c.vehicle_id) AS n FROM d JOIN c ON {_AGREE} AND (c.production_from IS NOT NULL OR c.production_to IS NOT NULL) AND {_IN_YEAR.format(a='production_from', b='production_to')} GROUP BY 1)"
_REVIEWED = f"d AS ({_DECODES}), c AS ({_FORMS}), m AS ({_LINKS}), {_COUNTS}"
_BOTH = f"('{mappings.SPARSE}', '{mappings.BY_NAME}')"


def _reviewed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _frame(spark, d, _DECODES, "orders"), _frame(spark, d, _LINKS, "orders", "supplier"), _frame(spark, d, _FORMS, "supplier")


@query("e4_vin_mappings", f"WITH {_REVIEWED}, ok AS (SELECT DISTINCT m.mapping_id FROM m JOIN d ON d.vin = m.vin JOIN c ON c.vehicle_id = m.vehicle_id LEFT JOIN n ON n.vin = d.vin WHERE {_policy_sql(False)} AND (m.source NOT IN {_BOTH} OR c.production_from IS NOT NULL OR c.production_to IS NOT NULL) AND {_IN_YEAR.format(a='production_from', b='production_to')}) SELECT CAST('0x' || left(sha256(d.vin), 15) AS BIGINT) AS id, d.vin, m.mapping_id, m.vehicle_id, CASE WHEN m.vehicle_id IS NULL THEN 'unmapped' WHEN ok.mapping_id IS NULL THEN 'stale' WHEN m.source IN {_BOTH} THEN 'confirmed_manual_override' ELSE 'confirmed' END AS mapping_status, CASE WHEN d.error_code = '0' THEN 'decoded' ELSE 'decoded_with_warning' END AS decode_status, CASE WHEN d.error_code = '0,8 - x' THEN 'partial_no_detail_data' WHEN d.model IS NULL THEN 'partial_missing_model' WHEN d.engine IS NULL OR trim(d.trim) = '' THEN 'partial_missing_powertrain_or_trim' WHEN d.error_code = '0' THEN 'decoded_complete' ELSE 'decoded_complete_with_warning' END AS completeness FROM d LEFT JOIN m ON m.vin = d.vin LEFT JOIN ok ON ok.mapping_id = m.mapping_id")
def e4_vin_mappings(spark: SparkSession, d: str) -> DataFrame:
    """Decoded VINs with their links and whether these hold, by three policies."""
    return mappings.mapping_view(*_reviewed(spark, d))


_FIT_PARTS = "SELECT DISTINCT l_suppkey AS vehicle_id, l_partkey AS part_id, CASE WHEN l_partkey % 11 > 0 THEN 'name' ELSE ' ' END AS part_name, CASE WHEN l_partkey % 2 = 0 THEN 'range' END AS part_range, CASE WHEN l_partkey % 7 > 0 THEN YEAR_OF(l_shipdate) || '-03' END AS part_from, CASE WHEN l_partkey % 10 > 0 THEN YEAR_OF(l_shipdate) || '-12' END AS part_to FROM lineitem"


@query("e4_vin_fitments", f"""WITH {_REVIEWED}, f AS ({_FIT_PARTS.replace("YEAR_OF(l_shipdate)", "strftime(l_shipdate, '%Y')")}), live AS (SELECT m.mapping_id, d.vin, d.model_year, m.source, c.* FROM m JOIN d ON d.vin = m.vin JOIN c ON c.vehicle_id = m.vehicle_id LEFT JOIN n ON n.vin = d.vin WHERE {_policy_sql(True)} AND (c.production_from IS NOT NULL OR c.production_to IS NOT NULL)),
w AS (SELECT mapping_id, vin, part_id, model_year, source, greatest(production_from, part_from) AS a, least(production_to, part_to) AS b FROM live JOIN f USING (vehicle_id) WHERE part_name <> ' ' AND (part_range IS NULL OR part_from IS NOT NULL OR part_to IS NOT NULL))
SELECT mapping_id, vin, CASE WHEN source IN {_BOTH} THEN 'manual_vehicle_override' ELSE 'compatible_by_model_year_engine_trim' END AS derivation, count(*) AS n_parts, min(mapping_id * 4294967296 + part_id) AS first_id, CAST(sum(part_id) AS BIGINT) AS id_sum, min(a) AS first_month, max(b) AS last_month FROM w WHERE (a IS NULL OR model_year >= CAST(left(a, 4) AS INT)) AND (b IS NULL OR model_year <= CAST(left(b, 4) AS INT)) AND (a IS NULL OR b IS NULL OR a <= b) GROUP BY ALL""")
def e4_vin_fitments(spark: SparkSession, d: str) -> DataFrame:
    """Parts that fit decoded VINs by their links, summed by link."""
    decodes, links, forms = _reviewed(spark, d)
    parts = _frame(spark, d, _FIT_PARTS.replace("YEAR_OF(l_shipdate)", "date_format(l_shipdate, 'yyyy')"), "lineitem")
    rows = mappings.fitments_by_link(decodes, links, parts.join(forms, "vehicle_id"))
    return rows.groupBy("mapping_id", "vin", "derivation").agg(F.count("*").alias("n_parts"), F.min("id").alias("first_id"), F.sum("part_id").alias("id_sum"), F.min("fitment_from").alias("first_month"), F.max("fitment_to").alias("last_month"))


_TERMS = "SELECT p_size AS id, min(p_name) AS english, '名' || p_size AS chinese, CASE p_size % 3 WHEN 0 THEN 'c' || p_size WHEN 1 THEN ' ' END AS common, 'manual' AS source, 'ref' || p_size AS reference FROM part GROUP BY p_size"


@query("e4_terms", f"WITH t AS ({_TERMS}) SELECT id, (SELECT min(p_partkey) FROM part WHERE p_name = t.english AND p_partkey % 4 > 0) AS part_number_id, english AS name_en_raw, upper(trim(english)) AS name_en_normalized, chinese AS name_zh_tw, CASE WHEN id % 3 = 0 THEN '[\"' || common || '\"]' ELSE '[]' END AS common_names_zh_tw, 'confirmed' AS mapping_status, source AS source_kind, CAST(1 AS DECIMAL(4, 3)) AS confidence, reference AS source_url FROM t")
def e4_terms(spark: SparkSession, d: str) -> DataFrame:
    """Names of parts in two languages, with the least part of that name."""
    return mappings.term_view(_frame(spark, d, _TERMS, "part"), table(spark, d, "part").filter("p_partkey % 4 > 0").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


@query("e7_with_manual", r"""WITH s AS (SELECT l_partkey AS part_id, p_brand || '-' || l_partkey AS part_number, p_name AS part_name, 'mk' || (l_suppkey % 5) AS make, 's' || l_suppkey AS model, min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
h AS (SELECT p_partkey AS part_id, CASE WHEN p_partkey % 6 < 4 THEN 'new ' || (p_partkey // 2) END AS num, CASE WHEN p_partkey % 4 = 0 THEN 'edited' END AS nm, CASE p_partkey % 5 WHEN 0 THEN 'retired' WHEN 1 THEN 'draft' ELSE 'active' END AS status, p_size AS revision FROM part WHERE p_partkey % 2 = 0),
x AS (SELECT CASE WHEN num IS NULL THEN part_number WHEN status = 'active' THEN num END AS found, 'catalog' AS kind, coalesce(num, part_number) AS part_number, coalesce(nm, part_name) AS part_name, make, model, a, b, coalesce(revision, 0) AS revision FROM s LEFT JOIN h USING (part_id) WHERE coalesce(status, 'active') <> 'retired' UNION ALL SELECT p_brand || ' ' || p_partkey, 'manual', p_brand || ' ' || p_partkey, p_name, 'hand', 'made', 2000, NULL, 0 FROM part WHERE p_partkey % 8 = 3)
SELECT upper(regexp_replace(found, '[\s-]+', '', 'g')) AS number, kind, part_number, part_name, make, model, CAST(a AS INT) AS year_from, CAST(b AS INT) AS year_to, CAST(revision AS INT) AS revision FROM x WHERE found IS NOT NULL""")
def e7_with_manual(spark: SparkSession, d: str) -> DataFrame:
    """What each part number fits, by the catalog as edited and by hand."""
    part, year = table(spark, d, "part"), F.year("l_shipdate")
    spans = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"), "l_suppkey").agg(F.min(year).alias("year_from"), F.max(year).alias("year_to"))
    number = lambda sep: F.concat("p_brand", F.lit(sep), F.col("p_partkey").cast("string"))
    snapshot = spans.join(part, "p_partkey").select(F.col("p_partkey").alias("part_id"), number("-").alias("part_number"), F.col("p_name").alias("part_name"), F.concat(F.lit("mk"), F.col("l_suppkey") % 5).alias("make"), F.concat(F.lit("s"), "l_suppkey").alias("model"), "year_from", "year_to")
    k = F.col("p_partkey")
    heads = part.filter("p_partkey % 2 = 0").select(k.alias("part_id"), F.when(k % 6 < 4, F.concat(F.lit("new "), (k / 2).cast("long").cast("string"))).alias("number"), F.when(k % 4 == 0, "edited").alias("name"), F.when(k % 5 == 0, "retired").when(k % 5 == 1, "draft").otherwise("active").alias("status"), F.col("p_size").alias("revision"))
    manual = part.filter("p_partkey % 8 = 3").select(number(" ").alias("part_number"), F.col("p_name").alias("part_name"), F.lit("hand").alias("make"), F.lit("made").alias("model"), F.lit(2000).alias("year_from"), F.lit(None).cast("int").alias("year_to"))
    return mappings.part_fitments(snapshot, heads, manual)


@query("p9_vehicle_records", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'TOYOTA ' || p_brand WHEN 1 THEN 'Audi' WHEN 2 THEN 'Renault' ELSE p_brand END AS brand, CASE p_partkey % 4 WHEN 0 THEN 'frame' WHEN 1 THEN 'sales' WHEN 2 THEN 'type' ELSE 'npl' END || p_size AS model, CASE p_partkey % 4 WHEN 0 THEN 'grade' END AS description, CASE WHEN p_partkey % 4 IN (0, 2) THEN p_type END AS options, '2010 - 2015' AS prod_period, '2010-01' AS production_from, '2015-12' AS production_to, upper(CASE p_partkey % 4 WHEN 0 THEN 'TOYOTA ' || p_brand WHEN 1 THEN 'Audi' WHEN 2 THEN 'Renault' ELSE p_brand END) AS brand_normalized FROM part")
def p9(spark: SparkSession, d: str) -> DataFrame:
    """Vehicles by the names that their brands use for model, options and period."""
    k, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    brand = F.when(k == 0, F.concat(F.lit("TOYOTA "), "p_brand")).when(k == 1, "Audi").when(k == 2, "Renault").otherwise(F.col("p_brand"))
    period = F.when(k == 1, "Model Year:").otherwise("Prod Range")
    meta = F.create_map(F.lit(" Make:"), brand, F.lit("Frame"), F.concat(F.lit("frame"), size), F.lit("Sales Type"), F.concat(F.lit("sales"), size), F.lit("TYPE"), F.concat(F.lit("type"), size), F.lit("npl"), F.concat(F.lit("npl"), size), F.lit("Grade"), F.lit("grade"), F.lit("Engine "), F.col("p_type"), period, F.lit("2010 - 2015"))
    return table(spark, d, "part").select("p_partkey", vehicle_record(meta).alias("v")).select("p_partkey", *(f"v.{c}" for c in ("brand", "model", "description", "options", "prod_period", "production_from", "production_to", "brand_normalized")))


_PUBLISHED = "SELECT p_brand AS category_main, CASE WHEN p_size % 5 > 0 THEN 'g' || (p_size % 4) END AS category_group FROM part WHERE p_partkey % 3 = 0"
_SAMPLED = "SELECT p_brand AS category_main, 'g' || (p_size % 6) AS category_group FROM part WHERE p_partkey % 3 = 1"
_LABELS = "SELECT p_brand AS category_main, CASE p_size % 7 WHEN 2 THEN '' ELSE 'g' || (p_size % 7) END AS category_group, CASE WHEN p_size % 7 > 3 AND p_size % 2 = 0 THEN 's' ELSE '' END AS category_small, min('L' || p_size) AS label FROM part WHERE p_size % 7 > 1 GROUP BY 1, 2, 3"


@query("e10_categories", f"WITH p AS ({_PUBLISHED}), s AS ({_SAMPLED}), l AS ({_LABELS}), c AS (SELECT category_main, coalesce(category_group, '') AS category_group, CAST(NULL AS VARCHAR) AS category_small, 'verified_bounded' AS dataset_status FROM p UNION SELECT category_main, category_group, NULL, 'sample_not_published' FROM s UNION SELECT category_main, category_group, nullif(category_small, ''), 'manual_only' FROM l) SELECT c.*, CASE WHEN c.category_small IS NULL THEN 'unavailable_in_current_hierarchy' ELSE 'manual_only' END AS small_source_status, l.label FROM c LEFT JOIN l ON l.category_main = c.category_main AND l.category_group = c.category_group AND l.category_small = coalesce(c.category_small, '')")
def e10_categories(spark: SparkSession, d: str) -> DataFrame:
    """Categories with their origins, the source of their third level, and labels on all three keys."""
    return overlay.category_list(*(_frame(spark, d, sql, "part") for sql in (_PUBLISHED, _SAMPLED, _LABELS)))
