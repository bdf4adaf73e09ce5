"""Views and summaries of the catalog: entities, mappings, lists, searches and the database summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, records, text
from ..operators import curation, evidence, export, gates, overlay, rules, vin
from .base import FLAT_SQL, flat_catalog, query, table
from .curate import _MAPPINGS, _VEHICLES, _mappings, _vehicles


@query(
    "e1_vehicles",
    "SELECT s_suppkey AS id, upper(trim(r_name)) AS brand_normalized, s_name AS name_raw, n_name AS model_raw, min(strftime(l_shipdate, '%Y-%m')) AS production_from, max(strftime(l_shipdate, '%Y-%m')) AS production_to, CASE WHEN count(l_shipdate) > 0 THEN 'month' END AS production_precision, '{\"brand_id\":' || r_regionkey || ',\"model_id\":' || n_nationkey || '}' AS metadata_json FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey, r_name, s_name, n_name, r_regionkey, n_nationkey",
)
def e1_vehicles(spark: SparkSession, d: str) -> DataFrame:
    """Vehicles with their levels, production months and metadata."""
    month = F.date_format("l_shipdate", "yyyy-MM")
    months = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.min(month).alias("production_from"), F.max(month).alias("production_to"))
    v = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(months, "s_suppkey", "left")
    exact = F.nullif(dates.precision(F.col("production_from"), F.col("production_to")), F.lit("unknown"))
    meta = F.to_json(F.struct(F.col("r_regionkey").alias("brand_id"), F.col("n_nationkey").alias("model_id")))
    return v.select(F.col("s_suppkey").alias("id"), F.upper(F.trim("r_name")).alias("brand_normalized"), F.col("s_name").alias("name_raw"), F.col("n_name").alias("model_raw"), "production_from", "production_to", exact.alias("production_precision"), meta.alias("metadata_json"))


@query(
    "e1_taxonomy",
    "WITH g AS (SELECT l_suppkey AS vehicle, l_returnflag AS c, l_linestatus AS code FROM lineitem GROUP BY 1, 2, 3), k AS (SELECT DISTINCT vehicle, c, vehicle * 100 + ascii(c) AS cid FROM g) SELECT cid * 2 AS id, vehicle AS vehicle_id, CAST(NULL AS BIGINT) AS parent_id, 1 AS depth, c AS code_raw, c AS path_raw FROM k UNION ALL SELECT (g.vehicle * 10000 + ascii(g.c) * 100 + ascii(g.code)) * 2 + 1, g.vehicle, cid * 2, 2, g.code, g.c || ' / ' || g.code FROM g JOIN k ON k.vehicle = g.vehicle AND k.c = g.c",
)
def e1_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Categories and groups as one tree with disjoint ids."""
    g = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("vehicle_id"), F.col("l_returnflag").alias("c"), F.col("l_linestatus").alias("code")).distinct()
    g = g.withColumn("cid", F.col("vehicle_id") * 100 + F.ascii("c"))
    top = g.select("vehicle_id", "c", "cid").distinct().select(text.tree_id("cid", 0).alias("id"), "vehicle_id", F.lit(None).cast("long").alias("parent_id"), F.lit(1).alias("depth"), F.col("c").alias("code_raw"), F.col("c").alias("path_raw"))
    own = F.col("vehicle_id") * 10000 + F.ascii("c") * 100 + F.ascii("code")
    return top.unionByName(g.select(text.tree_id(own, 1).alias("id"), "vehicle_id", text.tree_id("cid", 0).alias("parent_id"), F.lit(2).alias("depth"), F.col("code").alias("code_raw"), F.concat_ws(" / ", "c", "code").alias("path_raw")))


@query("e1_part_numbers", r"SELECT p_partkey AS id, p_brand || '-' || p_partkey AS number_raw, upper(regexp_replace(p_brand || '-' || p_partkey, '[\s-]+', '', 'g')) AS number_normalized, p_name AS name_raw, regexp_matches(p_name, '(?i)\b(ASSY|ASSEMBLY|SUB-ASSY)\b') AS is_assembly FROM part")
def e1_part_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Part numbers as written and as compared."""
    raw = F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), raw.alias("number_raw"), text.part_key(raw).alias("number_normalized"), F.col("p_name").alias("name_raw"), text.assembly_flag("p_name")["flag"].alias("is_assembly"))


@query(
    "e1_fitments",
    f"WITH {FLAT_SQL}, v AS (SELECT vehicle_id, min(month) AS a, max(month) AS b FROM flat WHERE part_id % 2 = 0 GROUP BY 1), p AS (SELECT part_id, min(month) AS a, max(month) AS b FROM flat GROUP BY 1), f AS (SELECT DISTINCT vehicle_id, part_id FROM flat), w AS (SELECT f.*, greatest(v.a, p.a) AS effective_from, least(v.b, p.b) AS effective_to FROM f JOIN p USING (part_id) LEFT JOIN v USING (vehicle_id)) SELECT vehicle_id, part_id, effective_from, effective_to, CASE WHEN effective_from > effective_to THEN 'invalid_date_intersection' WHEN part_id % 3 = 0 THEN 'verified_current_catalog' ELSE 'normalized_unpublished' END AS derivation FROM w",
)
def e1_fitments(spark: SparkSession, d: str) -> DataFrame:
    """Fitments with the months that vehicle and part share, and whether the snapshot has them."""
    flat = flat_catalog(spark, d).select("vehicle_id", "part_id", "month")
    span = lambda df, key, a, b: df.groupBy(key).agg(F.min("month").alias(a), F.max("month").alias(b))
    pairs = flat.select("vehicle_id", "part_id").distinct()
    j = pairs.join(span(flat, "part_id", "p_from", "p_to"), "part_id").join(span(flat.filter("part_id % 2 = 0"), "vehicle_id", "v_from", "v_to"), "vehicle_id", "left")
    start, end = dates.fitment_window(F.col("v_from"), F.col("v_to"), F.col("p_from"), F.col("p_to"))
    snapshot = flat.select("part_id").distinct().filter("part_id % 3 = 0").withColumn("published", F.lit(True))
    j = j.withColumns({"effective_from": start, "effective_to": end}).join(snapshot, "part_id", "left")
    return j.select("vehicle_id", "part_id", "effective_from", "effective_to", records.fitment_verdict(F.col("effective_from"), F.col("effective_to"), F.col("published"))["derivation"].alias("derivation"))


@query("n8_membership", "SELECT p_partkey, EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R') AS verified FROM part")
def n8(spark: SparkSession, d: str) -> DataFrame:
    """Which rows the current snapshot has."""
    snapshot = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("_in", F.lit(True))
    return table(spark, d, "part").select("p_partkey").join(snapshot, "p_partkey", "left").select("p_partkey", F.col("_in").isNotNull().alias("verified"))


@query("n11_undecoded", "SELECT o_orderpriority AS dataset, count(DISTINCT o_custkey) AS never_decoded FROM orders a WHERE o_orderstatus = 'F' AND NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderpriority = a.o_orderpriority AND b.o_orderstatus = 'O') GROUP BY 1")
def n11(spark: SparkSession, d: str) -> DataFrame:
    """Sources that ended without ever being decoded."""
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("dataset"), F.col("o_custkey").alias("source"), "o_orderstatus")
    key = ["dataset", "source"]
    return o.filter("o_orderstatus = 'F'").join(o.filter("o_orderstatus = 'O'").select(*key).distinct(), key, "left_anti").groupBy("dataset").agg(F.countDistinct("source").alias("never_decoded"))


@query("n20_part_search", r"SELECT p_partkey FROM part WHERE CASE WHEN p_partkey % 4 = 0 AND p_partkey % 8 = 0 THEN 'BRAND#11' WHEN p_partkey % 4 = 0 THEN NULL ELSE upper(regexp_replace(p_brand, '[\s-]+', '', 'g')) END = 'BRAND#11' OR (p_partkey % 8 = 4 AND upper(regexp_replace(p_brand, '[\s-]+', '', 'g')) = 'BRAND#11')")
def n20(spark: SparkSession, d: str) -> DataFrame:
    """Parts found by number: the override's where there is one, else the source's."""
    part = table(spark, d, "part").select("p_partkey", text.part_key("p_brand").alias("number"))
    heads = part.filter("p_partkey % 4 = 0").select("p_partkey", F.when(F.col("p_partkey") % 8 == 0, "BRAND#11").alias("override"), F.lit("active").alias("status"))
    return overlay.search_effective(part, heads, "p_partkey", "number", "Brand#11").select("p_partkey")


@query("u4_field_search", "SELECT p_partkey FROM part WHERE contains(lower(p_name), 'steel') OR starts_with(p_brand, 'Brand#2') UNION SELECT p_partkey FROM part WHERE contains(p_type, 'TIN')")
def u4(spark: SparkSession, d: str) -> DataFrame:
    """Rows that any of several fields matches, each once."""
    part = table(spark, d, "part")
    return part.filter(text.matches(F.lower("p_name"), "steel") | text.matches("p_brand", "Brand#2", prefix=True) | text.matches("p_type", "TIN")).select("p_partkey")


@query(
    "e4_reconciliation",
    f"WITH {_VEHICLES}, {_MAPPINGS}, c AS (SELECT vin, count(DISTINCT vehicle_id) AS candidates, count(DISTINCT CASE WHEN strict THEN vehicle_id END) AS strict_candidates FROM cand GROUP BY 1) SELECT d.vin, 'decoded' AS decode_status, CASE WHEN trim(d.model) = '' THEN 'partial_missing_model' WHEN trim(d.engine) = '' OR trim(d.trim) = '' THEN 'partial_missing_powertrain_or_trim' ELSE 'decoded_complete' END AS completeness, coalesce(candidates, 0) AS candidates, coalesce(strict_candidates, 0) AS strict_candidates, CASE WHEN EXISTS (SELECT 1 FROM map m WHERE m.vin = d.vin) THEN 'mapped' WHEN coalesce(strict_candidates, 0) = 1 THEN 'ready' WHEN coalesce(candidates, 0) > 0 THEN 'review' ELSE 'no_candidate' END AS outcome FROM dec d LEFT JOIN c ON c.vin = d.vin",
)
def e4(spark: SparkSession, d: str) -> DataFrame:
    """Each decoded VIN with how complete it is, its candidates and whether it is mapped."""
    decodes, vehicles = _vehicles(spark, d)
    counts = vin.candidate_counts(decodes, vehicles)
    mapped = _mappings(spark, d).select("vin").distinct().withColumn("_mapped", F.lit(True))
    j = decodes.withColumn("code", F.lit("0")).join(counts, "vin", "left").join(mapped, "vin", "left")
    n, strict = F.coalesce("candidates", F.lit(0)), F.coalesce("strict_candidates", F.lit(0))
    outcome = F.when(F.col("_mapped"), "mapped").when(strict == 1, "ready").when(n > 0, "review").otherwise("no_candidate")
    return j.select("vin", records.decode_status("code").alias("decode_status"), records.decode_completeness(F.col("code"), F.col("model"), F.col("engine"), F.col("trim")).alias("completeness"), n.alias("candidates"), strict.alias("strict_candidates"), outcome.alias("outcome"))


@query(
    "e11_mapping_list",
    f"WITH {_MAPPINGS} SELECT vin, vehicle_id, policy FROM map WHERE starts_with(vin, 'VIN1') AND policy <> 'strict' ORDER BY vin, vehicle_id LIMIT 100",
)
def e11(spark: SparkSession, d: str) -> DataFrame:
    """A list of mappings by VIN prefix and policy, first hundred."""
    m = _mappings(spark, d)
    return m.filter(text.matches("vin", "VIN1", prefix=True) & (F.col("policy") != "strict")).orderBy("vin", "vehicle_id").limit(100).select("vin", "vehicle_id", "policy")


@query(
    "e12_summary",
    """WITH s AS (SELECT (SELECT count(*) FROM lineitem) AS parts, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS part_numbers, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS vehicles, (SELECT count(*) FROM documents WHERE strlen(text) <> length(text)) AS non_ascii_texts, (SELECT count(*) FROM documents WHERE coalesce(trim(text), '') = '') AS blank_texts,
(SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS open_runs, (SELECT count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL) AS orphans, (SELECT CAST(max(ts) AS VARCHAR) FROM events) AS latest)
SELECT parts, part_numbers, vehicles, non_ascii_texts, blank_texts, open_runs, orphans, substr(latest, 1, 19) AS latest, array_to_string(list_filter([CASE WHEN blank_texts > 0 THEN 'blank_texts' END, CASE WHEN open_runs > 0 THEN 'open_runs' END, CASE WHEN orphans > 0 THEN 'orphans' END], lambda x: x IS NOT NULL), ',') AS blocking FROM s""",
)
def e12(spark: SparkSession, d: str) -> DataFrame:
    """The database summary in one row, with what blocks readiness (E12, A5, A6, A16, N18): each table is aggregated once."""
    line, docs, orders = table(spark, d, "lineitem"), table(spark, d, "documents"), table(spark, d, "orders")
    frames = [
        line.agg(F.count("*").alias("parts"), F.countDistinct("l_partkey").alias("part_numbers"), F.countDistinct("l_suppkey").alias("vehicles")),
        docs.agg(F.count_if(text.non_ascii("text")).alias("non_ascii_texts"), F.count_if(text.is_blank("text")).alias("blank_texts")),
        orders.agg(F.count_if(F.col("o_orderstatus") == "O").alias("open_runs")),
        line.select(F.col("l_orderkey").alias("o_orderkey")).join(orders.select("o_orderkey"), "o_orderkey", "left_anti").agg(F.count("*").alias("orphans")),
        table(spark, d, "events").agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("latest")),
    ]
    one = frames[0]
    for f in frames[1:]:
        one = one.crossJoin(F.broadcast(f))  # one row each
    reasons = F.filter(F.array(*(F.when(F.col(c) > 0, F.lit(c)) for c in ("blank_texts", "open_runs", "orphans"))), lambda x: x.isNotNull())
    return one.withColumn("blocking", F.array_join(reasons, ","))


_LINES = "SELECT l_orderkey * 10 + l_linenumber AS id, min(l_partkey) AS p, min(l_suppkey) AS v, min(l_returnflag) AS r, min(l_quantity) AS q FROM {lineitem} GROUP BY l_orderkey, l_linenumber"


@query(
    "e19_archive_export",
    f"""WITH l AS ({_LINES.replace('{lineitem}', 'lineitem')}), t AS (SELECT p_partkey, p_name, p_brand, string_split(p_type, ' ') AS w, array_to_string(string_split(p_type, ' '), ' > ') AS path FROM part)
SELECT n_name AS "Brand", s_name AS "Name", 'm' || s_nationkey AS "Model", NULL AS "Prod period", '1995-01' AS "Production from", NULL AS "Production to", p_name AS "產品英文名稱", p_brand AS "Number", CASE WHEN p_partkey % 2 = 0 THEN w[1] END AS "零件大分類", CASE WHEN p_partkey % 2 = 0 THEN w[2] END AS "零件中分類", CASE WHEN p_partkey % 2 = 0 THEN w[3] END AS "零件小分類", CASE WHEN p_partkey % 2 = 0 THEN path END AS "Category path",
'r' AS "Range", NULL AS "Part range from", NULL AS "Part range to", 'dr' AS "Diagram range", 'c' AS "Condition", 'd' AS "Description", 'o' AS "Options", p_brand AS "Diagram code", p_name AS "Diagram name", 'co' AS "Callout", CAST(q AS INT) AS "Quantity", NULL AS "Note", 'http://x/' || l.id AS "Source URL",
CASE WHEN l.id % 3 = 0 THEN 'historical_archive' ELSE 'live_http' END AS "Source mode", CASE WHEN l.id % 3 = 0 THEN 'arc' END AS "Archive source", CASE WHEN l.id % 3 = 0 THEN '2020' END AS "Captured at", NULL AS "Archive truncation", l.id AS "Response ID", md5(CAST(l.id AS VARCHAR)) AS "Response SHA-256", 1.0::DOUBLE AS "Confidence", 'explicit' AS "Derivation", true AS "Verified fitment"
FROM l JOIN t ON l.p = t.p_partkey JOIN supplier ON l.v = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE r = 'R'""",
)
def e19(spark: SparkSession, d: str) -> DataFrame:
    """The archive export with its 34 columns."""
    none = F.lit(None).cast("string")
    line = spark.sql(_LINES, lineitem=table(spark, d, "lineitem"))
    part = table(spark, d, "part")
    fitments = line.select("id", F.col("id").alias("occurrence_id"), F.col("p").alias("number_id"), F.col("v").alias("vehicle_id"), F.col("p").alias("diagram_id"), F.concat(F.lit("http://x/"), F.col("id")).alias("source_url"), F.lit(1.0).alias("confidence"), F.lit("explicit").alias("derivation"), (F.col("r") == "R").alias("is_verified"))
    occurrences = line.select("id", F.lit("r").alias("part_range_raw"), none.alias("part_from"), none.alias("part_to"), F.lit("c").alias("part_condition_raw"), F.lit("co").alias("callout_raw"), F.col("q").cast("int").alias("quantity_raw"), none.alias("note_raw"))
    numbers = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name_en_raw"), F.col("p_brand").alias("number_raw"))
    vehicles = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id"), F.col("n_name").alias("brand"), F.col("s_name").alias("name_raw"), F.concat(F.lit("m"), F.col("s_nationkey")).alias("model_raw"), none.alias("prod_period_raw"), F.lit("1995-01").alias("production_from"), none.alias("production_to"), F.lit("d").alias("description_raw"), F.lit("o").alias("options_raw"),
    )
    diagrams = part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey")).alias("taxonomy_id"), F.lit("dr").alias("diagram_range_raw"), F.col("p_brand").alias("diagram_code_raw"), F.col("p_name").alias("diagram_name_raw"))
    taxonomy = part.select(F.col("p_partkey").alias("id"), F.array_join(F.split("p_type", " "), " > ").alias("path_raw"))
    sources = line.select(F.col("id").alias("record_id"), F.col("id").alias("response_id"))
    responses = line.select("id", F.md5(F.col("id").cast("string")).alias("body_sha256"))
    archives = line.filter("id % 3 = 0").select(F.col("id").alias("response_id"), F.lit("arc").alias("archive_source"), F.lit("2020").alias("captured_at"), none.alias("truncation_reason"))
    return export.archive_export(fitments, occurrences, numbers, vehicles, diagrams, taxonomy, sources, responses, archives)


@query(
    "m3_vehicles",
    """WITH b AS (SELECT p_size % 10 AS model_id, p_type AS name, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS engine, p_partkey FROM part), o AS (SELECT model_id, name, engine, min(p_partkey) AS id, 'old' AS ssd, 'u' AS url FROM b WHERE p_partkey % 3 = 0 GROUP BY 1, 2, 3),
n AS (SELECT model_id, name, engine, arg_max(CASE WHEN p_partkey % 2 = 0 THEN 's' || p_partkey ELSE '' END, p_partkey) AS ssd, 'n' || max(p_partkey) AS url FROM b WHERE p_partkey % 3 <> 0 GROUP BY 1, 2, 3)
SELECT o.id, coalesce(o.model_id, n.model_id) AS model_id, coalesce(o.name, n.name) AS name, coalesce(o.engine, n.engine) AS engine, coalesce(nullif(n.ssd, ''), o.ssd) AS ssd, CASE WHEN n.name IS NOT NULL THEN n.url ELSE o.url END AS url FROM o FULL JOIN n ON o.model_id = n.model_id AND o.name = n.name AND coalesce(o.engine, '') = coalesce(n.engine, '')""",
)
def m3(spark: SparkSession, d: str) -> DataFrame:
    """Vehicles upserted by the hash of what makes them (M3, H3)."""
    none = F.lit(None).cast("string")
    rest = {c: none for c in (*(c for c in records.VEHICLE_IDENTITY if c not in ("model_id", "name", "engine")), "vid", "production_from", "production_to")}
    part = table(spark, d, "part").select("p_partkey", (F.col("p_size") % 10).alias("model_id"), F.col("p_type").alias("name"), F.when(F.col("p_size") % 4 != 0, F.col("p_brand")).alias("engine"))
    old = part.filter("p_partkey % 3 = 0").groupBy("model_id", "name", "engine").agg(F.min("p_partkey").alias("id")).withColumns(rest | {"ssd": F.lit("old"), "url": F.lit("u")})
    new = part.filter("p_partkey % 3 <> 0").withColumns(rest | {"ssd": F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("s"), F.col("p_partkey"))), "url": F.concat(F.lit("n"), F.col("p_partkey")), "position": F.col("p_partkey")}).drop("p_partkey")
    return curation.upsert_vehicles(old, new).select("id", "model_id", "name", "engine", "ssd", "url")


_SNAPSHOT = r"""SELECT p_partkey AS part_id, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size END AS group_id, 1 AS category_id, p_size AS vehicle_id, 1 AS model_id, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 1 END AS brand_id, CASE WHEN p_partkey % 19 = 0 THEN ' - ' ELSE p_brand END AS part_number,
CASE WHEN p_partkey % 7 = 0 THEN ' ' ELSE p_name END AS part_name, 'c' AS code, 'b' AS brand, 'm' AS model, 'v' AS vehicle_name, 'vc' AS vehicle_code, 'vid' AS vehicle_vid, 'cid' AS category_cid, 'cn' AS category_name, 'gn' AS group_name, 'gc' AS group_code, CAST(p_size AS STRING) AS group_uid,
'https://a.b/u?uid=' || CAST(p_size + CASE WHEN p_partkey % 11 = 0 THEN 1 ELSE 0 END AS STRING) AS source_url, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN '2005-01' ELSE '2010-01' END AS production_from, CASE WHEN p_size > 5 THEN '2012-01' END AS production_to,
CASE WHEN p_size > 5 THEN '2011-01' END AS part_from, CASE WHEN p_size > 45 THEN '2009-01' END AS part_to, CAST(9 AS BIGINT) AS seen_run_id FROM {part}"""


@query(
    "q3_snapshot_release",
    rf"""WITH s AS ({_SNAPSHOT.replace('{part}', 'part')}) SELECT part_id, CASE WHEN group_id IS NULL OR brand_id IS NULL OR trim(part_number) = '' OR regexp_replace(part_number, '[\s-]+', '', 'g') = '' OR trim(part_name) = '' OR NOT ends_with(source_url, 'uid=' || group_uid) OR (production_from IS NULL AND production_to IS NULL AND part_from IS NULL AND part_to IS NULL)
OR coalesce(part_to < production_from, false) OR coalesce(production_to < part_from, false) THEN NULL ELSE seen_run_id END AS seen_run_id FROM s""",
)
def q3_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Rows that break a rule of the snapshot leave the run."""
    rows = spark.sql(_SNAPSHOT, part=table(spark, d, "part"))
    return rules.released(rows, rules.snapshot_rules(r"https://a\.b/u\?uid=\d+"), "seen_run_id").select("part_id", "seen_run_id")


@query(
    "a15_completion",
    "WITH q AS (SELECT CASE WHEN o_orderstatus = 'O' THEN 'pending' WHEN o_orderstatus = 'P' THEN 'done' ELSE 'failed' END AS s FROM orders) SELECT (SELECT count(*) FROM q WHERE s = 'pending') = 0 AS queue_exhausted, (SELECT count(*) FROM q WHERE s = 'failed') = 0 AS no_failed_pages, (SELECT count(*) FROM pages WHERE contains(lower(html), 'just a moment')) = 0 AS no_challenges, true AS no_robots_skips, true AS no_parse_failures, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) = 0 AS provenance_complete, (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) = 0 AS foreign_keys_valid, false AS strict_complete",
)
def a15(spark: SparkSession, d: str) -> DataFrame:
    """The seven checks of a run that claims to be complete."""
    orders, line = table(spark, d, "orders"), table(spark, d, "lineitem")
    queue = orders.select(F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "done").otherwise("failed").alias("status"))
    responses = table(spark, d, "pages").select(F.contains(F.lower("html"), F.lit("just a moment")).alias("challenged"))
    named = lambda df, c: df.select(F.lit("order").alias("record_type"), F.col(c).alias("record_id"))
    broken = gates.orphans(line.select("l_partkey"), table(spark, d, "part").select("p_partkey"), {"l_partkey": "p_partkey"})
    return rules.completion_checks(queue, responses, named(orders, "o_orderkey"), named(line, "l_orderkey"), broken)


@query("e2_categories", f"WITH {FLAT_SQL} SELECT vehicle_id, group_code AS category, min(month) AS first_month, max(month) AS last_month, count(DISTINCT part_id) AS part_numbers, min(vehicle) AS vehicle FROM flat GROUP BY 1, 2")
def e2_categories(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot's categories."""
    return flat_catalog(spark, d).groupBy("vehicle_id", F.col("group_code").alias("category")).agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.countDistinct("part_id").alias("part_numbers"), F.min("vehicle").alias("vehicle"))


@query("e2_part_numbers", f"WITH {FLAT_SQL} SELECT part_number, min(part_name) AS part_name, count(DISTINCT vehicle_id) AS vehicles, count(DISTINCT brand) AS brands, count(*) AS occurrences FROM flat GROUP BY 1")
def e2_part_numbers(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot's part numbers."""
    return flat_catalog(spark, d).groupBy("part_number").agg(F.min("part_name").alias("part_name"), F.countDistinct("vehicle_id").alias("vehicles"), F.countDistinct("brand").alias("brands"), F.count("*").alias("occurrences"))


@query("e2_occurrences", f"WITH {FLAT_SQL} SELECT order_id, line, part_number, vehicle_id, min(month) AS effective_from, max(month) AS effective_to, 'verified_current_catalog' AS derivation FROM flat GROUP BY 1, 2, 3, 4")
def e2_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot's occurrences with their windows and verdicts."""
    rows = flat_catalog(spark, d).groupBy("order_id", "line", "part_number", "vehicle_id").agg(F.min("month").alias("effective_from"), F.max("month").alias("effective_to"))
    return rows.withColumn("derivation", records.fitment_verdict(F.col("effective_from"), F.col("effective_to"), F.lit(True))["derivation"])


@query(
    "e13_entities",
    "SELECT 'part' AS entity, (SELECT count(*) FROM part) AS source, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS manual, (SELECT count(*) FROM part WHERE p_size % 5 = 0) AS overridden, (SELECT count(*) FROM part WHERE p_size % 5 = 1) AS retired UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), 0, (SELECT count(*) FROM supplier WHERE s_suppkey % 3 = 0), 0",
)
def e13_entities(spark: SparkSession, d: str) -> DataFrame:
    """Source, manual, overridden and retired rows of each kind of entity."""
    part, supplier = table(spark, d, "part"), table(spark, d, "supplier")
    heads = part.filter("p_size % 5 < 2").select(F.lit("part").alias("entity"), F.col("p_partkey").alias("key"), F.when(F.col("p_size") % 5 == 0, "active").otherwise("retired").alias("status"))
    heads = heads.unionByName(supplier.filter("s_suppkey % 3 = 0").select(F.lit("supplier").alias("entity"), F.col("s_suppkey").alias("key"), F.lit("active").alias("status")))
    source = part.select(F.lit("part").alias("entity")).unionByName(supplier.select(F.lit("supplier").alias("entity")))
    return overlay.entity_counts(source, table(spark, d, "customer").filter("c_acctbal < 0").select(F.lit("part").alias("entity")), heads)


@query(
    "m17_captures",
    "SELECT doc_id, sha256(text) AS body_sha256, doc_id = min(doc_id) OVER (PARTITION BY text) AND NOT EXISTS (SELECT 1 FROM documents o WHERE o.doc_id % 10 = 0 AND o.text = d.text) AS stores_body, CASE WHEN doc_id % 2 = 0 THEN '[REDACTED]' ELSE 'v' END AS cookie FROM documents d WHERE doc_id % 10 <> 0",
)
def m17(spark: SparkSession, d: str) -> DataFrame:
    """Captures recorded against stored bodies: which bring a new body, and headers without secrets."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("body_sha256"))
    name = F.when(F.col("doc_id") % 2 == 0, "Set-Cookie").otherwise("X-Other")
    captures = docs.filter("doc_id % 10 <> 0").withColumn("headers", F.create_map(name, F.lit("v")))
    made = evidence.record_captures(captures, docs.filter("doc_id % 10 = 0").select("body_sha256").distinct(), "doc_id")
    return made.select("doc_id", "body_sha256", "stores_body", F.map_values("headers")[0].alias("cookie"))
