import gzip

import pytest
from pyspark.sql import functions as F

from cogwright.operators import gates, merge, overlay, paging, publish, vin
from cogwright.sources import bulk, documents, pages, warc


def test_merge_twice_inserts_nothing(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (None, "n")], "k int, v string")
    once = merge.merge(old, new, ["k"])
    assert {(r.k, r.v, r._change) for r in once.collect()} == {(1, "b", "updated"), (2, "c", "inserted"), (None, "n", "same")}
    twice = merge.merge(once.drop("_change"), new, ["k"])
    assert {r._change for r in twice.collect()} == {"same"}
    assert merge.insert_new(old, new, ["k"]).count() == 1


def test_requests(spark):
    heads = spark.createDataFrame([("a", 2, "{}", "active")], "k string, revision int, payload string, status string")
    asked = spark.createDataFrame([("a", 1, 2, "set", "{1}"), ("a", 2, 2, "set", "{2}"), ("b", 3, 0, "set", "{3}"), ("c", 4, 9, "retire", None)], "k string, request_id int, expected_revision int, action string, payload string")
    h, e, c = merge.apply_requests(heads, asked, ["k"])
    assert {(r.k, r.revision, r.payload) for r in h.collect()} == {("a", 3, "{1}"), ("b", 1, "{3}")}
    assert e.count() == 2 and {r.request_id for r in c.collect()} == {2, 4}


def test_gates(spark, tmp_path):
    df = spark.range(10).toDF("id")
    assert [(r.rule, r.n_bad, r.sample_key) for r in gates.check(df, {"big": F.col("id") > 7, "none": F.col("id") < 0}, "id").collect()] == [("big", 2, "8"), ("none", 0, None)]
    with pytest.raises(gates.GateError):
        publish.publish(df, str(tmp_path / "s"), 1, {"big": F.col("id") > 7}, "id")
    assert publish.current(spark, str(tmp_path / "s"), "id long").count() == 0
    assert publish.publish(df, str(tmp_path / "s"), 1, {"bad": F.col("id") < 0}, "id") == 10
    assert publish.current(spark, str(tmp_path / "s"), "id long").count() == 10
    assert gates.gated(df, spark.createDataFrame([(False,), (True,)], "ok boolean")).count() == 0
    shuffled = df.repartition(7).orderBy(F.desc("id"))
    assert gates.dataset_digest(df, ["id"]).first() == gates.dataset_digest(shuffled, ["id"]).first()
    known = spark.createDataFrame([("u", "A"), ("u", "B"), ("w", "C")], "uid string, code string")
    parsed = spark.createDataFrame([("u", "A"), ("w", "")], "uid string, code string")
    assert {(r.uid, r.missing, tuple(r.missing_codes), r.downgraded) for r in gates.identity_closure(known, parsed, "uid", "code").collect()} == {("u", False, ("B",), False), ("w", False, ("C",), True)}


def test_group_upgrade(spark):
    old = spark.createDataFrame([(1, "u", ""), (1, "w", "")], "category int, uid string, code string")
    new = spark.createDataFrame([(1, "u", "X")], "category int, uid string, code string")
    assert {tuple(r) for r in merge.upgrade_groups(old, new, "category", "uid", "code").collect()} == {(1, "u", "X"), (1, "w", "")}


def test_vin(spark):
    decodes = spark.createDataFrame([("V", "Toyota", "Corolla", "2ZR", "LE", 2010), ("W", "Toyota", "Corolla", None, None, 2010)], "vin string, make string, model string, engine string, trim string, model_year int")
    catalog = spark.createDataFrame([(1, "TOYOTA", "COROLLA", "2-ZR", "L E", "2009-01", None), (2, "TOYOTA", "COROLLA", "1NZ", "LE", None, "2009-12")], "vehicle_id int, make string, model string, engine string, trim string, production_from string, production_to string")
    best = vin.best_candidates(vin.candidates(decodes, catalog))
    assert {(r.vin, r.vehicle_id, r.status) for r in best.collect()} == {("V", 1, "exact"), ("W", 1, "review")}


def test_overlay_and_pages(spark):
    items, meta = paging.page(spark.range(25).toDF("id"), ["id"], 9, 10)
    assert [r.id for r in items.collect()] == [20, 21, 22, 23, 24] and meta.first()["page"] == 3
    source = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    heads = spark.createDataFrame([(1, '{"v":"z"}', "active"), (2, "{}", "retired")], "k int, payload string, status string")
    assert [tuple(r) for r in overlay.effective(source, heads, "k", ["v"]).collect()] == [(1, "z", True)]


def test_bulk(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("1\txé\n\n2\n\t \n3\ty\n".encode("latin-1"))
    spec = bulk.DatasetSpec("t", ("id", "v"), ("id",))
    records, rejects = bulk.read_dataset(spark, str(tmp_path / "a.txt"), spec)
    assert {(r.id, r.v, r.line) for r in records.collect()} == {("1", "xé", 1), ("3", "y", 5)}
    assert {(r.line, r.error_type) for r in rejects.collect()} == {(3, "field_count")}
    assert bulk.header_names(["Make Name", "Model"]) == ["MAKE_NAME", "MODEL"]


def test_documents(spark):
    texts = spark.createDataFrame([("a", '{"Count":2,"Results":[{"id":"1"},{"id":""}]}'), ("b", '{"Count":3,"Results":[]}')], "source string, value string")
    good, bad = documents.json_documents(texts, ["id"], {"vin": "X"})
    assert [r.payload for r in good.collect()] == [{"id": "1", "vin": "X"}]
    assert {(r.source, r.error) for r in bad.collect()} == {("a", "missing_field"), ("b", "count_mismatch")}
    maps = spark.createDataFrame([("s", "<urlset xmlns='u:x'><url><loc> http://a/b </loc></url></urlset>")], "source string, value string")
    assert [tuple(r) for r in documents.sitemap_urls(maps).collect()] == [("s", "page", "http://a/b")]


def test_warc(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nETag: x\r\n\r\nhello"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert [(r.position, r.kind, r.url, r.status, r.headers["etag"], bytes(r.body)) for r in rows] == [(i, "response", "http://a/", 200, "x", b"hello") for i in (0, 1)]


def test_pages(spark):
    html = "<ol class='breadcrumb'><li>A</li><li>B</li></ol><table><tr><th>Number</th><th>Name</th><th>Unified</th></tr><tr><td>1-2</td><td>bolt</td><td></td></tr><tr><td>12</td><td>bolt 2</td><td></td></tr><tr><td>9</td><td></td><td></td></tr></table><dl><dt>Engine:</dt><dd>2ZR</dd></dl>"
    parsed = pages.parse_pages(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).cache()
    parts, rejects = pages.extract_parts(parsed)
    assert [(r.part_number, r.name) for r in parts.collect()] == [("12", "bolt 2")]
    assert [r.error for r in rejects.collect()] == ["nameless"]
    assert {(r.depth, r.path, r.parent_path) for r in pages.taxonomy(parsed).collect()} == {(0, "A", None), (1, "A > B", "A")}
    assert parsed.filter("page_id = 1").select(pages.adapt_vehicle(F.col("metadata"), {"engine": ["Motor", "Engine"]}).alias("v")).first()["v"]["engine"] == "2ZR"
    names = spark.createDataFrame([("TOYOTA COROLLA ALTIS 1800 4D 自排",), ("HONDA FIT 1500 5D CVT",), (None,)], "n string").select(pages.parse_vehicle_name(F.col("n")).alias("v")).collect()
    assert tuple(names[0]["v"]) == ("TOYOTA", "COROLLA ALTIS", 1800, None, "AT", 4, None)
    assert tuple(names[1]["v"]) == ("HONDA", "FIT", 1500, None, "CVT", 5, None)
    assert names[2]["v"]["brand"] == ""


def test_dataset_layouts(spark, tmp_path):
    from cogwright.sources.datasets import DATASETS, members

    assert len(DATASETS) == 14 and len(DATASETS["recalls"].fields) == 29 and len(members("complaints")) == 7
    (tmp_path / "a.csv").write_text("Make,Model,Model-Yr,Body Style\nToyota,\"A, b\",2010,x\nToyota,,2011,y\n")
    spec = bulk.DatasetSpec("t", (), ("MAKE", "MODEL_YR"), delimiter=",", header=True, quote='"', required=("MAKE", "MODEL"), roles={"make": "MAKE", "model": "MODEL", "model_year": "MODEL_YR"})
    records, rejects = bulk.read_dataset(spark, str(tmp_path / "a.csv"), spec)
    row = bulk.normalised(records, spec).first()
    assert (row.make_name, row.model_name, row.model_year, row.source_line) == ("Toyota", "A, b", 2010, 2)
    assert [r.error_type for r in rejects.collect()] == ["missing_field"]


def test_page_links(spark):
    html = """<a href="/toyota">Toyota</a><a href="/toyota/">Toyota</a><a href="/honda"><img></a><a href="/toyota/corolla">Corolla</a><a href="/honda/fit">Fit</a>
      <a href="/c?cid=1">Engine</a><a href="/c?cid=1">Motor</a><a href="/u?cid=1&uid=7"><img></a><a href="/u?cid=1&uid=7">A1: Block</a><a href="/u?cid=1&uid=8" data-fits="X"><img></a>"""
    parsed = pages.parse_pages(spark.createDataFrame([(1, html)], "page_id long, html string")).cache()
    assert [r.value for r in pages.extract_hints(parsed, "fits").collect()] == ["X"]
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, record_sha256 string")
    b = spark.createDataFrame([(1, "x"), (2, "z")], "k int, record_sha256 string")
    assert {(r.k, r.record_sha256, r.side) for r in pages.replay_diff(a, b, ["k"]).collect()} == {(2, "y", "missing"), (2, "z", "unexpected")}
    assert pages.replay_diff(a, a, ["k"]).count() == 0


def test_export(spark, tmp_path):
    from cogwright.operators import export

    fitments = spark.createDataFrame([(1, 5, True), (2, 5, False)], "occurrence_id int, vehicle_id int, is_verified boolean")
    occurrences = spark.createDataFrame([(1, "=A1", "bolt", "a > b > c"), (2, "B", "nut", "a")], "occurrence_id int, part_number string, part_name string, category_path string")
    vehicles = spark.createDataFrame([(5, "Toyota", "Corolla")], "vehicle_id int, brand string, model string")
    hints = spark.createDataFrame([(2, "fits some")], "occurrence_id int, hint string")
    out = export.export(fitments, occurrences, vehicles, hints)
    assert {(r.occurrence_id, r.category_small, r.hint) for r in out.collect()} == {(1, "c", None), (2, None, "fits some")}
    assert export.export(fitments, occurrences, vehicles, unverified=True).count() == 2
    export.write_csv(out, str(tmp_path / "csv"))
    assert "'=A1" in {r.part_number for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()}
    export.write_jsonl(out, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_vehicle_tables(spark):
    v = "/en/catalog/genuine/vehicle"
    html = f"""<a href="{v}?c=TOY&ssd=z&vid=9">lost</a><a href="{v}?c=HON&ssd=q">foreign</a><table><tr><th>Brand</th><th>Code</th></tr><tr><td><a href="{v}?c=TOY&ssd=a&vid=1">x</a></td><td>y</td></tr></table>
      <table><tr><th class="x n_name">N</th><th class="__model">M</th><th class="v__modelyearfrom">F</th><th>Gearbox</th><th class="__ENGINE">E</th></tr>
      <tr><td><a href="https://h.x{v}?c=TOY&ssd=a&vid=1">Corolla</a></td><td>E12</td><td>2001</td><td>MT</td><td>2ZR</td></tr>
      <tr><td><a href="{v}?ssd=b&vid=2">Corolla</a></td><td>E12</td><td>2001</td><td>MT</td><td>2ZR</td></tr>
      <tr><td><a href="{v}?c=TOY&ssd=a&vid=1">Corolla</a></td><td>E13</td><td></td><td>AT</td><td></td></tr>
      <tr><td><a href="{v}?c=HON&ssd=q">Fit</a></td><td>G</td><td></td><td></td><td></td></tr><tr><td>no link</td><td>G</td></tr></table>"""
    shell = "<table><tr><th>Number</th><th>Name</th><th>Code</th></tr></table>"
    full = "<table><tr><th>Number</th><th>Name</th><th>Code</th></tr><tr><td>1</td><td>a</td><td>b</td></tr></table>"
    parsed = pages.parse_pages(spark.createDataFrame([(1, html), (2, shell), (3, full + shell), (4, None)], "page_id long, html string")).cache()
    vehicles, malformed = pages.extract_vehicles(parsed, spark.createDataFrame([(1, "TOY")], "page_id long, brand string"))
    assert sorted((r.name, r.model_code, r.prod_period, r.production_from, r.production_to, r.transmission, r.engine, r.vid) for r in vehicles.collect()) == [
        ("Corolla", "E12", "2001 -", "2001-01", None, "MT", "2ZR", "1"), ("Corolla", "E13", "", None, None, "AT", "", "1"),
    ]
    assert [tuple(r) for r in malformed.collect()] == [(1, 2)]
    assert {r.page_id: r.empty for r in pages.empty_parts_table(parsed).collect()} == {1: False, 2: True, 3: False, 4: False}


def test_current_catalog_fails_closed(spark, sf_dir):
    from cogwright.operators import evidence
    from cogwright.plans import evidence as fixtures

    t = {k: v.cache() for k, v in fixtures._tables(spark, sf_dir).items()}
    bodies = t["artifacts"].select("body_sha256", F.lit(100).alias("original_bytes"), F.lit(40).alias("stored_bytes")).cache()
    target = t["parts"].count()
    run = fixtures._run(spark, target, evidence.evidence_totals(t["artifacts"], fixtures._run(spark, target), t["jobs"], bodies)).cache()
    scope = spark.sql("SELECT 'B' AS scope_brand, 'M' AS scope_model, 2000 AS scope_vehicle_year_floor")
    inputs = {"bounded": t["parts"], "full": t["parts"].limit(0), "runs": run, "jobs": t["jobs"], "scope": scope, "artifacts": t["artifacts"], "bodies": bodies, "records": t["records"], "receipts": t["receipts"], "target": target}
    shown = lambda **change: {r.dataset_scope: r.n for r in evidence.current_catalog(**(inputs | change)).groupBy("dataset_scope").agg(F.count("*").alias("n")).collect()}
    assert shown() == {"bounded": target}
    one = t["artifacts"].filter("accepted_record_count > 0").orderBy("artifact_id").first().artifact_id
    assert shown(scope=scope.withColumn("scope_brand", F.lit("b"))) == {}
    assert shown(runs=run.withColumn("error_msg", F.lit("x"))) == {}
    assert shown(jobs=t["jobs"].withColumn("exit_code", F.lit(1))) == {}
    assert shown(receipts=t["receipts"].filter(F.col("group_id") != one)) == {}
    assert shown(artifacts=t["artifacts"].filter("page_type <> 'page1'")) == {}
    assert shown(bounded=t["parts"].withColumn("evidence_record_sha256", F.when(F.col("group_id") == one, "x").otherwise(F.col("evidence_record_sha256")))) == {}
    full_run = run.withColumns({"run_id": F.lit(2).cast("long"), "run_job_id": F.lit(3), "dataset_kind": F.lit("full"), "status": F.lit("success"), "target_parts": F.lit(None).cast("int")})
    jobs = t["jobs"].unionByName(t["jobs"].filter("job_id = 1").withColumn("job_id", F.lit(3)))
    full = t["parts"].filter(F.col("group_id") == one).withColumn("run_id", F.lit(2).cast("long"))
    assert shown(full=full, runs=run.unionByName(full_run), jobs=jobs) == {"full": full.count()}
    assert shown(full=full.unionByName(t["parts"].limit(1)), runs=run.unionByName(full_run), jobs=jobs) == {"bounded": target}


def test_publish_again(spark, tmp_path):
    root, df = str(tmp_path / "s"), spark.range(10).withColumn("run_id", F.lit(1).cast("long")).withColumns({"brand": F.lit(" Toyota"), "model": F.lit("x"), "production_to": F.lit("2010-05")})
    schema = df.schema.simpleString()[7:-1].replace(":", " ")
    with pytest.raises(gates.GateError):
        publish.publish(df, root, 1, {}, "id", expected_rows=11)
    assert publish.current(spark, root, schema).count() == 0
    assert publish.publish(df, root, 1, {}, "id", expected_rows=10) == 10 == publish.publish(df, root, 1, {}, "id")
    with pytest.raises(gates.GateError):
        publish.publish(df.limit(3), root, 1, {}, "id")
    with pytest.raises(gates.GateError):
        publish.publish_full(df, root, 2, {}, "id", 10, True)
    second = df.withColumn("run_id", F.lit(2).cast("long"))
    assert publish.publish_full(second, root, 2, {}, "id", 10, False) == 10 and publish.current_run(spark, root) == 2
    scope = ("TOYOTA ", "X", 2010)
    for bad in ((scope, ("TOYOTA", "X", 2010), 10), (("TOYOTA ", "X", 2011), ("TOYOTA ", "X", 2011), 10), (scope, scope, 9)):
        with pytest.raises(gates.GateError):
            publish.publish_bounded(second, root, 3, {}, "id", bad[2], bad[0], bad[1])
    assert publish.publish_bounded(second, root, 3, {}, "id", 10, scope, scope) == 10
    assert publish.current(spark, root, schema, 1).count() == 10


def test_quoted_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text('Make,Model,Note\nT,"a, b","two\n\nlines ""x"""\nU,c,\nV,d\n')
    (tmp_path / "d" / "b.csv").write_text('\ufeffModel,Make\nm,W\n')
    spec = bulk.DatasetSpec("t", (), ("MAKE", "MODEL"), delimiter=",", header=True, quote='"', required=("MAKE", "MODEL"))
    records, rejects = bulk.read_dataset(spark, str(tmp_path / "d"), spec)
    assert sorted((r.MAKE, r.MODEL, r.NOTE, r.line) for r in records.collect()) == [("T", "a, b", 'two\n\nlines "x"', 4), ("U", "c", "", 5), ("W", "m", None, 2)]
    assert [(r.line, r.error_type) for r in rejects.collect()] == [(6, "field_count")]
    (tmp_path / "d" / "c.csv").write_text("Make\nx\n")
    with pytest.raises(ValueError):
        bulk.read_dataset(spark, str(tmp_path / "d"), spec)


def test_running_sum(spark):
    df = spark.range(1000).selectExpr("id * id as k", "id as v")
    got = {r.k: r.s for r in paging.running_sum(df, "k", "v", "s", 7).collect()}
    assert got == {i * i: i * (i + 1) // 2 for i in range(1000)} and paging.running_sum(df.limit(0), "k", "v", "s").count() == 0


def test_unit_parts(spark):
    a = lambda q, shown=None: f'<td><a href="/en/search/all?q={q}">{shown or q}</a></td>'
    row = lambda *cells: "<tr>" + "".join(c if c.startswith("<td") else f"<td>{c}</td>" for c in cells) + "</tr>"
    head = lambda *names: "<tr>" + "".join(f"<th>{n}</th>" for n in names) + "</tr>"
    six = "<table>" + head("Number", "Name", "Code", "Quantity", "Unified", "Note") + row(a("A1"), "bolt", "c", "2", "u 1", "n") + row(a("A1"), "bolt 2", "c", "2", "", "n") + row(a("A2"), "", "c", "1", "", "") + row(a("A3"), "", "c", "1", "", "") + "</table>"
    seven = "<table>" + head("Part Number", "Part-Name", "Code", "QTY Required", "Filter Note", "Specification", "Prod. Period") + row(a("B1"), "nut", "k", "1", "", "2010 - 2012", "01.2010 - ") + row(a("B2", "B3"), "nut", "k", "1", "", "", "") + row(a("B4"), "x") + "</table>"
    minimal = "<table>" + head("Number", "Name", "Code") + row(a("C1"), "", "C1") + row(a("C2"), "", "") + "</table>"
    plain = "<table>" + row(a("D1"), "cap", "k", "only", "3", "2011") + row(a("D2"), "cap", "k") + row("no link", "x") + "</table>"
    parsed = pages.parse_pages(spark.createDataFrame([(1, six), (2, seven), (3, minimal), (4, plain)], "page_id long, html string"))
    parts, rejects = pages.extract_unit_parts(parsed)
    got = sorted(tuple(r) for r in parts.select("page_id", "part_number", "name", "code", "quantity", "range", "note", "part_from", "part_to").collect())
    assert got == [
        (1, "A1", "bolt 2", "c", "2", "", "Note: n", None, None),
        (2, "B1", "nut", "k", "1", "01.2010 -", "Specification: 2010 - 2012", "2010-01", None),
        (4, "D1", "cap", "k", "3", "2011", "only", "2011-01", "2011-12"),
    ]
    assert sorted((r.page_id, r.part_number, r.error) for r in rejects.collect()) == [
        (1, "A2", "nameless"), (1, "A3", "nameless"), (2, "B3", "malformed"), (2, "B4", "malformed"), (3, "C1", "nameless"), (3, "C2", "malformed"), (4, "D2", "malformed"),
    ]


def test_sitemap_files_and_members(spark, tmp_path):
    import gzip
    import zipfile

    from cogwright.functions.records import schema_fingerprint

    (tmp_path / "s").mkdir()
    index = "<sitemapindex xmlns='x'><sitemap><loc>http://a.b/2.xml</loc></sitemap></sitemapindex>"
    (tmp_path / "s" / "1.xml.gz").write_bytes(gzip.compress(index.encode()))
    (tmp_path / "s" / "2.xml").write_text("<urlset><url><loc> http://a.b/p </loc></url></urlset>")
    (tmp_path / "s" / "3.xml.gz").write_bytes(b"\x1f\x8bbroken")
    found = documents.read_sitemaps(spark, str(tmp_path / "s"))
    assert sorted((r.kind, r.url) for r in found.collect()) == [("page", "http://a.b/p"), ("sitemap", "http://a.b/2.xml")]
    texts = spark.createDataFrame([("http://a.b/2.xml", index.replace("2.xml", "3.xml")), ("http://a.b/3.xml", "<urlset><url><loc>http://a.b/q</loc></url></urlset>")], "source string, value string")
    assert sorted(r.url for r in documents.nested_sitemaps(found, texts).collect()) == ["http://a.b/p", "http://a.b/q"]
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        z.writestr("m.csv", "Make,Model-Yr\nx,1\n")
    spec = bulk.DatasetSpec("t", (), ("MAKE",), delimiter=",", header=True, quote='"')
    row = bulk.member_fields(bulk.archive_members(spark, str(tmp_path / "m.zip"), "m.csv"), spec).first()
    assert (row.fields, row.schema_sha256) == (["MAKE", "MODEL_YR"], schema_fingerprint(["MAKE", "MODEL_YR"]))
