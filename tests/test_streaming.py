from cogwright.streaming import discovery, jobs


def test_insert_new_and_counters(spark, tmp_path):
    rows = spark.createDataFrame([(1, "http://A.b"), (1, "http://a.b/"), (2, "http://a.b/")], "run_id long, status string")
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        jobs.stream_insert_new(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), "run_id long, status string", ["run_id", "status"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    jobs.stream_counters(spark, str(tmp_path / "in"), str(tmp_path / "counted"), str(tmp_path / "cp2")).awaitTermination()
    rows.limit(1).write.mode("append").parquet(str(tmp_path / "in"))
    jobs.stream_counters(spark, str(tmp_path / "in"), str(tmp_path / "counted"), str(tmp_path / "cp2")).awaitTermination()
    assert sorted(r["count"] for r in jobs.counters(spark, str(tmp_path / "counted")).collect()) == [1, 1, 2]


def test_discovered_once_a_run(spark, tmp_path):
    """Rows of earlier days and repeated ones, in several drops: each URL comes out once a run, none is lost, until the run ends."""
    made = [
        [(1, "http://A.b", "p", "html", "2024-01-10"), (1, "http://a.b/", "q", "html", "2024-01-10"), (1, "x", None, "html", "2024-01-10"), (2, "http://a.b/", None, "html", "2024-01-20")],
        [(1, "http://a.b/new", "p", "html", "2024-01-12"), (1, "http://a.b/", "p", "html", "2024-01-21"), (1, "http://a.b/", "p", "sitemap", "2024-01-21")],
        [(1, "http://a.b/after", None, "html", "2024-01-01"), (2, "http://a.b/late", None, None, "2023-01-01")],
    ]
    ends = [[], [(1, "2024-02-01")], []]
    for drop, over in zip(made, ends, strict=True):
        spark.createDataFrame(drop, "run_id long, url string, parent string, method string, s string").selectExpr("run_id", "url", "parent", "method", "timestamp(s) seen_at").write.mode("append").parquet(str(tmp_path / "d"))
        spark.createDataFrame(over, "run_id long, s string").selectExpr("run_id", "timestamp(s) ended_at").write.mode("append").parquet(str(tmp_path / "e"))
        discovery.stream_discovered(spark, str(tmp_path / "d"), str(tmp_path / "o"), str(tmp_path / "c"), str(tmp_path / "e")).awaitTermination()
    rows = spark.read.schema(discovery.FOUND).parquet(str(tmp_path / "o")).collect()
    assert sorted((r.run_id, r.url) for r in rows if r.kind == "url") == [(1, "http://a.b/"), (1, "http://a.b/new"), (2, "http://a.b/"), (2, "http://a.b/late")]
    assert sorted((r.run_id, r.parent or "", r.url, r.method or "") for r in rows if r.kind == "edge") == sorted(
        [(1, "p", "http://a.b/", "html"), (1, "q", "http://a.b/", "html"), (1, "p", "http://a.b/new", "html"), (1, "p", "http://a.b/", "sitemap"), (2, "", "http://a.b/", "html"), (2, "", "http://a.b/late", "")]
    )
    assert [(r.run_id, r.url) for r in rows if r.kind == "late"] == [(1, "http://a.b/after")]


def test_late_captures(spark, tmp_path):
    spark.sql("select 1L job_id, 'u' url, timestamp '2024-01-01 00:04:00' + make_interval(0,0,0,0,0,m) fetched_at from values (0), (9) t(m)").write.parquet(str(tmp_path / "l"))
    jobs_table = spark.sql("select 1L job_id, timestamp '2024-01-01' started_at, timestamp '2024-01-01 00:01:00' finished_at")
    jobs.stream_late_captures(spark, str(tmp_path / "l"), jobs_table, str(tmp_path / "lo"), str(tmp_path / "lc")).awaitTermination()
    assert sorted(r.accepted for r in spark.read.parquet(str(tmp_path / "lo")).collect()) == [False, True]
