import pytest
from pyspark.sql import functions as F

from cogwright.functions import dates, records, text, urls
from cogwright.sources.pages import parse_vehicle_name


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("2006-05 ～ 2011-12", ("2006-05", "2011-12", "month", 1.0)),
        ("01.2015 - 03.2018", ("2015-01", "2018-03", "month", 1.0)),
        ("01.2018 -", ("2018-01", None, "month", 1.0)),
        ("2010 - 2015", ("2010-01", "2015-12", "year", 1.0)),
        ("2010 -", ("2010-01", None, "year", 1.0)),
        ("- 2015", (None, "2015-12", "year", 1.0)),
        ("- 03.2018", (None, "2018-03", "month", 1.0)),
        ("2018", ("2018-01", "2018-12", "year", 1.0)),
        ("2010-13", (None, None, "unknown", 0.0)),
        ("2020-01 ～ 2021-99", (None, None, "unknown", 0.0)),
        ("2006-05-31—2011-12-01", ("2006-05", "2011-12", "month", 1.0)),
        ("2006-05-2011-12", (None, None, "unknown", 0.0)),
        ("0605-", (None, None, "unknown", 0.0)),
        ("12.2020 - 01.2018", (None, None, "unknown", 0.0)),
        (None, (None, None, "unknown", 0.0)),
    ],
)
def test_ranges(spark, raw, want):
    r = one(spark, raw, dates.parse_range("x"))
    assert (r["start"], r["end"], r["precision"], r["confidence"]) == want


def test_identifiers(spark):
    assert one(spark, " 12-34 a\tb ", text.part_key("x")) == "1234AB"
    assert one(spark, "Ab-1 é", text.alnum_key("x")) == "AB1"
    assert one(spark, " \t ", text.clean_text("x")) is None
    assert one(spark, "a  b", text.clean_text("x")) == "a b"
    assert one(spark, "1HGCM82633A004352", text.is_vin("x")) is True
    assert one(spark, "1HGCM82633A00435O", text.is_vin("x")) is False
    assert one(spark, "1HGCM82633A004352", text.mask_vin("x")) == "1HG**********4352"
    assert one(spark, "1, 11 ,x-bad", text.error_codes("x")) == [1, 11]
    assert one(spark, "a > b", text.split_path("x")).asDict() == {"main": "a", "middle": "b", "small": None}
    assert one(spark, "FRONT SUB-ASSY", text.assembly_flag("x")).asDict() == {"flag": True, "reason": "name_keyword"}
    assert one(spark, " #Part No. ", text.header_key("x")) == "PART_NO"
    assert one(spark, "\x80\x81", text.cp1252_from_latin1("x")) == "€\x81"
    assert one(spark, "=1", text.csv_safe("x")) == "'=1"
    assert one(spark, 7, text.category_name("x", {1: "ENGINE"}), "int") == "CATEGORY 7"


def test_urls(spark):
    assert one(spark, "HTTP://Ex.com:80#a", urls.normalize_url("x")) == "http://ex.com/"
    assert one(spark, "https://a.b/c?x=1&vin=2", urls.redact_url("x", ["vin"])) == "https://a.b/c?x=1&vin=[REDACTED]"
    assert one(spark, "https://a.b/c?x=%41b#z", urls.query_param("x", "x")) == "Ab"
    p = one(spark, "https://a.b/en/c?z=1&b=2&a=3", urls.public_url("x", ["a.b"], "^/en/", ["a", "b"]))
    assert (p["value"], p["error"]) == ("https://a.b/en/c?a=3&b=2", None)
    assert one(spark, "http://a.b/en", urls.public_url("x", ["a.b"], "^/en", []))["error"] == "scheme"
    assert one(spark, "https://a.b/x/y", urls.in_scope("x", F.lit("https://A.b/x/"))) is True
    assert one(spark, "https://a.b/xy", urls.in_scope("x", F.lit("https://a.b/x"))) is False
    assert one(spark, "https://a.b/p/", urls.resolve_links("x", F.array(F.lit("../q"), F.lit("#a"), F.lit("mailto:x"), F.lit("../q")))) == ["https://a.b/q"]
    assert one(spark, "https://a.b/u?uid=5", urls.canonical_unit_url("x", F.lit(5), r"https://a\.b/u\?uid=\d+")) is True


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("TOYOTA COROLLA ALTIS 1800 4D 自排", ("TOYOTA", "COROLLA ALTIS", 1800, None, "AT", 4, None)),
        ("LUXGEN S5 1800 4D Turbo", ("LUXGEN", "S5", 1800, None, None, 4, "Turbo")),
        ("Land Rover  Discovery 2000㏄ 自動手排 休旅 5-D", ("LAND ROVER", "Discovery 休旅", 2000, "SUV", "AMT", 5, None)),
        ("Benz 300 500 8000 2500 2000 手排 CVT 油電", ("MERCEDES-BENZ", "300 500 8000 2000", 2500, None, "MT", None, "Hybrid")),
        ("Unknown", ("Unknown", "", None, None, None, None, None)),
        ("  ", ("", "", None, None, None, None, None)),
    ],
)
def test_vehicle_names(spark, name, want):
    assert tuple(one(spark, name, parse_vehicle_name(F.col("x")))) == want


def test_records(spark):
    row = spark.createDataFrame([('{"a":"1","b":"2"}', '{"b":null,"c":"3"}')], "s string, o string").select(records.overlay(records.json_fields("s"), records.json_fields("o")).alias("m")).first()["m"]
    assert row == {"a": "1", "b": None, "c": "3"}
    assert one(spark, " ", records.natural_key(["x"])) is None
    assert one(spark, "ss%2564%253Dabc", records.has_secret("x")) is True and one(spark, "ssd=__REDACTED_2__&a", records.has_secret("x")) is False
    assert one(spark, "7 - not found", records.undecodable_kind("x", F.lit(""), F.lit(None))) == "nhtsa_unregistered"
    assert one(spark, "1,400 - bad", records.undecodable_kind("x", F.lit(""), F.lit(""))) == "invalid_vin"
    a = one(spark, "ab", records.length_prefixed([F.lit("a"), F.lit("bc")]))
    assert a == "1:a2:bc"


def test_redact_url_fragment(spark, sf_dir):
    import duckdb

    for url, want in {"http://a.b/c?x=1&ref=a#f?ref=b": "http://a.b/c?x=1&ref=[REDACTED]#f?ref=b", "http://a.b/c#f?ref=b": "http://a.b/c#f?ref=b", "http://a.b/?ref=a#": "http://a.b/?ref=[REDACTED]#"}.items():
        assert one(spark, url, urls.redact_url("x", ["ref"])) == want
    # Every page, those with fragments too.
    got = {tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", urls.redact_url("url", ["ref", "page"])).collect()}
    sql = rf"SELECT page_id, regexp_replace(regexp_replace(url, '([?&]ref=)[^&#]*', '\1[REDACTED]', 'g'), '([?&]page=)[^&#]*', '\1[REDACTED]', 'g') FROM '{sf_dir}/pages.parquet'"
    assert got == set(duckdb.sql(sql).fetchall())
