"""Catalog links of pages, with what is malformed and what is passed over."""

from cogwright.sources import links
from cogwright.sources.pages import parse_pages

SITE = "catalog.example"
G = "/en/catalog/genuine/"


def parsed(spark, *htmls):
    return parse_pages(spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")).cache()


def one(rows):
    return sorted(tuple(r)[1:] for r in rows.collect())


def test_endpoints(spark):
    hrefs = {
        f"{G}pick?x": True, f"{G}pick/": True, f"https://{SITE}{G}pick": True, f"//{SITE}:443{G}pick#a": True, f"HTTP://u@{SITE.upper()}:80{G}pick": True, f"https://{SITE}:8080{G}pick": False, f"https://{SITE}:x{G}pick": False,
        f"https://other{G}pick": False, f"http:{G}pick": False, f"ftp://{SITE}{G}pick": False, f"/redirect?next={G}pick": False, f"{G}picks": False, "": False, f"mailto:{G}pick": False,
    }
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(h,) for h in hrefs], "h string").select("h", links.leads_to(F.col("h"), links.PICK, SITE).alias("ok")).collect()
    assert {r.h: r.ok for r in got} == hrefs


def test_brands(spark):
    page = f"""<ul><li><a href="{G}locate?c=AA">Aa</a><li><a href="https://{SITE}{G}locate?c=B%20B"><b>B</b> <i>b</i></a></ul><a href="{G}locate?c=CC">Outside</a>
      <ul><li><a href="{G}locate?c=AA2">Aa</a></li><li><a href="{G}locate?c=DD"><img></a></li><li><a href="{G}locate?c=DD"></a><a href="{G}locate?c=&amp;d=1">No code</a></li><li><a href="/other?c=1">x</a></li></ul>"""
    brands, diagnostics = links.extract_brands(parsed(spark, page, ""), SITE)
    assert one(brands) == [("Aa", f"{G}locate?c=AA"), ("Bb", f"https://{SITE}{G}locate?c=B%20B")]
    assert [tuple(r) for r in diagnostics.collect()] == [(0, 2)]


def test_models(spark):
    page = f"""<a href="{G}pick?c=T&amp;model=m1&amp;ssd=s1">M1</a><a href="{G}pick?model=m2&ssd=s2">M2</a><a href="{G}pick?c=H&model=m3&ssd=s">Foreign</a><a href="{G}pick?c=T&model=m1&ssd=s1"><img></a>
      <a href="{G}pick?c=T&model=m4&ssd=s"><img></a><a href="{G}pick?c=T&ssd=s">Nameless</a>"""
    models, diagnostics = links.extract_models(parsed(spark, page), spark.createDataFrame([(0, "T")], "page_id long, brand string"), SITE)
    assert sorted((r.model, r.ssd) for r in models.collect()) == [("M1", "s1"), ("M2", "s2"), ("Nameless", "s")]
    assert [r.malformed for r in diagnostics.collect()] == [1]


def test_categories(spark):
    v = f"{G}vehicle?c=T&vid=7"
    page = f"""<a href="{v}&cid=1&cname=Engine+Fuel&ssd=a">x</a><a href="{v}&cid=1&ssd=a"><img></a><a href="{v}&cid=1&cname=Other&ssd=a">x</a><a href="{v}&cid=2&ssd=b">Body</a><a href="{v}&cid=3&ssd=c"><img></a>
      <a href="{v}">Categories</a><a href="{G}vehicle?c=T&vid=8&cid=1">Elsewhere</a><a href="{G}vehicle?c=T&cid=1">No vid</a><a href="{G}vehicle?c=H&vid=7&cid=1">Foreign</a>"""
    context = spark.createDataFrame([(0, "T", "7")], "page_id long, brand string, page_vid string")
    categories, diagnostics = links.extract_categories(parsed(spark, page), context, SITE)
    assert sorted((r.cid, r.name, r.ssd) for r in categories.collect()) == [("1", "Engine Fuel", "a"), ("2", "Body", "b")]
    assert [tuple(r) for r in diagnostics.collect()] == [(0, 2, 4)]  # another name, and a category without any


def test_groups(spark):
    u = f"{G}unit?c=T&vid=7&ssd=s"
    page = f"""<a href="{u}&cid=1&uid=1"><img></a><a href="{u}&cid=1&uid=1">0901: BLOCK</a><a href="{u}&cid=1&uid=1">0901: BLOCK</a><a href="{u}&cid=1&uid=2">0901: BLOCK</a><a href="{u}&cid=1&uid=2"><img></a>
      <a href="{u}&uid=3"><img></a><a href="{u}&cid=9&uid=4">12 34: ODD</a><a href="{u}&cid=1&uid=1&ssd=t">0901: RENAMED</a><a href="{u}x&cid=1&uid=1">0901: RENAMED</a><a href="{u}&cid=1&uid=5">no code</a><a href="{u}&cid=1&uid=6">0902:</a>
      <a href="{G}unit?c=H&vid=7&uid=1">0901: FOREIGN</a><a href="{G}unit?c=T&uid=1">0901: NO VID</a><a href="{u}&cid=1">0903: NO UID</a><a href="/redirect?next={u}&uid=8">0904: NO</a>"""
    context = spark.createDataFrame([(0, "T", "7", None)], "page_id long, brand string, page_vid string, page_cid string")
    groups, diagnostics = links.extract_groups(parsed(spark, page), context, SITE)
    assert sorted((r.cid, r.code, r.uid, r.name, r.category_name) for r in groups.collect()) == [
        ("1", "", "3", "", "ENGINE/FUEL/TOOL"), ("1", "0901", "1", "BLOCK", "ENGINE/FUEL/TOOL"), ("1", "0901", "2", "BLOCK", "ENGINE/FUEL/TOOL"), ("9", "12 34", "4", "ODD", "CATEGORY 9"),
    ]
    # One candidate has a second text, one group a second name; uids 5 and 6 and the link without a uid have no sound link.
    assert [tuple(r) for r in diagnostics.collect()] == [(0, 5, 2, 2)]
    only = spark.createDataFrame([(0, "T", None, "9")], "page_id long, brand string, page_vid string, page_cid string")
    assert [r.uid for r in links.extract_groups(parsed(spark, page), only, SITE)[0].collect()] == ["4"]
