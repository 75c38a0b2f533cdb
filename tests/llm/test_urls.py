from fxlake.llm import urls


def run(spark, pages):
    frame = spark.createDataFrame([(i, u, h, "extra") for i, u, h in pages], "page_id long, url string, html string, host string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict, r.by) for r in urls.judge(frame).collect()}


def link(target):
    return f'<html><link rel="canonical" href="{target}"></html>'


def refresh(target):
    return f"<meta http-equiv='Refresh' content='0; URL={target}'>"


def test_rules_and_parts(spark):
    got = run(spark, [(1, "https://A.Example.org/es/x?q#f", None), (2, "http://example.org/en/12", ""), (3, "http://example.org", None), (4, None, None),
                      (5, "no scheme", None), (6, "x://badexample.org/es/", None), (7, "http://a.com/fr/1", None), (8, "http://a.com/de/", None),
                      (9, "http://com/de/1", None), (10, "a://b://c/d", None), (11, "http://example.net/?x/y", None)])
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block", "rule")
    assert got[2][2:4] == ("example.org/en/1", "block")
    assert got[3] == ("example.org", "", None, "allow", "default")
    assert got[4][:3] == got[5][:3] == ("", "", None)
    assert got[6][2:4] == ("org/", "allow")
    assert [got[k][2] for k in (7, 8, 9)] == ["com/fr/", "com/de/", "com/de/"]
    assert got[10][:2] == ("b:", "//c/d")
    assert got[11][:2] == ("example.net", "/")


def test_aliases(spark):
    pages = [(1, "http://a.net/1", link("http://b.net/2")), (2, "http://b.net/2/", refresh("http://x.com/de/3")), (3, "http://c.net/9", link("http://d.net/")),
             (4, "http://e.org/ok", link("http://a.net/1")), (5, "http://f.net/5", link("/5")), (6, "http://a.net/1?again", None),
             (7, "http://g.net/1", "<link href='//g.net/2' rel=canonical>"), (8, "http://g.net/2", refresh("http://example.org/es/z")), (1, "http://a.net/1", None)]
    got = run(spark, pages)
    # A query string makes another page (6).
    assert [got[k][3] for k in range(1, 9)] == ["block", "block", "allow", "allow", "allow", "allow", "block", "block"]
    assert got[4][4] == "rule" and got[1][4] == "alias"


def test_hot_hub_and_long_chain(spark):
    pages = [(k, f"http://h{k}.net/", link("http://hub.net/")) for k in range(300)] + [(300, "http://hub.net/", link("http://h0.com/de/"))]
    pages += [(1000 + k, f"http://c.net/{k}", link(f"http://c.net/{k + 1}")) for k in range(40)]
    got = run(spark, pages)
    assert all(got[k][3] == "block" for k in range(301))
    assert all(got[1000 + k][3] == "allow" for k in range(40))


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_relative_links(spark):
    def edges(*tags, url="https://a.net/x/y/page.html?q=1"):
        frame = spark.createDataFrame([(url, "".join(tags))], "url string, html string")
        return sorted(r.b for r in urls.link_edges(frame).collect())

    assert edges(link("other.html")) == ["a.net/x/y/other.html"]
    assert edges(link("../new"), link("./../../../z/./w/..")) == ["a.net/x/new", "a.net/z"]
    assert edges(link("?p=2&amp;q=3"), link("?q=1#top"), link("mailto:a@b.c"), link("")) == ["a.net/x/y/page.html?p=2&q=3"]
    assert edges(refresh("/r;s=1"), refresh("next?u=http://b.net/"), link("//c.net/d/../e")) == ["a.net/r;s=1", "a.net/x/y/next?u=http://b.net/", "c.net/e"]
    assert edges(link("one"), url="http://a.net") == ["a.net/one"]
    assert edges(link("one"), url="no host") == []


def test_a_block_reaches_relative_aliases(spark):
    got = run(spark, [(1, "http://a.net/d/1", link("2")), (2, "http://a.net/d/2", refresh("../3;v=1")), (3, "http://a.net/3;v=1", link("http://b.net/") + link("http://x.com/de/9")),
                      (4, "http://a.net/d/4", None), (5, "http://b.net/", None)])
    assert [got[k][3] for k in range(1, 6)] == ["block", "block", "block", "allow", "block"]


def test_tags_that_count(spark):
    def edges(html):
        return sorted(r.b for r in urls.link_edges(spark.createDataFrame([("http://a.net/1", html)], "url string, html string")).collect())

    assert edges("<link rel='alternate canonical' href=/x><LINK HREF='/y' REL=Canonical><link href=/z rel=canonical />") == ["a.net/x", "a.net/y", "a.net/z"]
    assert edges("<!-- <link rel=canonical href=/x> --><link rel=not-canonical href=/y><link data-rel=canonical href=/z><a rel=canonical href=/w>") == []
    assert edges('<!-- a\nb --><meta\nhttp-equiv=refresh content="5; url=/q?a=1&amp;b=2">') == ["a.net/q?a=1&b=2"]
    assert edges("<link rel=canonical><a href=/x>") == []
    assert edges("<p>" * 200_000 + "<link rel=canonical href=/late>") == ["a.net/late"]


PLANTED = [
    (1, "http://a.net/item?id=1", link("http://x.com/de/1")), (2, "http://a.net/item?id=2", None), (3, "http://a.net/item?id=3", link("item?id=1")),
    (4, "http://b.net/d/./e/../f", link("../g/")), (5, "http://b.net/g", refresh("http://q.example.org/es/;v=1")), (6, "http://b.net/g/", None),
    (7, "http://c.org/ok", link("http://b.net/g")), (8, "http://d.net/1", "<!--" + link("http://x.com/de/") + "-->"), (9, None, link("/x")),
    (10, "http://e.net/1", link("http://e.net/2") + link("//e.net/3")), (11, "http://e.net/3", refresh("http://z.example.org/en/17")), (12, "http://e.net/2", ""),
    (13, "http://f.net", link("a/b/../c")), (14, "http://f.net/a/c/", link("?p=1&amp;r=2")), (15, "http://f.net/a/c/?p=1&r=2", link("http://x.com/de/")),
    (None, "http://e.net/2", None), (16, "no scheme", link("http://x.com/de/")), (17, "http://e.net/2#part", None), (17, "http://e.net/2#part", None),
    (18, "http://g.net/x", "<link rel='prev canonical' href='/y'>" + "<p>long</p>" * 50_000), (19, "http://g.net/y", refresh("http://com/de/"))]


def test_planted_pages_match_the_sql(spark):
    import duckdb
    import pandas as pd

    from fxlake.llm.queries import ORACLES

    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(PLANTED, "page_id long, url string, html string")).collect()), key=str)
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(PLANTED, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"}))
    want = sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op4_url_filter']})").fetchall(), key=str)
    assert got == want
    assert sorted(r[0] for r in got if r[4] == "block" and r[0]) == [1, 3, 4, 5, 6, 10, 11, 12, 13, 14, 15, 17, 17, 18, 19]


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame(PLANTED, "page_id long, url string, html string")
    plan = urls.judge(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
