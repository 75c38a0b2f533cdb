"""URL filters: rules, and redirect equivalence for the pages that no rule decides.

Pages that point to one another by a canonical link or a redirect are aliases.
Connected components over those edges carry a block decision to every alias; a
page that a rule allows stays allowed. A page is its host, path and query, so
``?id=1`` and ``?id=2`` are two pages that only a link can join. All of it is
DataFrame work; HTML is read in one scan that keeps the targets of a page's
links. Every canonical link and redirect outside of comments counts.

Cases: a url that is null or has no ``://`` has an empty host and path and fits
no rule; a null page has no links; links that resolve to no host are left out;
a null id stays null; repeated pages are answered each; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fxlake.llm.graph import components
from fxlake.session import stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

# Whole tags are taken first, then the attribute that makes one a canonical link or a redirect.
COMMENT = r"(?s)<!--.*?-->"
LINK_TAG, META_TAG = r"(?i)<link\s[^>]*>", r"(?i)<meta\s[^>]*>"
CANONICAL = r"""(?i)\srel\s*=\s*("([^"]*\s)?canonical[\s"]|'([^']*\s)?canonical[\s']|canonical[\s/>])"""
REFRESH = r"""(?i)\shttp-equiv\s*=\s*("\s*refresh\s*"|'\s*refresh\s*'|refresh[\s/>])"""
HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TARGET = r"""(?i)\burl\s*=\s*["']?([^"'>\s]+)"""
#: How an ampersand is written in an attribute.
AMPERSANDS = ("&amp;", "&#38;", "&#x26;")


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null without one. Rules are a short list, a parameter."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def clear_path(path: Column) -> Column:
    """``path`` without ``.`` and ``..`` segments."""
    none = F.array().cast("array<string>")
    kept = F.aggregate(F.split(path, "/"), none, lambda acc, part: F.when(part == ".", acc).when(
        part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(part))))
    tail = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), tail)).otherwise(path)


def page_key(host: Column, path: Column, query: Column) -> Column:
    """The node of a page: host, path without dot segments and closing slashes, and the query if there is one."""
    return F.when(host != "", F.concat(host, F.regexp_replace(clear_path(path), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def resolve(link: Column, url: Column) -> Column:
    """The absolute form of a link from the page at ``url``; null where it can't be told (mailto: and the like, pages without a host)."""
    host, path = host_of(url), path_of(url)
    scheme = F.regexp_extract(url, "^(.*?)://", 1)
    root = F.when(host != "", F.concat(scheme, F.lit("://"), host))
    folder = F.coalesce(F.nullif(F.regexp_extract(path, "^.*/", 0), F.lit("")), F.lit("/"))
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link).when(link.startswith("//"), F.concat(F.when(scheme != "", scheme).otherwise("http"), F.lit(":"), link))
            .when(link.startswith("/"), F.concat(root, link)).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(link.rlike("^[?#]"), F.concat(root, path, link)).otherwise(F.concat(root, folder, link)))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html",
               rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """(a, b, verdict): the node of a page and of each of its canonical links and redirects, and the rules' verdict on the latter."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.col(url_col)
    low = F.translate(html, UPPER, LOWER)
    body = F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, COMMENT, "")).otherwise(html)
    none = F.array().cast("array<string>")

    def tags(word: str, tag: str, attribute: str) -> Column:
        return F.when(F.contains(low, F.lit(word)), F.filter(F.regexp_extract_all(body, F.lit(tag), F.lit(0)), lambda t: t.rlike(attribute))).otherwise(none)

    def plain(link: Column) -> Column:
        for written in AMPERSANDS:
            link = F.replace(link, F.lit(written), F.lit("&"))
        return F.trim(link)

    found = F.concat(F.transform(tags("canonical", LINK_TAG, CANONICAL), lambda t: plain(F.concat(*[F.regexp_extract(t, HREF, k) for k in (1, 2, 3)]))),
                     F.transform(tags("refresh", META_TAG, REFRESH), lambda t: plain(F.regexp_extract(t, TARGET, 1))))
    links = pages.select(url.alias("url"), F.explode(F.array_distinct(F.filter(found, lambda x: x != ""))).alias("link"))
    far = links.select("url", resolve(F.col("link"), F.col("url")).alias("far"))
    near = page_key(host_of(F.col("url")), path_of(F.col("url")), query_of(F.col("url")))
    far_path = clear_path(path_of(F.col("far")))
    return (far.select(near.alias("a"), page_key(host_of(F.col("far")), far_path, query_of(F.col("far"))).alias("b"),
                       rule_of(host_of(F.col("far")), far_path, rules)["verdict"].alias("verdict"))
            .where("a is not null and b is not null and a <> b").distinct())


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """Per page: id, host, path, rule and verdict; ``by`` tells rule, alias or default."""
    url = F.col(url_col)
    edges = stage_table(link_edges(pages, url_col, html_col, rules), "links")
    groups = stage_table(components(edges, contract=False), "aliases")
    listed = pages.select(host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("query"))
    own = listed.select(page_key(F.col("host"), F.col("path"), F.col("query")).alias("node"), rule_of(F.col("host"), F.col("path"), rules)["verdict"].alias("v"))
    # A link's target may be no page of the table. A node counts as blocked if any of its urls is.
    blocked_nodes = (own.where("v = 'block'").select("node")
                     .unionByName(edges.where("verdict = 'block'").select(F.col("b").alias("node"))).distinct())
    blocked = stage_table(groups.join(blocked_nodes, "node").select("label").distinct(), "blocked")
    aliases = groups.join(blocked, "label").select(F.col("node").alias("_node"))
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("query"))
    ruled = parts.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).withColumn("key", page_key(F.col("host"), F.col("path"), F.col("query")))
    return (ruled.join(stage_table(aliases, "blocked-aliases"), F.col("key") == F.col("_node"), "left")
            .select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                    F.coalesce(F.col("r.verdict"), F.when(F.col("_node").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    F.when(F.col("r").isNotNull(), "rule").when(F.col("_node").isNotNull(), "alias").otherwise("default").alias("by")))
