"""URL filter whose block decisions reach a page's aliases. DataFrame operations only.

A page is its own url, in a normal form, and whatever its redirects and canonical links name. Connected components over
these edges are classes of aliases. Rules decide first; a page without a rule is blocked if its class holds a blocked
url and no explicitly allowed one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import quoted
from larder.llm.components import components
from larder.session import materialise

# verdict, host, path
Rule = tuple[str, str, str]

# Fixed values of the registered query.
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Query parameters that say where a visitor came from, not which page it is.
TRACKING = "^(utm_[^=]*|fbclid|gclid|ref)(=|$)"
CANONICAL_TAG = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_TARGET = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*\burl\s*=\s*[\"']?([^\"'\s>]+)"


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(_part(url, r"(?s)^.*?://([^/?#]*)"), ascii_uppercase, ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return _part(url, r"(?s)^.*?://[^/?#]*([^?#]*)")


def normal_form(url: Column) -> Column:
    """Host, path without closing slashes and the query without tracking parameters; null without ``://``."""
    query = F.filter(F.split(_part(url, r"(?s)^.*?://[^?#]*\?([^#]*)"), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise("")
    return F.when(F.contains(url, F.lit("://")), F.concat(host(url), F.regexp_replace(path(url), "/+$", ""), query))


def _without_dots(target: Column) -> Column:
    """A path and what follows it, with its ``.`` and ``..`` folders resolved; ``..`` above the root stays there."""
    begin = F.regexp_extract(target, "(?s)^[^?#]*", 0)

    def step(held: Column, part: Column) -> Column:
        up = F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", held).otherwise(F.array_append(held, part))

    parts = F.aggregate(F.split(begin, "/"), F.array().cast("array<string>"), step)
    return F.concat(F.array_join(parts, "/"), F.regexp_extract(target, "(?s)^[^?#]*(.*)$", 1))


def absolute(target: Column, url: Column) -> Column:
    """A link's target as a whole url, relative ones from the page's folder; null for a place in the page and other schemes."""
    scheme = _part(url, r"(?s)^([^:]*)://")
    site = F.concat(scheme, F.lit("://"), host(url))
    folder = F.regexp_replace(path(url), "[^/]*$", "")
    return (
        F.when(F.contains(target, F.lit("://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, _without_dots(target)))
        .when(target.rlike("^([A-Za-z][A-Za-z0-9+.-]*:|#)"), F.lit(None).cast("string"))
        .when(F.startswith(target, F.lit("?")), F.concat(site, path(url), target))
        .otherwise(F.concat(site, _without_dots(F.concat(F.when(folder == "", "/").otherwise(folder), target))))
    )


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct with its name and verdict; null if none fits. Of equally long ones an allow wins.

    The rules are a parameter and part of the plan, so they should be some thousands at most.
    """
    fits = [
        F.when(
            ((host == F.lit(h)) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(*(F.lit(x).alias(n) for n, x in (("length", len(h + p)), ("allows", v == "allow"), ("rule", h + p), ("verdict", v)))),
        )
        for v, h, p in rules
    ]
    return F.greatest(*fits) if len(fits) > 1 else reduce(lambda a, _: a, fits)


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``source, target``: from each page's url to all its canonical links and refresh targets, as whole urls."""
    here, body = F.col(quoted(url)), F.coalesce(F.col(quoted(html)), F.lit(""))
    canonical = F.transform(F.regexp_extract_all(body, F.lit(CANONICAL_TAG), F.lit(0)), lambda tag: F.regexp_extract(tag, HREF, 1))
    found = F.concat(canonical, F.regexp_extract_all(body, F.lit(REFRESH_TARGET), F.lit(1)))
    links = pages.select(here.alias("source"), F.explode(found).alias("found")).where("found != ''")
    return links.select("source", absolute(F.col("found"), F.col("source")).alias("target")).where("target IS NOT NULL")


def verdicts(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    redirects: DataFrame | None = None,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, alias_class`` for each row of ``pages``.

    ``redirects`` may add ``source, target`` urls, as from a crawl's responses. A null url, or one without ``://``, has
    an empty host and path, fits no rule, has no aliases and is allowed. Null or empty pages have no links. Repeated
    rows all stay; an empty table gives an empty result. Pages are joined to their class only, whose two flags are
    combined before the shuffle; a class that holds a third of all pages is one row there.
    """
    edges = alias_links(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    edges = edges.select("source", "target", normal_form(F.col("source")).alias("a"), normal_form(F.col("target")).alias("b"))
    edges = materialise(edges.distinct(), name="alias-links")

    def judged(urls: DataFrame) -> DataFrame:
        h, p = host(F.col("url")), path(F.col("url"))
        rows = urls.withColumns({"host": h, "path": p, "node": normal_form(F.col("url"))})
        return rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))

    rows = judged(pages.select(F.col(quoted(key)).alias("page_id"), F.col(quoted(url)).alias("url")))
    ends = judged(edges.select(F.explode(F.array("source", "target")).alias("url")))
    roots = components(edges).withColumnRenamed("component", "root")
    known = rows.select("node", "best.verdict").unionByName(ends.select("node", "best.verdict"))
    flags = known.where("node IS NOT NULL").groupBy("node").agg(_any("verdict", "block").alias("block"), _any("verdict", "allow").alias("allow"))
    flags = flags.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = flags.groupBy("root").agg(F.max("block").alias("block"), F.max("allow").alias("allow"))
    spread = flags.select("node", "root").join(classes, "root")
    by_class = F.when(F.col("block") & ~F.col("allow"), "block").otherwise("allow")
    return rows.join(spread, "node", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", by_class).alias("verdict"), F.col("root").alias("alias_class"),
    )


def _any(column: str, value: str) -> Column:
    return F.max(F.coalesce(F.col(column) == value, F.lit(False)))


# DuckDB SQL for the registered query.
_HOST = "translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), '" + ascii_uppercase + "', '" + ascii_lowercase + "')"
_PATH = "regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_QUERY = (
    "list_filter(string_split(regexp_extract({u}, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '&'), "
    "lambda p: p <> '' AND NOT regexp_matches(p, '" + TRACKING + "'))"
)
_FORM = (
    "CASE WHEN contains({u}, '://') THEN " + _HOST + " || regexp_replace(" + _PATH + ", '/+$', '') || "
    "CASE WHEN len(" + _QUERY + ") > 0 THEN '?' || array_to_string(" + _QUERY + ", '&') ELSE '' END END"
)


def _sql(expression: str, column: str) -> str:
    return expression.replace("{u}", column)


ORACLE = f"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
tags AS (SELECT url, html, regexp_extract(html, '{CANONICAL_TAG.replace("'", "''")}') AS tag FROM pages),
found AS (
  SELECT url, unnest([regexp_extract(tag, '{HREF.replace("'", "''")}', 1),
                      regexp_extract(html, '{REFRESH_TARGET.replace("'", "''")}', 1)]) AS t FROM tags),
links AS (
  SELECT DISTINCT url AS source, CASE WHEN contains(t, '://') THEN t
    WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^([^:]*)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^([^:]*)://', 1) || '://' || {_sql(_HOST, "url")} || t END AS target
  FROM found WHERE t <> ''),
urls AS (
  SELECT DISTINCT url FROM (SELECT url FROM pages UNION ALL SELECT source FROM links UNION ALL SELECT target FROM links)
  WHERE url IS NOT NULL),
judged AS (
  SELECT url, coalesce({_sql(_HOST, "url")}, '') AS host, coalesce({_sql(_PATH, "url")}, '') AS path, {_sql(_FORM, "url")} AS node
  FROM urls),
ruled AS (
  SELECT j.url, max_by(struct_pack(r := r.host || r.path, v := r.verdict), length(r.host || r.path)) AS best
  FROM judged j JOIN rules r ON (j.host = r.host OR ends_with(j.host, '.' || r.host)) AND starts_with(j.path, r.path)
  GROUP BY j.url),
nodes AS (SELECT j.node, max(b.best.v = 'block') AS block, max(b.best.v = 'allow') AS allow
          FROM judged j LEFT JOIN ruled b USING (url) WHERE j.node IS NOT NULL GROUP BY j.node),
sides AS (SELECT {_sql(_FORM, "source")} AS a, {_sql(_FORM, "target")} AS b FROM links WHERE target IS NOT NULL),
pairs AS (SELECT a, b FROM sides UNION SELECT b, a FROM sides),
reach(node, other) AS (SELECT node, node FROM nodes UNION SELECT r.node, e.b FROM reach r JOIN pairs e ON r.other = e.a),
classes AS (SELECT r.node, max(coalesce(n.block, false)) AS block, max(coalesce(n.allow, false)) AS allow
            FROM reach r JOIN nodes n ON r.other = n.node GROUP BY r.node)
SELECT p.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, b.best.r AS rule,
  coalesce(b.best.v, CASE WHEN c.block AND NOT c.allow THEN 'block' ELSE 'allow' END) AS verdict
FROM pages p LEFT JOIN judged j USING (url) LEFT JOIN ruled b USING (url) LEFT JOIN classes c ON c.node = j.node
"""
