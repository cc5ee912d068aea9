"""Operator 5: URL rules with redirect equivalence. DataFrame functions only.

A rule is a host and a path prefix with a verdict; it fits its host and all subdomains, and the longest that fits decides.
URLs are tied together by redirects (a table, or a page's meta refresh) and canonical links, and by nothing else. Link targets are decoded (character
references) and resolved against their page's URL, dot segments included. Two spellings are one URL if they differ in scheme, in the case of the host, a default port, an empty path or the fragment
(`resource`); the query counts. Connected components over these edges carry decisions to aliases: a URL that no rule fits
takes its component's verdict, allow if any member is explicitly allowed, else block if any is blocked, else allow. A
URL's own rule is never overridden, so an explicit allow holds whatever its aliases are.

Scale: rules are matched without a shuffle while they are at most MAP_RULES (a literal map by host), beyond that by an
equi-join on host suffixes. Components run as joins and grouped minima over the distinct URLs that have an edge.

Defined results: a null URL or one without `://` has an empty host and path and is not an alias of anything; repeated pages
get one row each; ties between rules of one length can't occur (a rule is one verdict, the last given wins); an empty
table gives no rows; a missing html column or redirect table means no such edges; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.common import cut, scratch, table
from sessionloom.llm.components import components

MAP_RULES = 2000
#: The rules of the registered query: (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\bcontent\s*=\s*["']?\s*\d+\s*;\s*url\s*=\s*["']?([^"'\s>]+)"""


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def resource(url: Column) -> Column:
    """What names a URL's resource: host without a default port, path, query; null where there is no host."""
    plain = F.regexp_replace(F.when(url.rlike(r"(?i)^https://"), F.regexp_replace(host(url), ":443$", "")).when(url.rlike(r"(?i)^http://"), F.regexp_replace(host(url), ":80$", "")).otherwise(host(url)), ":$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(host(url) != "", F.concat(plain, F.when(path(url) == "", "/").otherwise(path(url)), query))


def _suffixes(h: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(h, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def match_rules(rows: DataFrame, rules) -> DataFrame:
    """rows (with host, path) plus rule and rule_verdict of the longest fitting rule, else null."""
    rules = {rule: verdict for verdict, rule in rules}
    by_host: dict[str, list[str]] = {}
    for rule in rules:
        by_host.setdefault(rule.split("/", 1)[0], []).append(rule)
    if not rules:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")})
    best = lambda found: F.array_max(F.transform(found, lambda r: F.struct(F.length(r).alias("n"), r.alias("rule"))))["rule"]
    if len(rules) <= MAP_RULES:
        known = F.create_map(*[x for h, rs in by_host.items() for x in (F.lit(h), F.array(*map(F.lit, rs)))])
        found = F.flatten(F.transform(_suffixes(F.col("host")), lambda h: F.coalesce(F.try_element_at(known, h), F.array().cast("array<string>"))))
        verdicts = F.create_map(*[F.lit(x) for rule, v in rules.items() for x in (rule, v)])
        found = F.filter(found, lambda r: F.startswith(F.col("path"), F.regexp_replace(r, "^[^/]*", "")))
        return rows.withColumn("rule", best(found)).withColumn("rule_verdict", F.try_element_at(verdicts, F.col("rule")))
    spark = rows.sparkSession
    listed = spark.createDataFrame([(h, r, rules[r]) for h, rs in by_host.items() for r in rs], "suffix string, rule string, rule_verdict string")
    places = rows.select("host", "path").distinct()
    met = places.withColumn("suffix", F.explode(_suffixes(F.col("host")))).join(listed, "suffix").where(F.startswith(F.col("path"), F.regexp_replace("rule", "^[^/]*", "")))
    longest = met.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("m")).select("host", "path", "m.rule", "m.rule_verdict")
    return rows.join(longest, ["host", "path"], "left")


#: The named references that occur in links.
REFERENCES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def decoded(text: Column) -> Column:
    """Text with its character references (numbers, and the names in REFERENCES) replaced, each once."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|amp|lt|gt|quot|apos);"), F.lit(0)))
    names = F.create_map(*[F.lit(x) for k, v in REFERENCES.items() for x in (f"&{k};", v)])

    def one(r: Column) -> Column:
        hexed = F.when(r.rlike("^&#[xX]"), F.regexp_extract(r, "([0-9a-fA-F]+);$", 1)).when(r.rlike("^&#"), F.hex(F.regexp_extract(r, "([0-9]+);", 1).try_cast("long")))
        number = F.conv(hexed, 16, 10).try_cast("long")
        sound = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return F.coalesce(F.try_element_at(names, r), F.when(sound, F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")), r)

    # `&` last, so that what it becomes isn't read again
    last = F.array_intersect(F.array(F.lit("&amp;"), F.lit("&#38;"), F.lit("&#x26;"), F.lit("&#X26;")), found)
    return F.aggregate(F.concat(F.array_except(found, last), last), text, lambda t, r: F.replace(t, r, one(r)))


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, without `.` and `..` segments."""
    parts = F.split(F.substring(path, F.lit(2), F.length(path)), "/")
    none = F.array().cast("array<string>")
    kept = F.aggregate(parts, none, lambda s, x: F.when(x == ".", s).when(x == "..", F.when(F.size(s) > 0, F.slice(s, 1, F.size(s) - 1)).otherwise(s)).otherwise(F.concat(s, F.array(x))))
    tail = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")  # a folder stays one
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(path.contains("/."), F.when(joined == "/", joined).otherwise(F.concat(joined, tail))).otherwise(path)


def absolute(target: Column, base: Column) -> Column:
    """A link target as a URL: its own, or resolved against the page's. Null for an empty one and for other schemes without a host (mailto and so on)."""
    scheme, origin = F.regexp_extract(base, r"(?s)^(.*?:)//", 1), F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    at = F.when(path(base) == "", "/").otherwise(path(base))
    folder = F.regexp_replace(at, "[^/]*$", "")
    place, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    full = F.when(F.startswith(place, F.lit("/")), place).otherwise(F.concat(folder, place))
    out = F.when((target == "") | (origin == ""), None).when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target).when(F.startswith(target, F.lit("//")), F.concat(scheme, target))
    out = out.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None).when(place == "", F.concat(origin, at, rest))
    return out.otherwise(F.concat(origin, _without_dots(full), rest))


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. redirects: (source, target) URLs."""
    url = F.col("url").cast("string")
    html = F.col("html").cast("string") if "html" in pages.columns else F.lit(None).cast("string")
    targets = F.array(*[absolute(decoded(F.regexp_extract(html, p, 1)), url) for p in (_CANONICAL, _REFRESH)])
    with scratch(pages.sparkSession) as keep:
        own = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host(url).alias("host"), path(url).alias("path"), F.filter(targets, lambda t: t.isNotNull()).alias("targets"))
        own = cut(match_rules(own, rules).withColumn("node", resource(F.col("url"))), "url-pages")

        # nodes are resources; rules of link ends that are no pages count too
        links = own.select("url", F.explode("targets").alias("target"))
        if redirects is not None:
            links = links.union(redirects.select(F.col(redirects.columns[0]).cast("string"), F.col(redirects.columns[1]).cast("string")))
        links = links.where("url is not null and target is not null")
        edges = cut(links.select(resource(F.col("url")).alias("a"), resource(F.col("target")).alias("b")).where("a is not null and b is not null").distinct(), "url-edges")
        if edges.isEmpty():
            return keep(own.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit("allow")).alias("verdict")), "url-verdicts")
        ends = links.select("url").union(links.select("target")).distinct()
        extra = match_rules(ends.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")), rules).select(resource(F.col("url")).alias("node"), "rule_verdict")
        parts = cut(components(edges), "url-parts")
        known = own.select("node", "rule_verdict").union(extra).where("node is not null and rule_verdict is not null").distinct()
        decided = known.join(parts, "node").groupBy("component").agg(F.max((F.col("rule_verdict") == "allow").cast("int")).alias("allowed"))
        spread = parts.join(decided, "component").select("node", F.when(F.col("allowed") == 1, "allow").otherwise("block").alias("part_verdict"))
        out = own.join(spread, "node", "left")
        return keep(out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "part_verdict", F.lit("allow")).alias("verdict")), "url-verdicts")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


#: The test pages have no redirects or canonical links, so no verdict is spread.
OP5_SQL = r"""
WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
r AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
