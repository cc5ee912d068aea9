"""Operator 7: not-modified revisits resolved to full responses. DataFrame functions only.

A revisit record (a 304 answer) has no payload; it stands for the latest earlier full response of its canonical URL (without scheme, default
port and fragment, the host in lower case; path and query name the resource, which a validator holds for), if a validator agrees: entity tags compared weakly where both sides have one, else Last-Modified, else the payload digest.
The resolved record carries the response's locator and its headers, updated by those of the revisit that may be updated.

The as-of join is a range partition by (URL, time): in each range, every revisit takes the last response before it; the
last response of each (range, URL) is handed on to later ranges through a table of one row per range and URL. So a URL with a third of all
records is spread over many ranges, and no group holds more than a range.

Defined results: records with a null or host-less URL or a null time are returned unresolved; at equal times the smaller
record_id is earlier; repeated records are resolved each; a revisit without any validator is unresolved (`no validator`);
null header maps count as empty; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionloom.llm.common import cut, scratch, table
from sessionloom.llm.url_filter import resource

#: Headers that a 304 answer may not change in the stored response.
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive", "proxy-authenticate", "te", "trailer", "transfer-encoding", "upgrade")
FIELDS = {"record_id": "long", "kind": "string", "url": "string", "ts": "long", "etag": "string", "last_modified": "string", "digest": "string", "headers": "map<string,string>", "locator": "string"}


def _lower_keys(m: Column) -> Column:
    # the last of headers that differ only in case wins
    pairs = F.transform(F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    keys = F.array_distinct(F.transform(pairs, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda e: e["key"] == k), -1)["value"]))


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored headers, with every header of the update that may change; keys in lower case, in order."""
    stored, update = _lower_keys(stored), F.map_filter(_lower_keys(update), lambda k, v: ~k.isin(*KEPT_HEADERS))
    both = F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(update, k)), update)
    return F.map_from_entries(F.array_sort(F.map_entries(both)))


def resolve(records: DataFrame) -> DataFrame:
    """record_id, url_key, response_id, outcome, locator, headers of every revisit.

    records: record_id, kind (`response` or `revisit`), url, ts (any ordered long), etag, last_modified, digest, headers, locator.
    outcome: `resolved`, `no response`, `no validator` or `changed`; all but the first give no locator.
    """
    own = records.select(*[F.col(c).cast(t).alias(c) for c, t in FIELDS.items()]).where("kind in ('response', 'revisit')").withColumn("url_key", resource(F.col("url")))
    spark = records.sparkSession
    with scratch(spark) as keep:
        usable = F.col("url_key").isNotNull() & F.col("ts").isNotNull()
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranged = own.where(usable).drop("url").repartitionByRange(ranges, "url_key", "ts", "record_id").withColumn("range", F.spark_partition_id())
        ranged = cut(ranged, "warc-ranges")
        response = F.when(F.col("kind") == "response", F.struct("record_id", "etag", "last_modified", "digest", "headers", "locator"))
        order = ["ts", "record_id"]
        inside = Window.partitionBy("range", "url_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        near = ranged.withColumn("found", F.last(response, ignorenulls=True).over(inside)).where("kind = 'revisit'")
        last = ranged.where("kind = 'response'").groupBy("range", "url_key").agg(F.max_by(F.struct("record_id", "etag", "last_modified", "digest", "headers", "locator"), F.struct(*order)).alias("last"))
        every = ranged.select("range", "url_key").distinct().join(last, ["range", "url_key"], "left")
        handed = every.withColumn("handed", F.last("last", ignorenulls=True).over(Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))).select("range", "url_key", "handed")
        got = near.join(handed, ["range", "url_key"], "left").withColumn("r", F.coalesce("found", "handed"))
        unusable = own.where(~usable & (F.col("kind") == "revisit")).withColumn("r", F.lit(None).cast(got.schema["r"].dataType))
        columns = ["record_id", "url_key", "etag", "last_modified", "digest", "headers", "r"]
        got = got.select(*columns).union(unusable.select(*columns))

        strong = lambda c: F.regexp_replace(c, "^W/", "")
        agree = F.when(F.col("etag").isNotNull() & F.col("r.etag").isNotNull(), strong(F.col("etag")) == strong(F.col("r.etag")))
        agree = agree.when(F.col("last_modified").isNotNull() & F.col("r.last_modified").isNotNull(), F.col("last_modified") == F.col("r.last_modified"))
        agree = agree.when(F.col("digest").isNotNull() & F.col("r.digest").isNotNull(), F.col("digest") == F.col("r.digest"))
        outcome = F.when(F.col("r").isNull(), "no response").when(agree.isNull(), "no validator").when(agree, "resolved").otherwise("changed")
        got = got.withColumn("outcome", outcome)
        ok = F.col("outcome") == "resolved"
        return keep(got.select("record_id", "url_key", F.col("r.record_id").alias("response_id"), "outcome", F.when(ok, F.col("r.locator")).alias("locator"), F.when(ok, merged_headers(F.col("r.headers"), F.col("headers"))).alias("headers")), "warc-revisits")


#: Ticks after which the query asks for a page again.
LATER = 1005


def page_records(pages: DataFrame) -> DataFrame:
    """A crawl log from pages: each page is a response, and is asked for again LATER ticks after it (a revisit with its entity tag)."""
    tag, at = F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")), F.col("page_id") * 10
    size = F.length(F.coalesce(F.col("html"), F.lit("")).cast("binary")).cast("string")
    base = pages.select("page_id", "url", tag.alias("tag"), size.alias("size"), at.alias("at"))
    none = F.lit(None).cast("string")
    answer = base.select((F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", F.col("at").alias("ts"), F.col("tag").alias("etag"), none.alias("last_modified"), F.col("tag").alias("digest"), F.create_map(F.lit("Content-Length"), "size", F.lit("Date"), F.col("at").cast("string"), F.lit("ETag"), "tag").alias("headers"), F.concat(F.lit("page/"), "page_id").alias("locator"))
    later = (F.col("at") + LATER).alias("ts")
    again = base.select((F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", later, F.concat(F.lit("W/"), "tag").alias("etag"), none.alias("last_modified"), none.alias("digest"), F.create_map(F.lit("content-length"), F.lit("0"), F.lit("date"), (F.col("at") + LATER).cast("string"), F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"), none.alias("locator"))
    return answer.union(again)


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = resolve(page_records(table(spark, sf_dir, "pages")))
    header = lambda k: F.try_element_at("headers", F.lit(k))
    return got.select("record_id", "url_key", "response_id", "outcome", "locator", header("date").alias("date"), header("content-length").alias("content_length"), header("cache-control").alias("cache_control"), header("etag").alias("etag"))


OP7_SQL = r"""
WITH p AS (SELECT page_id, url, md5(coalesce(html, '')) AS tag, strlen(coalesce(html, '')) AS size, page_id * 10 AS t0,
  coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(nullif(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), ''), '/') || regexp_extract(url, '^[^?#]*(\?[^#]*)', 1, 's') AS rest FROM pages),
k AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(CASE WHEN lower(url) LIKE 'http://%' THEN regexp_replace(host, ':80$', '') WHEN lower(url) LIKE 'https://%' THEN regexp_replace(host, ':443$', '') ELSE host END, ':$', '') || rest END AS url_key FROM p),
j AS (SELECT v.page_id, v.url_key, v.tag, v.t0, r.page_id AS rp, r.tag AS rtag, r.size AS rsize
      FROM k v ASOF LEFT JOIN k r ON v.url_key = r.url_key AND v.t0 + 1005 > r.t0)
SELECT page_id * 2 + 1 AS record_id, url_key, rp * 2 AS response_id,
  CASE WHEN rp IS NULL THEN 'no response' WHEN tag = rtag THEN 'resolved' ELSE 'changed' END AS outcome,
  CASE WHEN tag = rtag THEN 'page/' || rp END AS locator, CASE WHEN tag = rtag THEN CAST(t0 + 1005 AS VARCHAR) END AS date,
  CASE WHEN tag = rtag THEN CAST(rsize AS VARCHAR) END AS content_length, CASE WHEN tag = rtag THEN 'max-age=60' END AS cache_control,
  CASE WHEN tag = rtag THEN rtag END AS etag
FROM j
"""
