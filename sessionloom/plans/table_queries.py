"""The operators applied to the driver's tables, each with the same question in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions import scalars as X
from sessionloom.operators import aggregates as A
from sessionloom.operators import ledger as L
from sessionloom.operators import ordered as O
from sessionloom.session import fresh, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def grade_sql(x: str) -> str:
    return f"CASE WHEN {x} >= 85 THEN 'A' WHEN {x} >= 70 THEN 'B' WHEN {x} >= 55 THEN 'C' WHEN {x} >= 40 THEN 'D' WHEN {x} IS NOT NULL THEN 'F' END"


def seconds(c: str):
    """A time column as seconds."""
    return F.unix_micros(F.col(c).cast("timestamp")) / 1e6


SECONDS = "epoch_us({}) / 1000000.0"


def scored_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("project_id"), F.col("o_orderpriority").alias("site_id"), F.to_date("o_orderdate").alias("snapshot_date"), F.round(F.round(F.col("o_totalprice") / 5000, 6), 1).alias("score"), "o_totalprice")


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("t", seconds("ts"))


_ISSUES = "CAST(sum(o_orderkey % 3) AS BIGINT) AS errors_count, CAST(sum(o_orderkey % 5) AS BIGINT) AS warnings_count"


@query(f"""
WITH s AS (SELECT o_orderkey, o_orderstatus AS project_id, o_orderpriority AS site_id, strftime(o_orderdate, '%Y-%m-%d') AS snapshot_date, round(round(o_totalprice / 5000, 6), 1) AS score FROM orders),
g AS (SELECT *, {grade_sql('score')} AS grade FROM s WHERE score IS NOT NULL)
SELECT project_id, site_id, snapshot_date, count(*) AS session_count, count(score) AS scored_count, round(round(avg(score), 6), 1) AS avg_score, min(score) AS min_score, max(score) AS max_score,
  {', '.join(f"count(*) FILTER (WHERE grade = '{x}') AS grade_{x.lower()}_count" for x in 'ABCDF')}, {_ISSUES}
FROM g GROUP BY ALL
""")
def kpi_snapshot(spark, d):
    rows = scored_orders(spark, d).withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))
    return A.kpi_snapshot(rows, ["project_id", "site_id", "snapshot_date"], "score", F.col("o_orderkey") % 3, F.col("o_orderkey") % 5)


_FLEET = f"""
WITH s AS (SELECT c_mktsegment AS segment, CASE WHEN c_acctbal >= 0 THEN round(round(c_acctbal / 100, 6), 1) END AS score, CAST(c_custkey % 1000 AS DOUBLE) AS secs FROM customer),
g AS (SELECT *, {grade_sql('score')} AS grade FROM s)
SELECT segment, count(*) AS sessions, count(score) AS scored, round(round(avg(score), 6), 1) AS avg_score, {', '.join(f"count(*) FILTER (WHERE grade = '{x}') AS n_{x.lower()}" for x in 'ABCDF')},
  round(coalesce(sum(secs), 0) / 3600, 4) AS hours, round(coalesce(sum(secs) FILTER (WHERE grade <> 'F'), 0) / 3600, 4) AS usable_hours,
  CASE WHEN count(score) > 0 THEN round(round(100.0 * (count(score) - count(*) FILTER (WHERE grade = 'F')) / count(score), 6), 1) END AS usable_pct
FROM g GROUP BY segment
"""


@query(_FLEET)
def fleet_quality(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.when(F.col("c_acctbal") >= 0, F.round(F.round(F.col("c_acctbal") / 100, 6), 1)).alias("score"), (F.col("c_custkey") % 1000).cast("double").alias("secs"))
    return A.fleet_quality(rows, "score", "secs", ["segment"])


@query("SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS first_only, count(*) FILTER (WHERE o_orderstatus = 'O') AS second_only, count(*) FILTER (WHERE o_orderstatus = 'P') AS both FROM orders")
def redundancy_stats(spark, d):
    s = F.col("o_orderstatus")
    return A.redundancy(table(spark, d, "orders"), s.isin("F", "P"), s.isin("O", "P"))


@query(f"SELECT coalesce({grade_sql('CASE WHEN c_acctbal >= 0 THEN round(round(c_acctbal / 100, 6), 1) END')}, 'not scored') AS bucket, count(*) AS n FROM customer GROUP BY 1")
def grade_histogram(spark, d):
    return A.histogram(table(spark, d, "customer"), X.grade(F.when(F.col("c_acctbal") >= 0, F.round(F.round(F.col("c_acctbal") / 100, 6), 1))), "not scored")


@query("SELECT s_suppkey, s_name, n_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey ORDER BY s_acctbal ASC NULLS LAST, s_suppkey")
def disk_join_backlog(spark, d):
    met = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return met.select("s_suppkey", "s_name", "n_name", "s_acctbal").orderBy(F.asc_nulls_last("s_acctbal"), "s_suppkey")


def _buyers(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def ledger_anti(spark, d):
    return L.not_in(table(spark, d, "customer").select("c_custkey", "c_name"), _buyers(spark, d), ["c_custkey"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def ledger_semi(spark, d):
    return L.also_in(table(spark, d, "customer").select("c_custkey", "c_name"), _buyers(spark, d), ["c_custkey"])


@query("SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def manifest_missing(spark, d):
    kept = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return L.restrict(kept, table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])[1]


_STATUS = """
WITH s AS (SELECT d.doc_id, source, n_chars, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) THEN 'delivered'
  WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 0) THEN 'sent' WHEN EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = d.doc_id AND p_size < 10) THEN 'skipped' ELSE 'pending' END AS status FROM documents d)
"""


def _status(spark, d):
    labels = table(spark, d, "labels")
    skipped = table(spark, d, "part").where("p_size < 10").select(F.col("p_partkey").alias("doc_id"))
    return L.coverage_status(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "doc_id", labels.where("quality = 1"), labels.where("quality = 0"), skipped)


@query(_STATUS + "SELECT doc_id, source, n_chars, status FROM s")
def coverage_status(spark, d):
    return _status(spark, d)


@query(_STATUS + """SELECT source, count(*) FILTER (WHERE status = 'delivered') AS n_delivered, count(*) FILTER (WHERE status = 'sent') AS n_sent, count(*) FILTER (WHERE status = 'skipped') AS n_skipped,
  count(*) FILTER (WHERE status = 'pending') AS n_pending, CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS bytes, CAST(coalesce(sum(n_chars) FILTER (WHERE status IN ('delivered', 'sent')), 0) AS BIGINT) AS covered_bytes,
  round(coalesce(100.0 * sum(n_chars) FILTER (WHERE status IN ('delivered', 'sent')) / sum(n_chars), 0), 4) AS covered_pct FROM s GROUP BY source""")
def coverage_totals(spark, d):
    return L.coverage_totals(_status(spark, d), "source", "n_chars")


@query("SELECT o_orderpriority, o_orderkey, o_totalprice, rn AS rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn FROM orders) WHERE rn <= 10")
def coverage_topn(spark, d):
    return O.top_of_group(table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), ["o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"], 10)


@query(f"""
WITH g AS (SELECT user_id, {SECONDS.format('ts')} - lag({SECONDS.format('ts')}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)
SELECT user_id, count(*) AS frames, count(*) FILTER (WHERE gap > 2.5 * 43200) AS drops, count(*) FILTER (WHERE gap > 10.0 * 43200) AS severe, max(gap) AS max_gap,
  round(coalesce(100.0 * count(*) FILTER (WHERE gap > 2.5 * 43200) / nullif(count(*) - 1, 0), 0), 4) AS drop_pct FROM g GROUP BY user_id
""")
def frame_gaps(spark, d):
    return O.frame_gaps(events(spark, d), ["user_id"], "t", "event_id", 43_200.0)


_WINDOWS = f"""
WITH e AS (SELECT user_id, {SECONDS.format('ts')} AS t FROM events), b AS (SELECT user_id, min(t) AS t0, max(t) AS t1 FROM e GROUP BY user_id),
w AS (SELECT user_id, t0, t1, unnest(range(0, CAST(floor((t1 - t0) / 432000) AS BIGINT) + 1)) AS k FROM b),
r AS (SELECT w.user_id, k, count(*) AS n FROM w JOIN e ON e.user_id = w.user_id AND e.t >= t0 + k * 432000.0 AND e.t < t0 + k * 432000.0 + 864000 WHERE t0 + k * 432000.0 + 864000 <= t1 GROUP BY 1, 2 HAVING count(*) > 5)
"""


@query(_WINDOWS.replace("count(*) AS n FROM", "count(*) AS n, (count(*) - 1) / (max(e.t) - min(e.t)) AS rate FROM") + "SELECT user_id, k, n, round(rate, 12) AS rate FROM r")
def sliding_rate(spark, d):
    return O.sliding_rate(events(spark, d), ["user_id"], "t", 864_000.0, 432_000.0).withColumn("rate", F.round("rate", 12))


@query(_WINDOWS.replace("count(*) AS n FROM", "count(*) AS n, 86400 * (count(*) - 1) / (max(e.t) - min(e.t)) AS rate FROM") + """, s AS (SELECT user_id, count(*) AS windows, stddev_pop(rate) AS std_rate, max_by(rate, k) - min_by(rate, k) AS trend FROM r GROUP BY user_id),
a AS (SELECT user_id, 86400 * (count(*) - 1) / (max(t) - min(t)) AS rate FROM e GROUP BY user_id HAVING count(*) >= 10 AND max(t) - min(t) >= 86400)
SELECT user_id, coalesce(windows, 0) AS windows, round(rate, 3) AS rate, round(rate - 2, 3) AS delta, round(coalesce(std_rate, 0), 3) AS std_rate, round(coalesce(trend, 0), 3) AS trend FROM a LEFT JOIN s USING (user_id)""")
def temporal_drift(spark, d):
    """Events a day, in windows of ten days."""
    days = events(spark, d).withColumn("t", F.col("t") / 86_400)
    return O.drift(days, ["user_id"], "t", 2.0, 10.0, 5.0, least_span=1.0)


@query(f"""
WITH s AS (SELECT user_id, event_type, min({SECONDS.format('ts')}) AS s, max({SECONDS.format('ts')}) AS e FROM events GROUP BY 1, 2)
SELECT user_id, count(*) AS streams, CASE WHEN count(*) >= 2 THEN round(coalesce(greatest(0, min(e) - max(s)) / nullif(max(e) - min(s), 0), 0), 6) END AS overlap FROM s GROUP BY user_id
""")
def overlap_ratio(spark, d):
    return A.overlap_ratio(events(spark, d), ["user_id"], "event_type", "t")


@query(f"""
WITH e AS (SELECT event_type, user_id, min({SECONDS.format('ts')}) AS t0, max({SECONDS.format('ts')}) AS t1, count(*) AS n FROM events GROUP BY 1, 2),
d AS (SELECT *, t1 - t0 AS dur FROM e), m AS (SELECT event_type, median(t0) AS mt0, median(t1) AS mt1, median(dur) AS mdur, median(n) AS mn FROM d GROUP BY 1),
v AS (SELECT *, CASE WHEN user_id % 4 > 0 THEN n * 10.0::DOUBLE + user_id % 7 END AS vs FROM d), vm AS (SELECT event_type, median(vs) AS mvs FROM v GROUP BY 1 HAVING count(vs) >= 2),
r AS (SELECT event_type, user_id, n, CAST(coalesce(vs / nullif(mvs, 0) NOT BETWEEN 0.7 AND 1.3, false) AS INTEGER) + CAST(abs(t0 - mt0) > 86400 AS INTEGER) + CAST(abs(t1 - mt1) > 86400 AS INTEGER) + CAST(coalesce(dur / nullif(mdur, 0) NOT BETWEEN 0.7 AND 1.3, false) AS INTEGER)
  + CAST(coalesce(n / nullif(mn, 0) NOT BETWEEN 0.7 AND 1.3, false) AS INTEGER) AS reasons FROM v JOIN m USING (event_type) LEFT JOIN vm USING (event_type))
SELECT event_type, user_id, n, reasons, CASE WHEN reasons >= 2 THEN 'HIGH' WHEN reasons = 1 THEN 'LOW' ELSE 'OK' END AS confidence FROM r
""")
def median_outlier(spark, d):
    videos = events(spark, d).where("user_id % 4 > 0").groupBy("event_type", "user_id").agg((F.count(F.lit(1)) * 10.0 + F.col("user_id") % 7).alias("video_seconds"))
    return A.median_outliers(events(spark, d), "event_type", "user_id", "t", 86_400.0, videos=videos)


_NEAREST = f"""
WITH e AS (SELECT event_id, user_id, event_type, {SECONDS.format('ts')} AS t FROM events), l AS (SELECT * FROM e WHERE event_type = 'purchase'), r AS (SELECT * FROM e WHERE event_type <> 'purchase'),
c AS (SELECT l.user_id, l.event_id, r.event_id AS other_id, abs(r.t - l.t) AS gap, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(r.t - l.t), r.t, r.event_id) AS rn FROM l JOIN r USING (user_id))
"""


def _nearest(spark, d):
    e = events(spark, d)
    return O.nearest(e.where("event_type = 'purchase'"), e.where("event_type != 'purchase'").withColumnRenamed("event_id", "other_id"), ["user_id"], "t", "event_id", "other_id")


@query(_NEAREST + "SELECT l.user_id, l.event_id, c.other_id, round(c.gap, 3) AS gap FROM l LEFT JOIN c ON l.event_id = c.event_id AND rn = 1")
def nearest_match(spark, d):
    return _nearest(spark, d).withColumn("gap", F.round("gap", 3))


@query(_NEAREST + """SELECT l.user_id, count(*) AS total, count(*) FILTER (WHERE gap > 3600) AS bad, round(count(*) FILTER (WHERE gap > 3600) / count(*), 6) AS ratio, round(median(gap) FILTER (WHERE gap > 3600), 3) AS bad_gap
FROM l LEFT JOIN c ON l.event_id = c.event_id AND rn = 1 GROUP BY 1""")
def sync_mismatch(spark, d):
    bad = F.col("gap") > 3600
    return _nearest(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("total"), A.count_where(bad).alias("bad"), F.round(F.count_if(bad) / F.count(F.lit(1)), 6).alias("ratio"), F.round(F.median(F.when(bad, F.col("gap"))), 3).alias("bad_gap"))


@query(f"""
WITH s AS (SELECT user_id, {SECONDS.format('ts')} AS t, avg(value) AS v FROM events GROUP BY 1, 2), b AS (SELECT user_id, min(t) AS t0, max(t) AS t1 FROM s GROUP BY 1),
p AS (SELECT user_id, t0 + unnest(range(0, CAST(floor((t1 - t0) / 86400.0::DOUBLE) AS BIGINT) + 1)) * 86400.0::DOUBLE AS t FROM b), q AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS k FROM p),
w AS (SELECT q.user_id, q.k, q.t, (SELECT max(s.t) FROM s WHERE s.user_id = q.user_id AND s.t <= q.t) AS tb, (SELECT min(s.t) FROM s WHERE s.user_id = q.user_id AND s.t >= q.t) AS ta FROM q)
SELECT w.user_id, k, round(CASE WHEN b.v IS NULL THEN a.v WHEN a.v IS NULL OR ta = tb THEN b.v ELSE b.v + (w.t - tb) / (ta - tb) * (a.v - b.v) END, 4) AS value
FROM w LEFT JOIN s a ON a.user_id = w.user_id AND a.t = ta LEFT JOIN s b ON b.user_id = w.user_id AND b.t = tb
""")
def interp_series(spark, d):
    """Each user's grid runs to their last time."""
    return _daily(spark, d, F.floor((F.max("t") - F.min("t")) / 86_400.0))


def _daily(spark, d, last):
    s = events(spark, d).groupBy("user_id", "t").agg(F.avg("value").alias("value"))
    grid = s.groupBy("user_id").agg(F.min("t").alias("t0"), last.cast("long").alias("last")).select("user_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("k"), "t0").withColumn("t", F.col("t0") + F.col("k") * 86_400.0)
    return O.interpolated(grid, s, ["user_id"], "t", "value", "k").select("user_id", "k", F.round("value", 4).alias("value"))


@query("""SELECT l_returnflag, round(CASE WHEN stddev_pop(l_quantity) < 1e-8 OR stddev_pop(l_extendedprice) < 1e-8 THEN 0.0 ELSE coalesce(covar_pop(l_quantity, l_extendedprice) / nullif(stddev_pop(l_quantity) * stddev_pop(l_extendedprice), 0), 0.0) END, 6) AS r,
  round(sqrt(avg(power(l_discount - l_tax, 2))), 6) AS rmse FROM lineitem GROUP BY 1""")
def pearson_guarded(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(A.pearson("l_quantity", "l_extendedprice"), 6).alias("r"), F.round(A.rmse("l_discount", "l_tax"), 6).alias("rmse"))


@query("""WITH d AS (SELECT event_id, user_id, coalesce(value - lag(value) OVER w, 0.0) AS d_value, coalesce(CAST(event_id AS DOUBLE) - lag(CAST(event_id AS DOUBLE)) OVER w, 0.0) AS d_x FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, round(d_value, 6) AS d_value, d_x, round(sqrt(d_value * d_value + d_x * d_x), 6) AS step FROM d""")
def displacement(spark, d):
    rows = events(spark, d).select("event_id", "user_id", "ts", "value", F.col("event_id").cast("double").alias("x"))
    return O.displacement(rows, ["user_id"], ["ts", "event_id"], ["value", "x"]).select("event_id", "user_id", F.round("d_value", 6).alias("d_value"), "d_x", F.round("step", 6).alias("step"))


@query(f"""
WITH f AS (SELECT user_id, {SECONDS.format('ts')} AS t, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS rn FROM events WHERE value IS NOT NULL) WHERE rn = 1),
s AS (SELECT user_id, t, t - lag(t) OVER w AS dt, abs(value - lag(value) OVER w) AS dv FROM f WINDOW w AS (PARTITION BY user_id ORDER BY t)), k AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS m FROM s WHERE dt > 0)
SELECT user_id, round(t - dt / 2, 3) AS mid, round(dv / dt, 8) AS speed FROM k WHERE m >= 3
""")
def derivative(spark, d):
    out = O.derivative(events(spark, d), ["user_id"], "t", "value", "event_id")
    return out.select("user_id", F.round("mid", 3).alias("mid"), F.round("speed", 8).alias("speed"))


@query("""SELECT o_custkey, o_orderkey, round(total, 2) AS total FROM (SELECT *, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS total FROM orders) WHERE total <= 500000""")
def capacity_prefix(spark, d):
    return O.capacity_prefix(table(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], "o_totalprice", 500_000.0).select("o_custkey", "o_orderkey", F.round("total", 2).alias("total"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders WHERE o_totalprice > 1000) WHERE rn = 1")
def one_per_group(spark, d):
    return O.first_of_group(table(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], F.col("o_totalprice") > 1000).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, hour(ts) AS hour, value > 50 AS bad FROM events), l AS (SELECT user_id, day, hour, min(event_id) AS lead_path FROM e GROUP BY ALL)
SELECT e.event_id, e.user_id, CAST(e.hour AS INTEGER) AS hour, l.lead_path, coalesce(x.bad, true) AS escalate FROM e JOIN l USING (user_id, day, hour) JOIN e x ON x.event_id = l.lead_path""")
def group_representative(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), (F.col("value") > 50).alias("bad"))
    return O.representatives(rows, ["user_id", "day", "hour"], "event_id", "bad").select("event_id", "user_id", "hour", "lead_path", "escalate")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def first_wins_dedupe(spark, d):
    return O.first_of_group(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("WITH n AS (SELECT *, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS number, count(*) OVER () AS total FROM part) SELECT p_partkey, p_retailprice, number FROM n WHERE number IN (SELECT CAST(floor(i * total / 100.0) AS BIGINT) FROM range(100) r(i), (SELECT max(total) AS total FROM n))")
def even_sample(spark, d):
    return O.even_sample(table(spark, d, "part").select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], 100).select("p_partkey", "p_retailprice", "number")


@query("""WITH p AS (SELECT l_orderkey * 10 + l_linenumber AS k, round(l_discount + 0.01 * (l_partkey % 97) / 97, 9) AS p FROM lineitem), r AS (SELECT k, p, CAST(count(*) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING) AS BIGINT) AS last_rank, count(*) OVER () AS n FROM p),
c AS (SELECT max(p) AS cut FROM r WHERE p <= last_rank / n * 0.05) SELECT k, p, last_rank, coalesce(p <= cut, false) AS passes FROM r, c""")
def fdr(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.round(F.col("l_discount") + 0.01 * (F.col("l_partkey") % 97) / 97, 9).alias("p"))
    return A.benjamini_hochberg(rows, "k", "p", 0.05)


@query("SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 200 AS chunk FROM customer")
def chunk_ids(spark, d):
    return O.chunk_ids(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], 200).select("c_custkey", "chunk")


_NAMES = ("ASIA", "AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST")


@query("""WITH n AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'left' WHEN 1 THEN 'Left' WHEN 2 THEN 'rigth' WHEN 3 THEN 'wall' WHEN 4 THEN 'cam_lefft' WHEN 5 THEN 'fix_head' ELSE p_brand END AS name FROM part),
b AS (SELECT *, regexp_replace(regexp_replace(lower(trim(name)), '^cam_', ''), '^fix_', '') AS bare FROM n),
k AS (SELECT *, least(levenshtein(bare, 'head'), levenshtein(bare, 'left'), levenshtein(bare, 'right')) AS d FROM b)
SELECT p_partkey, name, CASE WHEN bare IN ('head', 'left', 'right') THEN bare WHEN bare = 'wall' THEN 'head' WHEN bare = 'rigth' THEN 'right' WHEN d > 2 THEN NULL
  WHEN levenshtein(bare, 'head') = d THEN 'head' WHEN levenshtein(bare, 'left') = d THEN 'left' ELSE 'right' END AS resolved FROM k""")
def name_resolution(spark, d):
    k = F.col("p_partkey") % 7
    name = F.when(k == 0, "left").when(k == 1, "Left").when(k == 2, "rigth").when(k == 3, "wall").when(k == 4, "cam_lefft").when(k == 5, "fix_head").otherwise(F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", name.alias("name")).withColumn("resolved", X.resolve_name(F.col("name"), prefixes=("cam_", "fix_")))


@query("WITH m AS (SELECT CASE WHEN event_id % 4 = 0 THEN event_type ELSE '[' || event_type || '] value' END AS msg FROM events) SELECT coalesce(nullif(regexp_extract(msg, '^\\[([^\\]]+)\\]', 1), ''), 'other') AS value, count(*) AS n FROM m GROUP BY 1 ORDER BY n DESC, value LIMIT 5")
def tag_topk(spark, d):
    msg = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.concat(F.lit("["), "event_type", F.lit("] value")))
    return A.top_values(table(spark, d, "events"), X.tag(msg), 5)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract(props, '$.missing') IS NULL AS missing FROM events")
def json_extract(spark, d):
    v = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.try_variant_get(v, "$.missing", "string").isNull().alias("missing"))


@query("""WITH n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'session_x' ELSE 'session_' || strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '3015' END AS name FROM orders)
SELECT o_orderkey, name, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(epoch(strptime(substr(name, 9), '%Y%m%d_%H%M%S')) AS BIGINT) END AS at FROM n""")
def name_timestamp(spark, d):
    k = F.col("o_orderkey")
    name = F.when(k % 10 == 0, "session_x").otherwise(F.concat(F.lit("session_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit("3015")))
    return table(spark, d, "orders").select("o_orderkey", name.alias("name")).withColumn("at", F.unix_seconds(X.name_timestamp(F.col("name"))))


@query("""WITH c AS (SELECT c_custkey, 'operator ' || (c_custkey % 61) AS operator, CASE WHEN c_custkey % 3 = 0 THEN 'RIG-' || (c_custkey % 5) END AS code FROM customer),
n AS (SELECT *, c_custkey % 61 AS o, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 5 END AS own FROM c), r AS (SELECT *, CASE WHEN o <= 30 THEN o ELSE o - 30 END AS r FROM n)
SELECT c_custkey, CAST(r AS INTEGER) AS rig, CAST(CASE WHEN own IS NULL OR own = 1 THEN coalesce(r, own) ELSE own END AS INTEGER) AS config_rig FROM r""")
def rig_number(spark, d):
    k = F.col("c_custkey")
    op, code = F.concat(F.lit("operator "), (k % 61).cast("string")), F.when(k % 3 == 0, F.concat(F.lit("RIG-"), (k % 5).cast("string")))
    return table(spark, d, "customer").select("c_custkey", X.rig_number(op).alias("rig"), X.rig_of_config(code, F.lit(None).cast("string"), op).alias("config_rig"))


@query("""WITH q AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS c, CAST(embedding[4] AS DOUBLE) AS d FROM embeddings), n AS (SELECT *, sqrt(a*a+b*b+c*c+d*d) AS n FROM q),
u AS (SELECT vec_id, n, a/n AS w, b/n AS x, c/n AS y, d/n AS z FROM n)
SELECT vec_id, round(CASE WHEN n < 1e-6 THEN 0 ELSE degrees(atan2(2*(w*x+y*z), 1-2*(x*x+y*y))) END, 6) AS roll, round(CASE WHEN n < 1e-6 THEN 0 ELSE degrees(asin(greatest(-1.0, least(1.0, 2*(w*y-z*x))))) END, 6) AS pitch,
  round(CASE WHEN n < 1e-6 THEN 0 ELSE degrees(atan2(2*(w*z+x*y), 1-2*(y*y+z*z))) END, 6) AS yaw FROM u""")
def quat_euler(spark, d):
    e = X.euler_angles(F.col("embedding").cast("array<double>"))
    return table(spark, d, "embeddings").select("vec_id", *[F.round(e[k], 6).alias(k) for k in ("roll", "pitch", "yaw")])


@query(f"""WITH e AS (SELECT event_id, user_id, {SECONDS.format('ts')} AS t, min({SECONDS.format('ts')}) OVER (PARTITION BY user_id) AS t0, max({SECONDS.format('ts')}) OVER (PARTITION BY user_id) AS t1 FROM events)
SELECT event_id, round(t0 + (t - t0 + 12345.5) - floor((t - t0 + 12345.5) / (t1 - t0 + 1)) * (t1 - t0 + 1), 3) AS shifted FROM e""")
def circular_shift(spark, d):
    e = events(spark, d)
    ends = e.groupBy("user_id").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    return e.join(ends, "user_id").select("event_id", F.round(X.circular_shift(F.col("t"), F.col("t0"), F.lit(12345.5), F.col("t1") - F.col("t0") + 1), 3).alias("shifted"))


@query("SELECT l_orderkey, sha1(array_to_string(list_sort(list(l_linenumber || ':' || l_partkey)), '|')) AS fingerprint, count(*) AS files FROM lineitem GROUP BY 1")
def fingerprint(spark, d):
    return A.group_fingerprint(table(spark, d, "lineitem"), ["l_orderkey"], F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")))


@query("""WITH u AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS present FROM events GROUP BY 1)
SELECT user_id, array_to_string(list_sort(list_filter(['click', 'purchase', 'upload'], lambda x: NOT list_contains(present, x))), ',') AS missing, array_to_string(list_sort(list_filter(present, lambda x: NOT list_contains(['click', 'purchase', 'upload'], x))), ',') AS extra,
  array_to_string(list_sort(list_filter(present, lambda x: list_contains(['click', 'purchase', 'upload'], x))), ',') AS shared FROM u""")
def set_algebra(spark, d):
    return _sets(table(spark, d, "events"))


def _sets(events: DataFrame) -> DataFrame:
    want, have = F.array(*map(F.lit, ("click", "purchase", "upload"))), F.col("present")
    text = lambda a: F.array_join(F.array_sort(a), ",")
    u = events.groupBy("user_id").agg(F.collect_set("event_type").alias("present"))
    return u.select("user_id", text(F.array_except(want, have)).alias("missing"), text(F.array_except(have, want)).alias("extra"), text(F.array_intersect(want, have)).alias("shared"))


_UPSERT = "WITH o AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS bal FROM customer), n AS (SELECT c_custkey + 100 AS c_custkey, c_acctbal + 1 AS bal FROM customer) SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce({}, {}) AS bal FROM o FULL JOIN n ON o.c_custkey = n.c_custkey"


def _upsert(spark, d, keep_first):
    c = table(spark, d, "customer")
    old = c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("bal"))
    return L.upsert(old, c.select((F.col("c_custkey") + 100).alias("c_custkey"), (F.col("c_acctbal") + 1).alias("bal")), "c_custkey", ["bal"], keep_first)


@query(_UPSERT.format("o.bal", "n.bal"))
def upsert_keep_first(spark, d):
    return _upsert(spark, d, True)


@query(_UPSERT.format("n.bal", "o.bal"))
def upsert_overwrite(spark, d):
    return _upsert(spark, d, False)


@query("""SELECT doc_id, CASE WHEN s < 1024 THEN printf('%d B', s) WHEN s < 1048576 THEN printf('%.1f KB', round(round(s / 1024.0::DOUBLE, 6), 1)) WHEN s < 1073741824 THEN printf('%.1f MB', round(round(s / 1048576.0::DOUBLE, 6), 1)) ELSE printf('%.1f GB', round(round(s / 1073741824.0::DOUBLE, 6), 1)) END AS size,
  printf('%dh%02d', s // 3600, (s % 3600) // 60) AS hm FROM (SELECT doc_id, n_chars * 1000 AS s FROM documents)""")
def size_format(spark, d):
    s = F.col("n_chars") * 1000
    return table(spark, d, "documents").select("doc_id", X.format_size(s).alias("size"), X.hours_minutes(s).alias("hm"))


# --- streams over the events table, run to the end of what is there ---


def _events_stream(spark, d):
    from sessionloom.streaming import watch

    schema = table(spark, d, "events").schema
    return watch.file_stream(spark, d, schema, "events.parquet")


def _shared(spark: SparkSession) -> str:
    """A folder of our own that driver and executors share."""
    return fresh(spark, "stream")


@query("SELECT DISTINCT user_id FROM events")
def stream_dedupe(spark, d):
    from sessionloom.streaming import watch

    out = _shared(spark)
    watch.drain(watch.never_twice(_events_stream(spark, d).select("user_id"), ["user_id"]), lambda b, k: b.write.mode("overwrite").parquet(f"{out}/data/batch={k}"), f"{out}/state")
    return spark.read.parquet(f"{out}/data").select("user_id")


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, max(value) AS largest FROM events GROUP BY 1")
def stream_running_kpi(spark, d):
    from sessionloom.streaming import watch

    out = _shared(spark)
    watch.drain(watch.running_totals(_events_stream(spark, d), "event_type", "value"), lambda b, k: b.write.mode("overwrite").parquet(f"{out}/data"), f"{out}/state", "complete")
    return spark.read.parquet(f"{out}/data").select("event_type", "n", F.round("total", 2).alias("total"), "largest")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) GROUP BY 1")
def stream_unprocessed(spark, d):
    """Orders as a stream, of which each customer's first counts; customers divisible by 3 were handled before."""
    from sessionloom.streaming import stateful, watch

    out = _shared(spark)
    before = spark.conf.get(stateful.PROVIDER[0], None)
    stateful.with_rocksdb(spark)
    try:
        stream = watch.file_stream(spark, d, table(spark, d, "orders").schema, "orders.parquet").select("o_custkey", "o_orderkey")
        seed = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"))
        watch.drain(stateful.unprocessed(stream, "o_custkey", "o_orderkey", seed), lambda b, k: b.write.mode("overwrite").parquet(f"{out}/data/batch={k}"), f"{out}/state")
    finally:
        spark.conf.unset(stateful.PROVIDER[0]) if before is None else spark.conf.set(stateful.PROVIDER[0], before)
    return spark.read.parquet(f"{out}/data").select("o_custkey", "o_orderkey")


@query("""WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events), l AS (SELECT 'u' || user_id AS name, k * 30.0 AS observed_at, k // 3 AS size FROM e),
g AS (SELECT name, size, min(observed_at) AS since, max(observed_at) AS last FROM l GROUP BY 1, 2) SELECT name, CAST(size AS BIGINT) AS size, CAST(since AS DOUBLE) AS since FROM g WHERE last - since >= 60""")
def stability_gate(spark, d):
    """Each user's events as listings 30 seconds apart of a file that grows with every third."""
    from pyspark.sql import Window

    from sessionloom.streaming import watch

    k = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    seen = table(spark, d, "events").withColumn("k", k).select(F.concat(F.lit("u"), "user_id").alias("name"), F.floor(F.col("k") / 3).alias("size"), F.lit(0.0).alias("mtime"), (F.col("k") * 30.0).alias("observed_at"))
    out = _shared(spark)
    seen.write.parquet(f"{out}/seen")
    stream = spark.readStream.schema(spark.read.parquet(f"{out}/seen").schema).parquet(f"{out}/seen")
    watch.drain(watch.stability_gate(stream, 60.0), lambda b, i: b.write.mode("overwrite").parquet(f"{out}/data/batch={i}"), f"{out}/state")
    return spark.read.parquet(f"{out}/data").select("name", "size", "since")


# --- JSON line streams made of the events, a file for each hour of the day ---

_LINES = """WITH e AS (SELECT hour(ts) AS h, event_id, row_number() OVER (PARTITION BY hour(ts) ORDER BY event_id) - 1 AS n FROM events), f AS (SELECT *, n % 97 = 96 AND h % 2 = 0 AS bad FROM e), b AS (SELECT h, min(n) FILTER (WHERE bad) AS first FROM f GROUP BY 1)
SELECT f.h, n AS lineno, event_id AS frame_index, event_id * 2.0::DOUBLE AS ts_ms FROM f JOIN b USING (h) WHERE {} AND n % 5 > 0"""


def _line_stream(spark, d, until_error):
    """Every fifth line has no time, and some even hours' lines are cut off."""
    from sessionloom.sources import documents

    out = _shared(spark)
    e = table(spark, d, "events").select(F.hour("ts").alias("h"), "event_id")
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("h").orderBy("event_id")) - 1
    text = F.when((F.col("n") % 97 == 96) & (F.col("h") % 2 == 0), '{"frame_index": 1, "capt').when(F.col("n") % 5 == 0, F.format_string('{"frame_index": %d}', "event_id"))
    text = text.when(F.col("n") % 2 == 0, F.format_string('{"frame_index": %d, "capture_time": %d}', "event_id", F.col("event_id") * 2)).otherwise(F.format_string('{"capture_timestamp_sec": %d.%03d, "frame_index": %d}', F.floor(F.col("event_id") * 2 / 1000), F.col("event_id") * 2 % 1000, "event_id"))
    e.withColumn("n", n).select("h", "event_id", text.alias("line")).repartition("h").sortWithinPartitions("h", "event_id").select("h", "line").write.partitionBy("h").text(out)
    rows = documents.timestamps_ms(documents.lines(spark, [out]), until_error)
    return rows.select(F.regexp_extract("path", "/h=([0-9]+)/", 1).cast("long").alias("h"), "lineno", "frame_index", F.round("ts_ms", 6).alias("ts_ms"))


@query(_LINES.format("n < coalesce(first, n + 1)"))
def line_timestamps(spark, d):
    return _line_stream(spark, d, True)


@query(_LINES.format("first IS NULL"))
def line_timestamps_strict(spark, d):
    return _line_stream(spark, d, False)


@query("SELECT l_returnflag, l_linestatus, median(CASE WHEN l_orderkey % 5 > 0 THEN l_extendedprice END) AS median FROM lineitem GROUP BY 1, 2")
def exact_medians(spark, d):
    """Groups of more than 1,000 values are counted in cells."""
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.when(F.col("l_orderkey") % 5 > 0, F.col("l_extendedprice")).alias("v"))
    return A.exact_medians(rows, ["l_returnflag", "l_linestatus"], "v", most=1_000)


# --- order-dependent operators on bounded groups ---


@query("""WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
r AS (SELECT o_custkey, o_orderkey, k, o_totalprice <= 400000 AS taken, CASE WHEN o_totalprice <= 400000 THEN o_totalprice ELSE 0 END AS total FROM o WHERE k = 1
  UNION ALL SELECT o.o_custkey, o.o_orderkey, o.k, total + o_totalprice <= 400000, CASE WHEN total + o_totalprice <= 400000 THEN total + o_totalprice ELSE total END FROM o JOIN r ON o.o_custkey = r.o_custkey AND o.k = r.k + 1)
SELECT o_custkey, o_orderkey FROM r WHERE taken""")
def skip_capacity(spark, d):
    from sessionloom.operators.grouped import skip_capacity as run

    return run(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderkey", "o_totalprice", 400_000.0).select("o_custkey", "o_orderkey")


# --- composites ---


@query("""WITH s AS (SELECT o_orderkey AS session, o_orderkey % 9 = 0 AS delivered, o_orderkey % 5 > 0 AS a, o_orderkey % 7 > 0 AS b, o_orderkey % 4 AS findings, o_orderkey % 11 = 0 AS anomaly, o_orderkey % 6 = 0 AS issue FROM orders),
t AS (SELECT *, CASE WHEN a AND b AND findings = 0 AND NOT anomaly THEN 'OK' ELSE 'ANOMALY' END AS status FROM s)
SELECT session, status, CASE WHEN delivered THEN 'skip_move' WHEN status = 'OK' AND NOT issue THEN 'send' WHEN status = 'OK' THEN 'hold' ELSE 'quarantine' END AS action FROM t""")
def post_pipeline(spark, d):
    from sessionloom.plans.sessions import post_pipeline as run

    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(k.alias("session"), (k % 9 == 0).alias("delivered"), F.lit(False).alias("error"), (k % 5 > 0).alias("integrity_ok"), (k % 7 > 0).alias("sync_ok"), (k % 4).alias("findings"), (k % 11 == 0).alias("charuco_anomaly"), F.lit("same").alias("lr_verdict"), F.when(k % 6 == 0, F.array(F.lit("x"))).alias("issues"))
    return run(rows).select("session", "status", "action")


@query("""WITH k AS (SELECT c_custkey, 'session_20240' || (1 + c_custkey % 3) || '15_' || lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 3600 // 60 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') AS name, c_custkey % 24 AS h, c_custkey % 3 AS m, c_custkey % 4 AS rig, CAST(1000 + c_custkey AS BIGINT) AS size FROM customer),
v AS (SELECT *, sum(size) OVER (ORDER BY name ROWS UNBOUNDED PRECEDING) AS total FROM k WHERE m = 1 AND h >= 7 AND rig = 2 AND c_custkey % 5 > 0) SELECT name, size AS size_bytes FROM v WHERE total <= 60000""")
def daily_batch(spark, d):
    from sessionloom.plans.sessions import daily_batch as run

    k = F.col("c_custkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    name = F.concat(F.lit("session_20240"), (1 + k % 3).cast("string"), F.lit("15_"), two(k % 24), two(F.floor(k % 3600 / 60)), two(k % 60))
    rows = table(spark, d, "customer").select(name.alias("name"), F.concat(F.lit("RIG-"), (k % 4).cast("string")).alias("rig_code"), F.lit(None).cast("string").alias("rig_id"), F.lit("none").alias("operator"), (k % 5 > 0).alias("valid"), (1000 + k).cast("long").alias("size_bytes"))
    return run(rows, "2024-02-15", 2, cap_bytes=60_000).select("name", "size_bytes")
