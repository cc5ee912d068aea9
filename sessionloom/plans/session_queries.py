"""Checks, decisions, names, poses and reports on fixture columns of the driver's tables, each with its rule in DuckDB SQL.

A fixture is a list of expressions that Spark and DuckDB read alike, so both sides see the same inputs with nulls and boundary
values; the SQL beside it states the rule on its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions import scalars as X
from sessionloom.operators import aggregates as A
from sessionloom.operators import grouped as G
from sessionloom.operators import ledger as L
from sessionloom.operators import ordered as O
from sessionloom.plans import checks as C
from sessionloom.plans import reports as R
from sessionloom.plans import sessions as P
from sessionloom.session import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


class Fixture:
    """Rows of a table by expressions that both engines read."""

    def __init__(self, source: str, *columns: str, where: str = "true"):
        self.source, self.columns, self.where = source, columns, where
        self.sql = f"SELECT {', '.join(columns)} FROM {source} WHERE {where}"

    def __call__(self, spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, self.source).where(self.where).selectExpr(*self.columns)


def listed(c: str) -> F.Column:
    """A comma-separated text as an array; an empty one has nothing, null stays null."""
    return F.when(F.col(c).isNull(), None).otherwise(F.filter(F.split(c, ","), lambda x: x != ""))


def listed_sql(c: str) -> str:
    return f"list_filter(string_split({c}, ','), lambda x: x <> '')"


def r1(x: str) -> str:
    return f"round(round({x}, 6), 1)"


def grade_sql(x: str) -> str:
    return f"CASE WHEN {x} >= 85 THEN 'A' WHEN {x} >= 70 THEN 'B' WHEN {x} >= 55 THEN 'C' WHEN {x} >= 40 THEN 'D' WHEN {x} IS NOT NULL THEN 'F' END"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- scores ---

_FULL = Fixture(
    "orders", "o_orderkey AS session", "CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 240) / 10e0 END AS max_drift", "CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 20) / 10e0 END AS fps_spread",
    "CASE WHEN o_orderkey % 7 > 0 THEN (o_orderkey % 31) / 1e0 END AS worst_drop_pct", "CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 4 END AS severe_drops", "CASE WHEN o_orderkey % 11 > 0 THEN (o_orderkey % 40) / 10e0 END AS max_local_std",
    "CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 60) / 2e0 END AS gap_pct", "o_orderkey % 3 AS queue_drops", "CASE WHEN o_orderkey % 6 > 0 THEN (o_orderkey % 11) / 10e0 END AS any_rate", "o_orderkey % 2 AS poses",
    "(o_orderkey % 5) / 4e0 AS left_rate", "(o_orderkey % 7) / 6e0 AS right_rate", "o_orderkey % 13 > 0 AS vision", "CASE WHEN o_orderkey % 9 > 0 THEN (o_orderkey % 21) / 20e0 END AS imu_ratio", "o_orderkey % 6 AS checks_ok", "5 AS checks_total",
    "CASE WHEN o_orderkey % 8 > 0 THEN (o_orderkey % 101) / 100e0 END AS overlap", "CASE WHEN o_orderkey % 10 > 0 THEN o_orderkey % 3 > 0 END AS duration_ok",
)


@query(f"""
WITH s AS ({_FULL.sql}), v AS (SELECT *, CASE WHEN vision THEN any_rate END AS a, CASE WHEN vision THEN poses ELSE 0 END AS p, CASE WHEN vision THEN left_rate ELSE 0 END AS l, CASE WHEN vision THEN right_rate ELSE 0 END AS r,
    CASE WHEN vision THEN imu_ratio END AS i, CASE WHEN worst_drop_pct IS NULL THEN 50 ELSE greatest(0, 100 - 4 * worst_drop_pct - 3 * severe_drops) END AS d, CASE WHEN max_local_std IS NULL THEN 50 ELSE greatest(0, 100 - 30 * max_local_std) END AS t FROM s),
c AS (SELECT session, {r1("CASE WHEN max_drift IS NOT NULL THEN greatest(0, 100 - 5 * max_drift) WHEN fps_spread IS NOT NULL THEN greatest(0, 100 - 60 * fps_spread) ELSE 50e0 END")} AS sync,
    {r1("CASE WHEN gap_pct IS NULL THEN 0.65e0 * d + 0.35e0 * t ELSE 0.45e0 * d + 0.25e0 * t + 0.30e0 * greatest(0, 100 - 2 * gap_pct - 5 * queue_drops) END")} AS stability,
    {r1("CASE WHEN a IS NOT NULL THEN 100 * a WHEN p > 0 THEN 20e0 ELSE 0e0 END")} AS detectability, {r1("CASE WHEN l > 0 AND r > 0 THEN 100e0 * least(l, r) / greatest(l, r) WHEN l > 0 OR r > 0 THEN 25e0 ELSE 0e0 END")} AS coverage,
    {r1("coalesce(100 * i, 0e0)")} AS imu, {r1("100e0 * checks_ok / 5")} AS integrity, {r1("coalesce(100 * overlap, 50e0)")} AS temporal, CASE WHEN duration_ok IS NULL THEN 50e0 WHEN duration_ok THEN 100e0 ELSE 0e0 END AS duration FROM v),
t AS (SELECT *, {r1("sync * 0.20e0 + stability * 0.20e0 + detectability * 0.20e0 + coverage * 0.10e0 + imu * 0.10e0 + integrity * 0.08e0 + temporal * 0.07e0 + duration * 0.05e0")} AS score FROM c)
SELECT *, {grade_sql("score")} AS grade FROM t""")
def full_score(spark, d):
    return P.full_score(_FULL(spark, d)).select("session", *P.WEIGHTS, "score", "grade")


_WATCH = Fixture(
    "orders", "o_orderkey AS session", "CASE WHEN o_orderkey % 6 > 0 THEN (o_orderkey % 250) / 10e0 END AS max_drift", "CASE WHEN o_orderkey % 7 = 0 THEN 0e0 WHEN o_orderkey % 7 > 1 THEN 1000e0 END AS expected_frames", "(o_orderkey % 90) / 1e0 AS gap_frames",
    "o_orderkey % 11 AS queue_drops", "CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 13 > 0 END AS sync_ok", "CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 17) / 100e0 END AS sync_delta", "CASE WHEN o_orderstatus = 'P' THEN 'x' END AS error",
)


def _watch(spark, d):
    return _WATCH(spark, d).withColumn("errors", F.when(F.col("error").isNotNull(), F.array("error")))


@query(f"""
WITH s AS ({_WATCH.sql}), c AS (SELECT session, error, CASE WHEN max_drift IS NULL THEN 50e0 ELSE greatest(0, 100 - 5 * max_drift) END AS sync,
    CASE WHEN expected_frames IS NULL THEN 50e0 ELSE greatest(0, 100 - 2 * (CASE WHEN expected_frames > 0 THEN 100e0 * gap_frames / expected_frames ELSE 0e0 END) - 5 * queue_drops) END AS fps,
    CASE WHEN coalesce(sync_ok, true) THEN greatest(0, 100 - 300 * coalesce(sync_delta, 0e0)) ELSE greatest(0, 30 - 100 * coalesce(sync_delta, 0e0)) END AS cam_sensor FROM s),
t AS (SELECT *, CASE WHEN error IS NOT NULL THEN 0e0 ELSE {r1("0.40e0 * sync + 0.35e0 * fps + 0.25e0 * cam_sensor")} END AS score FROM c)
SELECT session, round(sync, 6) AS sync, round(fps, 6) AS fps, round(cam_sensor, 6) AS cam_sensor, score, {grade_sql("score")} AS grade FROM t""")
def watch_score(spark, d):
    return rounded(P.watch_score(_watch(spark, d)).select("session", "sync", "fps", "cam_sensor", "score", "grade"), "sync", "fps", "cam_sensor")


@query(f"""
WITH s AS ({_WATCH.sql}), c AS (SELECT session, error, CASE WHEN max_drift IS NULL THEN 50e0 ELSE greatest(0, 100 - 5 * max_drift) END AS sync,
    CASE WHEN expected_frames IS NULL THEN 50e0 WHEN expected_frames > 0 THEN greatest(0, 100 - 1.5e0 * (100e0 * gap_frames / expected_frames) - least(0.2e0 * (100e0 * queue_drops / expected_frames), 10)) ELSE 100e0 END AS fps,
    CASE WHEN coalesce(sync_ok, true) THEN greatest(0, 100 - 200 * coalesce(sync_delta, 0e0)) ELSE greatest(0, 20 - 100 * coalesce(sync_delta, 0e0)) END AS cam_sensor FROM s),
t AS (SELECT *, CASE WHEN error IS NOT NULL THEN 0e0 ELSE {r1("0.40e0 * sync + 0.35e0 * fps + 0.25e0 * cam_sensor")} END AS score FROM c)
SELECT session, CASE WHEN session % 4 = 0 THEN 'retry' ELSE 'scored' END AS state, CASE WHEN session % 4 > 0 THEN score END AS score, CASE WHEN session % 4 > 0 THEN {grade_sql("score")} END AS grade,
    CASE WHEN session % 4 > 0 THEN session * 10 END AS size_bytes, CASE WHEN session % 4 > 0 THEN greatest(session % 50, session % 60) / 1e0 END AS duration FROM t""")
def watch_evaluation(spark, d):
    rows = _watch(spark, d).withColumns({"readable": F.expr("session % 4 > 0"), "size_bytes": F.col("session") * 10, "durations": F.expr("map('a', session % 50 / 1e0, 'b', session % 60 / 1e0)")})
    return C.watch_evaluation(rows)


# --- left and right ---

_FOUR = Fixture("customer", "c_custkey AS session", "(c_custkey % 21 - 10) / 10e0 AS ll", "(c_custkey % 11) / 10e0 AS rr", "(c_custkey % 13) / 12e0 AS lr", "CASE WHEN c_custkey % 17 > 0 THEN (c_custkey % 19 - 9) / 9e0 END AS rl", "c_custkey % 6 > 0 AS enough")
_PAIRING = """CASE WHEN NOT enough OR (greatest(abs(ll), abs(rr)) < 0.8 AND greatest(abs(lr), coalesce(abs(rl), 0)) < 0.8) OR abs((abs(ll) + abs(rr)) - (abs(lr) + coalesce(abs(rl), 0))) < 0.3 THEN 'inconclusive'
    WHEN abs(ll) + abs(rr) > abs(lr) + coalesce(abs(rl), 0) THEN 'same' ELSE 'swap' END"""


def _pairing(spark, d):
    return _FOUR(spark, d).withColumn("verdict", P.pairing_verdict(F.col("ll"), F.col("rr"), F.col("lr"), F.col("rl"), enough=F.col("enough")))


@query(f"WITH s AS ({_FOUR.sql}) SELECT session, {_PAIRING} AS verdict FROM s")
def pairing_verdict(spark, d):
    return _pairing(spark, d).select("session", "verdict")


@query(f"WITH s AS ({_FOUR.sql}), v AS (SELECT *, {_PAIRING} AS verdict, abs(ll) + abs(rr) - abs(lr) - coalesce(abs(rl), 0) AS margin FROM s) SELECT count(*) FILTER (WHERE verdict = 'same') AS same, count(*) FILTER (WHERE verdict = 'swap') AS swap, count(*) FILTER (WHERE verdict = 'inconclusive') AS inconclusive, count(*) FILTER (WHERE session % 5 = 0) AS robust, round(sum(margin), 6) AS margin_sum FROM v")
def verdict_totals(spark, d):
    size = lambda c: F.coalesce(F.abs(c), F.lit(0.0))
    return R.verdict_totals(_pairing(spark, d).withColumns({"margin": size("ll") + size("rr") - size("lr") - size("rl"), "robust": F.expr("session % 5 = 0")}))


@query(f"WITH s AS ({_FOUR.sql}), v AS (SELECT session, {_PAIRING} AS verdict FROM s WHERE session IS NOT NULL) SELECT session, unnest(['left', 'right']) AS name, unnest(['right', 'left']) AS target FROM v WHERE verdict = 'swap'")
def side_swaps(spark, d):
    return C.side_swaps(_pairing(spark, d))


_SECONDS = "epoch_us(ts) / 1000000e0"


def _series(spark, d, names: dict[str, str], unit: float) -> DataFrame:
    """One value for each user, series and time."""
    kind = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("event_type")]
    rows = table(spark, d, "events").select("user_id", kind.alias("series"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / unit).alias("t"), F.col("value").alias("v")).where("series is not null")
    return rows.groupBy("user_id", "series", "t").agg(F.avg("v").alias("v"))


def _series_sql(names: dict[str, str], unit: float) -> str:
    """ev: the same series; seg: each with the point after it; ends: first and last point."""
    kind = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"
    return f"""ev AS (SELECT user_id, {kind} AS series, {_SECONDS} / {unit}e0 AS t, avg(value) AS v FROM events GROUP BY ALL HAVING {kind} IS NOT NULL),
seg AS (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM ev WINDOW w AS (PARTITION BY user_id, series ORDER BY t)),
ends AS (SELECT user_id, series, min(t) AS t0, max(t) AS t1, count(*) AS n, min_by(v, t) AS first_v FROM ev GROUP BY ALL)"""


def _at(points: str, series: str, alias: str) -> str:
    """points (user_id, x, …) with the interpolated value of a series: held at both ends."""
    return f"""{alias} AS (SELECT p.*, CASE WHEN s.t IS NULL THEN e.first_v WHEN s.t2 IS NULL THEN s.v ELSE s.v + (p.x - s.t) / (s.t2 - s.t) * (s.v2 - s.v) END AS y
FROM {points} p JOIN ends e ON e.user_id = p.user_id AND e.series = {series} ASOF LEFT JOIN seg s ON s.user_id = p.user_id AND s.series = {series} AND s.t <= p.x)"""


_LAG = {"purchase": "a", "click": "b"}


@query(f"""
WITH {_series_sql(_LAG, 86400)}, g AS (SELECT a.user_id, greatest(a.t0, b.t0) AS lo, least(a.t1, b.t1) AS hi FROM ends a JOIN ends b ON a.user_id = b.user_id AND a.series = 'a' AND b.series = 'b' WHERE least(a.n, b.n) >= 5),
pts AS (SELECT user_id, i, lo + i * 0.5e0 AS x FROM (SELECT *, unnest(range(0, CAST(ceil((hi - lo) / 0.5e0) AS BIGINT))) AS i FROM g WHERE hi > lo)), {_at("pts", "'a'", "av")},
lagged AS (SELECT user_id, i, k, x - (k - 6) * 0.5e0 AS x FROM pts, range(13) r(k)), {_at("lagged", "'b'", "bv")},
r AS (SELECT a.user_id, k, CASE WHEN stddev_pop(a.y) < 1e-9 OR stddev_pop(b.y) < 1e-9 THEN 0 ELSE covar_pop(a.y, b.y) / (stddev_pop(a.y) * stddev_pop(b.y)) END AS r FROM av a JOIN bv b USING (user_id, i) GROUP BY ALL),
best AS (SELECT user_id, arg_max(k, (round(abs(r), 9), -k)) AS k, arg_max(r, (round(abs(r), 9), -k)) AS r FROM r GROUP BY 1)
SELECT u.user_id, CASE WHEN best.r IS NULL OR best.r = 0 THEN 0e0 ELSE (k - 6) * 0.5e0 END AS lag, round(coalesce(r, 0e0), 6) AS r FROM (SELECT DISTINCT user_id FROM ev) u LEFT JOIN best USING (user_id)""")
def best_lag(spark, d):
    return rounded(G.best_lag(_series(spark, d, _LAG, 86_400), "user_id", "a", "b", 0.5, 3.0, 0.5), "r")


_PAIRS4 = {"purchase": "video_left", "click": "video_right", "view": "sensor_left", "signup": "sensor_right"}


@query(f"""
WITH {_series_sql(_PAIRS4, 86400)}, p(v, s) AS (VALUES ('video_left', 'sensor_left'), ('video_left', 'sensor_right'), ('video_right', 'sensor_left'), ('video_right', 'sensor_right')),
g AS (SELECT a.user_id, p.v, p.s, greatest(a.t0, b.t0) AS lo, least(a.t1, b.t1) AS hi FROM p JOIN ends a ON a.series = p.v JOIN ends b ON b.series = p.s AND b.user_id = a.user_id WHERE least(a.n, b.n) >= 5),
pts AS (SELECT user_id, v, s, i, lo + i * 1e0 AS x FROM (SELECT *, unnest(range(0, CAST(ceil(hi - lo) AS BIGINT))) AS i FROM g WHERE hi > lo)), {_at("pts", "p.v", "av")},
lagged AS (SELECT user_id, v, s, i, k, x - (k - 2) * 1e0 AS x FROM pts, range(5) r(k)), {_at("lagged", "p.s", "bv")},
r AS (SELECT a.user_id, a.v, a.s, k, CASE WHEN stddev_pop(a.y) < 1e-9 OR stddev_pop(b.y) < 1e-9 THEN 0 ELSE covar_pop(a.y, b.y) / (stddev_pop(a.y) * stddev_pop(b.y)) END AS r FROM av a JOIN bv b USING (user_id, v, s, i) GROUP BY ALL),
best AS (SELECT user_id, v, s, arg_max(r, (round(abs(r), 9), -k)) AS r FROM r GROUP BY ALL),
w AS (SELECT u.user_id, coalesce(max(r) FILTER (WHERE v = 'video_left' AND s = 'sensor_left'), 0) AS ll, coalesce(max(r) FILTER (WHERE v = 'video_left' AND s = 'sensor_right'), 0) AS lr, coalesce(max(r) FILTER (WHERE v = 'video_right' AND s = 'sensor_left'), 0) AS rl,
    coalesce(max(r) FILTER (WHERE v = 'video_right' AND s = 'sensor_right'), 0) AS rr FROM (SELECT DISTINCT user_id FROM ev) u LEFT JOIN best USING (user_id) GROUP BY 1),
n AS (SELECT user_id, coalesce(bool_and(n >= 10 AND t1 - t0 >= 3), false) AND count(*) = 2 AS enough FROM ends WHERE series IN ('video_left', 'video_right') GROUP BY 1)
SELECT w.user_id, round(ll, 6) AS r_ll, round(lr, 6) AS r_lr, round(rl, 6) AS r_rl, round(rr, 6) AS r_rr, {_PAIRING.replace("NOT enough", "NOT coalesce(enough, false)")} AS verdict FROM w LEFT JOIN n USING (user_id)""")
def full_pairing(spark, d):
    out = P.full_pairing(_series(spark, d, _PAIRS4, 86_400), "user_id", grid_step=1.0, reach=2.0, lag_step=1.0, least_points=10)
    return rounded(out, "r_ll", "r_lr", "r_rl", "r_rr").select("user_id", "r_ll", "r_lr", "r_rl", "r_rr", "verdict")


@query(f"""
WITH {_series_sql(_PAIRS4, 86400)}, sp AS (SELECT user_id, series, (t + t2) / 2 AS t, abs(v2 - v) / (t2 - t) AS v FROM seg JOIN ends USING (user_id, series) WHERE series LIKE 'sensor%' AND t2 IS NOT NULL AND n >= 4),
se AS (SELECT user_id, series, min(t) AS t0, max(t) AS t1, count(*) AS n FROM sp GROUP BY ALL),
ok AS (SELECT user_id FROM (SELECT user_id, n FROM se UNION ALL SELECT user_id, n FROM ends WHERE series LIKE 'video%') GROUP BY 1 HAVING count(*) = 4 AND min(n) >= 5), per AS (SELECT user_id, min(t1 - t0) AS period FROM se JOIN ok USING (user_id) GROUP BY 1),
dr AS (SELECT user_id, -1 AS d, 0e0 AS shift FROM per UNION ALL SELECT user_id, d, 1 + (('0x' || substr(md5(user_id || ':' || d), 1, 8))::BIGINT / 4294967296e0) * (period - 2) FROM per, range(20) r(d) WHERE period > 2),
mv AS (SELECT sp.user_id, d, sp.series, sp.t AS orig, CASE WHEN d < 0 THEN sp.t ELSE se.t0 + (sp.t - se.t0 + shift) % (se.t1 - se.t0) END AS t, sp.v FROM dr JOIN sp USING (user_id) JOIN se ON se.user_id = sp.user_id AND se.series = sp.series),
ms AS (SELECT * FROM (SELECT *, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM mv WINDOW w AS (PARTITION BY user_id, d, series ORDER BY t, orig)) WHERE t2 IS NULL OR t2 > t), me AS (SELECT user_id, d, series, min(t) AS t0, max(t) AS t1, arg_min(v, (t, orig)) AS first_v FROM mv GROUP BY ALL),
p(v, s) AS (VALUES ('video_left', 'sensor_left'), ('video_left', 'sensor_right'), ('video_right', 'sensor_left'), ('video_right', 'sensor_right')),
g AS (SELECT a.user_id, b.d, p.v, p.s, greatest(a.t0, b.t0) AS lo, least(a.t1, b.t1) AS hi FROM p JOIN ends a ON a.series = p.v JOIN me b ON b.series = p.s AND b.user_id = a.user_id),
pts AS (SELECT user_id, d, v, s, i, lo + i * 1e0 AS x FROM (SELECT *, unnest(range(0, CAST(ceil(hi - lo) AS BIGINT))) AS i FROM g WHERE hi > lo AND hi - lo >= 2)),
av AS (SELECT p.*, CASE WHEN s.t IS NULL THEN e.first_v WHEN s.t2 IS NULL THEN s.v ELSE s.v + (p.x - s.t) / (s.t2 - s.t) * (s.v2 - s.v) END AS y FROM (SELECT *, v AS series FROM pts) p JOIN ends e ON e.user_id = p.user_id AND e.series = p.v ASOF LEFT JOIN seg s ON s.user_id = p.user_id AND s.series = p.series AND s.t <= p.x),
lagged AS (SELECT user_id, d, v, s, i, k, x - (k - 2) * 1e0 AS x FROM pts, range(5) r(k)),
bv AS (SELECT p.user_id, p.d, p.v, p.s, p.i, p.k, CASE WHEN m.t IS NULL THEN e.first_v WHEN m.t2 IS NULL THEN m.v ELSE m.v + (p.x - m.t) / (m.t2 - m.t) * (m.v2 - m.v) END AS y FROM (SELECT *, s AS series FROM lagged) p JOIN me e ON e.user_id = p.user_id AND e.d = p.d AND e.series = p.s ASOF LEFT JOIN ms m ON m.user_id = p.user_id AND m.d = p.d AND m.series = p.series AND m.t <= p.x),
r AS (SELECT a.user_id, a.d, a.v, a.s, k, CASE WHEN stddev_pop(a.y) < 1e-9 OR stddev_pop(b.y) < 1e-9 THEN 0 ELSE covar_pop(a.y, b.y) / (stddev_pop(a.y) * stddev_pop(b.y)) END AS r FROM av a JOIN bv b USING (user_id, d, v, s, i) GROUP BY ALL),
best AS (SELECT user_id, d, v, s, max(abs(r)) AS r FROM r GROUP BY ALL), w AS (SELECT dr.user_id, dr.d, coalesce(sum(CASE WHEN substr(v, 7) = substr(s, 8) THEN r ELSE -r END), 0) AS margin FROM dr LEFT JOIN best ON best.user_id = dr.user_id AND best.d = dr.d GROUP BY 1, 2),
f AS (SELECT a.user_id, a.margin, (1 + count(b.d) FILTER (WHERE round(abs(b.margin) - abs(a.margin), 9) >= 0)) / (1 + count(b.d)) AS p FROM w a LEFT JOIN w b ON b.user_id = a.user_id AND b.d >= 0 WHERE a.d = -1 GROUP BY 1, 2)
SELECT user_id, round(margin, 6) AS margin, round(p, 9) AS p, CASE WHEN p >= 0.05 THEN 'inconclusive' WHEN margin > 0 THEN 'same' ELSE 'swap' END AS vote FROM f""")
def permutation_test(spark, d):
    out = G.permutation_test(_series(spark, d, _PAIRS4, 86_400), "user_id", draws=20, grid_step=1.0, reach=2.0, lag_step=1.0)
    return rounded(out, "margin").withColumn("p", F.round("p", 9))


_QUICK = Fixture("events", "user_id AS session", "CASE WHEN event_id % 2 = 0 THEN 'left' ELSE 'right' END AS side", "event_id AS sample_id", "event_id * 1e0 AS t", "CASE WHEN event_id % 11 > 0 THEN value END AS distance", "value + event_id % 5 AS opening", where="event_type = 'purchase'")
_SENSOR = Fixture("events", "user_id AS session", "CASE WHEN event_id % 2 = 0 THEN 'left' ELSE 'right' END AS side", "event_id * 1e0 AS t", "value AS opening", where="event_type = 'click'")


@query(f"""
WITH s AS ({_QUICK.sql}), o AS ({_SENSOR.sql}), seg AS (SELECT *, CASE WHEN side = 'left' THEN 'right' ELSE 'left' END AS other, lead(t) OVER w AS t2, lead(opening) OVER w AS o2, first_value(opening) OVER w AS o1, first_value(t) OVER w AS t1 FROM o WINDOW w AS (PARTITION BY session, side ORDER BY t)),
e AS (SELECT DISTINCT session, other, o1 FROM seg),
x AS (SELECT s.*, CASE WHEN g.t IS NULL THEN e.o1 WHEN g.t2 IS NULL THEN g.opening ELSE g.opening + (s.t - g.t) / (g.t2 - g.t) * (g.o2 - g.opening) END AS crossed FROM s LEFT JOIN e ON e.session = s.session AND e.other = s.side ASOF LEFT JOIN seg g ON g.session = s.session AND g.other = s.side AND g.t <= s.t),
c AS (SELECT session, side, count(distance) AS n, CASE WHEN count(distance) < 4 OR stddev_pop(distance) < 1e-9 OR stddev_pop(opening) FILTER (WHERE distance IS NOT NULL) < 1e-9 THEN 0 ELSE corr(distance, opening) END AS own,
    CASE WHEN count(distance) < 4 OR stddev_pop(distance) < 1e-9 OR stddev_pop(crossed) FILTER (WHERE distance IS NOT NULL) < 1e-9 THEN 0 ELSE coalesce(corr(distance, crossed), 0) END AS crs FROM x GROUP BY ALL),
w AS (SELECT session, max(own) FILTER (WHERE side = 'left') AS ll, max(own) FILTER (WHERE side = 'right') AS rr, max(crs) FILTER (WHERE side = 'left') AS lr, max(crs) FILTER (WHERE side = 'right') AS rl,
    coalesce(max(n) FILTER (WHERE side = 'left'), 0) AS nl, coalesce(max(n) FILTER (WHERE side = 'right'), 0) AS nr FROM c GROUP BY 1)
SELECT session, nl AS found_left, nr AS found_right, round(ll, 6) AS r_ll, round(rr, 6) AS r_rr, round(lr, 6) AS r_lr, round(rl, 6) AS r_rl, {_PAIRING.replace("NOT enough", "least(nl, nr) < 5").replace("abs(ll)", "coalesce(abs(ll), 0)").replace("abs(rr)", "coalesce(abs(rr), 0)").replace("abs(lr)", "coalesce(abs(lr), 0)")} AS verdict FROM w""")
def quick_pairing(spark, d):
    out = P.quick_pairing(_QUICK(spark, d), _SENSOR(spark, d))
    return rounded(out, "r_ll", "r_rr", "r_lr", "r_rl")


_FLOW = {"purchase": "gripper", "click": "flow"}


@query(f"""
WITH {_series_sql(_FLOW, 600)}, g AS (SELECT a.user_id, greatest(a.t0, b.t0) AS lo, least(a.t1, b.t1) AS hi FROM ends a JOIN ends b ON a.user_id = b.user_id AND a.series = 'gripper' AND b.series = 'flow'),
pts AS (SELECT user_id, i, lo + i * 33.33e0 AS x FROM (SELECT *, unnest(range(0, CAST(ceil((hi - lo) / 33.33e0) AS BIGINT))) AS i FROM g WHERE hi - lo >= 2000)), {_at("pts", "'gripper'", "av")}, {_at("pts", "'flow'", "bv")},
m AS (SELECT a.user_id, count(*) AS n, avg(a.y) AS ma, avg(b.y) AS mb, stddev_pop(a.y) AS sa, stddev_pop(b.y) AS sb, max(a.y) - min(a.y) AS ra, max(b.y) - min(b.y) AS rb FROM av a JOIN bv b USING (user_id, i) GROUP BY 1),
c AS (SELECT a.user_id, b.i - a.i AS k, sum((b.y - mb) / (sb + 1e-8) * ((a.y - ma) / (sa * n + 1e-8))) AS r FROM av a JOIN bv b ON a.user_id = b.user_id AND abs(b.i - a.i) <= 45 JOIN m ON m.user_id = a.user_id WHERE ra >= 1e-6 AND rb >= 1e-6 GROUP BY ALL),
b AS (SELECT user_id, arg_max(k, (round(abs(r), 9), -k)) AS k, arg_max(r, (round(abs(r), 9), -k)) AS r, max(r) FILTER (WHERE k = 0) AS r0 FROM c GROUP BY 1),
f AS (SELECT user_id, round(CASE WHEN abs(r0) >= 0.8e0 * abs(r) THEN r0 ELSE r END, 4) AS correlation, CASE WHEN abs(r0) >= 0.8e0 * abs(r) THEN 0 ELSE k END AS lag FROM b)
SELECT g.user_id, f.correlation, f.lag, abs(f.correlation) AS weakest, coalesce(abs(f.correlation) >= 0.3, true) AS ok FROM g LEFT JOIN f USING (user_id)""")
def gripper_flow(spark, d):
    sides = written(G.gripper_flow_sides(_series(spark, d, _FLOW, 600).withColumn("side", F.lit("left")), "user_id"), "flow")
    return sides.select("user_id", "correlation", F.round(F.col("lag_ms") / 33.33).cast("long").alias("lag")).join(G.gripper_flow_check(sides, "user_id"), "user_id")


_TRAJECTORY = {"purchase": "stereo", "click": "head"}


@query(f"""
WITH {_series_sql(_TRAJECTORY, 600)}, g AS (SELECT a.user_id, greatest(a.t0, b.t0) AS lo, least(a.t1, b.t1) AS hi FROM ends a JOIN ends b ON a.user_id = b.user_id AND a.series = 'stereo' AND b.series = 'head' WHERE least(a.n, b.n) >= 5),
pts AS (SELECT user_id, i, lo + i * 50e0 AS x FROM (SELECT *, unnest(range(0, CAST(ceil((hi - lo) / 50e0) AS BIGINT))) AS i FROM g WHERE hi - lo >= 2000)), {_at("pts", "'stereo'", "av")}, {_at("pts", "'head'", "bv")},
s AS (SELECT a.user_id, count(*) AS points, CASE WHEN stddev_pop(a.y) < 1e-8 OR stddev_pop(b.y) < 1e-8 THEN 0 ELSE corr(a.y, b.y) END AS r, sqrt(avg(power(a.y - b.y, 2))) AS rmse, avg(a.y) AS ma, avg(b.y) AS mb, stddev_pop(a.y) AS sa, stddev_pop(b.y) AS sb FROM av a JOIN bv b USING (user_id, i) GROUP BY 1),
c AS (SELECT a.user_id, a.i - b.i AS k, sum((a.y - ma) / (sa + 1e-8) * ((b.y - mb) / (sb + 1e-8))) AS r FROM av a JOIN bv b ON a.user_id = b.user_id AND abs(b.i - a.i) <= 30 JOIN s ON s.user_id = a.user_id GROUP BY ALL),
k AS (SELECT user_id, arg_max(k, (round(abs(r), 7), -k)) AS k FROM c GROUP BY 1)
SELECT u.user_id, coalesce(points, 0) AS points, round(coalesce(r, 0), 4) AS pearson, round(rmse, 2) AS rmse, coalesce(k * 50e0, 0) AS lag_ms, coalesce(abs(r) >= 0.7, false) AS coherent FROM (SELECT DISTINCT user_id FROM ev) u LEFT JOIN s USING (user_id) LEFT JOIN k USING (user_id)""")
def trajectory_correlation(spark, d):
    rows = _series(spark, d, _TRAJECTORY, 600).select("user_id", F.col("series").alias("source"), F.col("t").alias("t_ms"), *[F.col("v").alias(a) for a in "xyz"])
    return G.trajectory_correlation(rows, "user_id", 50.0).selectExpr("user_id", "points", "pearson_x as pearson", "rmse_y as rmse", "lag_ms", "coherent")


_INVERTED = Fixture("customer", "c_custkey AS session", "CASE WHEN c_custkey % 17 > 0 THEN (c_custkey % 20 - 10) / 10e0 END AS l_own", "(c_custkey % 7 - 3) / 5e0 AS l_other", "(c_custkey % 9 - 4) / 5e0 AS r_own", "CASE WHEN c_custkey % 17 > 1 THEN (c_custkey % 13 - 6) / 5e0 END AS r_other")


@query(f"""WITH s AS ({_INVERTED.sql}), e AS (SELECT session, l_own AS own, l_other AS other FROM s UNION ALL SELECT session, r_own, r_other FROM s), v AS (SELECT session, NOT (own > other) AS bad, abs(own - other) AS margin FROM e WHERE own IS NOT NULL AND other IS NOT NULL)
SELECT session, CASE WHEN bool_and(bad) AND bool_and(margin >= 0.12e0) THEN 'inverted' WHEN bool_and(bad) AND bool_or(margin >= 0.12e0) THEN 'suspect' ELSE 'ok' END AS verdict FROM v GROUP BY 1""")
def label_inversion(spark, d):
    rows = _INVERTED(spark, d).select("session", F.expr("stack(2, 'left', l_own, l_other, 'right', r_own, r_other) as (side, own, other)"))
    return P.label_inversion(rows)


# --- files and structure ---

_NAMES = ("cameras/head.jsonl", "cameras/head.mp4", "cameras/left.jsonl", "cameras/left.mp4", "cameras/right.jsonl", "cameras/right.mp4", "config.json", "mission.json", "sensors/left.jsonl", "sensors/right.jsonl", "cameras/resampled_30hz.jsonl", "notes.txt")
_PATHS = f"SELECT c_custkey AS session, i, [{', '.join(repr(n) for n in _NAMES)}][i + 1] AS path, CASE WHEN (c_custkey + i) % 8 = 0 THEN 0 ELSE (c_custkey * 7 + i * 13) % 4 * 60000 + 10 END AS size FROM customer, range(12) r(i) WHERE (c_custkey + i * 5) % 23 > 0"


def _files(spark, d):
    """Paths of each session's folder; some are missing, some hold nothing."""
    i = F.explode(F.sequence(F.lit(0), F.lit(11)))
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("session"), i.alias("i")).where("(session + i * 5) % 23 > 0")
    path = F.element_at(F.array(*map(F.lit, _NAMES)), F.col("i") + 1)
    size = F.when((F.col("session") + F.col("i")) % 8 == 0, 0).otherwise((F.col("session") * 7 + F.col("i") * 13) % 4 * 60_000 + 10)
    rows = rows.select("session", path.alias("path"), size.alias("size"))
    sub = F.regexp_extract("path", r"^(.*)/", 1)
    return rows.withColumns({"subdir": sub, "name": F.regexp_extract("path", r"([^/]*)$", 1), "is_dir": F.lit(False), "ok": F.col("size") > 0})


_STRUCTURE = Fixture("customer", "c_custkey AS session", "CASE WHEN c_custkey % 5 = 0 THEN 'failed' WHEN c_custkey % 9 > 0 THEN 'Success' END AS result", "CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 6 > 0 END AS config_ok", "CASE WHEN c_custkey % 8 = 0 THEN 'left,head' END AS cams", "c_custkey % 11 > 0 AS mission_ok", "CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 13 > 0 END AS sync_ok", "CASE WHEN c_custkey % 10 = 0 THEN 'e1,e2' ELSE '' END AS errs")


@query(f"""
WITH f AS ({_PATHS}), s AS ({_STRUCTURE.sql}), z AS (SELECT session, max(size) FILTER (WHERE path = 'cameras/head.mp4') AS hm, max(size) FILTER (WHERE path = 'cameras/left.mp4') AS lm, max(size) FILTER (WHERE path = 'cameras/right.mp4') AS rm, max(size) FILTER (WHERE path = 'cameras/head.jsonl') AS hj,
    max(size) FILTER (WHERE path = 'cameras/left.jsonl') AS lj, max(size) FILTER (WHERE path = 'cameras/right.jsonl') AS rj, max(size) FILTER (WHERE path = 'cameras/resampled_30hz.jsonl') AS g, max(size) FILTER (WHERE path = 'sensors/left.jsonl') AS sl, max(size) FILTER (WHERE path = 'sensors/right.jsonl') AS sr FROM f GROUP BY 1)
SELECT s.session, concat_ws('|', CASE WHEN upper(coalesce(result, '')) <> 'SUCCESS' THEN '[result] not SUCCESS' END, CASE WHEN NOT coalesce(config_ok, false) THEN '[config] missing or invalid' END, CASE WHEN cams IS NOT NULL THEN '[camera] left, head' END, CASE WHEN NOT mission_ok THEN '[mission] missing or invalid' END,
    CASE WHEN NOT coalesce(sync_ok, true) THEN '[sync] check failed' END, CASE WHEN coalesce(hm, 0) < 100000 THEN '[video] head missing or too small' END, CASE WHEN coalesce(lm, 0) < 100000 THEN '[video] left missing or too small' END, CASE WHEN coalesce(rm, 0) < 100000 THEN '[video] right missing or too small' END,
    CASE WHEN coalesce(hj, 0) = 0 THEN '[frames] head missing or empty' END, CASE WHEN coalesce(lj, 0) = 0 THEN '[frames] left missing or empty' END, CASE WHEN coalesce(rj, 0) = 0 THEN '[frames] right missing or empty' END, CASE WHEN coalesce(g, 0) = 0 THEN '[grid] missing or empty' END,
    CASE WHEN coalesce(sl, 0) = 0 THEN '[sensor] left missing or empty' END, CASE WHEN coalesce(sr, 0) = 0 THEN '[sensor] right missing or empty' END, CASE WHEN errs <> '' THEN '[analysis] e1|[analysis] e2' END) AS issues FROM s LEFT JOIN z USING (session)""")
def structure_issues(spark, d):
    rows = _STRUCTURE(spark, d).withColumns({"camera_errors": listed("cams"), "errors": listed("errs")})
    return P.structure_issues(rows, _files(spark, d), with_analysis_errors=True).select("session", F.array_join("issues", "|").alias("issues"))


_REQUIRED = ", ".join(repr(n) for n in P.REQUIRED)


@query(f"""
WITH f AS ({_PATHS}), p AS (SELECT session, list(path) AS have, array_to_string(list_sort(list(path) FILTER (WHERE size = 0)), ',') AS corrupt FROM f GROUP BY 1),
m AS (SELECT session, array_to_string(list_sort(list_filter([{_REQUIRED}], lambda x: NOT list_contains(have, x))), ',') AS missing, array_to_string(list_sort(list_filter(have, lambda x: x = 'notes.txt')), ',') AS extra, coalesce(corrupt, '') AS corrupt FROM p)
SELECT *, missing = '' AND extra = '' AND corrupt = '' AS ok FROM m""")
def exact_set(spark, d):
    out = P.exact_set(_files(spark, d))
    return out.select("session", *[F.array_join(c, ",").alias(c) for c in ("missing", "extra", "corrupt")], "ok")


_COMPLETE = Fixture("customer", "c_custkey AS session", "c_custkey % 7 > 0 AS result_present", "CASE WHEN c_custkey % 11 > 0 THEN CASE WHEN c_custkey % 5 > 0 THEN 'success' ELSE 'no' END END AS result", "c_custkey % 13 > 0 AS config_present", "c_custkey % 17 > 0 AS config_ok", "100000 - (c_custkey % 600) AS mtime", "CASE WHEN c_custkey % 2 = 0 THEN 'left,right' ELSE 'head' END AS cams", "CASE WHEN c_custkey % 3 = 0 THEN 'left,' ELSE '' END AS sens")


@query(f"""
WITH f AS ({_PATHS}), s AS ({_COMPLETE.sql}), e AS (SELECT session, unnest(list_concat(list_transform({listed_sql("cams")}, lambda n: 'cameras/' || n || '.mp4'), list_transform({listed_sql("cams")}, lambda n: 'cameras/' || n || '.jsonl'), list_transform({listed_sql("sens")}, lambda n: 'sensors/' || n || '.jsonl'))) AS path FROM s),
m AS (SELECT e.session, min(e.path) AS missing FROM e LEFT JOIN f ON f.session = e.session AND f.path = e.path AND f.size > 0 WHERE f.session IS NULL GROUP BY 1),
r AS (SELECT session, CASE WHEN NOT result_present THEN 'result missing' WHEN result IS NULL THEN 'result unreadable' WHEN upper(result) <> 'SUCCESS' THEN 'result not SUCCESS' WHEN NOT config_present THEN 'config missing' WHEN NOT config_ok THEN 'config unreadable'
    WHEN missing IS NOT NULL THEN missing || ' missing or empty' WHEN 100000 - mtime < 300 THEN 'changed lately' ELSE '' END AS reason FROM s LEFT JOIN m USING (session)) SELECT session, reason = '' AS complete, reason FROM r""")
def completeness(spark, d):
    rows = _COMPLETE(spark, d).withColumns({"cameras": listed("cams"), "sensors": listed("sens")})
    return C.completeness(rows, C.declared_files(rows), _files(spark, d), F.lit(100_000))


@query(f"""
WITH f AS ({_PATHS}), s AS (SELECT c_custkey AS session, c_custkey % 9 > 0 AS folder, c_custkey % 4 > 0 AS meta FROM customer), z AS (SELECT session, count(*) AS n, count(*) FILTER (WHERE size = 0) AS empty, sum(size) AS bytes FROM f GROUP BY 1),
c AS (SELECT session, folder AS folder_exists, folder AND coalesce(n, 0) > 0 AS files_present, folder AND coalesce(empty, 0) = 0 AS no_empty_files, folder AND coalesce(bytes, 0) >= 600000 AS min_size, folder AND meta AS m FROM s LEFT JOIN z USING (session))
SELECT session, folder_exists, files_present, no_empty_files, min_size, folder_exists::INT + files_present::INT + no_empty_files::INT + min_size::INT + m::INT AS checks_ok FROM c""")
def file_rules(spark, d):
    rows = table(spark, d, "customer").selectExpr("c_custkey as session", "c_custkey % 9 > 0 as folder_exists", "c_custkey % 4 > 0 as metadata_valid")
    return C.file_checks(rows, _files(spark, d), least_bytes=600_000)


_RULES = Fixture(
    "part", "p_partkey AS session", "CASE WHEN p_partkey % 3 > 0 THEN CASE WHEN p_partkey % 4 = 0 THEN 'e' ELSE '' END END AS errs", "p_partkey % 5 > 0 AS present", "p_partkey % 7 = 0 AS failed", "CASE WHEN p_partkey % 11 = 0 THEN 'bad' END AS error", "CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 6 = 0 END AS l", "p_partkey % 9 = 0 AS r",
    "CASE WHEN p_partkey % 4 > 0 THEN p_partkey % 3 END AS scen", "CASE WHEN p_partkey % 5 > 0 THEN concat('', p_partkey % 3) ELSE '' END AS written", "CASE WHEN p_partkey % 8 > 0 THEN (p_partkey % 73) * 100e0 END AS secs", "CASE WHEN p_partkey % 6 > 0 THEN (p_partkey % 9) / 100e0 END AS share", "p_partkey % 40 AS pts", "(p_partkey % 50) / 10e0 AS span",
    "p_partkey % 19 = 0 AS invalid", "p_partkey % 5 = 0 AS rejected", "p_partkey % 3 = 0 AS hollow",
)


@query(f"""WITH s AS ({_RULES.sql}) SELECT session, CASE WHEN present THEN coalesce(errs, '') = '' END AS analysis, CASE WHEN failed THEN true WHEN error IS NULL THEN coalesce(l, false) OR r END AS tracking, coalesce(CASE WHEN written <> '' THEN CAST(scen AS VARCHAR) = written END, true) AS scenario,
    coalesce(secs BETWEEN 10 AND 7200, true) AS duration, CASE WHEN share >= 0.05 THEN 'gripper' WHEN share <= 0.02 THEN 'head' WHEN share IS NOT NULL THEN 'ambiguous' END AS role, coalesce(CASE WHEN share >= 0.05 THEN true WHEN share <= 0.02 THEN false END, false) AS mismatch, pts >= 30 AND span >= 3 AS enough,
    CASE WHEN invalid THEN 'invalid' WHEN rejected THEN 'rejected' WHEN hollow THEN 'empty' ELSE 'valid' END AS class, coalesce(len({listed_sql("errs")}), 0) AS n_errors FROM s""")
def check_rules(spark, d):
    c = F.col
    s = _RULES(spark, d).withColumn("errors", listed("errs")).withColumn("role", P.role(c("share")))
    return s.select(
        "session", C.analysis_check(c("errors"), c("present")).alias("analysis"), C.tracking_check(c("failed"), c("error"), c("l"), c("r")).alias("tracking"), C.scenario_check(c("scen"), c("written")).alias("scenario"), C.duration_check(c("secs")).alias("duration"), "role",
        C.role_mismatch(c("role"), F.lit("head")).alias("mismatch"), P.enough_data(c("pts"), c("span")).alias("enough"), P.classify(c("invalid"), c("rejected"), c("hollow")).alias("class"), F.size(C.analysis_errors(c("errors"))).cast("long").alias("n_errors"),
    )


@query("WITH s AS (SELECT o_custkey AS session, sum(o_orderkey % 4) AS severe, max(round((o_orderkey % 13) * 0.83336e0, 2)) AS worst_pct FROM orders GROUP BY 1) SELECT session, CAST(severe AS BIGINT) AS severe, worst_pct, severe <= 5 AND worst_pct <= 10 AS ok FROM s")
def frame_drop_rule(spark, d):
    return C.frame_drop_check(table(spark, d, "orders").selectExpr("o_custkey as session", "o_orderkey as camera", "o_orderkey % 4 as severe", "o_orderkey % 13 * 0.83336e0 as drop_pct"))


@query("WITH s AS (SELECT o_custkey AS session, round(abs((o_orderkey % 40 - 1) / ((o_orderkey % 14) / 10e0) - 30), 3) AS delta FROM orders WHERE o_orderkey % 40 >= 10 AND o_orderkey % 14 >= 10) SELECT session, round(max(delta), 6) AS worst_delta, round(max(delta) - min(delta), 6) AS spread, max(delta) <= 1 AS ok FROM s GROUP BY 1")
def drift_rule(spark, d):
    return rounded(C.drift_check(table(spark, d, "orders").selectExpr("o_custkey as session", "o_orderkey as camera", "o_orderkey % 40 as frames", "o_orderkey % 14 / 10e0 as seconds")), "worst_delta", "spread")


_GRID = Fixture("events", "user_id AS session", "CASE event_id % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'right' ELSE 'head' END AS camera", "event_id AS idx", "CASE WHEN event_id % 29 > 0 THEN event_id * 10e0 END AS ts_ms", "CASE WHEN event_id % 3 = 2 AND event_id % 2 = 0 THEN 'wall' WHEN event_id % 3 = 0 THEN 'left' WHEN event_id % 3 = 1 THEN 'right' ELSE 'head' END AS key", "CASE WHEN event_id % 31 = 0 THEN 'x/cameras/other/f.jpg' WHEN event_id % 37 > 0 THEN concat('x/cameras/', CASE event_id % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'right' ELSE 'wall' END, '/f.jpg') END AS file", where="event_type = 'purchase'")
_FRAMES = Fixture("events", "user_id AS session", "CASE event_id % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'right' ELSE 'head' END AS camera", "event_id AS frame_id", "CASE WHEN user_id % 10 > 1 THEN event_id * 10e0 END AS ts_ms", where="event_type <> 'purchase' AND user_id % 10 > 0")


@query(f"""
WITH g AS ({_GRID.sql}), f AS ({_FRAMES.sql}), c AS (SELECT DISTINCT session, camera FROM f), n AS (SELECT session, camera, idx, min(abs(f.ts_ms - g.ts_ms)) AS gap FROM g JOIN c USING (session, camera) LEFT JOIN f USING (session, camera) GROUP BY ALL),
b AS (SELECT g.*, coalesce(n.gap, 'Infinity'::DOUBLE) AS gap, coalesce(n.gap > 300, true) AS bad, coalesce(nullif(regexp_extract(file, 'cameras/([^/]+)/', 1), '') <> key, false) AS other FROM g JOIN n USING (session, camera, idx)),
m AS (SELECT session, camera, list_sort(list(gap) FILTER (WHERE bad)) AS gaps FROM b GROUP BY 1, 2)
SELECT session, camera, count(*) AS total, count(*) FILTER (WHERE bad) AS bad, count(*) FILTER (WHERE other) AS bad_path, max(round((gaps[(len(gaps) + 1) // 2] + gaps[(len(gaps) + 2) // 2]) / 2, 3)) AS median_bad_ms, round(count(*) FILTER (WHERE bad) / count(*), 6) AS ratio, round(count(*) FILTER (WHERE other) / count(*), 6) AS path_ratio,
    count(*) FILTER (WHERE bad) / count(*) <= 0.02 AND count(*) FILTER (WHERE other) / count(*) <= 0.02 AS ok FROM b JOIN m USING (session, camera) GROUP BY 1, 2""")
def camera_sync(spark, d):
    """Users that end in 1 have streams without times; those that end in 0 have no streams."""
    frames = _FRAMES(spark, d)
    return rounded(P.camera_sync(_GRID(spark, d), frames, gap_ms=300.0, cameras=frames), "ratio", "path_ratio")


@query("""WITH s AS (SELECT c_custkey AS session, CASE c_custkey % 5 WHEN 0 THEN ['left', 'right', 'wall'] WHEN 1 THEN ['left', 'rigth', 'wall'] WHEN 2 THEN ['left'] WHEN 3 THEN ['left', 'right', 'wall', 'top'] END AS cameras FROM customer),
x AS (SELECT session, array_to_string(list_sort(list_filter(cameras, lambda n: NOT list_contains(['left', 'right', 'wall'], n))), ',') AS unexpected, array_to_string(list_sort(list_filter(['left', 'right', 'wall'], lambda n: NOT list_contains(cameras, n))), ',') AS missing FROM s WHERE cameras IS NOT NULL)
SELECT * FROM x WHERE unexpected <> '' OR missing <> ''""")
def name_anomalies(spark, d):
    k = F.col("c_custkey") % 5
    lists = [F.array(*map(F.lit, x)) for x in (("left", "right", "wall"), ("left", "rigth", "wall"), ("left",), ("left", "right", "wall", "top"))]
    cams = F.when(k == 0, lists[0]).when(k == 1, lists[1]).when(k == 2, lists[2]).when(k == 3, lists[3])
    return P.name_anomalies(table(spark, d, "customer").select(F.col("c_custkey").alias("session"), cams.alias("cameras"))).select("session", F.array_join("unexpected", ",").alias("unexpected"), F.array_join("missing", ",").alias("missing"))


_DOCS = Fixture("orders", "o_custkey AS session", "CASE o_orderkey % 5 WHEN 0 THEN 'result.json' WHEN 1 THEN 'mission.json' WHEN 2 THEN 'config.json' WHEN 3 THEN 'analysis.json' ELSE 'metadata.json' END AS name", "CASE WHEN o_orderkey % 7 = 0 THEN '{bad' ELSE concat('{\"k\": ', o_orderkey, '}') END AS text")


@query(f"WITH f AS ({_DOCS.sql}) SELECT session, " + ", ".join(f"max(text) FILTER (WHERE name = '{k}.json' AND text <> '{{bad') AS {k}" for k in C.KINDS) + " FROM f GROUP BY 1")
def session_documents(spark, d):
    return C.documents_of(_DOCS(spark, d))


@query(f"""WITH f AS ({_DOCS.sql}), s AS (SELECT session, bool_or(name = 'metadata.json') AS h0, bool_or(name = 'config.json') AS h1, max(text) FILTER (WHERE name = 'metadata.json' AND text <> '{{bad') AS t0, max(text) FILTER (WHERE name = 'config.json' AND text <> '{{bad') AS t1,
    max(text) FILTER (WHERE name = 'mission.json' AND text <> '{{bad') AS t2 FROM f GROUP BY 1), c AS (SELECT session, CASE WHEN h0 THEN 'metadata.json' WHEN h1 THEN 'config.json' WHEN t2 IS NOT NULL THEN 'mission.json' END AS source, CASE WHEN h0 THEN t0 WHEN h1 THEN t1 ELSE t2 END AS metadata FROM s)
SELECT session, source, metadata IS NOT NULL AS valid, metadata FROM c""")
def metadata_fallback(spark, d):
    return C.metadata_of(_DOCS(spark, d))



@query("""
WITH o AS (SELECT o_orderkey AS k, lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS s FROM orders),
r AS (SELECT k, CASE k % 4 WHEN 0 THEN 'sess_20240101_0000' || s || '_' || k WHEN 1 THEN 'sess_20240102_0000' || s || '_' || k ELSE 'id' || k END AS session_id, CASE k % 4 WHEN 2 THEN 'run/2024-01-03_00-00-' || s || '_' || k WHEN 3 THEN 'session_20240104_0000' || s ELSE NULL END AS folder FROM o),
f AS (SELECT DISTINCT CASE k % 4 WHEN 0 THEN 'session_20240101_0000' || s WHEN 1 THEN 'session_20240102_0000' || s || '_x' || k WHEN 2 THEN 'session_20240103_0000' || s || CASE WHEN k % 3 = 0 THEN '' ELSE '_b' END ELSE 'session_20240104_0000' || s END AS name FROM o WHERE k % 100 < 60)
SELECT r.session_id, coalesce((SELECT name FROM f WHERE name = coalesce(r.folder, r.session_id)), (SELECT name FROM f WHERE name = 'session_' || nullif(regexp_extract(r.session_id, '^sess_(\\d{8}_\\d{6})(?:_[0-9a-f]+)?$', 1), '')), (SELECT min(name) FROM f WHERE starts_with(name, 'session_' || nullif(regexp_extract(r.session_id, '^sess_(\\d{8}_\\d{6})(?:_[0-9a-f]+)?$', 1), ''))),
  CASE WHEN r.k % 4 = 2 THEN coalesce((SELECT name FROM f WHERE name = 'session_20240103_0000' || lpad(CAST(r.k % 100 AS VARCHAR), 2, '0')), (SELECT min(name) FROM f WHERE starts_with(name, 'session_20240103_0000' || lpad(CAST(r.k % 100 AS VARCHAR), 2, '0')))) END, coalesce(r.folder, r.session_id)) AS path FROM r""")
def session_paths(spark, d):
    k = F.col("o_orderkey")
    s, m, t = F.lpad((k % 100).cast("string"), 2, "0"), k % 4, k.cast("string")
    o = table(spark, d, "orders")
    sid = F.when(m == 0, F.concat(F.lit("sess_20240101_0000"), s, F.lit("_"), t)).when(m == 1, F.concat(F.lit("sess_20240102_0000"), s, F.lit("_"), t)).otherwise(F.concat(F.lit("id"), t))
    folder = F.when(m == 2, F.concat(F.lit("run/2024-01-03_00-00-"), s, F.lit("_"), t)).when(m == 3, F.concat(F.lit("session_20240104_0000"), s))
    name = F.when(m == 0, F.concat(F.lit("session_20240101_0000"), s)).when(m == 1, F.concat(F.lit("session_20240102_0000"), s, F.lit("_x"), t)).when(m == 2, F.concat(F.lit("session_20240103_0000"), s, F.when(k % 3 == 0, "").otherwise("_b"))).otherwise(F.concat(F.lit("session_20240104_0000"), s))
    return C.session_paths(o.select(sid.alias("session_id"), folder.alias("session_folder")), o.where(k % 100 < 60).select(name.alias("name")))


@query("""WITH f AS (SELECT o_custkey AS session, CASE o_orderkey % 3 WHEN 0 THEN 'left.jsonl' WHEN 1 THEN 'left.mp4' ELSE 'right.jsonl' END AS name, o_orderkey AS size FROM orders),
s AS (SELECT session, name, min(size) / 1e0 AS t_start, max(size) / 1e0 + 5 AS t_end, count(*) AS n FROM f WHERE name LIKE '%.jsonl' GROUP BY ALL), c AS (SELECT session, split_part(name, '.', 1) AS camera, count(*) AS files, min(size) FILTER (WHERE name LIKE '%.mp4') AS video_size FROM f GROUP BY ALL)
SELECT session, camera, t_start, t_end, t_end - t_start AS duration, n AS frames, files, video_size FROM (SELECT session, split_part(name, '.', 1) AS camera, t_start, t_end, n FROM s) JOIN c USING (session, camera)""")
def camera_statistics(spark, d):
    files = table(spark, d, "orders").selectExpr("o_custkey as session", "case o_orderkey % 3 when 0 then 'left.jsonl' when 1 then 'left.mp4' else 'right.jsonl' end as name", "o_orderkey as size")
    stats = files.where("name like '%.jsonl'").groupBy("session", "name").agg((F.min("size") / 1e0).alias("t_start"), (F.max("size") / 1e0 + 5).alias("t_end"), F.count(F.lit(1)).alias("n"))
    return C.camera_statistics(files, stats)


# --- decisions, batches, ledgers ---


@query("""WITH s AS (SELECT o_orderkey AS session, o_orderkey % 5 = 0 AS issue, o_orderkey % 3 = 0 AS error, o_orderkey % 7 = 0 AS hollow, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS sent FROM orders)
SELECT session, CASE WHEN issue THEN 'invalid' WHEN error THEN 'rejected' WHEN hollow THEN 'empty' WHEN sent THEN 'already_sent' ELSE 'deliver' END AS outcome FROM s""")
def upload_decision(spark, d):
    rows = table(spark, d, "orders").selectExpr("o_orderkey as session", "if(o_orderkey % 5 = 0, array('x'), null) as issues", "if(o_orderkey % 3 = 0, array('x'), array()) as errors", "o_orderkey % 7 = 0 as empty")
    return C.upload_decision(rows, table(spark, d, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey as session"))


@query("""WITH s AS (SELECT c_custkey AS batch_id, CASE c_custkey % 5 WHEN 0 THEN 'rejected' WHEN 1 THEN 'sent' WHEN 2 THEN 'pending_validation' WHEN 3 THEN 'pending_validation' END AS status, CASE WHEN c_custkey % 2 = 0 THEN 'b,a' ELSE 'a' END AS old, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'a,b' ELSE 'a' END AS new FROM customer)
SELECT batch_id, CASE WHEN status = 'rejected' THEN 'rejected' WHEN status <> 'pending_validation' THEN 'closed' WHEN new = '' THEN 'empty' WHEN status IS NOT NULL AND array_to_string(list_sort(string_split(old, ',')), ',') = new THEN 'unchanged' ELSE 'register' END AS action FROM s""")
def batch_guard(spark, d):
    rows = table(spark, d, "customer").selectExpr("c_custkey as batch_id", "case c_custkey % 5 when 0 then 'rejected' when 1 then 'sent' when 2 then 'pending_validation' when 3 then 'pending_validation' end as status", "if(c_custkey % 2 = 0, array('b', 'a'), array('a')) as old_sessions", "case c_custkey % 3 when 0 then array() when 1 then array('a', 'b') else array('a') end as new_sessions")
    return C.batch_guard(rows)


@query("""WITH f AS (SELECT o_custkey AS operator, o_orderkey AS session, o_totalprice AS size_bytes FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1),
b AS (SELECT *, coalesce(sum(size_bytes) OVER (ORDER BY session ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f) SELECT operator, session, round(before, 2) AS before FROM b WHERE before < 3000000""")
def one_per_operator(spark, d):
    rows = table(spark, d, "orders").selectExpr("o_custkey as operator", "o_orderkey as session", "o_orderstatus != 'P' as valid", "o_totalprice as size_bytes")
    return rounded(C.one_per_operator(rows, 3_000_000.0).select("operator", "session", "before"), "before", digits=2)


@query(f"SELECT o_orderkey AS session_id FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(arg_min(o_orderdate, (o_totalprice, o_orderkey)) AS DATE) FROM orders) AND {grade_sql(r1('o_totalprice / 5000'))} = 'F'")
def select_day(spark, d):
    """The day of the order with the least price, its F orders."""
    o = table(spark, d, "orders")
    day = o.agg(F.date_format(F.min(F.struct("o_totalprice", "o_orderkey", "o_orderdate"))["o_orderdate"], "yyyy-MM-dd")).first()[0]
    rows = o.select(F.col("o_orderkey").alias("session_id"), F.col("o_orderdate").alias("started_at"), X.grade(X.round1(F.col("o_totalprice") / 5000)).alias("quality_grade"))
    return C.select_day(rows, day, "F").select("session_id")


@query("SELECT 'oldest' AS mode, session FROM (SELECT o_orderkey AS session FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25) UNION ALL SELECT 'recent', session FROM (SELECT o_orderkey AS session FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25)")
def choose_sessions(spark, d):
    rows = table(spark, d, "orders").selectExpr("o_orderkey as session", "o_orderdate as mtime")
    return C.choose(rows, "oldest", 25).selectExpr("'oldest' as mode", "session").union(C.choose(rows, "recent", 25).selectExpr("'recent' as mode", "session"))


@query("""SELECT c_custkey AS session, CASE WHEN c_custkey % 3 > 0 THEN 'keep' WHEN c_custkey % 4 = 0 THEN 'skip' ELSE 'move' END AS action FROM customer""")
def migration_plan(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey as session")
    return P.migration_plan(c, c.where("session % 3 = 0"), c.where("session % 4 = 0")).select("session", "action")


@query("SELECT 'orders' AS name, o_orderkey AS k, o_custkey AS c FROM orders WHERE o_custkey % 5 > 0 UNION ALL SELECT 'parents', c_custkey, c_custkey FROM customer WHERE c_custkey % 5 > 0")
def delete_cascade(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey as c")
    out = L.delete_cascade(c, c.where("c % 5 = 0"), "c", {"orders": table(spark, d, "orders").selectExpr("o_orderkey as k", "o_custkey as c")})
    return out["orders"].selectExpr("'orders' as name", "k", "c").union(out["parents"].selectExpr("'parents' as name", "c as k", "c"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 3 > 0 UNION ALL SELECT o_custkey, o_orderkey + 1000000, o_totalprice + 1 FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 2 = 0 UNION ALL SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 3 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 2 = 0)")
def rebuild_partitions(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return L.rebuild_partitions(o, o.where("o_custkey % 3 = 0 and o_orderkey % 2 = 0").selectExpr("o_custkey", "o_orderkey + 1000000L as o_orderkey", "o_totalprice + 1 as o_totalprice"), ["o_custkey"])


@query("SELECT o_orderkey AS session, o_orderkey % 4 > 0 AND o_orderkey % 3 > 0 AND o_orderkey % 5 > 0 AS cached FROM orders")
def reuse_reports(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey as session", "concat('f', o_orderkey) as fingerprint", "'v1:true' as config_key")
    old = o.selectExpr("session", "if(session % 4 > 0, fingerprint, 'old') as fingerprint", "config_key", "if(session % 3 > 0, 'OK', 'ANOMALY') as status").where("session % 5 > 0")
    return P.reuse_reports(o, old.union(old)).select("session", "cached")


@query("SELECT o_orderpriority AS disk, count(*) AS sessions, count(*) FILTER (WHERE o_orderstatus = 'F') AS with_analysis, round(sum(CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END), 4) AS seconds FROM orders GROUP BY 1")
def disk_totals(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderpriority as disk", "o_orderstatus", "if(o_orderstatus != 'O', o_totalprice, null) as s")
    return A.disk_totals(o, "disk", F.col("o_orderstatus") == "F", "s")


@query("SELECT l_orderkey, min_by(l_linenumber, (-l_quantity, l_linenumber)) AS worst, max(l_quantity) AS value FROM lineitem GROUP BY 1")
def worst_camera(spark, d):
    return A.worst(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def merge_ledgers(spark, d):
    return L.merge_ledgers(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"]).select("user_id", "event_id")


@query("SELECT o_custkey AS session, arg_min(o_orderkey, (o_orderpriority, o_orderkey)) AS session_path, min(o_orderpriority) AS root FROM orders GROUP BY 1")
def first_disk_wins(spark, d):
    from sessionloom.sources.inventory import first_wins

    o = table(spark, d, "orders").selectExpr("o_custkey as session", "o_orderkey as session_path", "o_orderpriority as root")
    disks = o.select("root", F.ascii(F.col("root")).alias("disk_order")).distinct()
    return first_wins(o, disks).select("session", "session_path", "root")


@query("SELECT printf('d%05d', s_suppkey) AS key, s_suppkey % 7 * 1000000000 + 5 AS total_bytes, " + r1("CASE WHEN s_suppkey % 7 * 1000000000 + 5 > 0 THEN 100e0 * (s_suppkey % 7 * 1000000000 + 5 - s_suppkey * 1000) / (s_suppkey % 7 * 1000000000 + 5) END") + " AS used_pct FROM supplier")
def heartbeat(spark, d):
    from sessionloom.streaming.watch import heartbeat as run

    rows = table(spark, d, "supplier").select(F.format_string("d%05d", "s_suppkey").alias("disk_uuid"), F.col("s_name").alias("label"), (F.col("s_suppkey").cast("long") % 7 * 1_000_000_000 + 5).alias("total_bytes"), (F.col("s_suppkey").cast("long") * 1000).alias("free_bytes"))
    sent = run(rows, "2024-01-01T00:00:00", "host")
    return sent.join(rows.select(F.col("disk_uuid").alias("key"), "total_bytes"), "key").select("key", "total_bytes", F.get_json_object("value", "$.used_pct").cast("double").alias("used_pct"))


@query("SELECT o_custkey AS session_path, o_orderkey AS name FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn > 5")
def keep_newest(spark, d):
    from sessionloom.sources.inventory import keep_newest as run

    return run(table(spark, d, "orders").selectExpr("o_custkey as session_path", "o_orderkey as name", "o_orderdate as mtime", "false as is_dir"), 5).select("session_path", "name")


@query("WITH m AS (SELECT event_type AS step, round(avg(value), 6) AS mean_s FROM events GROUP BY 1), b AS (SELECT s_name AS bottleneck, s_acctbal AS per_second FROM supplier ORDER BY s_acctbal, s_name LIMIT 1) SELECT * FROM m, b")
def throughput(spark, d):
    return P.throughput(table(spark, d, "events").selectExpr("event_type as step", "value as seconds"), table(spark, d, "supplier").selectExpr("s_name as stage", "s_acctbal as per_second"))


@query("""WITH c AS (SELECT o_custkey AS session, concat('c', o_orderkey, ': ', o_orderstatus) AS t, o_orderkey % 3 > 0 AS ok, o_orderkey % 2 = 0 AS critical FROM orders),
v AS (SELECT session, coalesce(array_to_string(list_sort(list(t) FILTER (WHERE ok)), '|'), '') AS conclusions, coalesce(array_to_string(list_sort(list(t) FILTER (WHERE NOT ok AND NOT critical)), '|'), '') AS warnings, coalesce(array_to_string(list_sort(list(t) FILTER (WHERE NOT ok AND critical)), '|'), '') AS errors FROM c GROUP BY 1)
SELECT *, CASE WHEN errors <> '' THEN 'failed' WHEN warnings <> '' THEN 'warning' ELSE 'passed' END AS verdict FROM v""")
def conclusions(spark, d):
    return _conclusions(spark, d).select("session", *[F.array_join(c, "|").alias(c) for c in ("conclusions", "warnings", "errors")], "verdict")


def _conclusions(spark, d):
    return P.verdict(table(spark, d, "orders").selectExpr("o_custkey as session", "concat('c', o_orderkey) as check", "o_orderkey % 3 > 0 as ok", "o_orderkey % 2 = 0 as critical", "o_orderstatus as detail"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 4 = 0 THEN 'approved' WHEN c_custkey % 2 = 0 THEN 'pending_validation' WHEN c_custkey % 3 = 0 THEN 'sending' ELSE 'approved' END AS status, c_custkey % 2 = 0 AND c_custkey % 4 > 0 AND c_custkey % 7 > 0 OR c_custkey % 2 = 1 AND c_custkey % 3 > 0 AND c_custkey % 7 > 0 AS refused FROM customer")
def batch_states(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey as id", "if(c_custkey % 2 = 0, 'pending_validation', 'approved') as status")
    to = c.selectExpr("id", "case when id % 2 = 0 then if(id % 4 = 0, 'approved', 'sent') when id % 3 = 0 then 'sending' else 'rejected' end as to_status").where("id % 7 > 0 or id % 4 = 0 and id % 2 = 0 or id % 2 = 1 and id % 3 = 0")
    return L.advance(c, to, "id")


@query("SELECT c_custkey AS session_id, CASE WHEN c_custkey % 3 = 0 THEN concat('hdd', c_custkey % 10) WHEN c_custkey % 2 = 0 THEN 'old' END AS hdd FROM customer")
def mark_replicas(spark, d):
    s = table(spark, d, "customer").selectExpr("c_custkey as session_id", "if(c_custkey % 2 = 0, 'old', null) as hdd")
    return L.mark_replicas(s, s.where("session_id % 3 = 0").selectExpr("session_id", "concat('hdd', session_id % 10) as hdd"), "session_id", "hdd").select("session_id", "hdd")


@query("""WITH s AS (SELECT concat('id', c_custkey * 7) AS id, concat('f', c_custkey) AS folder FROM customer), n AS (SELECT CASE c_custkey % 4 WHEN 0 THEN concat('f', c_custkey) WHEN 1 THEN concat('id', c_custkey * 7) WHEN 2 THEN concat('id', c_custkey) ELSE concat('z', c_custkey) END AS name FROM customer)
SELECT n.name, coalesce((SELECT min(id) FROM s WHERE folder = n.name), (SELECT min(id) FROM s WHERE id = n.name), (SELECT min(id) FROM s WHERE starts_with(id, n.name))) AS id FROM n""")
def resolve_ids(spark, d):
    s = table(spark, d, "customer").selectExpr("concat('id', c_custkey * 7) as id", "concat('f', c_custkey) as folder")
    n = table(spark, d, "customer").selectExpr("case c_custkey % 4 when 0 then concat('f', c_custkey) when 1 then concat('id', c_custkey * 7) when 2 then concat('id', c_custkey) else concat('z', c_custkey) end as name")
    return L.resolve_ids(n, s, "name", "folder", "id")


@query("SELECT concat('s', c_custkey) AS session, CASE WHEN c_custkey % 3 = 0 THEN concat('id', c_custkey) ELSE concat('s', c_custkey) END AS reference FROM customer")
def result_lookup(spark, d):
    s = table(spark, d, "customer").selectExpr("concat('s', c_custkey) as session", "c_custkey")
    return C.result_lookup(s.select("session"), s.where("c_custkey % 3 = 0").selectExpr("session", "concat('id', c_custkey) as session_id"))


@query("SELECT DISTINCT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0")
def name_union(spark, d):
    return table(spark, d, "orders").selectExpr("o_custkey as k").union(table(spark, d, "customer").where("c_custkey % 2 = 0").selectExpr("c_custkey as k")).distinct()


@query("SELECT 'explicit' AS origin, s_suppkey AS disk FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT 'found', s_suppkey FROM supplier WHERE s_suppkey % 3 = 0")
def disk_lists(spark, d):
    s = table(spark, d, "supplier")
    return s.where("s_suppkey % 2 = 0").selectExpr("'explicit' as origin", "s_suppkey as disk").unionByName(s.where("s_suppkey % 3 = 0").selectExpr("'found' as origin", "s_suppkey as disk"))


# --- names ---


@query("""WITH s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 > 0 THEN 'session_2024010' || (1 + c_custkey % 9) || '_' || lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') || '3000' ELSE 'other' END AS name, CASE WHEN c_custkey % 3 > 0 THEN 'rig_' || (c_custkey % 4) END AS rig, CASE WHEN c_custkey % 7 > 0 THEN 'op ' || (c_custkey % 61) END AS op FROM customer),
n AS (SELECT *, CAST(nullif(regexp_extract(rig, '[0-9]+', 0), '') AS INT) AS own, CAST(nullif(regexp_extract(op, '[0-9]+', 0), '') AS INT) AS o FROM s), r AS (SELECT *, coalesce(nullif(own, 1), CASE WHEN o <= 30 THEN o ELSE o - 30 END) AS num FROM n)
SELECT k, CASE WHEN name <> 'other' AND num IS NOT NULL THEN concat('rig_', num, '/', substr(name, 9, 8), '/', substr(name, 18, 2)) END AS key FROM r""")
def group_keys(spark, d):
    return _keys(spark, d).select("k", F.when(F.col("key").isNotNull(), F.concat_ws("/", "key.rig", "key.day", "key.hour")).alias("key"))


def _keys(spark, d):
    k = F.col("c_custkey")
    name = F.when(k % 5 > 0, F.concat(F.lit("session_2024010"), (1 + k % 9).cast("string"), F.lit("_"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit("3000"))).otherwise("other")
    rig, op = F.when(k % 3 > 0, F.concat(F.lit("rig_"), (k % 4).cast("string"))), F.when(k % 7 > 0, F.concat(F.lit("op "), (k % 61).cast("string")))
    return table(spark, d, "customer").select(k.alias("k"), C.group_key(name, rig, op).alias("key"))


@query("WITH k AS (" + ORACLE["group_keys"] + ") SELECT count(*) AS probe, round((count(DISTINCT key) + count(*) FILTER (WHERE key IS NULL)) / count(*), 6) AS fraction FROM k")
def representative_fraction(spark, d):
    return R.representative_fraction(_keys(spark, d))


@query("""SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN '2024-03-01' WHEN 1 THEN '2024-03-01' WHEN 2 THEN '2024-02-29' WHEN 3 THEN '2024-02-29' WHEN 4 THEN '2024-01-' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') END AS day FROM part""")
def relative_dates(spark, d):
    k = F.col("p_partkey")
    text = F.when(k % 6 == 0, " Today").when(k % 6 == 1, F.lit(None)).when(k % 6 == 2, "hier").when(k % 6 == 3, "YESTERDAY ").when(k % 6 == 4, F.concat(F.lit("2024-01-"), F.lpad((1 + k % 28).cast("string"), 2, "0"))).otherwise("2024-13-77")
    return table(spark, d, "part").select(k.alias("k"), F.date_format(C.relative_date(text, F.lit("2024-03-01").cast("date")), "yyyy-MM-dd").alias("day"))


@query("SELECT p_partkey AS k, concat('v7:', CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END, ':', p_partkey % 5, ':10') AS key, round(least(1, 0.45e0 + 0.14e0 * (p_partkey % 6)), 6) AS corner, round(least(1, greatest(0.1e0, 1 - (p_partkey % 8) / 5e0)) * CASE WHEN p_partkey % 6 >= 3 THEN 1 ELSE 0.85e0 END, 6) AS board, round(least(1, 0.4e0 + 0.15e0 * (p_partkey % 6)) * CASE WHEN p_partkey % 6 >= 3 THEN 1 ELSE 0.8e0 END, 6) AS markers FROM part")
def keys_and_confidence(spark, d):
    n = F.col("p_partkey") % 6
    p = table(spark, d, "part").withColumns({"a": F.expr("p_partkey % 2 = 0"), "b": F.expr("p_partkey % 5")})
    conf = {"corner": C.confidence("corner", n), "board": C.confidence("board", n, F.expr("p_partkey % 8 / 1e0")), "markers": C.confidence("markers", n)}
    return p.select(F.col("p_partkey").alias("k"), C.config_key("v7", "a", "b", F.lit(10)).alias("key"), *[F.round(v, 6).alias(c) for c, v in conf.items()])


@query("SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN CAST(p_partkey % 10 AS VARCHAR) || '=' || CAST((p_partkey % 7) / 2e0 AS VARCHAR) || '/1.5' ELSE '' END AS layout FROM part")
def board_layouts(spark, d):
    k = F.col("p_partkey")
    text = F.when(k % 3 == 0, F.concat(F.lit('{"'), (k % 10).cast("string"), F.lit('": ['), (k % 7 / F.lit(2.0)).cast("string"), F.lit(", 1.5]}"))).when(k % 3 == 1, '{"a": [1, 2]}').otherwise("no json")
    entries = F.transform(F.map_entries(C.board_layout(text)), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"]["x"].cast("string"), F.lit("/"), e["value"]["y"].cast("string")))
    return table(spark, d, "part").select(k.alias("k"), F.array_join(entries, ",").alias("layout"))


_STEMS = "SELECT o_custkey AS session, CASE o_orderkey % 6 WHEN 0 THEN 'left' WHEN 1 THEN 'rigth' WHEN 2 THEN 'head' WHEN 3 THEN 'lefft' WHEN 4 THEN 'right' ELSE 'zzzzzz' END AS name, CASE WHEN o_orderkey % 11 = 0 THEN 'right' WHEN o_orderkey % 13 = 0 THEN 'odd' END AS truth FROM orders"


@query(f"""
WITH n AS (SELECT session, name, max(truth) AS truth FROM ({_STEMS}) GROUP BY ALL), t AS (SELECT *, CASE WHEN truth = 'right' THEN 'right' WHEN name IN ('left', 'right', 'head') THEN name WHEN name = 'rigth' THEN 'right' WHEN name = 'lefft' THEN 'left' END AS target FROM n),
p AS (SELECT session, bool_or(target IS NULL) AS lost, list(name) AS present, list(target) FILTER (WHERE target <> name) AS targets, list(name) FILTER (WHERE target <> name) AS sources FROM t GROUP BY 1),
e AS (SELECT session, CASE WHEN lost THEN 'unresolved' WHEN len(list_distinct(targets)) < len(targets) THEN 'several for one target' WHEN len(list_filter(targets, lambda x: list_contains(present, x) AND NOT list_contains(sources, x))) > 0 THEN 'target taken' END AS error FROM p)
SELECT session, name, target, error FROM t JOIN e USING (session) WHERE target IS NULL OR target <> name""")
def rename_plan(spark, d):
    return _rename(spark, d)[0]


def _rename(spark, d):
    k = F.col("o_orderkey")
    name = F.when(k % 6 == 0, "left").when(k % 6 == 1, "rigth").when(k % 6 == 2, "head").when(k % 6 == 3, "lefft").when(k % 6 == 4, "right").otherwise("zzzzzz")
    truth = F.when(k % 11 == 0, "right").when(k % 13 == 0, "odd")
    names = table(spark, d, "orders").select(F.col("o_custkey").alias("session"), name.alias("name"), truth.alias("truth")).groupBy("session", "name").agg(F.max("truth").alias("truth"))
    return C.rename_plan(names), names


@query("WITH r AS (" + ORACLE["rename_plan"] + "), s AS (SELECT session, max(error) AS error FROM r GROUP BY 1) SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS sessions, count(*) FILTER (WHERE error IS NULL) AS to_fix, count(error) AS errors FROM s")
def rename_summary(spark, d):
    return C.rename_summary(*_rename(spark, d))


@query("""WITH f AS (SELECT o_custkey AS session, CASE o_orderkey % 4 WHEN 0 THEN 'head' WHEN 1 THEN 'left' WHEN 2 THEN 'right' ELSE 'wall' END AS name, CASE WHEN o_orderkey % 3 = 0 THEN 'head' ELSE 'gripper' END AS role, o_orderkey % 5 = 0 AS mismatch FROM orders),
o AS (SELECT session, count(*) AS n, list_distinct(list(name) FILTER (WHERE name IN ('head', 'wall') AND role = 'gripper')) AS a, list_distinct(list(name) FILTER (WHERE name NOT IN ('head', 'wall') AND role = 'head')) AS b FROM f WHERE mismatch GROUP BY 1), p AS (SELECT session, a[1] AS a, b[1] AS b FROM o WHERE n = 2 AND len(a) = 1 AND len(b) = 1)
SELECT session, unnest([a, b]) AS name, unnest([b, a]) AS target FROM p""")
def swap_fixes(spark, d):
    f = table(spark, d, "orders").selectExpr("o_custkey as session", "case o_orderkey % 4 when 0 then 'head' when 1 then 'left' when 2 then 'right' else 'wall' end as name", "if(o_orderkey % 3 = 0, 'head', 'gripper') as role", "o_orderkey % 5 = 0 as mismatch")
    return C.swap_fixes(f)


@query("""WITH g AS (SELECT o_custkey AS session, o_orderkey AS idx, CASE o_orderkey % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'rigth' ELSE 'head' END AS camera, CASE WHEN o_orderkey % 7 > 0 THEN '/d/cameras/' || CASE o_orderkey % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'rigth' ELSE 'head' END || '/f.jpg' END AS file FROM orders),
n AS (SELECT *, CASE WHEN camera = 'rigth' THEN 'right' ELSE camera END AS c FROM g), t AS (SELECT *, CASE WHEN session % 2 = 0 AND c = 'left' THEN 'right' WHEN session % 2 = 0 AND c = 'right' THEN 'left' ELSE c END AS target FROM n)
SELECT session, idx, target AS camera, CASE WHEN file IS NOT NULL THEN '/d/cameras/' || target || '/f.jpg' END AS file FROM t""")
def grid_renames(spark, d):
    k = F.col("o_orderkey")
    cam = F.when(k % 3 == 0, "left").when(k % 3 == 1, "rigth").otherwise("head")
    g = table(spark, d, "orders").select(F.col("o_custkey").alias("session"), k.alias("idx"), cam.alias("camera"), F.when(k % 7 > 0, F.concat(F.lit("/d/cameras/"), cam, F.lit("/f.jpg"))).alias("file"))
    renames = g.where("session % 2 = 0").select("session").distinct().select("session", F.expr("stack(2, 'left', 'right', 'right', 'left') as (name, target)"))
    return C.grid_renames(g, renames)


@query("""WITH c AS (SELECT c_custkey AS k, 'operator ' || (c_custkey % 61) AS op, CASE WHEN c_custkey % 3 > 0 THEN 'RIG-' || (c_custkey % 4) END AS code FROM customer), n AS (SELECT *, k % 61 AS o, CAST(nullif(regexp_extract(code, '[0-9]+', 0), '') AS INT) AS own FROM c)
SELECT k, CASE WHEN own IS NULL OR own = 1 THEN 'rig_' || (CASE WHEN o <= 30 THEN o ELSE o - 30 END) END AS rig_id, CASE WHEN own IS NULL OR own = 1 THEN 'RIG-' || (CASE WHEN o <= 30 THEN o ELSE o - 30 END) ELSE code END AS code, CASE WHEN k % 4 = 0 THEN 'a' WHEN k % 4 = 1 THEN 'b' END AS operator,
    CASE WHEN s < 60 THEN printf('%ds', s) WHEN s < 3600 THEN printf('%dm %02ds', s // 60, s % 60) ELSE printf('%dh %02dm', s // 3600, s % 3600 // 60) END AS took FROM (SELECT *, k * 37 AS s FROM n)""")
def rig_fixes(spark, d):
    k = F.col("c_custkey")
    op, code = F.concat(F.lit("operator "), (k % 61).cast("string")), F.when(k % 3 > 0, F.concat(F.lit("RIG-"), (k % 4).cast("string")))
    fixed = X.fixed_rig(code, op)
    first = X.first_not_empty(F.when(k % 4 == 0, " a ").otherwise(F.lit(" ")), F.when(k % 4 == 1, "b"))
    return table(spark, d, "customer").select(k.alias("k"), fixed["rig_id"].alias("rig_id"), fixed["code"].alias("code"), first.alias("operator"), X.format_duration(k * 37).alias("took"))


# --- poses, markers, aggregates ---


@query("SELECT event_id, round(x, 6) AS x, round(y, 6) AS y, round(depth, 6) AS depth, worst, round(mid, 6) AS mid FROM (SELECT event_id, value - 1 AS x, 2e0 - event_id % 10 AS y, 40e0 * 0.8e0 * 640 / nullif(event_id % 50, 0) AS depth, greatest(event_id % 5, event_id % 7) / 1e0 AS worst, list_sort(list_filter([value, event_id % 9 - 3e0, event_id % 4 - 1e0], lambda v: v > 0)) AS l, l[len(l) // 2 + 1] AS mid FROM events)")
def pose_scalars(spark, d):
    c = F.col
    at = X.camera_to_world(F.array(F.lit(0.0), F.lit(3.141592653589793), F.lit(0.0)), F.array(F.lit(1.0), F.lit(2.0), F.lit(0.0)), F.array(c("value"), (c("event_id") % 10).cast("double"), F.lit(0.0)))
    e = table(spark, d, "events").select("event_id", at.alias("p"), X.depth_of_size(F.lit(40.0), c("event_id") % 50, F.lit(640)).alias("depth"), A.max_of_streams(F.expr("map('a', event_id % 5 / 1e0, 'b', event_id % 7 / 1e0)")).alias("worst"), A.upper_median(F.expr("array(value, event_id % 9 - 3e0, event_id % 4 - 1e0)")).alias("mid"))
    return rounded(e.select("event_id", (-c("p")[0]).alias("x"), (0 - c("p")[1]).alias("y"), "depth", "worst", "mid"), "x", "y", "depth", "mid")


@query("WITH f AS (SELECT user_id AS session, CASE WHEN event_id % 7 > 0 THEN event_id % 3 = 0 END AS l, event_id % 5 = 0 AS r FROM events), a AS (SELECT session, avg(CAST(coalesce(l, false) AS INT)) AS l, avg(CAST(r AS INT)) AS r FROM f GROUP BY 1) SELECT session, round(l, 6) AS left_rate, round(r, 6) AS right_rate, round(greatest(l, r), 6) AS any_rate FROM a")
def detection_rates(spark, d):
    f = table(spark, d, "events").selectExpr("user_id as session", "case when event_id % 7 > 0 then event_id % 3 = 0 end as left", "event_id % 5 = 0 as right")
    return rounded(C.detection_rates(f), "left_rate", "right_rate", "any_rate")


@query("SELECT user_id, round(median(value), 6) AS x_mm, round(median(event_id % 100), 6) AS y_mm, round(median(-value), 6) AS z_mm, count(*) AS n FROM events GROUP BY 1")
def median_pose(spark, d):
    return rounded(C.median_pose(table(spark, d, "events").selectExpr("user_id", "value as x_mm", "event_id % 100 / 1e0 as y_mm", "-value as z_mm"), ["user_id"]), "x_mm", "y_mm", "z_mm")


@query("WITH f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) SELECT user_id, round(median(value), 6) AS a, round(median(event_id % 13), 6) AS b FROM f WHERE rn <= 20 GROUP BY 1")
def median_vector(spark, d):
    rows = table(spark, d, "events").selectExpr("user_id", "event_id", "array(value, event_id % 13 / 1e0) as v")
    return rounded(C.median_vector(rows, ["user_id"], "v", ["event_id"], 20).selectExpr("user_id", "v[0] as a", "v[1] as b"), "a", "b")


@query("SELECT a.l_orderkey, a.l_linenumber AS a, b.l_linenumber AS b, round(sqrt(power(a.l_quantity - b.l_quantity, 2) + power(a.l_discount - b.l_discount, 2)), 6) AS pixels FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber")
def marker_pairs(spark, d):
    return rounded(C.marker_pairs(table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber as marker", "l_quantity as x", "l_discount as y"), ["l_orderkey"]), "pixels")


@query("SELECT user_id AS session, event_type AS camera, round(avg(CASE WHEN event_id % 6 > 0 THEN CAST(event_id % 2 = 0 AND event_id % 3 = 0 AS INT) END), 6) AS ratio FROM events GROUP BY 1, 2")
def marker_visibility(spark, d):
    rows = table(spark, d, "events").selectExpr("user_id as session", "event_type as camera", "event_id as frame", "case when event_id % 6 > 0 then filter(array(if(event_id % 2 = 0, 244, 0), if(event_id % 3 = 0, 255, 0)), x -> x > 0) end as markers")
    return rounded(C.marker_visibility(rows), "ratio")


@query("WITH f AS (SELECT user_id AS session, min_by(event_id * 2e0, event_id) AS first FROM events WHERE event_id % 3 = 0 GROUP BY 1) SELECT user_id AS session, event_id AS frame, round(CASE WHEN event_id % 3 = 0 THEN event_id * 2e0 ELSE coalesce(first, 0) + event_id / 30e0 END, 6) AS ts FROM events LEFT JOIN f ON f.session = user_id WHERE event_type = 'click'")
def frame_times(spark, d):
    e = table(spark, d, "events")
    out = C.frame_times(e.where("event_type = 'click'").selectExpr("user_id as session", "event_id as frame", "value as magnitude"), e.where("event_id % 3 = 0").selectExpr("user_id as session", "event_id as frame", "event_id * 2e0 as ts"))
    return rounded(out.select("session", "frame", "ts"), "ts")


_POSES = {"purchase": "stereo", "click": "head"}


@query(f"""
WITH {_series_sql(_POSES, 3600)}, pts AS (SELECT user_id, t AS x, v FROM ev WHERE series = 'stereo'), {_at("pts", "'head'", "hv")},
near AS (SELECT h.user_id, CASE WHEN h.user_id % 3 > 0 THEN sqrt(2 * power(v - y, 2) + power(v - y + 20, 2)) ELSE abs(v - y) * sqrt(3) END AS mm FROM hv h JOIN ends e ON e.user_id = h.user_id AND e.series = 'head' AND x BETWEEN e.t0 AND e.t1 JOIN ends s ON s.user_id = h.user_id AND s.series = 'stereo' WHERE least(e.n, s.n) >= 3)
SELECT user_id AS session, count(mm) AS compared, count(*) FILTER (WHERE mm <= 50) AS agreed, round(coalesce(avg(CAST(mm <= 50 AS INT)), 0), 6) AS rate, round(avg(mm), 4) AS mean_mm FROM (SELECT DISTINCT user_id FROM pts) LEFT JOIN near USING (user_id) GROUP BY 1""")
def cross_validation(spark, d):
    """Two of three sessions have camera poses: the same turn, and shifts 20 mm apart along z."""
    s = _series(spark, d, _POSES, 3600).selectExpr("user_id as session", "series", "t as ts_ms", "v as x_mm", "v as y_mm", "v as z_mm")
    stereo = s.where("series = 'stereo'").withColumn("pose_id", F.unix_micros(F.timestamp_seconds(F.col("ts_ms") * 3600)))
    poses = s.where("session % 3 > 0").selectExpr("session", "array(0D, 0D, 0D) as stereo_rotation", "array(0.1D, 0.2D, 0.3D) as stereo_shift", "array(0D, 0D, 0D) as head_rotation", "array(0.1D, 0.2D, 0.32D) as head_shift").distinct()
    return P.cross_validation(s.where("series = 'head'").drop("series"), stereo.drop("series"), poses=poses)


# --- reports ---

_RUN = Fixture("customer", "c_custkey AS session", "c_custkey % 5 > 0 AS valid", f"CASE WHEN c_custkey % 3 > 0 THEN {r1('(c_custkey % 97) * 1.03e0')} END AS score", "(c_custkey % 500) / 1e0 AS duration_seconds", "c_custkey % 7 = 0 AS has_errors")
_HM = "printf('%dh%02d', CAST(floor({0}) AS BIGINT) // 3600, CAST(floor({0}) AS BIGINT) % 3600 // 60)"


@query(f"""WITH s AS ({_RUN.sql}), g AS (SELECT *, {grade_sql("score")} AS g FROM s), t AS (SELECT count(*) AS n, count(*) FILTER (WHERE valid) AS v, count(score) AS c, {r1("avg(score)")} AS m, sum(duration_seconds) AS secs, sum(duration_seconds) FILTER (WHERE NOT has_errors) AS clean, {", ".join(f"count(*) FILTER (WHERE g = '{x}') AS n{x}" for x in "ABCDF")} FROM g)
SELECT n AS on_disk, v AS valid, {r1("100e0 * v / n")} AS valid_pct, {r1("100e0 * (n - v) / n")} AS invalid_pct, {_HM.format("secs")} AS total_hours, {_HM.format("clean")} AS clean_hours, c AS scored, m AS avg_score, {", ".join(r1(f"100e0 * n{x} / c") + f" AS {x.lower()}_pct" for x in "ABCDF")} FROM t""")
def run_summary(spark, d):
    return R.run_summary(_RUN(spark, d))


@query(f"""WITH s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 > 0 THEN {r1('(c_custkey % 97) * 1.03e0')} END AS score FROM customer), e AS (SELECT 'grade' AS kind, coalesce({grade_sql("score")}, 'F') AS name, NULL::DOUBLE AS v FROM s UNION ALL SELECT 'status', CASE WHEN k % 4 = 0 THEN 'OK' WHEN k % 4 = 1 THEN 'ANOMALY' ELSE 'ERROR' END, NULL FROM s
    UNION ALL SELECT 'score', 'score', coalesce(score, 0) FROM s UNION ALL SELECT 'criterion', 'sync', (k % 10) / 1e0 FROM s WHERE k % 2 = 0 UNION ALL SELECT 'criterion', 'imu', (k % 6) / 1e0 FROM s WHERE k % 2 = 0 UNION ALL SELECT 'issue', CASE WHEN k % 6 = 0 THEN 'sync' ELSE 'other' END, NULL FROM s WHERE k % 3 = 0)
SELECT kind, name, count(*) AS n, round(avg(v), 6) AS mean FROM e GROUP BY 1, 2""")
def live_stats(spark, d):
    k = F.col("c_custkey")
    score = F.when(k % 3 > 0, X.round1(k % 97 * F.lit(1.03)))
    rows = table(spark, d, "customer").select(
        k.alias("session"), score.alias("score"), X.grade(score).alias("grade"), F.when(k % 4 == 0, "OK").when(k % 4 == 1, "ANOMALY").alias("status"), F.expr("case when c_custkey % 2 = 0 then map('sync', c_custkey % 10 / 1e0, 'imu', c_custkey % 6 / 1e0) end").alias("criteria"),
        F.expr("case when c_custkey % 6 = 0 then array('  [sync] late') when c_custkey % 3 = 0 then array('plain') end").alias("lines"),
    )
    return R.live_stats(rows)


_FINDINGS = Fixture("orders", "o_custkey AS session", "CASE o_orderkey % 23 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'LOW' ELSE 'OK' END AS confidence")


@query(f"WITH f AS ({_FINDINGS.sql}), s AS (SELECT session, bool_or(confidence = 'HIGH') AS h, bool_or(confidence <> 'OK') AS a FROM f GROUP BY 1) SELECT (SELECT count(*) FROM customer) AS analysed, count(*) FILTER (WHERE h) AS contaminated, count(*) FILTER (WHERE a AND NOT h) AS warned, count(*) FILTER (WHERE a) AS flagged FROM s WHERE session IN (SELECT c_custkey FROM customer)")
def contamination_totals(spark, d):
    return R.contamination_totals(_FINDINGS(spark, d), table(spark, d, "customer").selectExpr("c_custkey as session"))


@query("SELECT l_orderkey * 10 + l_linenumber AS session, l_discount * 0.5 AS p FROM lineitem ORDER BY p, session LIMIT 30")
def smallest_p(spark, d):
    return R.smallest_p(table(spark, d, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber as session", "l_discount * 0.5 as p"))


@query("SELECT n_name AS disk, count(*) FILTER (WHERE s_suppkey % 4 > 0 AND s_suppkey % 3 > 0) AS sessions, array_to_string(list_sort(list(s_name)), ',') AS names, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def disk_folders(spark, d):
    e = table(spark, d, "supplier").join(table(spark, d, "nation"), F.expr("s_nationkey = n_nationkey")).selectExpr("n_name as disk", "if(s_suppkey % 4 > 0, 'Session_x', 'x_session') as name", "s_suppkey % 3 > 0 as is_dir", "s_name")
    return R.sessions_on_disk(e).join(R.folders_per_disk(e.selectExpr("disk", "s_name as name")), "disk")


@query("SELECT o_orderpriority, count(*) AS sessions, CAST(sum(o_orderkey) AS BIGINT) AS bytes, round(sum(o_totalprice), 4) AS seconds FROM orders GROUP BY 1")
def batch_totals(spark, d):
    return R.totals(table(spark, d, "orders").selectExpr("o_orderpriority", "o_orderkey as size_bytes", "o_totalprice as duration_seconds"), ["o_orderpriority"])


@query("SELECT o_orderpriority AS disk, count(*) AS sessions, count(*) FILTER (WHERE o_orderstatus = 'F') AS with_analysis, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS seconds FROM orders GROUP BY 1")
def fast_scan(spark, d):
    o = table(spark, d, "orders")
    return rounded(C.fast_scan(o.selectExpr("o_orderpriority as disk", "o_orderkey as session"), o.where("o_orderstatus = 'F'").selectExpr("o_orderkey as session", "o_totalprice as seconds")), "seconds", digits=2)


@query("""WITH v AS (""" + ORACLE["conclusions"] + """), c AS (SELECT o_custkey AS session, count(*) AS n FROM orders GROUP BY 1) SELECT session, verdict IN ('passed', 'warning') AS passed, CASE WHEN verdict = 'failed' THEN 'failed' WHEN warnings <> '' THEN 'warning' ELSE 'passed' END AS verdict, n AS file_count, warnings FROM v JOIN c USING (session)""")
def treatment(spark, d):
    c = _conclusions(spark, d)
    rows = c.selectExpr("session", "verdict != 'failed' as passed", "50D as score", "'D' as grade", "null as size_bytes", "1D as duration_seconds").join(table(spark, d, "orders").groupBy(F.col("o_custkey").alias("session")).agg(F.count(F.lit(1)).alias("file_count")), "session")
    doc = F.from_json("document", "passed boolean, verdict string, stats struct<file_count:long>, warnings array<string>")
    return R.treatment(rows, c).select("session", doc.alias("x")).select("session", "x.passed", "x.verdict", "x.stats.file_count", F.array_join("x.warnings", "|").alias("warnings"))


@query("""WITH e AS (SELECT o_custkey AS batch, concat('s', o_orderkey) AS session, o_orderkey AS k FROM orders), l AS (SELECT batch, session, concat_ws(chr(10), '── ' || session, '  operator: ' || CASE WHEN k % 3 > 0 THEN 'n' || k ELSE '—' END || ' (' || k || ')', '  rig: r, —', '  mission: —', '  result: SUCCESS', '  duration: ' || (k % 60) || 's', '  size: ' || (k % 1000) || ' B') AS t FROM e)
SELECT batch, concat_ws(chr(10), count(*) || ' session(s)', string_agg(t, chr(10) ORDER BY session), 'archive attached: 10 B') AS body FROM l GROUP BY 1""")
def mail_bodies(spark, d):
    e = table(spark, d, "orders").selectExpr("o_custkey as batch", "concat('s', o_orderkey) as session", "if(o_orderkey % 3 > 0, concat('n', o_orderkey), null) as operator_name", "string(o_orderkey) as operator_id", "'r' as rig", "string(null) as site", "string(null) as mission", "'SUCCESS' as result", "o_orderkey % 60 / 1e0 as duration_seconds", "o_orderkey % 1000 as size_bytes")
    return R.mail_body(e, F.lit(10), F.lit(True))


@query(f"""WITH RECURSIVE e AS (SELECT user_id, event_id, {_SECONDS} AS t FROM events), n AS (SELECT *, min(row(t, event_id)) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN 200000 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt, min(row(t, event_id)) OVER (PARTITION BY user_id) AS fst FROM e),
k AS (SELECT user_id, t, event_id AS done, nxt FROM n WHERE row(t, event_id) = fst UNION ALL SELECT n.user_id, n.t, n.event_id, n.nxt FROM k JOIN n ON n.user_id = k.user_id AND row(n.t, n.event_id) = k.nxt)
SELECT user_id AS run, CASE WHEN user_id % 3 = 0 THEN 'completed' WHEN user_id % 3 = 1 THEN 'aborted' ELSE 'running' END AS status, CASE WHEN user_id % 3 < 2 THEN -1 ELSE max_by(done, t) END AS done FROM k GROUP BY 1 UNION ALL SELECT 100000 + s_suppkey, 'old', 1 FROM supplier""")
def run_progress(spark, d):
    e = table(spark, d, "events").selectExpr("user_id as run", "unix_micros(timestamp(ts)) / 1e6 as at", "event_id as done")
    progress = e.selectExpr("run", "'progress' as kind", "at", "done", "100L as total")
    ends = e.groupBy("run").agg(F.max("at").alias("at"), F.lit(-1).cast("long").alias("done")).where("run % 3 < 2").selectExpr("run", "if(run % 3 = 0, 'completed', 'aborted') as kind", "at + 1 as at", "done", "100L as total")
    runs = table(spark, d, "supplier").selectExpr("100000L + s_suppkey as run", "'old' as status", "1L as done", "2L as total", "0D as updated_at")
    return R.run_progress(runs, progress.union(ends), every=200_000.0).select("run", "status", "done")


@query("SELECT user_id AS name, count(*) AS tries, CASE WHEN arg_max(event_id % 3 = 0, (ts, event_id)) THEN 'done' ELSE 'pending' END AS state FROM events GROUP BY 1")
def retry_states(spark, d):
    from sessionloom.streaming.watch import attempts

    return attempts(table(spark, d, "events").selectExpr("user_id as name", "event_id % 3 = 0 as ok", "struct(ts, event_id) as at"))


@query("SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_custkey, o_orderstatus, o_orderkey) - 1 AS number FROM orders")
def multi_key_order(spark, d):
    return O.numbered(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey", "o_orderstatus", "o_orderkey"])


_DIVERSE = 5
_CHOSEN = " ".join(
    f"c{k} AS (SELECT user_id, arg_min(event_id, (abs(value - t{k}), value, event_id)) AS event_id FROM e WHERE event_id NOT IN (SELECT event_id FROM ({' UNION ALL '.join(['SELECT -1 AS event_id', *[f'SELECT event_id FROM c{j}' for j in range(k)]])})) GROUP BY 1),"
    for k in range(_DIVERSE)
)


@query(f"WITH b AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1), e AS (SELECT user_id, event_id, value, {', '.join(f'lo + {k} * ((hi - lo) / 4) AS t{k}' for k in range(4))}, hi AS t4 FROM events JOIN b USING (user_id) WHERE value IS NOT NULL), {_CHOSEN} a AS ({' UNION ALL '.join(f'SELECT event_id FROM c{k}' for k in range(_DIVERSE))}) SELECT user_id, event_id, value FROM e WHERE event_id IN (SELECT event_id FROM a)")
def diverse_sample(spark, d):
    return G.diverse_sample(table(spark, d, "events").select("user_id", "event_id", "value"), "user_id", "value", "event_id", _DIVERSE)


_TODO = Fixture("customer", "c_custkey AS session_id", "CASE WHEN c_custkey % 11 > 0 THEN c_custkey * 37 % 1000 END AS day", "1000 + c_custkey * 7 % 5000 AS size_bytes", where="c_custkey % 13 > 0")


@query(f"""
WITH RECURSIVE s AS (SELECT *, row_number() OVER (ORDER BY day NULLS LAST, session_id) AS k FROM ({_TODO.sql})), h AS (SELECT list(s_suppkey ORDER BY s_suppkey) AS ids, list(CAST(20000 + s_suppkey * 100 AS DOUBLE) ORDER BY s_suppkey) AS free FROM supplier),
r AS (SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS session_id, CAST(NULL AS BIGINT) AS pos, free FROM h
  UNION ALL SELECT k, session_id, pos, CASE WHEN pos IS NULL THEN free ELSE list_concat(free[1:pos - 1], [free[pos] - size_bytes], free[pos + 1:]) END FROM (SELECT s.k, s.session_id, s.size_bytes, r.free, nullif(list_position(list_transform(r.free, lambda f: f - s.size_bytes >= 5000), true), 0) AS pos FROM r JOIN s ON s.k = r.k + 1))
SELECT session_id, 'ssd' AS source, CASE WHEN pos IS NOT NULL THEN concat('/mnt/', ids[pos]) END AS target, CASE WHEN pos IS NULL THEN 'wait' ELSE 'copy' END AS action FROM r, h WHERE k > 0""")
def replication_plan(spark, d):
    s = _TODO(spark, d).withColumns({"started_at": F.timestamp_seconds(F.col("day") * 86_400), "ssd_disk_uuid": F.lit("S"), "hdd_disk_uuid": F.lit(None).cast("string")})
    h = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("disk_uuid"), F.format_string("%08d", "s_suppkey").alias("label"), F.concat(F.lit("/mnt/"), F.col("s_suppkey").cast("string")).alias("mount_path"), F.lit("HDD").alias("disk_type"), (20_000 + F.col("s_suppkey") * 100).cast("long").alias("free_bytes"))
    ssd = spark.createDataFrame([("S", "", "ssd", "SSD", 0)], "disk_uuid string, label string, mount_path string, disk_type string, free_bytes long")
    return P.replication_plan(s, h.union(ssd), reserve=5000)


@query(f"""
WITH s AS ({_WATCH.sql}), c AS (SELECT session, error, CASE WHEN max_drift IS NULL THEN 50e0 ELSE greatest(0, 100 - 5 * max_drift) END AS sync,
    CASE WHEN expected_frames IS NULL THEN 50e0 WHEN expected_frames > 0 THEN greatest(0, 100 - 1.5e0 * (100e0 * gap_frames / expected_frames) - least(0.2e0 * (100e0 * queue_drops / expected_frames), 10)) ELSE 100e0 END AS fps,
    CASE WHEN coalesce(sync_ok, true) THEN greatest(0, 100 - 200 * coalesce(sync_delta, 0e0)) ELSE greatest(0, 20 - 100 * coalesce(sync_delta, 0e0)) END AS cam_sensor FROM s),
t AS (SELECT *, CASE WHEN error IS NOT NULL THEN 0e0 ELSE {r1("0.40e0 * sync + 0.35e0 * fps + 0.25e0 * cam_sensor")} END AS score FROM c)
SELECT session, round(sync, 6) AS sync, round(fps, 6) AS fps, round(cam_sensor, 6) AS cam_sensor, score, {grade_sql("score")} AS grade FROM t""")
def light_score(spark, d):
    return rounded(P.light_score(_watch(spark, d)).select("session", "sync", "fps", "cam_sensor", "score", "grade"), "sync", "fps", "cam_sensor")
