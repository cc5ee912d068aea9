"""Sources, sinks and small rules over files that Spark writes from the driver's tables, each with its rule in DuckDB SQL.

A query writes its files below the shared folder, reads them again with the reader it shows, and its SQL states what the reader must give on the rows the files were made of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionloom.functions import scalars as X
from sessionloom.operators import aggregates as A
from sessionloom.operators import grouped as G
from sessionloom.operators import ledger as L
from sessionloom.plans import reports as R
from sessionloom.plans import sessions as P
from sessionloom.plans.session_queries import Fixture, listed, listed_sql
from sessionloom.plans.table_queries import _shared, grade_sql
from sessionloom.session import table
from sessionloom.sources import documents as D
from sessionloom.sources import inventory as I
from sessionloom.streaming import watch

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# --- rules ---


@query("""WITH g AS (SELECT o_custkey AS session, list_sort(list(CASE WHEN o_orderkey % 4 > 0 THEN o_totalprice ELSE 0 END) FILTER (WHERE o_orderkey % 4 > 0 AND o_totalprice > 0)) AS d FROM orders GROUP BY 1)
SELECT session, d[len(d) // 2 + 1] AS duration FROM g""")
def upper_medians(spark, d):
    """The element at half the length of the positive durations."""
    each = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("session")).agg(F.collect_list(F.when(F.col("o_orderkey") % 4 > 0, F.col("o_totalprice")).otherwise(0.0)).alias("d"))
    return each.select("session", A.upper_median(F.col("d")).alias("duration"))


_FOLDER = Fixture("orders", "o_custkey % 7 AS root", "concat('session_', o_custkey) AS session", "concat('/d/session_', o_custkey) AS session_path", "CASE o_orderkey % 3 WHEN 0 THEN 'config.json' WHEN 1 THEN 'metadata.json' ELSE concat('f', o_orderkey) END AS name", "CASE WHEN o_custkey % 5 = 0 OR o_orderkey % 6 = 2 THEN 0 ELSE o_orderkey END AS size", "o_orderkey / 2e0 AS mtime", "o_orderkey % 11 = 0 AS is_dir")


@query(f"""WITH f AS ({_FOLDER.sql}) SELECT session, count(*) FILTER (WHERE NOT is_dir) AS files, CAST(coalesce(sum(size) FILTER (WHERE NOT is_dir), 0) AS BIGINT) AS size_bytes, max(mtime) AS mtime, count(*) FILTER (WHERE NOT is_dir AND size = 0) AS empty_files,
    count(*) FILTER (WHERE NOT is_dir) = 0 OR count(*) FILTER (WHERE NOT is_dir AND name LIKE 'f%') = 0 OR sum(size) FILTER (WHERE NOT is_dir AND name LIKE 'f%') = 0 AS empty FROM f GROUP BY session""")
def folder_emptiness(spark, d):
    """Sizes and latest times of folders, and those without a byte of data."""
    return I.emptiness(I.sessions(_FOLDER(spark, d))).select("session", "files", "size_bytes", "mtime", "empty_files", "empty")


@query(f"SELECT c_custkey AS session, {grade_sql('s')} AS grade, NOT bad AND s >= 40 AS passes FROM (SELECT c_custkey, c_custkey % 101 / 1.0::DOUBLE AS s, c_custkey % 7 = 0 AS bad FROM customer)")
def pass_rule(spark, d):
    s = F.col("c_custkey") % 101 / F.lit(1.0)
    return table(spark, d, "customer").select(F.col("c_custkey").alias("session"), X.grade(s).alias("grade"), P.passes(F.col("c_custkey") % 7 == 0, s).alias("passes"))


_MISSION = Fixture("customer", "c_custkey AS session", "CASE c_custkey % 5 WHEN 0 THEN concat('m', c_custkey) WHEN 1 THEN '' WHEN 2 THEN '  ' END AS scenario_id", "CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN '' END AS name", "CASE c_custkey % 3 WHEN 0 THEN concat('w', c_custkey) END AS written", "CASE c_custkey % 2 WHEN 0 THEN 's' END AS scenario")


@query(f"WITH m AS ({_MISSION.sql}) SELECT session, coalesce(nullif(trim(scenario_id), ''), nullif(trim(name), ''), nullif(trim(written), ''), nullif(trim(scenario), '')) AS mission FROM m")
def mission_fallback(spark, d):
    return _MISSION(spark, d).select("session", X.first_not_empty(*map(F.col, ("scenario_id", "name", "written", "scenario"))).alias("mission"))


_PENDING = Fixture("orders", "o_orderkey AS session", "CASE o_orderkey % 4 WHEN 0 THEN 'a,b,c' WHEN 1 THEN 'a' WHEN 2 THEN '' END AS issues", "CASE o_orderkey % 3 WHEN 0 THEN 'x,y,z' WHEN 1 THEN '' END AS errs")


@query(f"""WITH p AS ({_PENDING.sql}), l AS (SELECT session, {listed_sql('issues')} AS i, {listed_sql('errs')} AS e FROM p)
SELECT session, CASE WHEN len(i) > 0 THEN array_to_string(i[1:2], '; ') WHEN len(e) > 0 THEN array_to_string(e[1:2], '; ') ELSE 'not sent yet' END AS reason FROM l""")
def pending_reasons(spark, d):
    return _PENDING(spark, d).select("session", L.pending_reason(listed("issues"), listed("errs")).alias("reason"))


@query("SELECT nation.n_nationkey AS disk_order, '/m/' || n_name AS mount, CASE n_nationkey % 4 WHEN 0 THEN 'ssd' ELSE 'hdd' END AS kind, 'l' || n_nationkey AS label, 'u' || n_nationkey AS uuid FROM nation WHERE n_nationkey % 4 < 2 AND n_nationkey % 5 > 0")
def disk_entries(spark, d):
    """Entries of an unknown type or without an id are left out."""
    k = F.col("n_nationkey")
    kind = F.when(k % 4 == 0, "SSD").when(k % 4 == 1, "hdd").otherwise("tape")
    entry = F.concat_ws(":", F.concat(F.lit("/m/"), "n_name"), kind, F.concat(F.lit("l"), k), F.when(k % 5 > 0, F.concat(F.lit("u"), k)).otherwise(""))
    spec = table(spark, d, "nation").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k, entry.alias("e")))), lambda x: x["e"]), ";")).first()[0]  # the nations
    return I.disks_of(spec, spark).select(F.col("disk_order").cast("long").alias("disk_order"), "mount", "kind", "label", "uuid")


@query("SELECT event_id, json_object('k', json_extract(props, '$.k'), 'side', CASE WHEN event_id % 2 = 0 THEN 'left' ELSE 'right' END, 'left', ['right', 'x', 'left'])::VARCHAR AS swapped FROM events")
def json_value_renames(spark, d):
    """Left and right change places in values, not in keys."""
    e = table(spark, d, "events")
    k = F.coalesce(F.get_json_object("props", "$.k"), F.lit("null"))
    doc = F.concat(F.lit('{"k":'), k, F.lit(',"side":"'), F.when(F.col("event_id") % 2 == 0, "right").otherwise("left"), F.lit('","left":["left","x","right"]}'))
    swapped = G.replace_json_values(e.select("event_id", doc.alias("doc")), "doc", {"left": "right", "right": "left"})
    return swapped.select("event_id", F.regexp_replace(F.regexp_replace("doc", ", ", ","), ": ", ":").alias("swapped"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a \"right\" and \"left\" x' ELSE '\"left\", left' END AS swapped FROM events")
def quoted_renames(spark, d):
    text = F.when(F.col("event_id") % 2 == 0, 'a "left" and "right" x').otherwise('"right", left')
    return G.replace_quoted(table(spark, d, "events").select("event_id", text.alias("swapped")), "swapped", {"left": "right", "right": "left"})


_CAPTURE = Fixture("customer", "c_custkey AS session", "CASE WHEN c_custkey % 7 > 0 THEN 'left,right' ELSE '' END AS cams", "CASE WHEN c_custkey % 3 > 0 THEN 'left' END AS sens", "c_custkey % 101 / 1e0 AS score")
_CAPTURED = Fixture("orders", "o_custkey AS session", "CASE o_orderkey % 8 WHEN 7 THEN 'sensors' ELSE 'cameras' END AS subdir", "CASE o_orderkey % 8 WHEN 0 THEN 'left.mp4' WHEN 1 THEN 'left.jsonl' WHEN 2 THEN 'right.mp4' WHEN 3 THEN 'right.jsonl' WHEN 4 THEN 'resample_report.json' WHEN 5 THEN 'resampled_30hz.jsonl' WHEN 6 THEN 'notes.txt' ELSE 'left.jsonl' END AS name", "CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey ELSE 0 END AS size", "o_orderkey % 5 > 0 AS ok")


@query(f"""WITH s AS ({_CAPTURE.sql}), f AS ({_CAPTURED.sql}), x AS (SELECT session, unnest(list_concat(CASE WHEN cams <> '' THEN ['cameras/left.mp4', 'cameras/left.jsonl', 'cameras/right.mp4', 'cameras/right.jsonl', 'cameras/resample_report.json', 'cameras/resampled_30hz.jsonl'] ELSE [] END, CASE WHEN sens = 'left' THEN ['sensors/left.jsonl'] ELSE [] END)) AS file FROM s),
h AS (SELECT session, subdir || '/' || name AS file, bool_and(ok) AS ok FROM f WHERE size > 0 GROUP BY 1, 2), j AS (SELECT x.session, count(*) FILTER (WHERE h.file IS NULL) AS missing, count(*) FILTER (WHERE NOT h.ok) AS corrupt FROM x LEFT JOIN h ON h.session = x.session AND h.file = x.file GROUP BY 1)
SELECT s.session, coalesce(missing, 0) AS missing, coalesce(corrupt, 0) AS corrupt, 1 + coalesce(missing, 0) + coalesce(corrupt, 0) AS errors, CASE WHEN coalesce(missing + corrupt, 0) > 0 THEN 0e0 ELSE score END AS score, CASE WHEN coalesce(missing + corrupt, 0) > 0 THEN 'F' ELSE {grade_sql('score')} END AS grade FROM s LEFT JOIN j USING (session)""")
def capture_integrity(spark, d):
    s = _CAPTURE(spark, d).select("session", listed("cams").alias("cameras"), listed("sens").alias("sensors"), "score", X.grade(F.col("score")).alias("grade"), F.array(F.lit("e")).alias("errors"))
    size = lambda c: F.size(c).cast("long").alias(c)
    return P.capture_integrity(s, _CAPTURED(spark, d)).select("session", size("missing"), size("corrupt"), size("errors"), "score", "grade")


@query("""WITH f AS (SELECT o_custkey AS session, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS a, count(*) FILTER (WHERE o_orderkey % 3 = 1) AS b, count(*) FILTER (WHERE o_orderkey % 3 = 2) AS x FROM orders GROUP BY 1)
SELECT session, 'extra' AS view FROM f WHERE x > 0 UNION ALL SELECT session, 'missing' FROM f WHERE a = 0 OR b = 0 UNION ALL SELECT session, 'both' FROM f WHERE x > 0 AND (a = 0 OR b = 0) UNION ALL SELECT session, 'all' FROM f WHERE x > 0 OR a = 0 OR b = 0""")
def integrity_views(spark, d):
    name = F.when(F.col("o_orderkey") % 3 == 0, "a").when(F.col("o_orderkey") % 3 == 1, "b").otherwise("x")
    report = P.exact_set(table(spark, d, "orders").select(F.col("o_custkey").alias("session"), F.lit("").alias("subdir"), name.alias("name"), F.lit(False).alias("is_dir"), F.lit(True).alias("ok")), ("a", "b"), ())
    views = [P.integrity_view(report, e, m).select("session", F.lit(v).alias("view")) for v, e, m in (("extra", True, False), ("missing", False, True), ("both", True, True), ("all", False, False))]
    return views[0].union(views[1]).union(views[2]).union(views[3])


# --- JSON lines and documents ---


def _files(spark: SparkSession, rows: DataFrame, key: str, order: str, line: str = "line") -> str:
    """A text file (or several) for each key, its lines in order; the folder."""
    out = _shared(spark)
    rows.repartition(key).sortWithinPartitions(key, order).select(F.col(key).alias("key"), F.col(line).alias("value")).write.partitionBy("key").text(out)
    return out


def _key(c: str = "path"):
    return F.regexp_extract(c, "/key=([^/]+)/", 1).cast("long")


@query("""WITH e AS (SELECT user_id % 50 AS k, event_id, row_number() OVER (PARTITION BY user_id % 50 ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id % 50) AS m FROM events)
SELECT k, min(event_id) FILTER (WHERE n = 1) * 1.5::DOUBLE AS t_start, min(event_id) FILTER (WHERE n = m) * 1.5::DOUBLE AS t_end, count(*) AS n, NOT bool_or(n = m AND k % 7 = 0) AS ok FROM e GROUP BY 1 HAVING count(*) >= 2""")
def line_ends(spark, d):
    """First and last lines of streams; every seventh stream's last line is cut off."""
    e = table(spark, d, "events").select((F.col("user_id") % 50).alias("k"), "event_id")
    last = F.col("event_id") == F.max("event_id").over(Window.partitionBy("k"))
    body = F.format_string('{"t": %.1f', F.col("event_id") * 1.5)
    folder = _files(spark, e.withColumn("line", F.when(last & (F.col("k") % 7 == 0), body).otherwise(F.concat(body, F.lit("}")))), "k", "event_id")
    lines = D.lines(spark, [folder])
    timed = lines.withColumn("ts_ms", F.regexp_extract("line", "([0-9.]+)", 1).cast("double"))
    met = D.first_last(timed).join(D.jsonl_whole_ok(lines), "path")
    return met.select(_key().alias("k"), "t_start", "t_end", "n", "ok")


@query("""WITH e AS (SELECT user_id % 40 AS k, event_id, CASE WHEN event_id % 9 > 0 THEN event_id * 0.5::DOUBLE END AS t, CASE WHEN event_id % 7 > 0 THEN event_id % 100 / 4.0::DOUBLE END AS o FROM events)
SELECT k, t, o AS opening FROM e WHERE t IS NOT NULL AND o IS NOT NULL""")
def sensor_openings(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 40).alias("k"), "event_id")
    value = lambda cond, c: F.when(cond, c.cast("string")).otherwise("null")
    line = F.concat(F.lit('{"host_time_sec": '), value(F.col("event_id") % 9 > 0, F.col("event_id") * 0.5), F.when(F.col("event_id") % 14 > 0, F.concat(F.lit(', "Opening_width": '), value(F.col("event_id") % 7 > 0, F.col("event_id") % 100 / 4))).otherwise(""), F.lit("}"))
    rows = D.sensor_openings(D.lines(spark, [_files(spark, e.withColumn("line", line), "k", "event_id")]))
    return rows.select(_key().alias("k"), "t", "opening")


@query("""WITH e AS (SELECT user_id % 30 AS k, event_id % 6 AS c FROM events) SELECT k, count(*) AS total, count(*) FILTER (WHERE c IN (0, 1)) AS valid, round(count(*) FILTER (WHERE c IN (0, 1)) / count(*), 6) AS valid_ratio FROM e GROUP BY 1""")
def sensor_quaternions(spark, d):
    """Quaternions that are null, of three numbers, all zeros, or hold a null are not valid."""
    e = table(spark, d, "events").select((F.col("user_id") % 30).alias("k"), "event_id")
    c = F.col("event_id") % 6
    q = F.when(c == 0, "[1, 0, 0, 0]").when(c == 1, "[0.5, -0.5, 0.5, 1e-12]").when(c == 2, "[0, 0, 1e-10, 0]").when(c == 3, "[1, 0, 0]").when(c == 4, "null").otherwise("[1, null, 0, 0]")
    line = F.concat(F.lit('{"host_time_sec": 1.5, "q": '), q, F.lit("}"))
    rows = D.quaternion_ratio(D.sensor_quaternions(D.lines(spark, [_files(spark, e.withColumn("line", line), "k", "event_id")])))
    return rows.select(_key().alias("k"), "total", "valid", F.round("valid_ratio", 6).alias("valid_ratio"))


@query("""WITH e AS (SELECT user_id % 20 AS k, event_id, event_id % 5 AS c FROM events)
SELECT k, CASE WHEN c < 2 THEN event_id * 1.0::DOUBLE ELSE event_id * 2.0::DOUBLE END AS ts, CASE WHEN c < 3 THEN 'cameras/right/' || event_id END AS file FROM e WHERE c < 4""")
def grid_rows(spark, d):
    """A camera's own time (under its name or a misspelt one), else the grid's; points without either are left out."""
    e = table(spark, d, "events").select((F.col("user_id") % 20).alias("k"), "event_id")
    c, n = F.col("event_id") % 5, F.col("event_id").cast("string")
    own = F.when(c == 0, F.concat(F.lit('"right": {"capture_timestamp_sec": '), n, F.lit(', "file": "cameras/right/'), n, F.lit('"}'))).when(c == 1, F.concat(F.lit('"rigth": {"capture_timestamp_sec": '), n, F.lit(', "file": "cameras/right/'), n, F.lit('"}')))
    own = own.when(c == 2, F.concat(F.lit('"right": {"file": "cameras/right/'), n, F.lit('"}'))).otherwise("")
    line = F.concat(F.lit("{"), F.when(c < 4, F.concat(F.lit('"grid_t": '), (F.col("event_id") * 2).cast("string"), F.lit(", "))).otherwise(""), F.lit('"frames": {'), own, F.lit("}}"))
    rows = D.grid(D.lines(spark, [_files(spark, e.withColumn("line", line), "k", "event_id")]), "right", "rigth")
    return rows.select(_key().alias("k"), "ts", "file")


@query("""WITH e AS (SELECT user_id % 60 AS k, event_id, row_number() OVER (PARTITION BY user_id % 60 ORDER BY event_id) - 1 AS n FROM events)
SELECT k AS session, n AS lineno, CASE WHEN k % 4 > 1 THEN event_id * 4.0::DOUBLE WHEN event_id % 3 = 0 THEN event_id * 2.0::DOUBLE ELSE event_id * 1.0::DOUBLE END AS ts FROM e WHERE k % 4 < 2 OR (k % 4 = 2 AND event_id % 5 > 0)""")
def camera_times(spark, d):
    """Of four sessions two have sound grids (a null time stands for the grid's); one's grid has a line without any time, so that its camera's lines count; one's lines are spoilt too."""
    e = table(spark, d, "events").select((F.col("user_id") % 60).alias("k"), "event_id")
    n, last = F.col("event_id").cast("string"), F.col("event_id") == F.max("event_id").over(Window.partitionBy("k"))
    own = F.when(F.col("event_id") % 3 == 0, F.lit("null")).otherwise(n)
    point = F.concat(F.lit('{"grid_t": '), (F.col("event_id") * 2).cast("string"), F.lit(', "frames": {"'), F.when(F.col("k") % 2 == 0, "right").otherwise("rigth"), F.lit('": {"capture_timestamp_sec": '), own, F.lit("}}}"))
    grid = e.withColumn("line", F.when(last & (F.col("k") % 4 > 1), '{"frames": {"left": {}}}').otherwise(point))
    frame = F.when(F.col("event_id") % 5 > 0, F.concat(F.lit('{"capture_timestamp_sec": '), (F.col("event_id") * 4).cast("string"), F.lit("}"))).otherwise("{}")
    mine = e.withColumn("line", F.when(last & (F.col("k") % 4 == 3), "{").otherwise(frame))
    lines = lambda rows: D.lines(spark, [_files(spark, rows, "k", "event_id")]).withColumn("session", _key())
    return D.camera_times(lines(grid), lines(mine), "right", "rigth")


@query("SELECT s_suppkey AS k, s_suppkey % 3 > 0 AS valid, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name, CASE WHEN s_suppkey % 3 > 0 AND s_suppkey % 2 = 0 THEN s_nationkey END AS nation FROM supplier")
def json_documents(spark, d):
    """Whole documents, a third of them cut off; a number of the wrong type is null."""
    k = F.col("s_suppkey")
    doc = F.concat(F.lit('{"name": "'), "s_name", F.lit('",'), F.lit("\n"), F.lit('"nation": '), F.when(k % 2 == 0, F.col("s_nationkey").cast("string")).otherwise('"none"'), F.when(k % 3 > 0, "}").otherwise(""))
    folder = _shared(spark)
    table(spark, d, "supplier").select(k.alias("key"), doc.alias("value")).repartition("key").write.partitionBy("key").text(folder)
    docs = D.parsed(D.texts(spark, [folder]))
    return docs.select(_key().alias("k"), F.col("doc").isNotNull().alias("valid"), D.field(F.col("doc"), "$.name").alias("name"), D.field(F.col("doc"), "$.nation", "bigint").alias("nation"))


@query("SELECT event_id * 1.0::DOUBLE AS t_ms, value AS v FROM events WHERE event_id % 5 > 0 AND value IS NOT NULL")
def csv_flux(spark, d):
    """A CSV whose value column goes by its second name; rows that don't parse are left out."""
    folder = _shared(spark)
    e = table(spark, d, "events").select(F.when(F.col("event_id") % 5 > 0, F.col("event_id").cast("string")).otherwise("bad").alias("timestamp_ms"), F.lit("x").alias("note"), F.col("value").alias("magnitude"))
    e.write.option("header", True).csv(folder)
    return D.csv_series(spark, folder, ["time", "timestamp_ms"], ["flow", "magnitude", "note"])


@query("""WITH e AS (SELECT user_id % 60 AS k, event_id, row_number() OVER (PARTITION BY user_id % 60 ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id % 60) AS m FROM events)
SELECT k, CASE k % 5 WHEN 0 THEN 'first' WHEN 1 THEN 'last' WHEN 2 THEN 'middle' WHEN 3 THEN 'blank' ELSE 'none' END AS spoilt, k % 5 IN (2, 4) AS ok FROM e GROUP BY 1""")
def stream_files(spark, d):
    """Files of streams checked by their first and last line: a spoilt one in the middle isn't seen, a blank first one fails."""
    e = table(spark, d, "events").select((F.col("user_id") % 60).alias("k"), "event_id")
    w = Window.partitionBy("k")
    first, last = F.col("event_id") == F.min("event_id").over(w), F.col("event_id") == F.max("event_id").over(w)
    good, case = F.format_string('{"a": %d}', "event_id"), F.col("k") % 5
    line = F.when((case == 0) & first | (case == 1) & last | (case == 2) & ~first & ~last, '{"a": ').when((case == 3) & first, "").otherwise(good)
    folder = _files(spark, e.withColumn("line", line), "k", "event_id")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("path", F.col("length").alias("size"))
    checked = files.withColumn("ok", F.pandas_udf(D.jsonl_edges_many, "boolean")("path"))
    case = _key() % 5
    return checked.select(_key().alias("k"), F.when(case == 0, "first").when(case == 1, "last").when(case == 2, "middle").when(case == 3, "blank").otherwise("none").alias("spoilt"), "ok")


# --- sinks, read again ---


@query("SELECT DISTINCT 'session_' || c_custkey % 500 AS name FROM customer")
def name_manifest(spark, d):
    """A written manifest, with comments and blank lines among its names."""
    names = table(spark, d, "customer").select(F.concat(F.lit("session_"), F.col("c_custkey") % 500).alias("session"))
    noise = names.limit(1).select(F.explode(F.array(F.lit("# list"), F.lit(""), F.lit("  "))).alias("session"))
    folder = _shared(spark)
    R.write_manifest(names.unionByName(noise), folder)
    return I.manifest(spark, folder)


@query("SELECT o_custkey AS name, min(o_orderkey) AS size_bytes FROM orders GROUP BY 1")
def ledger_appends(spark, d):
    """Orders delivered in three batches, the second one twice: a customer's first delivery stays."""
    path = f"{_shared(spark)}/ledger"
    sink = watch.ledger_sink(path, ["name"])
    first = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("name")).agg(F.min("o_orderkey").alias("size_bytes"))
    for k, part in enumerate((0, 1, 1, 2)):
        sink(first.where(F.col("size_bytes") % 3 == part), k)
    sink(first.select("name", F.lit(-1).cast("long").alias("size_bytes")), 4)
    return spark.read.parquet(path)


@query("SELECT c_custkey AS session, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS score, CASE WHEN c_custkey % 4 = 0 THEN c_name || ' \"q\" é' END AS detail, c_custkey % 2 = 0 AS ok FROM customer")
def report_lines(spark, d):
    """A JSON report with nulls and quotes, read again."""
    rows = table(spark, d, "customer").selectExpr("c_custkey as session", "if(c_custkey % 3 > 0, c_acctbal, null) as score", "if(c_custkey % 4 = 0, concat(c_name, ' \"q\" é'), null) as detail", "c_custkey % 2 = 0 as ok")
    folder = _shared(spark)
    R.write_lines(rows, folder)
    return spark.read.schema(rows.schema).json(folder)


@query("SELECT event_id / 2.0::DOUBLE AS ts_ms, event_type AS side, 's' || user_id % 3 AS source, value AS x, row_number() OVER (ORDER BY event_id / 2.0::DOUBLE, event_type, user_id % 3) - 1 AS place FROM events")
def trajectory_csv(spark, d):
    """Poses written as CSV come back in order: the place of each row by file and line."""
    folder = _shared(spark)
    R.write_trajectory(table(spark, d, "events").selectExpr("event_id / 2D as ts_ms", "event_type as side", "concat('s', user_id % 3) as source", "value as x"), folder)
    rows = spark.read.schema("ts_ms double, side string, source string, x double").option("header", True).csv(folder).withColumn("file", F.input_file_name()).withColumn("row", F.monotonically_increasing_id())
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.regexp_extract("file", "part-([0-9]+)", 1)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each file
    placed = rows.join(sizes.select("file", "first", before.alias("before")), "file")
    return placed.select("ts_ms", "side", "source", "x", (F.col("before") + F.col("row") - F.col("first")).alias("place"))


@query("SELECT o_orderstatus AS status, o_orderdate AS day, CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 ELSE o_orderkey END AS n FROM orders WHERE o_orderstatus <> 'P'")
def rebuilt_table(spark, d):
    """A table by status; F is rebuilt, P is emptied, and the rebuild is repeated."""
    path = f"{_shared(spark)}/table"
    rows = table(spark, d, "orders").selectExpr("o_orderstatus as status", "o_orderdate as day", "o_orderkey as n")
    L.write_partitions(rows, path, "status", [r[0] for r in rows.select("status").distinct().collect()], "first")  # three states
    for _ in range(2):
        L.write_partitions(rows.where("status = 'F'").withColumn("n", F.col("n") * 10), path, "status", ["F", "P"], "second")
    return spark.read.schema(rows.schema).parquet(path)

