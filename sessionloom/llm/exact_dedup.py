"""Operator 9: exact deduplication with streaming state. DataFrame and SQL functions only.

A state is a folder. Each run over more documents lands digests (SHA-256 of the normalised text) with identifier and content locator in it, and one streaming
query, which goes on from the state's checkpoint, reads the new landings in about BATCHES micro-batches. The query's keyed state (RocksDB: on disk, no watermark, so nothing
expires) keeps for each digest the smallest identifier, its locator and the number of rows of all runs. A locator is a file and a row in it, from which the bytes can be
fetched: those of the input where it is read from Parquet files, else those of a copy that is landed with the digests.

Hits (digests with several rows) are checked on full bytes: all texts of a digest are equal if the least and the greatest of them are. The present run's
texts are at hand, those of earlier runs are fetched through their locators, for the digests that were hit alone. Rows whose bytes differ although the digest is equal
form groups of their own by full text.

A run has a name. A run that failed is repeated under its name: what it has landed isn't landed again, and the query goes on where it stopped.

Shuffles: (digest, id) pairs with partial aggregation into the state, narrow rows when groups are joined back, and of hits
one or two texts for each digest and task, as the least and the greatest are found before the shuffle; rows that are no hits are left out by
a bitmap of FILTER_BITS bits of the hits' digests (broadcast, of fixed size; a fuller one lets more rows through and loses
nothing). So a digest that a third of all rows share sends a text for each task; narrow rows meet their
group in a sort-merge join, which Spark splits at run time; nothing is collected but names of files. Without a state folder of the caller's, landings and state are removed at the end.

Defined results: null text counts as empty; empty texts are equal to each other; rows without doc_id never stay unless
their whole group has none; rows that repeat doc_id and text carry equal values, and `keep_rows` returns one of them; an
empty table gives an empty table; other columns pass through `keep_rows` whatever their names are.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.common import ASCII_SPACE, cut, exists, free_name, fresh_path, scratch, settings, table

#: Disk-backed state with bounded memory for all stores of an executor; a store is closed after its commit, since each open
#: one holds several MB of files besides its data.
FILTER_BITS = 26
BATCHES = 3
LANDED = "doc_id long, digest binary, text_sha256 string, file string, row long, run string"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), ASCII_SPACE, " ")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def groups_of_stream(spark: SparkSession, landing: str, schema, state: str, files: int | None = None) -> DataFrame:
    """digest, first (no_id, doc_id, file, row), n: the state after all landed files, by one run of the streaming query over `files` new ones."""
    out = f"{state}/groups"

    def emit(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={k}")

    with settings(spark, STATE_CONF):
        reader = spark.readStream.schema(schema)
        if files:
            reader = reader.option("maxFilesPerTrigger", max(1, -(-files // BATCHES)))
        grouped = reader.parquet(landing).groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
        query = grouped.writeStream.outputMode("update").option("checkpointLocation", f"{state}/query").trigger(availableNow=True).foreachBatch(emit).start()
        query.awaitTermination()
    found = spark.read.parquet(out)
    # update mode tells a key again in each batch that touches it; the last one holds
    return found.groupBy("digest").agg(F.max_by(F.struct("first", "n"), "batch").alias("last")).select("digest", "last.first", "last.n")


def _may_hit(rows: DataFrame, several: DataFrame) -> DataFrame:
    """The rows whose digest may be among several's: all that are, and a few others by chance. At most 2^FILTER_BITS / 32,768 rows of 4 KB are broadcast."""
    place = F.shiftrightunsigned(F.xxhash64("digest"), 64 - FILTER_BITS)
    maps = several.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    placed = rows.withColumn("place", place).withColumn("bucket", F.bitmap_bucket_number("place")).join(F.broadcast(maps), "bucket")
    at = F.bitmap_bit_position("place")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return placed.where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("bucket", "bits", "place")


def _located(docs: DataFrame, content: str) -> DataFrame:
    """doc_id, text (normalised), file, row of docs: the places of their Parquet files, or of a copy written to `content`."""
    columns = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    place = lambda df: [df.metadataColumn("_metadata").getField(k).alias(c) for k, c in (("file_path", "file"), ("row_index", "row"))]
    try:
        found = docs.select(*columns, *place(docs))
    except AnalysisException:
        if not exists(docs.sparkSession, f"{content}/_SUCCESS"):
            docs.select(*columns).write.mode("overwrite").parquet(content)
        copy = docs.sparkSession.read.schema("doc_id long, text string").parquet(content)
        found = copy.select(*columns, *place(copy))
    return found.select("doc_id", normalised(F.col("text")).alias("text"), "file", "row")


def fetched(spark: SparkSession, places: DataFrame) -> DataFrame:
    """places (file, row, ...) with `text` (normalised), read from the files they name."""
    files = [unquote(r["file"]) for r in places.select("file").distinct().collect()]
    if not files:
        return places.withColumn("text", F.lit(None).cast("string"))
    read = spark.read.parquet(*files)
    meta = read.metadataColumn("_metadata")
    rows = read.select(meta.getField("file_path").alias("file"), meta.getField("row_index").alias("row"), normalised(F.col("text").cast("string")).alias("text"))
    return places.join(rows, ["file", "row"])


def exact_groups(docs: DataFrame, digest=sha256_digest, state: str | None = None, run: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, first_file, first_row.

    digest: the key of the state. Any function of the text gives right groups, since hits are checked on full bytes.
    state: a folder that earlier runs have left, or a new one; without it the state is removed at the end. keep_id and group_size count the rows of all its runs. run: this
    run's name, by default a number; a name whose documents are landed already goes on with these.
    """
    spark = docs.sparkSession
    with scratch(spark) as keep:
        state = (state or fresh_path(spark, "dedup-state")).rstrip("/")
        landing = f"{state}/landing"
        known = {r["run"] for r in spark.read.schema(LANDED).parquet(landing).select("run").distinct().collect()} if exists(spark, landing) else set()
        run = run or next(str(k) for k in range(len(known) + 1) if str(k) not in known)
        own = _located(docs, f"{state}/content/run={run}")
        here = f"{landing}/run={run}"
        if not exists(spark, f"{here}/_SUCCESS"):
            own.select("doc_id", digest(F.col("text")).alias("digest"), F.lower(F.sha2(F.col("text").cast("binary"), 256)).alias("text_sha256"), "file", "row").write.mode("overwrite").parquet(here)
        landed = spark.read.schema(LANDED).parquet(here).drop("run")
        groups = groups_of_stream(spark, landing, LANDED, state, len(landed.inputFiles())).select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.file").alias("first_file"), F.col("first.row").alias("first_row"), "n")
        if known - {run}:  # digests of other runs alone aren't asked for
            groups = groups.join(landed.select("digest").distinct(), "digest", "left_semi")
        groups = cut(groups, "dedup-groups")
        joined = landed.drop("file", "row").join(groups, "digest")
        keep_id, size = F.col("keep_id"), F.col("n")

        # hits: full bytes
        several = groups.where("n > 1")
        texts = _may_hit(own.select("doc_id", "text", digest(F.col("text")).alias("digest")), several)
        if known - {run}:
            before = spark.read.schema(LANDED).parquet(landing).where(F.col("run") != run).join(several.select("digest"), "digest", "left_semi")
            texts = texts.unionByName(fetched(spark, cut(before.select("doc_id", "digest", "file", "row"), "dedup-places")).select("doc_id", "text", "digest"))
        differ = cut(texts.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most")).where("least != most").select("digest"), "dedup-differ")
        if differ.take(1):  # equal digests of unlike texts
            parts = texts.join(differ, "digest", "left_semi").groupBy("digest", "text").agg(F.min("doc_id").alias("part_id"), F.count(F.lit(1)).alias("part_n"))
            parts = cut(parts.select("digest", F.lower(F.sha2(F.col("text").cast("binary"), 256)).alias("text_sha256"), "part_id", "part_n"), "dedup-parts")
            joined = joined.join(parts, ["digest", "text_sha256"], "left")
            apart = F.col("part_n").isNotNull()
            keep_id, size = F.when(apart, F.col("part_id")).otherwise(keep_id), F.coalesce("part_n", size)
        return keep(joined.select("doc_id", keep_id.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256", "first_file", "first_row"), "dedup-rows")


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    spark = docs.sparkSession
    sha = free_name("_row_sha", docs.columns)
    stay_id, stay_sha = free_name("_stay_id", docs.columns), free_name("_stay_sha", docs.columns)
    with scratch(spark) as keep:
        kept = exact_groups(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows"))
        kept = keep(kept.select(F.col("doc_id").alias(stay_id), F.col("text_sha256").alias(stay_sha), F.col("rows").alias("stay_rows")), "dedup-kept")
    keyed = docs.withColumn(sha, F.lower(F.sha2(normalised(F.col("text").cast("string")).cast("binary"), 256)))
    found = keyed.join(kept, keyed["doc_id"].cast("long").eqNullSafe(kept[stay_id]) & (keyed[sha] == kept[stay_sha]), "left_semi")
    if kept.where("stay_rows > 1").take(1):  # rows that repeat doc_id and text
        found = found.dropDuplicates(["doc_id", sha])
    return found.drop(sha)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("first_file", "first_row")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
