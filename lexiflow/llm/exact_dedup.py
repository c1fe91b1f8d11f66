"""Exact deduplication as a stateful stream [DataFrame and SQL functions only].

Digests of the texts go through Structured Streaming into keyed state on disk (the RocksDB store) that never expires. A
key's state holds the digest, the stable identifier of the row that stays (the largest id), the locator of its content (the
file that has it) and the number of rows. Every key that was hit more than once has the full bytes of its rows compared
with those of the row that stays; where a digest hides different texts, its rows are grouped anew by their bytes.

Defined cases: a null text counts as empty; a null id is smaller than any other; rows with equal text and equal id are all
marked as kept (`kept_rows` leaves one of them); an empty table gives an empty result; columns that aren't named are left alone.

Scale: all texts are shuffled once by their digests, for the hit groups' byte check; state and result have a fixed width. Counting a hot group
is done before the shuffle (partial aggregation); the joins on the digest have one row a key on one side, so that
adaptive execution splits a hot key's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, scratch, written

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each of many small stores reserves megabytes
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _normal(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def stream_state(spark: SparkSession, source: str, schema, checkpoint: str, sink: str, files_per_batch: int | None = None) -> None:
    """Takes all digests in the files at source, that earlier calls with this checkpoint haven't seen, into the state.

    Each micro-batch writes the keys that it touched, with their state after it, to its own folder below sink, so a batch that
    is run again after a failure writes the same.
    """
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        state = reader.parquet(source).groupBy("digest").agg(F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))

        def put(batch: DataFrame, number: int) -> None:
            batch.select("digest", F.col("keep.id").alias("keep_id"), F.col("keep.locator").alias("locator"), "group_size").write.mode("overwrite").parquet(f"{sink}/batch={number}")

        query = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _groups(spark: SparkSession, sink: str, digest_type, id_type) -> DataFrame:
    """The state after the last batch: a row a digest."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("digest", digest_type), T.StructField("keep_id", id_type), T.StructField("locator", T.StringType()), T.StructField("group_size", T.LongType()), T.StructField("batch", T.LongType())])
    try:
        found = spark.read.schema(schema).parquet(sink)
    except Exception as e:  # no batch, as there was no row
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema).drop("batch")
    if found.select("batch").distinct().count() > 1:
        found = found.groupBy("digest").agg(F.max_by(F.struct("keep_id", "locator", "group_size"), "batch").alias("s")).select("digest", "s.*")
    return found.drop("batch")


def link_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None) -> DataFrame:
    """(id, digest, keep_id, locator, group_size, kept) for each row of docs."""
    spark = docs.sparkSession
    text = _normal(text_col)
    rows = written(docs.select(F.col(id_col).alias("id"), digest(text).alias("digest"), F.input_file_name().alias("locator")), "lexiflow-digests")
    source = rows.inputFiles()[0].rsplit("/", 1)[0] if rows.inputFiles() else None
    sink = scratch(spark, "lexiflow-dedup-state")
    if source:
        stream_state(spark, source, rows.schema, scratch(spark, "lexiflow-dedup-checkpoint"), sink, files_per_batch)
    groups = _groups(spark, sink, rows.schema["digest"].dataType, rows.schema["id"].dataType)

    # full bytes on hits: every row of a group against the row that stays
    hits = groups.where("group_size > 1").select("digest", "keep_id", "locator")
    whole = docs.select(F.col(id_col).alias("id"), text.alias("text"), digest(text).alias("digest"))
    members = written(whole.join(hits.select("digest"), "digest", "left_semi"), "lexiflow-hits")
    release(spark)
    stay = members.join(hits, (members.digest == hits.digest) & members.id.eqNullSafe(hits.keep_id), "left_semi").groupBy("digest").agg(F.min("text").alias("stay"))
    differ = members.join(written(stay, "lexiflow-stay"), "digest").where("text != stay").select("digest")
    same = differ.isEmpty()
    release(spark)
    result = rows.join(groups, "digest")
    if not same:
        bad = written(differ.distinct(), "lexiflow-collisions")
        again = members.join(bad, "digest", "left_semi")
        split = again.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        mended = again.join(split, ["digest", "text"]).select("digest", "id", F.lit("").alias("locator"), "keep_id", "group_size")
        result = result.join(bad, "digest", "left_anti").select("digest", "id", groups.locator, "keep_id", "group_size").unionByName(mended)
        return result.select("id", "digest", "keep_id", "locator", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))
    return result.select("id", "digest", "keep_id", groups.locator, "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without copies: of equal texts, the row with the largest id. All columns stay."""
    own, other = (next(n for n in (f"_{c}{i or ''}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for c in ("digest", "id"))
    linked = written(link_copies(docs, id_col, text_col).where("kept").select(F.col("id").alias(other), F.col("digest").alias(own)), "lexiflow-kept")
    out = docs.withColumn(own, sha256(_normal(text_col)))
    out = out.join(linked.distinct(), out[id_col].eqNullSafe(linked[other]) & (out[own] == linked[own]), "left_semi")
    if not linked.groupBy(other, own).count().where("count > 1").isEmpty():
        out = out.dropDuplicates([id_col, own])
    return out.drop(own)
