"""Sharding by proportional stratified interleaving.

Every source is shuffled by a seeded hash; a row's fractional rank is its place in that shuffle
divided by the size of its source. Sorted by fractional rank, any stretch of rows holds each
source in its corpus share, so cutting the order into equal stretches gives shards that all
match the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook.llm.common import documents, running, text_size

SHARDS = 8
SEED = 20240131


def interleave(rows: DataFrame, stratum: str, key: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All rows and columns of ``rows`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    Law: counts of the shards differ by one at most, and every shard holds each stratum in its
    corpus share, up to rounding. Null strata form one stratum, null keys are keys like any
    other. Rows with equal keys and strata are ordered by the remaining sortable columns;
    fully equal rows are interchangeable. No rows give no rows. Helper columns start with two
    underscores; an input column called ``shard`` or ``slot`` is replaced.
    """
    rows = rows.drop("shard", "slot")
    plain = [f.name for f in rows.schema.fields if f.name not in (stratum, key) and f.dataType.typeName() in ("long", "integer", "string")]
    shuffled = rows.withColumn("__one", F.lit(1).cast("long")).withColumn(
        "__shuffle", F.xxhash64(F.lit(seed), F.col(key).cast("string"))
    )
    order = [stratum, "__shuffle", key, *plain]
    placed = running(shuffled, order, "__one", "shard-strata", "__place")
    sizes = placed.groupBy(F.col(stratum).alias("__stratum")).agg(
        F.count("*").alias("__rows"), F.min("__place").alias("__first")
    )
    ranked = placed.join(sizes, F.col(stratum).eqNullSafe(F.col("__stratum"))).withColumn(
        "__fraction", (F.col("__place") - F.col("__first") + 0.5) / F.col("__rows")
    )
    mixed = running(ranked.drop("__stratum", "__rows", "__first", "__place"), ["__fraction", *order], "__one", "shard-mixed", "__place")
    total = mixed.count()
    shard = F.expr(f"__place * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        mixed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("__place") - first).cast("long"))
        .drop("__one", "__shuffle", "__fraction", "__place")
    )


def write_shards(rows: DataFrame, path: str) -> None:
    """Write interleaved rows as one folder for each shard, in slot order inside the files."""
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 under the law ``rows``; texts travel as size and checksum only."""
    docs = documents(spark, sf_dir)
    thin = docs.select(
        "doc_id",
        "source",
        (text_size("text") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return interleave(thin, "source", "doc_id").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
