"""Sinks (S6-S9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("YEAR",), fmt: str = "parquet") -> None:
    """Write partitioned by key columns (S6, S8) so that readers prune by year or entity.

    Rows are first rebalanced on the same keys: few files per partition value,
    and a value with many rows is split over several tasks by its size.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .partitionBy(*partition_by)
        .format(fmt)
        .option("header", "true")
        .save(path)
    )


def write_entity_files(df: DataFrame, path: str, entity: str, fmt: str = "csv", **options: str) -> None:
    """One folder with one file per entity (S8), for many entities with few rows each, into a new ``path``.

    The cost is the files, not the bytes: entities are dealt to as many tasks as a
    shuffle has, which are not merged by their size. Each task moves its own folders
    to their place when it ends, so the driver does not move one after the other when
    the job ends. Until then a failed job leaves files at ``path``: read it only after a success.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(tasks, F.xxhash64(entity))  # by the entity itself, an exchange below would serve, whose tasks are merged
        .write.mode("errorifexists")
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .options(**options)
        .partitionBy(entity)
        .format(fmt)
        .save(path)
    )


def write_sorted_csv(df: DataFrame, path: str, order_by: tuple[str, ...], single_file: bool = False) -> None:
    """Sorted, headered CSV of a result table.

    ``single_file`` is meant for small result tables only (a report): it routes
    every row through one task.
    """
    out = df.orderBy(*order_by)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str] = ("YEAR", "CODE"), buckets: int = 64) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``keys`` (S6) and return it.

    Tables with the same keys and number of buckets are joined and grouped on
    these keys without an exchange (J1). Rows are dealt by the bucket's own hash
    first, so that a bucket is one file. ``path`` must be shared by the cluster.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def finished_entities(spark: SparkSession, path: str, entity: str, kind: str) -> DataFrame:
    """The entities whose files under ``path`` are complete; none before the first run."""
    schema = f"{entity} {kind}"
    try:
        return spark.read.schema(schema).parquet(f"{path}-finished")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_entities(df: DataFrame, path: str, entity: str, batches: int = 8, fmt: str = "parquet", most: int | None = None, **options: str) -> int:
    """Resumable build of one folder per entity (S8); returns the number of batches written.

    Entities are dealt to ``batches`` by a hash. A batch's folders are replaced
    (dynamic partition overwrite), then its entities are added to the list of
    finished ones beside ``path``. A run leaves out what is on that list: after
    a loss of the driver, only the entities of the batch under way are written
    again and none twice. ``most`` ends the run after so many batches. ``df`` is
    read once per batch still open; hand in a stored table where it is derived.
    """
    spark = df.sparkSession
    kind = df.schema[entity].dataType.simpleString()
    number = F.pmod(F.xxhash64(entity), F.lit(batches)).cast("int")
    done = finished_entities(spark, path, entity, kind).distinct().withColumnRenamed(entity, "__done")
    rest = df.join(done, F.col(entity).eqNullSafe(F.col("__done")), "left_anti").withColumn("__batch", number)
    open_batches = sorted(r[0] for r in rest.select("__batch").distinct().collect())  # at most ``batches`` numbers
    for batch in open_batches[:most]:
        rows = rest.where(F.col("__batch") == batch).drop("__batch")
        names = rows.select(entity).distinct()
        (
            rows.hint("rebalance", entity).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .options(**{"header": "true", **options}).partitionBy(entity).format(fmt).save(path)
        )
        names.write.mode("append").parquet(f"{path}-finished")
    return len(open_batches[:most])
