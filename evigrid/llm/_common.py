"""Helpers that the corpus operators share: table access, shared scratch tables, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one Arrow batch; texts can be long, so batches are far smaller than Spark's default.
BATCH_ROWS = 1000
#: Equal rows that one task writes at once.
COPIES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark itself so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where that is unset, as in tests."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        set_before = spark.sparkContext.getCheckpointDir()
        if not set_before and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = set_before.rsplit("/", 1)[0] if set_before else tempfile.mkdtemp(prefix="evigrid-")
        if not urlparse(configured).scheme:
            configured = f"file://{configured}"
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    return path


def stored(df: DataFrame, tag: str, rows: int = 0) -> tuple[DataFrame, str]:
    """``df`` written to a table in the shared folder and read again, which cuts its lineage, and the path.

    With ``rows`` a file has at most as many: Spark holds thousands of a file's rows at once when it
    reads them, so rows of long arrays need small files to be read in bounded memory.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    schema = df.schema
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return spark.read.schema(schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables that no plan reads any longer."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small enough for a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def id_crc(column: str | Column = "doc_id") -> Column:
    """CRC-32 of an id's decimal text; an id that is null counts as the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")))


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """Only the columns ``doc_id`` and ``text``, so other columns of any name do no harm."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def each_text(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of each non-empty batch of ``ids_and_texts``."""
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0), batch.column(1).to_pylist()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each led by as many underscores as make it unlike every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def new_names(df: DataFrame, names: tuple[str, ...] | None, *defaults: str) -> list[str]:
    """``names`` if given, which must not be columns of ``df``; else the defaults made fresh."""
    if names is None:
        return fresh(df, *defaults)
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")
    return list(names)


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever signs their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def before(df: DataFrame, keys: list[str], split: Column, order: list[str], value: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over the rows of its ``keys`` that come first by ``split`` and ``order``.

    Two levels: rows of one ``split`` are summed in one window, and the splits' own sums in another.
    """
    cut = df.withColumn("_split", split)
    sums = cut.groupBy(*keys, "_split").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_split", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_split").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0))).join(starts, [*keys, "_split"])
        .withColumn("before", F.col("_start") + F.col("_within")).drop("_split", "_start", "_within")
    )


def each_copy(df: DataFrame, *salt: str) -> DataFrame:
    """``n`` rows for each row, numbered from 0 in ``i``; very many are dealt to several tasks by the ``salt`` columns."""
    zero = F.lit(0).cast("long")
    few = df.where(F.col("n") <= COPIES).withColumn("i", F.explode(F.sequence(zero, F.col("n") - 1)))
    many = df.where(F.col("n") > COPIES).withColumn("_from", F.explode(F.sequence(zero, F.col("n") - 1, F.lit(COPIES).cast("long")))).repartition(*salt, "_from")
    many = many.withColumn("i", F.explode(F.sequence(F.col("_from"), F.least(F.col("n"), F.col("_from") + COPIES) - 1))).drop("_from")
    return few.union(many)
