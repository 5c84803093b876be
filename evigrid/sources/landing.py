"""Landed pages in, result frames out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_hash, make_pk, normalize_domain, normalize_url

#: Columns of a landed page.
PAGE_SCHEMA = (
    "job_pk string, seed_name string, seed_state string, seed_market string, seed_website string, target_url string, normalized_url string, "
    "status_code int, content string, content_hash string, fetched_at timestamp"
)


def read_tables(spark: SparkSession, folder: str, names: list[str], views: bool = True) -> dict[str, DataFrame]:
    """Parquet tables of a folder, registered as views of their names."""
    found = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
    if views:
        for n, df in found.items():
            df.createOrReplaceTempView(n)
    return found


def for_extraction(jobs: DataFrame, results: DataFrame, since: Column | None = None) -> DataFrame:
    """Usable results with their job, optionally from a time on, which reaches the scan as a filter."""
    usable = results.where((F.col("status_code") == 200) & (F.coalesce(F.col("content"), F.lit("")) != ""))
    if since is not None:
        usable = usable.where(F.col("fetched_at") >= since)
    return jobs.join(usable, "crawl_job_pk")


def landed(pages: DataFrame, url: str, content: str) -> DataFrame:
    """Pages with their normalised URL, content hash and key, one row per URL and content."""
    keyed = pages.withColumns({"normalized_url": normalize_url(F.col(url)), "content_hash": content_hash(F.col(content))})
    return keyed.dropDuplicates(["normalized_url", "content_hash"]).withColumn("page_pk", make_pk("page", F.col("normalized_url"), F.col("content_hash")))


def record_crawl(fetches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs and results that a crawl's fetches leave.

    ``fetches`` has ``seed_name``, ``seed_website``, ``run_id``, ``requested_url``, ``status_code``,
    ``content``, ``error_message``, ``attempts``, ``fetched_at``. A result is keyed by job, address and
    content, and the latest fetch of it counts; a job by seed and run, with its counts and its end.
    """
    c = F.col
    domain = normalize_domain(c("seed_website"))
    keyed = fetches.withColumns({"seed_domain": domain, "crawl_job_pk": make_pk("job", c("seed_website"), c("run_id"), domain), "target_url": normalize_url(c("requested_url")), "content_hash": content_hash(c("content"))})
    keyed = keyed.withColumn("crawl_result_pk", make_pk("res", c("crawl_job_pk"), c("target_url"), c("content_hash")))
    columns = ("crawl_job_pk", "requested_url", "target_url", "status_code", "content_hash", "content", "fetched_at", "error_message")
    results = keyed.groupBy("crawl_result_pk").agg(F.max_by(F.struct(*columns), F.struct("fetched_at", "requested_url")).alias("r")).select("crawl_result_pk", "r.*")
    good = (c("status_code") == 200) & (F.coalesce(c("content"), F.lit("")) != "")
    jobs = keyed.groupBy("crawl_job_pk", "seed_domain").agg(
        F.max_by("seed_name", "fetched_at").alias("seed_name"), F.sum("attempts").alias("attempts"), F.count_if(good).alias("success_pages"), F.count_if(~good).alias("failure_pages"), F.count("*").alias("pages_fetched"),
        F.max_by("status_code", F.struct("fetched_at", "requested_url")).alias("last_status_code"), F.min("fetched_at").alias("started_at"), F.max("fetched_at").alias("completed_at"),
    )
    fetched = c("success_pages") + c("failure_pages") > 0
    return jobs.withColumn("status", F.when(c("success_pages") > 0, F.when(c("failure_pages") > 0, "partial").otherwise("completed")).when(fetched, "failed").otherwise("empty")), results


def source_documents(pages: DataFrame) -> DataFrame:
    """Documents of pages with their seed: keyed by address, content, tier and kind of source; the latest page of a key counts."""
    c = F.col
    keyed = pages.withColumns({"content_hash": content_hash(c("content")), "normalized_url": normalize_url(c("source_url"))})
    keyed = keyed.withColumn("source_document_id", make_pk("src", c("source_url"), c("content_hash"), c("source_tier"), c("source_type")))
    columns = ("source_url", "normalized_url", "source_tier", "source_type", "content_hash", "content", "fetched_at")
    return keyed.groupBy("source_document_id").agg(F.max_by(F.struct(*columns), F.struct("fetched_at", "source_url")).alias("r")).select("source_document_id", "r.*")


def replaced(rows: DataFrame, news: DataFrame, key: str) -> DataFrame:
    """``rows`` with those of ``news`` in place of the ones of equal key. Rows that hang on a replaced key go with it: give the new rows of a document in place of its old ones."""
    return rows.join(news.select(key).distinct(), key, "left_anti").unionByName(news, allowMissingColumns=True)


#: Ends of a run that count as a failure of its seed.
FAILED_RUNS = ("partial", "empty", "failed", "stopped", "quarantined")


def seed_telemetry(jobs: DataFrame) -> DataFrame:
    """Totals of each seed over its runs, and how many failed since the last with a page: the state that ordered upserts leave."""
    c = F.col
    failed, order = c("status").isin(*FAILED_RUNS), F.struct("completed_at", "crawl_job_pk")
    totals = jobs.groupBy("seed_domain").agg(
        F.sum("attempts").alias("attempts"), F.sum("success_pages").alias("successes"), F.sum("failure_pages").alias("failures"), F.count_if(c("success_pages") > 0).alias("success_runs"),
        F.count_if(failed).alias("failure_runs"), F.max(F.when(c("success_pages") > 0, c("completed_at"))).alias("last_success_at"), F.max(F.when(failed, c("completed_at"))).alias("last_failure_at"),
        F.max_by(F.struct("seed_name", "last_status_code", c("started_at").alias("last_run_started_at"), c("completed_at").alias("last_run_completed_at"), c("status").alias("last_run_status"),
                          c("pages_fetched").alias("last_run_pages_fetched"), c("success_pages").alias("last_run_success_pages"), c("failure_pages").alias("last_run_failure_pages")), order).alias("l"),
        F.max(F.when(c("success_pages") > 0, order)).alias("_good"),
    )
    later = jobs.where(failed & (c("success_pages") == 0)).join(totals.select("seed_domain", "_good"), "seed_domain").where(c("_good").isNull() | (order > c("_good")))
    streaks = later.groupBy("seed_domain").agg(F.count("*").alias("_n"))
    return totals.join(streaks, "seed_domain", "left").withColumn("consecutive_failures", F.coalesce("_n", F.lit(0))).select("*", "l.*").drop("l", "_good", "_n")


def nested_as_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for flat sinks."""
    return df.select(*((F.to_json(c) if kind.startswith(("array", "map", "struct")) else F.col(c)).alias(c) for c, kind in df.dtypes))


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV folder with header; quotes are doubled."""
    nested_as_json(df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """A folder of JSON lines, nested values kept nested."""
    df.write.mode("overwrite").json(path)
