"""Extraction is dealt to all tasks, however few files its narrow source has."""

from evigrid.plans import registered_records


def test_pages_of_one_small_file_are_dealt_to_all_tasks(spark, tmp_path, monkeypatch):
    spark.range(400).selectExpr("id AS c_custkey", "cast(id % 25 AS int) AS c_nationkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    seen, cut = [], registered_records.cut
    monkeypatch.setattr(registered_records, "cut", lambda df: seen.append(df.rdd.getNumPartitions()) or cut(df))
    assert registered_records.extract_records(spark, str(tmp_path)).select("source_url").distinct().count() == 350 - 50
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
