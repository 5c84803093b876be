import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from evigrid.llm import bpe_tree, registry

SF = "/root/testdata/sf0.001"


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "mix_sources", "bpe_encode"]
    assert sorted(int(q[2:].split("_")[0]) for q in registry.queries()) == list(range(1, 14))
    assert set(__spark_entry__.queries()) >= set(registry.queries()) | {"pipeline"}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumn("_mix_n", F.lit("clash")).union(spark.createDataFrame([(None, None, None, None, None, None), (900, "", "en", "s", 0, "c")], docs.schema.add("_mix_n", "string")))
    out, folder = [docs], tmp_path_factory.mktemp("pipeline")
    for name, f in corpus_pipeline.STAGES:
        f(spark, out[-1], SF).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


def test_stages_keep_columns_and_clean_documents(stages):
    docs, *rest = stages
    for df in rest[:-1]:
        assert df.columns == docs.columns
    clean, known, single, mixed, encoded = rest
    assert docs.count() >= clean.count() >= 0.8 * docs.count()
    assert known.where("text is null or text = ''").count() == 0 and known.count() >= clean.count() - 8
    distinct = known.select("text").distinct().count()
    assert 0.8 * distinct <= single.count() <= distinct
    assert encoded.count() == mixed.count() > 0


def test_encoded_ids_decode_to_the_mixed_texts(stages):
    bpe = bpe_tree.tokenizer()
    texts = sorted(r.text for r in stages[4].collect())
    assert sorted(bpe.decode(np.array(r.ids)).decode() for r in stages[5].collect()) == texts


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and "ids" in got.columns


CLASHES = (
    "_keep_id", "_keep_null", "_keep_hash", "_mix_id", "_mix_source", "_mix_hash", "_mix_n", "_mix_full", "_mix_parts", "_mix_size", "_mix_part", "_tox_score", "_tox_predicted",
    "_lang", "_lang_pred", "_lang_score", "_lang_rejected", "a.b", "a`b", "before", "row", "k0", "_split", "node", "key", "block", "component", "fp",
)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_columns_of_any_name_are_kept(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.select("*", *(F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")).alias(c) for i, c in enumerate(CLASHES)))
    docs = docs.union(docs.limit(3))
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    rows = out.collect()
    if name == "bpe_encode":
        assert len(rows) == docs.count()
        return
    assert out.columns == docs.columns and rows
    assert all(r[c] == f"{i}:{r.doc_id}" for r in rows for i, c in enumerate(CLASHES))
