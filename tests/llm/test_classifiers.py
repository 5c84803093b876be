import random

import pytest
from pyspark.sql import functions as F

from evigrid.llm import language, toxicity
from evigrid.llm._common import id_crc

WORDS = {
    "en": "the of and that with this from have they which their would there about could other into more".split(),
    "fr": "les des une dans pour qui sur pas avec sont été leur mais nous comme tout faire même".split(),
    "de": "der und die nicht mit sich auf für eine werden dass auch nach wird über können größe straße".split(),
}


def make(n, seed, toxic=False):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        words = [rng.choice(WORDS[lang]) for _ in range(rng.randint(20, 80))]
        bad = toxic and rng.random() < 0.3
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["idiot", "1d1ot", "IDI0T", "scum", "ѕcum", "gromble", "grombling", "grombled", "gromblers"])
        elif toxic and rng.random() < 0.012:
            at = rng.randrange(len(words) - 1)
            words[at : at + 2] = ["pond", "scum"]
        rows.append((i, " ".join(words), lang, "s"))
        labels.append((i, int(bad)))
    return rows, labels


ODD = [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 34 !!", None, "s"), (None, "the of and", "en", None), (1003, "und die nicht " * 30_000, "de", "s"), (5, "the same of this", "en", "s")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make(600, 1)[0] + ODD, "doc_id long, text string, lang string, score string")


def test_language_on_held_out_rows(docs):
    model = language.fit(docs)
    got = language.predict(docs, model).withColumn("held", id_crc() % 4 == 2).collect()
    assert len(got) == docs.count()
    plain = [r for r in got if r.held and (r.doc_id or 0) < 600]
    assert sum(r.lang == r._lang_pred for r in plain) >= 0.97 * len(plain) > 50
    by_id = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by_id[i]._lang_pred, by_id[i]._lang_score, by_id[i]._lang_rejected) == ("und", 0.0, True)
    assert all(0 <= r._lang_score <= 1 for r in got) and by_id[1003]._lang_pred == "de"
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id < 600").count() >= 595 and kept.where("doc_id in (1000, 1001, 1002)").count() == 0


def test_foreign_scripts_and_gibberish_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    rng = random.Random(4)
    scripts = {"latin": (97, 122), "cjk": (0x4E00, 0x9FA5), "hangul": (0xAC00, 0xD7A3), "cyrillic": (0x430, 0x44F), "arabic": (0x627, 0x64A), "thai": (0xE01, 0xE2E)}
    for low, high in scripts.values():
        for n in (60, 300):
            texts = [" ".join("".join(chr(rng.randint(low, high)) for _ in range(6)) for _ in range(n)) for _ in range(20)]
            assert model.predict(texts)[2].mean() >= 0.95
    clean = [r.text for r in docs.where("lang is not null and text is not null").where(id_crc() % 4 == 2).select("text").collect()]
    assert model.predict(clean)[2].mean() <= 0.02
    for n in (1, 2, 8):
        short = [" ".join(t.split()[5 : 5 + n]) for t in clean if len(t.split()) > 20]
        assert model.predict([t for t in short if any(c.isalpha() for c in t)])[2].mean() <= 0.04


def test_language_needs_only_text(docs):
    model = language.fit(docs)
    changed = docs.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.lit(1).cast("long"))
    assert sorted(r._lang_pred for r in language.predict(changed, model).collect()) == sorted(r._lang_pred for r in language.predict(docs, model).collect())


def test_language_without_training_rows(docs):
    model = language.fit(docs.limit(0))
    assert {r._lang_pred for r in language.predict(docs.limit(20), model).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def test_counts_in_blocks(monkeypatch):
    text = "größer und kleiner " * 50
    whole = language.counts(text)
    monkeypatch.setattr(language, "BLOCK", 64)
    assert (language.counts(text) == whole).all()


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = make(1500, 2, toxic=True)
    docs = spark.createDataFrame(rows + ODD, "doc_id long, text string, lang string, source string")
    return docs, spark.createDataFrame([*labels, (1000, None), (None, 1), (3, labels[3][1])], "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    lexicon = toxicity.fit(docs, labels)
    got = toxicity.score(docs, lexicon).withColumn("held", id_crc() % 5 == 0).join(labels.dropDuplicates(["doc_id"]), "doc_id").collect()
    held = [r for r in got if r.held and r.toxic is not None and r.doc_id < 1000]
    assert sum(r._tox_predicted == r.toxic for r in held) >= 0.97 * len(held) > 100
    assert any(e.startswith("grom") and not e.endswith(" ") for e in lexicon.weights), "a beginning stands for many words"
    assert {"scum ", "idiot "} <= set(lexicon.weights) and lexicon.exceptions == ["pond scum"]
    clean = docs.where("text like '%pond scum%'").limit(20)
    assert {r._tox_predicted for r in toxicity.score(clean, lexicon).collect()} == {0}


def test_toxicity_edge_rows(spark, labelled):
    docs, labels = labelled
    lexicon = toxicity.fit(docs, labels)
    odd = {r.doc_id: r for r in toxicity.score(docs.where("doc_id >= 1000 or doc_id is null"), lexicon).collect()}
    assert odd[1000]._tox_score == odd[1001]._tox_score and odd[1000]._tox_predicted == 0
    assert toxicity.accepted(docs.limit(0), lexicon).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert none.weights == {} and {r._tox_predicted for r in toxicity.score(docs.limit(5), none).collect()} == {0}
    assert toxicity.accepted(docs, lexicon).columns == docs.columns


def test_few_labels_call_nothing_toxic(spark, labelled):
    docs, labels = labelled
    lexicon = toxicity.fit(docs, labels.where("doc_id < 40"))
    assert {r._tox_predicted for r in toxicity.score(docs.where("doc_id >= 1000"), lexicon).collect()} == {0}


def test_folding():
    assert toxicity.fold("ІDІ0Т") == toxicity.fold("idiot") == toxicity.fold("Íd1öt") == toxicity.fold("ｉｄｉｏｔ") == toxicity.fold("ídiot")


def test_matches_are_at_word_beginnings_and_outside_exceptions():
    lexicon = toxicity.Lexicon({"scum ": 2.0, "grom": 3.0}, ["pond scum"])
    found = lambda t: [round(m[2]) for m in lexicon.matches(toxicity.fold(t))]
    assert found("scum, scummy ascum grombled xgrom") == [2, 3] and found("pond scum") == [] and found("pond scum scum") == [2]
    assert lexicon.score("scum") > lexicon.score("scum " + "word " * 500) > lexicon.score("word")


def test_outputs_never_replace_columns(spark):
    from evigrid.llm import language, toxicity

    docs = spark.createDataFrame([(i, t, 7.5, "mine", 3) for i, t in enumerate(["der hund läuft", "the dog runs", None, ""])], "doc_id long, text string, _tox_score double, _lang_pred string, _LANG int")
    scored = toxicity.score(docs, toxicity.Lexicon({}, []))
    assert scored.columns == [*docs.columns, "__tox_score", "_tox_predicted"] and {r._tox_score for r in scored.collect()} == {7.5}
    found = language.predict(docs, language.fit(docs.selectExpr("doc_id", "text", "'de' AS lang")))
    assert found.columns == [*docs.columns, "__lang_pred", "_lang_score", "_lang_rejected"] and {r._lang_pred for r in found.collect()} == {"mine"}
    with pytest.raises(ValueError):
        toxicity.score(docs, toxicity.Lexicon({}, []), ("_TOX_score", "p"))
