import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm.langid import keep_identified, predict_languages, train_language_model

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").cache()


def noise(spark, words):
    rng = np.random.default_rng(words)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    texts = [" ".join("".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(words)) for _ in range(100)]
    return spark.createDataFrame(pd.DataFrame({"doc_id": range(100), "text": texts}))


@pytest.mark.parametrize("words", [8, 60])
def test_noise_is_rejected(spark, labelled, words):
    model = train_language_model(labelled)
    assert predict_languages(noise(spark, words), model).where("rejected").count() >= 95
    assert keep_identified(noise(spark, words), model).count() <= 5


@pytest.mark.parametrize("lang", ["fr", "en"])
def test_a_language_left_out_of_training_is_rejected(labelled, lang):
    model = train_language_model(labelled.where(F.col("lang") != lang))
    left_out = labelled.where(F.col("lang") == lang)
    assert predict_languages(left_out, model).where("rejected").count() >= 0.9 * left_out.count()
    known = labelled.where(F.col("lang") != lang)
    assert predict_languages(known, model).where("rejected").count() <= 0.02 * known.count()


def test_numbers_and_marks_do_not_make_a_text_unlike(spark, labelled):
    model = train_language_model(labelled)
    marked = labelled.select("doc_id", F.concat(F.lit("8471-2290 #### $$ 0x5f3a77 "), F.regexp_replace("text", " ", " %% 99 ")).alias("text"))
    assert predict_languages(marked, model).where("rejected").count() <= 0.02 * marked.count()


def test_a_language_with_one_row_rejects_nothing_by_likeness(spark):
    rows = [(k, "der hund und die katze sind im garten", "de") for k in range(20)] + [(99, "el perro", "es")]
    model = train_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert predict_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).where("rejected").count() == 0
