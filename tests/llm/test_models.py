import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridtally.llm.language_id import UNDETERMINED, _score, accepted, fit_languages, identify, learnable
from gridtally.llm.ordinal_quality import drawn_ratings, features, fit_grades, grade_texts


def test_languages_of_held_out_documents(documents):
    model = fit_languages(documents.filter(learnable()))
    found = identify(documents.filter(~learnable()), model).collect()
    hits = [r.lang_pred == r.lang for r in found]
    assert len(hits) > 20 and np.mean(hits) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_backoff_goes_from_words_to_shorter_grams():
    one, two, three = np.array([1.0, 0]), np.array([0, 1.0]), np.array([0.5, 0.5])
    none = np.zeros(2)
    tables = [{"word": one}, {"w": three}, {}, {"wor": two}, {}]
    assert _score("word", tables, none) is one
    assert np.array_equal(_score("worm", tables, none), two)
    assert np.array_equal(_score("wim", tables, none), three)
    assert _score("zzz", tables, none) is none


def test_language_of_odd_rows(odd, nothing, documents):
    model = fit_languages(documents)
    rows = identify(odd.withColumns({"SCORE": F.lit("x"), "words": F.lit(1)}), model).withColumn("ok", accepted()).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.ok) == (UNDETERMINED, 0.0, False)
        else:
            assert r.lang_pred in model.languages and 0 <= r.score <= 1
    assert identify(nothing, model).collect() == []
    untaught = identify(odd, fit_languages(nothing)).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {(UNDETERMINED, 0.0)}


def test_grades_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rated = docs.join(labels, "doc_id").withColumn(
        "grade", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    )
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit_grades(rated.filter(~held))
    assert model.grades == [0.0, 1.0, 2.0] and model.thresholds[0] < model.thresholds[1]
    rows = grade_texts(rated.filter(held), model).collect()
    toxic = [r.tail[0] < 0.5 for r in rows if r.grade == 0]
    clean = [r.tail[0] >= 0.5 for r in rows if r.grade == 2]
    assert len(toxic) > 50 and np.mean(toxic) > 0.75 and np.mean(clean) > 0.99
    order = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)]
    assert order == sorted(order)
    assert all(r.tail[0] >= r.tail[1] for r in rows)


def test_features_of_plain_text():
    rows, cells = features(pa.array(["A b a!", None, "", "a"]))
    assert rows.tolist() == [0, 0, 0, 3]
    assert cells[3] in cells[:3]


def test_grades_of_odd_rows(spark, odd, nothing):
    rated = spark.createDataFrame([("good text here", 2.0), ("bad words", 0.0), (None, 1.0), ("no rating", None), ("nan", float("nan"))], "text string, grade double")
    model = fit_grades(rated)
    assert len(grade_texts(odd.withColumn("TAIL", F.lit(1)), model).collect()) == odd.count()
    assert grade_texts(nothing, model).collect() == []
    single = fit_grades(rated.filter("grade = 2"))
    assert {r.expected_grade for r in grade_texts(odd, single).collect()} == {2.0}
    assert drawn_ratings(rated).count() == rated.distinct().count()
    unrated = fit_grades(rated.limit(0))
    assert {r.expected_grade for r in grade_texts(odd, unrated).collect()} == {None}
