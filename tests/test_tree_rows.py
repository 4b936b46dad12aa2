from tidemark.ml import training
from tidemark.ml.candidates import Settings
from tidemark.operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET


def test_missing_entries_are_null_and_listed_once_a_row(spark):
    a, b, text = *NUMERIC_FEATURES[:2], CATEGORICAL_FEATURES[0]
    rows = [(1, 0, 0, 1.0, 5.0, "x"), (2, 1, 0, None, 7.0, "y"), (3, 1, 1, 3.0, None, None), (4, 0, 1, None, None, "x")]
    df = spark.createDataFrame(rows, f"customer_id long, {TARGET} int, fold int, `{a}` double, `{b}` double, `{text}` string")
    for one_hot, texts in ((False, 1), (True, 2)):
        settings = Settings(one_hot=one_hot)
        out = training._tree_rows(training._fit_preparation(df, settings), df, settings)
        gaps = {r["customer_id"]: [x is None for x in r["x"]] for r in out.collect()}
        last = [False] * texts
        assert gaps[1] == [False, False, *last] and gaps[2] == [True, False, *last] and gaps[4] == [True, True, *last]
        assert gaps[3] == [False, True, *(last if one_hot else [True])]
        # the list of gaps was once built again for every entry of the vector
        assert "get(array(isnull" not in out._jdf.queryExecution().analyzed().toString().lower()
