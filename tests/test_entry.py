"""Driver contract: entry, queries and oracle keys are consistent."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "c_mktsegment", "pos", "item", "cnt", "mean_target"]


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())
    from featurelane.plans import catalog
    rows_only = set(catalog.QUERIES) - set(E.oracle_sql())
    # fitted by iteration: no SQL
    assert rows_only <= {"ridge", "gbt_sales", "wide_linear", "wide_deep", "score_batch", "score_padded", "classifier", "als_hybrid",
                         "model_search", "sales_flow"}
