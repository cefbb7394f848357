import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.check import compare, duck

SMALL = "/root/testdata/sf0.001"
# One query per group of operators; the check tool runs all of them at a larger scale.
CHOSEN = ("csv_scan", "csv_bad_lines", "dedupe_messages", "preprocess", "stratified_split", "tfidf_transform",
          "feature_vectors", "association_rules", "classification_report", "cluster_report", "smote_rows", "alerts")


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    got = queries()[name](spark, SMALL).toPandas()
    assert compare(got, duck(SMALL).execute(oracle_sql()[name]).df()) == ""


def test_entry_and_names(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
