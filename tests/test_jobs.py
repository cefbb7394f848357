import json

import pytest
from pyspark.sql import functions as F

from msgrisk.operators import dedupe
from msgrisk.plans import report as reporting, training
from msgrisk.sources import sinks
from msgrisk.streaming import messages as streaming

SPAM = ["free click win now", "urgent otp bank free", "click http://bit.ly/a1 now free", "trúng thưởng 5 triệu click free"]
HAM = ["see you at lunch", "meeting moved to noon today", "thanks for the report", "call me when home"]


@pytest.fixture(scope="module")
def messages(spark):
    """120 messages, a third of them copies of one text."""
    rows = [(i, f"{SPAM[i % 4]} {i % 7} w{i}", "spam", "sms") for i in range(40)]
    rows += [(i, f"{HAM[i % 4]} {i % 5} w{i}", "ham", "email") for i in range(40, 80)]
    rows += [(i, "the same words again", "ham", "email") for i in range(80, 120)]
    return spark.createDataFrame(rows, "msg_id bigint, text string, label string, source string")


@pytest.fixture(scope="module")
def fitted(messages):
    return training.fit(messages, restarts=2, num_trees=5, max_depth=5, n_clusters=3)


def test_dedupe_keeps_the_first_source(spark, messages):
    extra = spark.createDataFrame([(999, "the same words again", "spam", "sms")], messages.schema)
    merged = dedupe.merge_sources(extra, messages)
    kept = dedupe.dedupe_messages(merged)
    assert kept.count() == 81
    assert kept.filter("text = 'the same words again'").first().msg_id == 999 * 2
    summary = {r.metric: r.value for r in dedupe.dataset_summary(merged, kept).collect()}
    assert summary == {"sms_rows": 41, "email_rows": 80, "total_rows": 81, "removed_rows": 40,
                       "label_spam": 41, "label_ham": 40}


def test_summary(fitted, messages):
    model, summary = fitted
    values = {r.metric: r.value for r in training.summary_table(summary).collect()}
    assert 0 <= values["roc_auc"] <= 1 and values["accuracy/accuracy"] > 0.8
    assert values["macro avg/support"] == 24
    assert [r.k for r in summary.diagnostics.orderBy("k").collect()] == [2, 3]
    importance = summary.importance.collect()
    assert len(importance) == model.features.size
    assert sum(r.importance for r in importance) == pytest.approx(1)
    assert importance == sorted(importance, key=lambda r: (-r.importance, r.feature))
    # Clusters hold fraud rows only, so their risk is 1.
    assert {r.cluster_risk for r in model.risks.collect()} == {1.0}


def test_predictions(fitted, messages):
    model, _ = fitted
    rows = model.predict(messages).collect()
    assert len(rows) == 120 and all(0 <= r.risk_score <= 1 for r in rows)
    scored = model.score(messages).collect()
    for r in scored:
        expected = 0.6 * r.fraud_probability + 0.2 * r.cluster_risk + 0.2 * min(r.rule_hits, 5) / 5
        assert r.risk_score == pytest.approx(expected)
        assert r.reasons[0] == f"Cluster {r.cluster_id}" and len(r.reasons) == 1 + bool(r.rule_hits)


def test_saved_model_predicts_alike(spark, fitted, messages, tmp_path):
    model, _ = fitted
    model.save(str(tmp_path / "model"))
    again = training.MessageRiskModel.load(spark, str(tmp_path / "model"))
    assert again.features == model.features
    assert sorted(again.predict(messages).collect()) == sorted(model.predict(messages).collect())


def test_stream_equals_batch(spark, fitted, messages, tmp_path):
    model, _ = fitted
    messages.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = streaming.read_messages(spark, str(tmp_path / "in"), messages.schema, files_per_trigger=1)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    streaming.write_available(model.predict(stream), out, progress).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == sorted(model.predict(messages).collect())
    # A restart from the same checkpoint adds nothing.
    streaming.write_available(model.predict(stream), out, progress).awaitTermination()
    assert spark.read.parquet(out).count() == 120


def test_stream_dedupe(spark, messages, tmp_path):
    messages.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = streaming.read_messages(spark, str(tmp_path / "in"), messages.schema, files_per_trigger=1)
    arrived = stream.withColumn("at", F.timestamp_seconds(F.col("msg_id") + 1_700_000_000))
    kept = streaming.dedupe_stream(arrived, "at", "1 day")
    streaming.write_available(kept, str(tmp_path / "out"), str(tmp_path / "p")).awaitTermination()
    texts = [r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(texts) == len(set(texts)) == 81


def test_report_files(spark, fitted, messages, tmp_path):
    model, summary = fitted
    views = reporting.cluster_views(model, messages)
    report = reporting.run_report(messages, messages, summary, views.report)
    reporting.export(views, report, str(tmp_path))
    got = json.loads(spark.read.text(str(tmp_path / "report.json")).first()[0])
    assert list(got) == ["dataset_summary", "evaluation", "confusion_matrix", "roc_auc", "top_features", "rules_found",
                         "cluster_k", "cluster_inertias", "cluster_silhouettes", "cluster_descriptions"]
    assert got["dataset_summary"] == {"sms_rows": 40, "email_rows": 80, "total_rows": 120,
                                      "label_counts": {"spam": 40, "ham": 80}}
    assert len(got["top_features"]) == 20 and got["cluster_k"] == [2, 3]
    assert sum(c["n_samples"] for c in got["cluster_descriptions"]) == 40
    table = spark.read.csv(str(tmp_path / "cluster_descriptions.csv"), header=True, escape='"')
    assert table.columns == list(sinks.CLUSTER_TABLE_COLUMNS) and table.count() == len(got["cluster_descriptions"])
    text = "\n".join(r[0] for r in spark.read.text(str(tmp_path / "cluster_descriptions.md")).collect())
    assert text.startswith("# Bảng Mô Tả Các Cụm") and "\n## Cụm 0: Nhóm liên quan tới '" in text
    assert text.index("## Cụm 0") < text.index("## Cụm 1")
    assert [int(r[0]) for r in table.collect()] == [c["cluster_id"] for c in got["cluster_descriptions"]]
    quality = spark.read.text(str(tmp_path / "cluster_evaluation.md")).collect()
    assert quality[0][0].startswith("# Bảng Đánh Giá") and "| Silhouette Score |" in quality[6][0]
    assert spark.read.csv(str(tmp_path / "cluster_evaluation.csv"), header=True).count() == 4
    assert spark.read.parquet(str(tmp_path / "cluster_coordinates.parquet")).count() == 40


def test_without_fraud_rows_all_are_clustered(spark, messages):
    ham = messages.filter("label = 'ham'")
    model, summary = training.fit(ham, restarts=1, num_trees=2, max_depth=3, n_clusters=2)
    assert summary.auc.first().auc is None
    assert {r.cluster_risk for r in model.risks.collect()} == {0.0}


@pytest.mark.parametrize("missing", ["text", "label"])
def test_missing_columns(messages, missing):
    with pytest.raises(KeyError, match=missing):
        training.fit(messages.drop(missing))
