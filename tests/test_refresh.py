from pyspark.sql import functions as F

import pytest

from msgrisk.operators import rules as ru
from msgrisk.streaming import messages as streaming, refresh


def rules_of(spark, *antecedents):
    rows = [(a.split(), ["x"], 0.5, 1.0, 2.0) for a in antecedents]
    return spark.createDataFrame(rows, ru.RULE_SCHEMA)


@pytest.fixture
def arriving(spark, tmp_path):
    """Three files; a call writes the next one."""
    schema = "msg_id bigint, clean_text string, fraud_probability double, cluster_id int"
    texts = ["free click now", "bank otp", "hello there"]

    def write(part):
        rows = [(part * 10 + i, t, 0.5, 0) for i, t in enumerate(texts)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{part}"))

    write(0)
    stream = lambda: streaming.read_messages(spark, str(tmp_path / "in" / "*"), spark.read.parquet(str(tmp_path / "in" / "part0")).schema, files_per_trigger=1)
    return write, stream


def test_rules_swapped_between_batches_and_restarts(spark, arriving, tmp_path):
    write, stream = arriving
    models, out, progress = (str(tmp_path / n) for n in ("models", "out", "progress"))
    risks = spark.createDataFrame([(0, 0.0)], "cluster_id int, cluster_risk double")
    run = lambda: refresh.score_arrivals(stream(), models, out, progress, lambda d: d.select("msg_id", "rule_hits")).awaitTermination()
    assert refresh.publish(spark, models, risks, rules_of(spark, "free", "click now")) == 1
    run()
    assert refresh.publish(spark, models, risks, rules_of(spark, "otp bank", "hello", "there", "free now bank")) == 2
    write(1)
    run()
    wanted = {0: (2, 1), 1: (0, 1), 2: (0, 1), 10: (0, 2), 11: (1, 2), 12: (2, 2)}
    found = lambda: {r.msg_id: (r.rule_hits, r.model_version) for r in refresh.scored_rows(spark, out).collect()}
    assert found() == wanted
    # Nothing new: a restart adds nothing, and a batch run again keeps its first version.
    refresh.publish(spark, models, risks, rules_of(spark, "hello"))
    run()
    again = spark.read.parquet(str(tmp_path / "in" / "part0"))
    refresh.score_batch(again, models, out, 0, lambda d: d.select("msg_id", "rule_hits"))
    assert found() == wanted and refresh.scored_rows(spark, out).count() == 6


def test_nothing_published(spark, arriving, tmp_path):
    rows = arriving[1]
    with pytest.raises(ValueError):
        refresh.version_of_batch(spark, str(tmp_path / "none"), str(tmp_path / "out"), 0)
    assert rows().isStreaming and refresh.latest_version(spark, str(tmp_path / "none")) is None
    # Tables written without their line in the list, as by a publisher that was lost.
    rules_of(spark, "a").write.parquet(str(tmp_path / "models" / "v1" / "rules"))
    risks = spark.createDataFrame([(0, 0.0)], "cluster_id int, cluster_risk double")
    assert refresh.publish(spark, str(tmp_path / "models"), risks, rules_of(spark, "b", "c")) == 1
    assert spark.read.parquet(str(tmp_path / "models" / "v1" / "rules")).agg(F.count("*")).first()[0] == 2
