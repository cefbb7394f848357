"""Ids across sources, missing scores, lenient labels and wide projections."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgrisk.functions import scoring
from msgrisk.operators import projection
from msgrisk.operators.dedupe import dedupe_messages, merge_sources
from msgrisk.plans import training
from msgrisk.sources.messages import load_email, load_sms


def test_ids_of_two_sources_without_ids(spark, tmp_path):
    (tmp_path / "sms.csv").write_text("v1,v2\n" + "".join(f"ham,sms {i}\n" for i in range(40)))
    (tmp_path / "email.csv").write_text("Email Text,Email Type\n" + "".join(f"mail {i},spam\n" for i in range(40)))
    merged = merge_sources(load_sms(spark, str(tmp_path / "sms.csv")), load_email(spark, str(tmp_path / "email.csv")))
    deduped = dedupe_messages(merged)
    assert deduped.count() == deduped.select("msg_id").distinct().count() == 80
    raw = merge_sources(merged.drop("source_rank"), keep_ids=True)
    assert {r.msg_id for r in raw.collect()} == {r.msg_id for r in merged.collect()}


def test_training_refuses_repeated_ids(spark):
    rows = spark.createDataFrame([(1, "a b", "ham"), (1, "c d", "spam"), (2, "e", "ham")], "msg_id long, text string, label string")
    with pytest.raises(ValueError, match="more than once"):
        training.fit(rows)


def test_missing_score_stays_missing(spark):
    row = spark.range(1).select(scoring.risk_score(F.lit(None).cast("double"), F.lit(1.0), F.lit(5)).alias("s"))
    got = row.select("s", scoring.severity(F.col("s")).alias("v")).first()
    assert got.s is None and got.v is None


def test_projection_of_many_columns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 120)) * (rng.random((60, 120)) < 0.2)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    coords, values = projection.svd_coordinates(df, "id", "x", 5)
    got = np.array([r.coords for r in coords.orderBy("id").collect()])
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, s[:5]) and np.allclose(np.abs(got), np.abs(u[:, :5] * s[:5]), atol=1e-8)
