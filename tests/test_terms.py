import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from msgrisk.operators import vectorize as ve


@pytest.fixture(scope="module")
def grams(spark):
    """Few frequent terms, many rare ones, ties, rows without terms."""
    rng = random.Random(2)
    rows = [[f"t{int(400 * rng.random() ** 4)}" for _ in range(rng.randrange(30))] + [f"rare{i}"] for i in range(300)] + [[], None, ["tie"] * 3]
    return rows, spark.createDataFrame([(r,) for r in rows], "grams array<string>")


def brute(rows, n):
    tf = Counter(t for r in rows for t in r or ())
    df = Counter(t for r in rows for t in set(r or ()))
    return [(t, tf[t], df[t]) for t in sorted(tf, key=lambda t: (-tf[t], t))[:n]]


# With few buckets all of them are heavy; with some the first bound is too high and a second recount settles it.
@pytest.mark.parametrize("buckets", [1, 7, 64, 512, 1 << 20])
@pytest.mark.parametrize("n", [1, 10, 60, 100_000])
def test_top_terms(grams, n, buckets):
    rows, df = grams
    got = sorted(map(tuple, ve.top_terms(df, n, buckets).collect()), key=lambda r: (-r[1], r[0]))
    assert got == brute(rows, n)


def test_all_counts_and_nothing(spark, grams):
    rows, df = grams
    assert sorted(map(tuple, ve.term_counts(df).collect())) == sorted(brute(rows, 10**6))
    assert ve.top_terms(spark.createDataFrame([], "grams array<string>")).count() == 0
    with pytest.raises(ValueError):
        ve.top_terms(df, 0)


def test_only_heavy_buckets_are_recounted(spark, monkeypatch):
    """Of 30,000 terms the shuffle of the recount carries a few."""
    rows = [[f"often{i % 20}"] * 5 + [f"rare{i}-{j}" for j in range(10)] for i in range(3000)]
    df = spark.createDataFrame([(r,) for r in rows], "grams array<string>")
    seen = []
    summed = ve._summed

    def counted(terms):
        out = summed(terms)
        seen.append(out.count())
        return out

    monkeypatch.setattr(ve, "_summed", counted)
    top = {r.term: (r.tf, r.df) for r in ve.top_terms(df, 15).collect()}
    assert len(top) == 15 and set(top.values()) == {(750, 150)}
    assert sum(seen) < 1000


def test_long_weights_of_rows_without_terms(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "msg_id bigint, clean_text string")
    model = ve.FeatureModel.fit(df, manual=())
    assert set(model.terms) == {"a", "b", "a b", "b a"}
    found = ve.long_weights(model.text_vectors(df), model).agg(F.count_distinct("msg_id"), F.count("*")).first()
    assert tuple(found) == (1, 4)


def test_sketch_and_plain_counts_fit_alike(spark, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(f"w{int(90 * rng.random() ** 2)}" for _ in range(25)) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "msg_id bigint, clean_text string")
    plain = ve.FeatureModel.fit(df, manual=(), max_features=200)
    monkeypatch.setattr(ve, "SKETCH_FROM_CHARS", -1)
    assert ve.FeatureModel.fit(df, manual=(), max_features=200) == plain and len(plain.terms) == 200
