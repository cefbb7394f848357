from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from msgrisk.operators.dedupe import dedupe_messages
from msgrisk.streaming import messages as streaming
from msgrisk.streaming.dedupe import dedupe_by_rank

SCHEMA = "msg_id bigint, text string, source string, source_rank int, at timestamp, score double"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
TICK = (None, None, "tick", 0, 10_000_000, None)


@pytest.fixture
def flow(spark, tmp_path):
    """add() writes a file of rows with seconds for times; run() processes what arrived and gives all rows so far."""
    files = iter(range(100))
    (tmp_path / "in").mkdir()

    def add(*rows):
        timed = [(*r[:4], None if r[4] is None else START + timedelta(seconds=r[4]), r[5]) for r in rows]
        spark.createDataFrame(timed, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{next(files)}"))

    def run(**options):
        schema = spark.createDataFrame([], SCHEMA).schema
        stream = streaming.read_messages(spark, str(tmp_path / "in" / "*"), schema, files_per_trigger=1)
        kept = dedupe_by_rank(stream, "at", "10 seconds", 100, tick=F.col("source") == "tick", **options)
        streaming.write_available(kept, str(tmp_path / "out"), str(tmp_path / "p"), keyed_state=True).awaitTermination()
        return spark.read.schema(schema).parquet(str(tmp_path / "out"))

    def everything():
        return spark.read.parquet(str(tmp_path / "in" / "*")).filter("source <> 'tick'")

    return add, run, everything


def test_sms_wins_though_it_comes_later(spark, flow):
    add, run, everything = flow
    before = spark.conf.get(streaming.STATE_STORE)
    add((5, "same", "email", 1, 0, 0.5), (6, "alone", "email", 1, 1, None), (7, "same", "email", 1, 2, 1.5))
    assert run().count() == 0
    assert spark.conf.get(streaming.STATE_STORE) == before
    # Another run goes on from the state of the first; times are out of order.
    add((4, "same", "sms", 0, 50, 2.5), (3, "alone", "email", 1, 45, 0.1), (9, None, "sms", 0, 46, 0.2))
    add((2, "same", "sms", 0, 60, 3.5), (8, None, "email", 1, 47, 0.3), (1, "", "email", 1, 48, 0.4))
    assert run().count() == 0
    add(TICK)
    got = run()
    assert sorted(got.collect(), key=str) == sorted(dedupe_messages(everything()).collect(), key=str)
    assert {r.text: r.msg_id for r in got.collect()} == {"same": 2, "alone": 3, None: 9, "": 1}
    # A restart adds nothing.
    assert run().count() == 4


def test_copies_after_the_wait_are_dropped(flow):
    add, run, _ = flow
    add((5, "a", "email", 1, 0, 0.0))
    add((6, "b", "email", 1, 200, 0.0))
    assert [r.msg_id for r in run().collect()] == [5]
    add((1, "a", "sms", 0, 201, 0.0), (2, "b", "sms", 0, 250, 0.0))
    add(TICK)
    assert sorted(r.msg_id for r in run().collect()) == [2, 5]


def test_texts_are_forgotten_in_time(flow):
    add, run, _ = flow
    for row in ((5, "a", "email", 1, 0, 0.0), (6, "b", "email", 1, 150, 0.0), (7, "a", "email", 1, 151, 0.0),
                (8, "c", "email", 1, 1000, 0.0), (9, "a", "email", 1, 1001, 0.0), TICK):
        add(row)
        kept = run(forget_seconds=300)
    # The copy of second 151 falls into the 300 seconds, the one of second 1001 does not.
    assert sorted(r.msg_id for r in kept.collect()) == [5, 6, 8, 9]


def test_a_hot_text_and_missing_values(flow):
    add, run, everything = flow
    rows = [(i, "hot" if i % 3 else f"t{i}", "email", 1, i % 90, 0.5) for i in range(1, 3000)]
    rows += [(None, "hot", "email", 1, 3, None), (4, "hot", "sms", None, 4, None), (4000, "no time", "sms", 0, None, 0.0)]
    add(*rows)
    add(TICK)
    got = run().collect()
    assert sorted(got, key=str) == sorted(dedupe_messages(everything()).collect(), key=str) and len(got) == 999 + 2


def test_names_in_use(spark):
    with pytest.raises(ValueError, match="_digest"):
        dedupe_by_rank(spark.createDataFrame([], SCHEMA + ", _digest int"), "at", "1 second", 1)
