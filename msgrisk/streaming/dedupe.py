"""De-duplicating arriving messages so that the best copy wins, not the first to arrive."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructType

HELPERS = ("_digest", "_tick", "_first", "_last")
# Stand for missing times in minima and maxima.
NO_FIRST, NO_LAST = 2 ** 63 - 1, -(2 ** 63)


def _ranked(values: Sequence) -> tuple:
    """Compares as an ascending order with nulls first."""
    return tuple((True, v) if v is not None else (False,) for v in values)


class BestCopy(StatefulProcessor):
    """Holds the best copy of a text until its timer, emits it, then only remembers that it did."""

    def __init__(self, schema: StructType, order: Sequence[str], wait_ms: int, forget_ms: int | None) -> None:
        self.schema, self.wait_ms, self.forget_ms = schema, wait_ms, forget_ms
        self.places = [schema.fieldNames().index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.schema)
        self.emitted = handle.getValueState("emitted", "at bigint")

    def _rank(self, values: Sequence) -> tuple:
        return _ranked([values[i] for i in self.places])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        winner, first = None, None
        for row in rows:
            if row["_tick"]:
                continue
            values = tuple(row[name] for name in self.schema.fieldNames())
            first = row["_first"] if first is None else min(first, row["_first"])
            if winner is None or self._rank(values) < self._rank(winner):
                winner = values
        if winner is not None and not self.emitted.exists():
            held = self.best.get()
            if held is None:
                start = timerValues.getCurrentWatermarkInMs() if first == NO_FIRST else first // 1000
                self.handle.registerTimer(start + self.wait_ms)
            if held is None or self._rank(winner) < self._rank(held):
                self.best.update(winner)
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        held = self.best.get()
        if held is None:
            self.emitted.clear()
            return
        at = expiredTimerInfo.getExpiryTimeInMs()
        self.best.clear()
        self.emitted.update((at,))
        if self.forget_ms is not None:
            self.handle.registerTimer(at + self.forget_ms)
        yield Row(**dict(zip(self.schema.fieldNames(), held)))


def _best_of_batches(order: Sequence[str]):
    """Of each Arrow batch only the best copy of a text goes on, with the first and last time of all its copies."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            keys = [(c, "ascending") for c in ("_tick", "_digest", *order)]
            table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))
            digest = table["_digest"].combine_chunks()
            tick = table["_tick"].to_numpy()
            # A digest is never null, so neighbours compare as plain texts.
            new = pc.not_equal(digest[1:], digest[:-1]).to_numpy(zero_copy_only=False) | (tick[1:] != tick[:-1])
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            for name, extreme in (("_first", np.minimum), ("_last", np.maximum)):
                place = table.column_names.index(name)
                whole = pa.array(np.repeat(extreme.reduceat(table[name].to_numpy(), starts), np.diff(np.append(starts, len(tick)))))
                table = table.set_column(place, name, whole)
            yield from table.take(pa.array(starts)).combine_chunks().to_batches()

    return combine


def dedupe_by_rank(
    messages: DataFrame, time: str, delay: str, wait_seconds: int, text: str = "text",
    order: Sequence[str] = ("source_rank", "msg_id"), forget_seconds: int | None = None, tick: Column | None = None,
) -> DataFrame:
    """Each text once: the copy of lowest order (nulls first) among those that come while the text is held.

    A text is held from the event time of its first copy on; wait_seconds later, by the watermark, its best copy goes
    out. Copies that come after that are dropped, for ever or until forget_seconds more have passed. Once every
    copy has come within the wait this gives the rows of `operators.dedupe.dedupe_messages`.

    Of many copies in one micro-batch each Arrow batch sends one row to the shuffle, so a text that makes up a third
    of all rows is no hot key. State is one row per text held and a number per text emitted. It needs the state store
    of RocksDB, see `messages.write_available(keyed_state=True)`.

    Rows older than the watermark (`delay` behind the latest time) are late and left out. A row without a time is
    never late and its text is held from the watermark on. A missing text is a text of its own. Rows that meet the condition `tick` move the watermark and are
    never emitted: a closing tick sends out what is still held.
    """
    schema = messages.schema
    clash = set(HELPERS) & set(messages.columns)
    if clash:
        raise ValueError(f"column names in use: {sorted(clash)}")
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    named = messages.withColumns({
        "_digest": F.coalesce(F.sha2(text, 256), F.lit("")),
        "_tick": F.coalesce(tick, F.lit(False)) if tick is not None else F.lit(False),
        "_first": F.coalesce(micros, F.lit(NO_FIRST)), "_last": F.coalesce(micros, F.lit(NO_LAST)),
    })
    best = named.mapInArrow(_best_of_batches(order), named.schema)
    seen = F.when(F.col("_last") > F.lit(NO_LAST), F.timestamp_micros("_last"))
    timed = best.withColumn("_seen", seen).withWatermark("_seen", delay)
    forget_ms = None if forget_seconds is None else forget_seconds * 1000
    return timed.groupBy("_digest").transformWithState(
        BestCopy(schema, order, wait_seconds * 1000, forget_ms), schema, "Append", "EventTime"
    )
