"""Mix sources to target weights by balanced sampling with the cube method.

Each source gets a target number of words. A row of a source is to be taken x = target / words of the source
times: floor(x) times for certain, and once more with probability x - floor(x). The cube method decides these
extra copies: it moves the vector of probabilities through the null space of the constraints (number of rows
and number of words, both kept exactly) until a probability reaches 0 or 1, that is, until fewer rows than
constraints plus one are undecided. Blocks of a source do so side by side; what they leave undecided meets in
fewer blocks, round after round, until each source is one block. There the flight ends with two open rows at
most; with LANDING_ROWS short rows kept out of it they land on the corner of the cube that misses the words
of the source by least.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from msgrisk.llm.tables import stored
from msgrisk.llm.tokens import pieces, raw

BLOCK_ROWS = 4096
LANDING_ROWS = 12
CAP = 3
CYCLE = 3
_EDGE = 1e-9
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_totals(texts: pa.Array) -> np.ndarray:
    """Number of words of each text; 0 for null."""
    offsets, data = raw(pc.fill_null(texts, ""))
    space = _SPACE[data]
    start = ~space
    start[1:] &= space[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = ~space[first]
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(start, out=before[1:])
    return before[offsets[1:]] - before[offsets[:-1]]


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """mx_id, mx_source, mx_size and mx_hash (of id and text, to deal rows into blocks) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "t"):
            size = pa.array(word_totals(piece.column("t")))
            yield pa.RecordBatch.from_arrays([piece.column("i"), piece.column("s"), size, piece.column("h")], ["mx_id", "mx_source", "mx_size", "mx_hash"])

    rows = docs.select(
        F.col(id_col).alias("i"), F.col(source_col).cast("string").alias("s"), F.col(text_col).alias("t"),
        F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h"),
    )
    return rows.mapInArrow(count, f"mx_id {kind}, mx_source string, mx_size bigint, mx_hash bigint")


def targets(sized: DataFrame) -> DataFrame:
    """mx_source, mx_rows, mx_source_size and mx_target, one row per source.

    Sources in code point order, null last, weigh 1, 2, 3, repeating. A target above CAP times the source is
    cut to that, and what is cut goes to the others by weight, until none is above.
    """
    spark = sized.sparkSession
    totals = sized.groupBy("mx_source").agg(F.count("*").alias("mx_rows"), F.sum("mx_size").alias("mx_source_size"))
    ordered = totals.orderBy(F.col("mx_source").isNull(), "mx_source")
    ranked = spark.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda pair: (*pair[0], pair[1] % CYCLE + 1)),
        "mx_source string, mx_rows bigint, mx_source_size bigint, weight int",
    )
    ranked = stored(ranked, "mix-sources")
    left, share = ranked.agg(F.sum("mx_source_size"), F.sum("weight")).first()
    left, share = left or 0, share or 0
    capped = F.lit(False)
    while share:
        above = CAP * F.col("mx_source_size") * F.lit(float(share)) < F.lit(float(left)) * F.col("weight")
        more = ranked.where(~capped & above).agg(F.sum("mx_source_size"), F.sum("weight")).first()
        if more[1] is None:
            break
        # Every source above its cap at this level stays above it at all later ones, whose level is higher.
        level = left / share
        left, share = left - CAP * more[0], share - more[1]
        capped = CAP * F.col("mx_source_size") < F.lit(float(level)) * F.col("weight")
    level = F.lit(left / share if share else 0.0)
    return ranked.withColumn(
        "mx_target", F.when(capped, CAP * F.col("mx_source_size").cast("double")).otherwise(level * F.col("weight"))
    ).drop("weight")


def _flight(chance: list[float], size: list[float], rng: np.random.Generator) -> list[float]:
    """Move chances along null vectors of (1, size) until at most two are strictly between 0 and 1."""
    out = list(chance)
    open_rows: list[int] = []
    draws = iter(rng.random(len(out) + 8).tolist())
    for i, p in enumerate(out):
        if p <= _EDGE or p >= 1 - _EDGE:
            out[i] = round(p)
            continue
        open_rows.append(i)
        if len(open_rows) < 3:
            continue
        a, b, c = open_rows
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if u == (0, 0, 0):
            u = (1, -1, 0)
        up = down = float("inf")
        for k, x in zip(open_rows, u):
            if x > 0:
                up, down = min(up, (1 - out[k]) / x), min(down, out[k] / x)
            elif x < 0:
                up, down = min(up, out[k] / -x), min(down, (1 - out[k]) / -x)
        step = up if next(draws) * (up + down) < down else -down
        rest = []
        for k, x in zip(open_rows, u):
            p = out[k] + step * x
            if p <= _EDGE or p >= 1 - _EDGE:
                out[k] = 0.0 if p < 0.5 else 1.0
            else:
                out[k] = p
                rest.append(k)
        open_rows = rest
    return out


def _land(chance: list[float], size: list[float]) -> list[float]:
    """Round the open rows to the corner of the cube nearest in words, then in rows."""
    p, words = np.array(chance), np.array(size)
    at = np.flatnonzero((p > 0) & (p < 1))
    bits = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
    off = bits - p[at]
    # A row too many or too few weighs as much as one word.
    p[at] = bits[np.argmin(np.abs(off @ words[at]) + np.abs(off.sum(1)))]
    return p.tolist()


def _round(rows: DataFrame, last: bool) -> DataFrame:
    """One flight per block of a source; the landing as well when each source is one block."""

    def fly(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["mx_hash", "mx_size", "mx_id"]).reset_index(drop=True)
        key = [int(frame["mx_hash"].iloc[0]) & 0xFFFFFFFF, len(frame)]
        size, chance = frame["mx_size"].to_numpy(float), frame["chance"].to_numpy(float)
        flying = np.ones(len(frame), bool)
        if last or frame["block"].iloc[0] == 0:
            # A few rows below the median size wait for the landing, which finds a corner close to the target.
            short = np.flatnonzero((size > 0) & (chance > _EDGE) & (chance < 1 - _EDGE) & (size <= np.median(size)))
            flying[short[:LANDING_ROWS]] = False
        at = np.flatnonzero(flying)
        chance[at] = _flight(chance[at].tolist(), size[at].tolist(), np.random.default_rng(key))
        frame["chance"] = _land(chance.tolist(), size.tolist()) if last else chance
        return frame

    return rows.groupBy("mx_source", "block").applyInPandas(fly, rows.schema)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source, size, source_size, target, copies and taken (= size * copies), one row per row of docs.

    Null text has size 0; null source is a source. Rows of size 0 count as rows, not as words. Repeated rows
    are sampled one by one. A source without words has target 0 and takes nothing. Blocks, order and random
    draws follow from ids, texts and sizes alone, so reruns agree.
    """
    sized = stored(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    plan = targets(sized)
    wanted = F.when(F.col("mx_source_size") > 0, F.col("mx_target") / F.col("mx_source_size")).otherwise(0.0)
    rows = sized.join(plan, sized["mx_source"].eqNullSafe(plan["mx_source"])).drop(plan["mx_source"])
    base = F.floor(F.col("wanted") + _EDGE)
    rows = rows.withColumn("wanted", wanted).withColumn("base", base).withColumn("chance", F.greatest(F.col("wanted") - F.col("base"), F.lit(0.0)))
    blocks = F.ceil(F.col("mx_rows") / BLOCK_ROWS)
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod("mx_hash", "blocks")).drop("wanted", "mx_rows")
    decided, most = [], -(-(plan.agg(F.max("mx_rows")).first()[0] or 0) // BLOCK_ROWS)
    while True:
        last = most <= 1
        rows = stored(_round(rows, last), "mix-round")
        open_rows = (F.col("chance") > 0) & (F.col("chance") < 1)
        decided.append(rows.where(~open_rows))
        if last:
            break
        # A source of one block can have open rows as well; they meet again with the larger ones.
        blocks = F.ceil(F.col("blocks") * 2 / BLOCK_ROWS)
        rows = rows.where(open_rows).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("mx_hash"), "blocks"))
        most = -(-most * 2 // BLOCK_ROWS)
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    copies = (F.col("base") + F.col("chance")).cast("bigint")
    return out.select(
        F.col("mx_id").alias(id_col), F.col("mx_source").alias(source_col), F.col("mx_size").alias("size"),
        F.col("mx_source_size").alias("source_size"), F.col("mx_target").alias("target"), copies.alias("copies"),
        (F.col("mx_size") * copies).alias("taken"),
    )
