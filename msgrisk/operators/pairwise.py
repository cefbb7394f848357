"""Exact all-pairs work, block against block.

Distances between all rows are quadratic by nature. Rows are hashed into blocks of bounded size and
every pair of blocks is one group, keyed by the pair and reached by an ordinary shuffle, so no task
ever holds more than two blocks. Blocks grow with the table up to BLOCK_NUMBERS numbers, so that up to there the
rows sent grow no faster than the table. A task multiplies its two blocks as matrices, tile by tile, and emits
sums per row, never a pair of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F

# Rows of the smallest blocks, and of a tile. The distances of two tiles (2 MB) stay in a core's cache.
BLOCK_ROWS = 2048
TILE_ROWS = 512
# Blocks of a table, unless they would hold more numbers than this as dense rows (32 MB) or fewer than BLOCK_ROWS.
BLOCKS = 16
BLOCK_NUMBERS = 4 * 1024 * 1024
# Distances are compared to this many digits, so that ties between copies go by id.
DIGITS = 9
# Share of the squared norms below which a squared distance is computed by differences.
NEAR = 1e-4
# Numbers held at once for that (32 MB).
NEAR_ENTRIES = 4 * 1024 * 1024


def packed(df: DataFrame, vector: str) -> DataFrame:
    """Replace the vector by _at (positions, null where dense) and _x (values)."""
    if isinstance(df.schema[vector].dataType, VectorUDT):
        inner = F.unwrap_udt(vector)
        at, x = inner["indices"], inner["values"]
    else:
        at, x = F.lit(None).cast("array<int>"), F.col(vector).cast("array<double>")
    return df.withColumns({"_at": at, "_x": x}).drop(vector)


def _halved(df: DataFrame) -> DataFrame:
    """Move the values of rows that single precision holds exactly from _x to _single, so that they travel in half the bytes."""
    exact = F.forall("_x", lambda v: v.cast("float").cast("double") == v)
    single = df.withColumn("_single", F.when(exact, F.col("_x").cast("array<float>")))
    return single.withColumn("_x", F.when(F.col("_single").isNull(), F.col("_x")))


def width_of(df: DataFrame, vector: str) -> int:
    if isinstance(df.schema[vector].dataType, VectorUDT):
        inner = F.unwrap_udt(vector)
        size = F.coalesce(inner["size"], F.size(inner["values"]))
    else:
        size = F.size(vector)
    row = df.select(size).first()
    return row[0] if row else 0


def matrix(rows: pd.DataFrame, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    values = rows["_x"] if "_single" not in rows else (s if x is None else x for x, s in zip(rows["_x"], rows["_single"]))
    for i, (at, x) in enumerate(zip(rows["_at"], values)):
        out[i, slice(None) if at is None else at] = x
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances from one matrix product. Near pairs, where that loses digits, are taken directly."""
    scale = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    squared = scale - 2.0 * (a @ b.T)
    rows, columns = np.nonzero(squared < NEAR * scale)
    step = max(1, NEAR_ENTRIES // max(a.shape[1], 1))
    for start in range(0, len(rows), step):
        i, j = rows[start:start + step], columns[start:start + step]
        squared[i, j] = ((a[i] - b[j]) ** 2).sum(1)
    return np.sqrt(np.maximum(squared, 0.0, out=squared), out=squared)


def _block_rows(n_rows: int, width: int) -> int:
    """Rows of a block: a share of the table, within what a task can hold."""
    return max(BLOCK_ROWS, min(math.ceil(n_rows / BLOCKS), BLOCK_NUMBERS // max(width, 1)))


def _block_count(n_rows: int, block_rows: int, cores: int) -> int:
    """Enough blocks to keep each below about block_rows, and to use all cores on small inputs."""
    spread = min(math.ceil(math.sqrt(2 * cores)), math.ceil(n_rows / 64))
    return max(math.ceil(n_rows / block_rows), spread, 1)


def _tiles(rows: pd.DataFrame, width: int) -> list[tuple[pd.DataFrame, np.ndarray]]:
    parts = [rows.iloc[i:i + TILE_ROWS] for i in range(0, max(len(rows), 1), TILE_ROWS)]
    return [(part, matrix(part, width)) for part in parts]


def per_block_pair(
    df: DataFrame,
    key: str,
    vector: str,
    carried: Sequence[str],
    sums: Callable[[np.ndarray, pd.DataFrame], np.ndarray],
    shown: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame],
    schema: str,
    sizes: dict[int | None, int],
    group: str | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Add up sums(distances, others) over the tiles of another block, for every ordered pair of blocks.

    shown(rows, added) gives the lines of the rows of one tile. With a group column only blocks of the same group
    meet. sizes has the rows of each group (of None without one); there is an entry per class, so it is small.
    """
    width = width_of(df, vector)
    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks = {g: _block_count(n, block_rows or _block_rows(n, width), cores) for g, n in sizes.items()}
    if group is None:
        placed, n_blocks = df.withColumn("_group", F.lit(0)), F.lit(blocks[None])
    else:
        known = F.create_map(*[F.lit(v) for pair in blocks.items() for v in pair])
        placed, n_blocks = df.withColumn("_group", F.col(group)), F.element_at(known, F.col(group))
    placed = placed.withColumn("_blocks", n_blocks)
    placed = _halved(packed(placed.select(key, vector, "_group", "_blocks", *carried), vector)).withColumn(
        "_block", F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int")
    )
    copies = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).withColumns(
        {"_low": F.least("_block", "_other"), "_high": F.greatest("_block", "_other")}
    ).drop("_other", "_blocks")

    def both(pair: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, low, high = pair
        first = _tiles(rows[rows["_block"] == low], width)
        second = first if low == high else _tiles(rows[rows["_block"] == high], width)
        added: dict[tuple[int, int], np.ndarray] = {}

        def add(side: int, i: int, part: np.ndarray) -> None:
            added[side, i] = added[side, i] + part if (side, i) in added else part

        for i, (a_rows, a) in enumerate(first):
            for j, (b_rows, b) in enumerate(second):
                if low == high and j < i:
                    continue
                found, itself = distances(a, b), low == high and i == j
                if itself:
                    np.fill_diagonal(found, 0.0)
                add(0, i, sums(found, b_rows))
                if not itself:
                    add(int(low != high), j, sums(found.T, a_rows))
        return pd.concat([shown((second if side else first)[i][0], total) for (side, i), total in added.items()])

    # Few bytes make much work here, so partitions are not left to their sizes.
    pairs = ("_group", "_low", "_high")
    n_pairs = sum(n * (n + 1) // 2 for n in blocks.values())
    return copies.repartition(min(max(n_pairs, 1), 32 * cores), *pairs).groupBy(*pairs).applyInPandas(both, schema)


def silhouettes(
    df: DataFrame, key: str, vector: str, clusterings: Sequence[str], block_rows: int | None = None
) -> DataFrame:
    """(clustering, silhouette): mean Euclidean silhouette of each clustering column.

    All clusterings share one pass over the distances.
    """
    sizes = (
        df.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("clustering"), F.col(c).cast("int").alias("cluster"))
            for i, c in enumerate(clusterings)
        ])))
        .groupBy("clustering", "cluster").agg(F.count("*").alias("n"))
    )
    # One row per cluster.
    slots = sorted((r.clustering, r.cluster, r.n) for r in sizes.collect())
    n_rows = sum(n for i, _, n in slots if i == 0)
    of = np.array([s[0] for s in slots], np.int32)
    cluster = np.array([s[1] for s in slots], np.int32)

    def sums(distances, others):
        theirs = others[list(clusterings)].to_numpy()
        return distances @ (theirs[:, of] == cluster[None, :]).astype(float)

    def shown(rows, total):
        return pd.DataFrame({key: rows[key].to_numpy(), "given": list(rows[list(clusterings)].to_numpy()), "totals": list(total)})

    kind = df.schema[key].dataType.simpleString()
    typed = df.select(key, vector, *[F.col(c).cast("int").alias(c) for c in clusterings])
    partial = per_block_pair(
        typed, key, vector, clusterings, sums, shown, f"{key} {kind}, given array<int>, totals array<double>",
        {None: n_rows}, None, block_rows,
    )
    spark = df.sparkSession
    slot_table = spark.createDataFrame(
        [(i, s[0], clusterings[s[0]], s[1], s[2]) for i, s in enumerate(slots)],
        "slot int, place int, clustering string, cluster int, n bigint",
    )
    # A row is one line per block it meets up to its key's task; its clusters come apart there.
    lines = partial.repartition(F.col(key)).select(key, "given", F.posexplode("totals").alias("slot", "total"))
    marked = lines.join(F.broadcast(slot_table), "slot").withColumn("own", F.get("given", F.col("place")) == F.col("cluster"))
    own_mean = F.when(F.col("own"), F.col("total") / F.nullif(F.col("n") - 1, F.lit(0)))
    per_row = (
        marked.groupBy(key, "clustering", "slot", "own", "n").agg(F.sum("total").alias("total"))
        .groupBy("clustering", key)
        .agg(F.max(own_mean).alias("a"), F.min(F.when(~F.col("own"), F.col("total") / F.col("n"))).alias("b"))
    )
    # A row alone in its cluster, or equal to all rows, scores 0.
    score = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    return per_row.groupBy("clustering").agg(
        F.avg(F.when(F.col("a").isNull(), F.lit(0.0)).otherwise(F.coalesce(score, F.lit(0.0)))).alias("silhouette")
    )
