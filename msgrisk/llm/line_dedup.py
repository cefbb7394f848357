"""Delete later copies of repeated line runs, found with a suffix array over line-ID sequences.

A document is the sequence of its non-blank lines, each a 64-bit ID. Prefix doubling ranks the runs of
1, 2, 4, ... lines that start at each line: level k + 1 sorts the pairs (rank at i, rank at i + 2^k) of level k.
Runs that occur once leave at each level, so later levels hold repeated lines alone. Suffixes that share a rank
of level k have a longest common prefix of 2^k lines at least; any run is named by the ranks of the two
overlapping windows of 2^k lines that cover it. Windows of MIN_WORDS words, the shortest that start and the
shortest that end at each line, are grouped by name; every window but the earliest of its group is deleted.
Together these windows cover exactly the maximal repeated runs of MIN_WORDS words or more: a line goes if and
only if a run of at least MIN_WORDS words with it also starts earlier, in an earlier document or further up in
its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from msgrisk.llm.tables import stored
from msgrisk.llm.tokens import hash64, pieces

MIN_WORDS = 8


def line_windows(n_words: list[int], min_words: int) -> tuple[list[int], list[int]]:
    """For each line the lines of the shortest window of min_words words that starts there, and that ends there; 0: none."""
    total = np.r_[0, np.cumsum(n_words)]
    n = len(n_words)
    first_end = np.searchsorted(total, total[:-1] + min_words)  # window [i, first_end)
    last_start = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    ahead = np.where(first_end <= n, first_end - np.arange(n), 0)
    behind = np.where(last_start >= 0, np.arange(n) + 1 - last_start, 0)
    return ahead.tolist(), behind.tolist()


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """id, h, pos, line, ahead and behind of every non-blank line."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            of, pos, texts, ahead, behind = [], [], [], [], []
            for row, text in enumerate(piece.column("text").to_pylist()):
                lines = [x for x in (text or "").encode().split(b"\n") if x.strip()]
                if lines:
                    a, b = line_windows([len(x.split()) for x in lines], min_words)
                    of += [row] * len(lines)
                    pos += range(len(lines))
                    texts += lines
                    ahead += a
                    behind += b
            at = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([
                piece.column("id").take(at), piece.column("h").take(at), pa.array(pos, pa.int32()),
                pa.array(hash64(pa.array(texts, pa.binary())).view(np.int64)), pa.array(ahead, pa.int32()), pa.array(behind, pa.int32()),
            ], ["id", "h", "pos", "line", "ahead", "behind"])

    return docs.mapInArrow(run, f"id {kind}, h bigint, pos int, line bigint, ahead int, behind int")


def _ranked(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Number the groups that occur twice or more in the order of their keys."""
    repeated = groups.groupBy(*keys).count().where("count > 1").select(*keys).orderBy(*keys)
    numbered = repeated.rdd.zipWithIndex().map(lambda pair: (*pair[0], pair[1]))
    return groups.sparkSession.createDataFrame(numbered, ", ".join(f"{k} bigint" for k in keys) + ", rank bigint")


def _levels(lines: DataFrame, longest: int) -> list[DataFrame]:
    """id, h, pos and rank of the repeated runs of 1, 2, 4, ... lines, up to `longest` lines."""
    rank = _ranked(lines.select("line"), ["line"])
    levels = [stored(lines.join(rank, "line").select("id", "h", "pos", "rank"), "line-level")]
    while 2 ** len(levels) <= longest:
        step = 2 ** (len(levels) - 1)
        here, there = levels[-1], levels[-1].select(F.col("id").alias("id2"), F.col("h").alias("h2"), (F.col("pos") - step).alias("pos2"), F.col("rank").alias("second"))
        on = here["id"].eqNullSafe(there["id2"]) & (here["h"] == there["h2"]) & (here["pos"] == there["pos2"])
        pairs = stored(here.join(there, on).select("id", "h", "pos", F.col("rank").alias("first"), "second"), "line-pairs")
        rank = _ranked(pairs.select("first", "second"), ["first", "second"])
        levels.append(stored(pairs.join(rank, ["first", "second"]).select("id", "h", "pos", "rank"), "line-level"))
    return levels


def _repeats(lines: DataFrame, min_words: int) -> DataFrame:
    """id, h, pos and m of every window that also starts earlier."""
    starting = lines.where("ahead > 0").select("id", "h", "pos", F.col("ahead").alias("m"))
    ending = lines.where("behind > 0").select("id", "h", (F.col("pos") - F.col("behind") + 1).alias("pos"), F.col("behind").alias("m"))
    windows = starting.unionByName(ending).distinct()
    out = []
    # A window has min_words lines at most, since every line has a word.
    for k, level in enumerate(_levels(lines, min_words)):
        mine = windows.where((F.col("m") >= 2**k) & (F.col("m") < 2 ** (k + 1)))
        left = level.select(F.col("id").alias("id1"), F.col("h").alias("h1"), F.col("pos").alias("pos1"), F.col("rank").alias("first"))
        right = level.select(F.col("id").alias("id2"), F.col("h").alias("h2"), F.col("pos").alias("pos2"), F.col("rank").alias("second"))
        named = mine.join(left, F.col("id").eqNullSafe(F.col("id1")) & (F.col("h") == F.col("h1")) & (F.col("pos") == F.col("pos1"))).join(
            right, F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")) & (F.col("pos") + F.col("m") - 2**k == F.col("pos2"))
        ).select("id", "h", "pos", "m", "first", "second")
        here = F.struct("id", "h", "pos")
        name = ["m", "first", "second"]
        earliest = named.groupBy(*name).agg(F.min(here).alias("origin"), F.count("*").alias("n")).where("n > 1").drop("n")
        out.append(named.join(earliest, name).where(here > F.col("origin")).select("id", "h", "pos", "m"))
    return reduce(DataFrame.unionByName, out)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the later copies deleted from text_col, and n_lines, n_removed and n_runs of each row.

    Earlier means a smaller id (null first), then further up. Rows with equal id and text count as one document
    and get the same result; equal texts under different ids lose all but the first. Lines are compared byte by
    byte; blank lines are never deleted and do not part runs. Null stays null and has no lines.
    """
    clash = {"n_lines", "n_removed", "n_runs", "ld_h", "ld_spans"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    keyed = docs.withColumn("ld_h", F.xxhash64(text_col))
    texts = keyed.select(F.col(id_col).alias("id"), F.col("ld_h").alias("h"), F.col(text_col).alias("text"))
    lines = stored(_lines(texts, min_words).dropDuplicates(["id", "h", "pos"]), "lines")
    found = _repeats(lines, min_words)
    spans = found.groupBy("id", "h").agg(F.array_sort(F.collect_set(F.struct("pos", "m"))).alias("ld_spans"))
    on = keyed[id_col].eqNullSafe(spans["id"]) & (keyed["ld_h"] == spans["h"])
    rows = keyed.join(spans, on, "left").drop("id", "h", "ld_h")
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n_lines bigint, n_removed bigint, n_runs bigint"
    at_text = names.index(text_col)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_col):
            texts, counts = [], []
            for text, spans in zip(piece.column(text_col).to_pylist(), piece.column("ld_spans").to_pylist()):
                parts = (text or "").split("\n")
                # The same lines as before: not blank as bytes.
                solid = [k for k, x in enumerate(parts) if x.strip(" \t\n\r\x0b\x0c")]
                gone = np.zeros(len(solid), bool)
                for span in spans or ():
                    gone[span["pos"]:span["pos"] + span["m"]] = True
                drop = {solid[k] for k in np.flatnonzero(gone).tolist()}
                texts.append(text if not drop else "\n".join(x for k, x in enumerate(parts) if k not in drop))
                counts.append((len(solid), len(drop), int(np.count_nonzero(np.diff(np.r_[False, gone].astype(np.int8)) == 1))))
            columns = [piece.column(c) for c in names]
            columns[at_text] = pa.array(texts, pa.string())
            totals = [pa.array(c, pa.int64()) for c in zip(*counts)]
            yield pa.RecordBatch.from_arrays([*columns, *totals], [*names, "n_lines", "n_removed", "n_runs"])

    return rows.select(*names, "ld_spans").mapInArrow(cut, schema)
