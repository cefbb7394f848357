"""Merkle manifest of a table: a hash tree over the rows of each group, and one over the groups.

Rows are numbered per group in the order of their keys by a range shuffle: rows of one task get consecutive numbers,
and only the counts per task and group are summed up. Every level then equijoins its nodes with their computed sibling
indices (index XOR 1 in a binary tree, the other slots of the run otherwise). Nodes of slot zero, which by then hold
all digests of their run, emit the parents. A last run may be short; its parent hashes the nodes there are, even one.
Levels are written to the shared folder. From the top down each level joins its parents' paths, so a row ends with the
siblings of every level up to the root, its proof. Keys of all joins are (group, index), so a group that holds most of
the rows is spread over all tasks.

Digests are SHA-256: 32 bytes in tables, lower-case hex as the input of further digests.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from msgrisk.llm.tables import stored

PATH = "array<struct<before: binary, after: binary>>"


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """A value as digest input: `-` if null, else its UTF-8 byte count, `:` and its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: 32 bytes over its fields in order."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def fold(digest: Column, path: Column) -> Column:
    """Hex of the root that a leaf digest and its path lead to."""
    return F.aggregate(path, hex_of(digest), lambda acc, e: F.sha2(F.concat(hex_of(e["before"]), acc, hex_of(e["after"])), 256))


def proof_digest(path: Column) -> Column:
    """Hex of the digest of all siblings of a path, leaf level first, each run from left to right."""
    siblings = F.aggregate(path, F.lit(b""), lambda acc, e: F.concat(acc, e["before"], e["after"]))
    return F.sha2(hex_of(siblings), 256)


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows with idx, the position in the group g, and n, the rows of the group; stored."""
    # Equal keys may go to several tasks: rows of one key may be many.
    keys = ["g", *order, "tie"]
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(
        ranged.select(*rows.columns, F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")), "merkle-placed"
    )
    counts = placed.groupBy("g", "task").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    before = Window.partitionBy("g").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select(
        "g", "task", (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(Window.partitionBy("g")).alias("n"),
    ), "merkle-starts")
    return placed.join(starts, ["g", "task"]).withColumn("idx", F.col("at") + F.col("shift")).drop("task", "at", "shift")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """nodes with before and after: the digests of the run to their left and right, joined end to end."""
    slot = F.col("idx") % arity
    index = [F.col("idx").bitwiseXOR(F.lit(1))] if arity == 2 else [F.col("idx") - slot + (slot + k) % arity for k in range(1, arity)]
    out = nodes
    for k, sibling in enumerate(index):
        other = nodes.select(F.col("g").alias("og"), F.col("idx").alias(f"oi{k}"), F.col("digest").alias(f"od{k}"))
        out = out.join(other, (F.col("g") == F.col("og")) & (sibling == F.col(f"oi{k}")), "left").drop("og")
    run = F.array_sort(F.filter(
        F.array(*[F.struct(F.col(f"oi{k}").alias("i"), F.col(f"od{k}").alias("d")) for k in range(len(index))]), lambda e: e["i"].isNotNull()
    ))
    joined = lambda keep: F.aggregate(F.filter("run", keep), F.lit(b""), lambda acc, e: F.concat(acc, e["d"]))
    return (
        out.withColumn("run", run)
        .withColumn("before", joined(lambda e: e["i"] < F.col("idx")))
        .withColumn("after", joined(lambda e: e["i"] > F.col("idx")))
        .select(*nodes.columns, "before", "after")
    )


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """The slot-zero nodes' parents."""
    run = F.sha2(F.concat(hex_of(F.col("digest")), hex_of(F.col("after"))), 256)
    return level.where((F.col("idx") % arity == 0) & (F.col("n") > 1)).select(
        "g", F.floor(F.col("idx") / arity).alias("idx"), F.ceil(F.col("n") / arity).alias("n"), F.unhex(run).alias("digest")
    )


def _tree(rows: DataFrame, arity: int) -> tuple[DataFrame, DataFrame]:
    """Rows with g, idx, n and digest as leaves: the rows with their path, and (g, digest) of each group's top."""
    levels = [stored(_with_siblings(rows, arity), "merkle-level")]
    size = levels[0].agg(F.max("n")).first()[0] or 0
    tops = [levels[0].where("n = 1").select("g", "digest")]
    while size > 1:
        above = _parents(levels[-1], arity)
        tops.append(above.where("n = 1").select("g", "digest"))
        size = -(-size // arity)
        if size > 1:
            levels.append(stored(_with_siblings(above, arity), "merkle-level"))
    paths = None
    for level in reversed(levels):
        step = F.array(F.struct("before", "after"))
        if paths is None:
            out = level.withColumn("path", F.when(F.col("n") > 1, step).otherwise(F.array()).cast(PATH))
        else:
            above = paths.select(F.col("g").alias("pg"), F.col("idx").alias("pi"), F.col("path").alias("rest"))
            out = level.join(above, (F.col("g") == F.col("pg")) & (F.floor(F.col("idx") / arity) == F.col("pi")), "left")
            rest = F.coalesce("rest", F.array().cast(PATH))
            out = out.withColumn("path", F.when(F.col("n") > 1, F.concat(step.cast(PATH), rest)).otherwise(rest)).drop("pg", "pi", "rest")
        out = out.drop("before", "after")
        paths = out if level is levels[0] else stored(out, "merkle-paths")
    return paths, reduce(DataFrame.unionByName, tops)


def manifest(rows: DataFrame, leaf_col: str, group_col: str, order_col: str, arity: int = 2) -> DataFrame:
    """rows with subroot and path (siblings from the leaf to the root, see fold), and root, which is the same in all rows.

    leaf_col holds 32-byte digests, see leaf(). Leaves of a group ascend by order_col (null first), ties by digest, so
    repeated rows keep their places in turn. Groups ascend by group_col as text, null first, which is a group of its own.
    A lone leaf is its group's subroot, a lone subroot the root. An empty table gives no rows.
    """
    if arity < 2:
        raise ValueError("a node needs two children at least")
    clash = {"g", "idx", "n", "digest", "path", "subroot", "root", "tie", "task", "at", "first"} & set(rows.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    # "-" sorts before "=".
    named = rows.withColumns({"g": F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")), "digest": F.col(leaf_col)})
    leaves, subroots = _tree(_numbered(named, [order_col, "digest"]), arity)
    groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    upper, top = _tree(_numbered(groups, ["name"]), arity)
    upper = stored(upper.select(F.col("name").alias("g"), F.col("digest").alias("subroot"), F.col("path").alias("rest")), "merkle-upper")
    root = top.select("digest").first()
    return (
        leaves.join(upper, "g")
        .withColumn("path", F.concat("path", "rest"))
        .withColumn("root", F.lit(bytes(root.digest) if root else None).cast("binary"))
        .select(*rows.columns, "subroot", "root", "path")
    )
