"""Prefix trie of conversations from vertical bitmaps.

Conversations are dealt to shards of neighbouring ids. A shard indexes (position, turn) to a bitset of its
conversations and walks depth first: a node is the bitset of the conversations that share its turns, its children are
the intersections with the postings of the next position, taken at the lowest conversation not yet covered. A popcount
counts members; members that end there form the shard's end list. A single conversation left means a plain tail.

Nodes are named by 128-bit digests chained over their turns, so equal nodes of several shards add up by key, and end
lists are hashed in the order of their shards. Sums over subtrees need the nodes with two members and more alone, since
the rest are tails of one leaf. They double their reach in every round (1, 2, 4, ... levels), so a trie of depth d takes
log2(d) rounds, whatever its shape.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from msgrisk.llm.tables import stored

# Ids of one shard, and the turns after which a shard is cut between two conversations.
SHARD_IDS = 1000
SHARD_TURNS = 100_000
ROOT = bytes(16)
_NODES = "node binary, parent binary, depth int, conv_id bigint, n_convs bigint, words bigint, ends string"
_NAMES = ["node", "parent", "depth", "conv_id", "n_convs", "words", "ends"]
_TYPES = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def turns_of(conversations: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, turn, words): position from 1, digest of role and text, and words of the text, of every turn.

    Turns go by order_col, null first, ties by digest, so that repeated rows are turns of their own. A null role or
    text counts as empty. Rows without an id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(order_col).alias("at"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("turn"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("at"), "turn"))
    return turns.select("conv_id", pos.alias("pos"), "turn", "words")


def walk(convs: list[int], turns: list[list[tuple[bytes, int]]]) -> Iterator[tuple]:
    """Nodes of the trie over distinct conversations in ascending order of id, parents first."""
    postings: defaultdict[tuple[int, bytes], int] = defaultdict(int)
    ended: defaultdict[int, int] = defaultdict(int)
    for i, mine in enumerate(turns):
        for p, (turn, _) in enumerate(mine):
            postings[p, turn] |= 1 << i
        ended[len(mine)] |= 1 << i
    stack = [((1 << len(convs)) - 1, 0, ROOT, None)] if convs else []
    while stack:
        members, depth, node, parent = stack.pop()
        first = (members & -members).bit_length() - 1
        ends, left = [], members & ended[depth]
        rest = members & ~left
        while left:
            low = left & -left
            ends.append(str(convs[low.bit_length() - 1]))
            left ^= low
        yield node, parent, depth, convs[first], members.bit_count(), turns[first][depth - 1][1] if depth else 0, ",".join(ends) or None
        while rest:
            low = (rest & -rest).bit_length() - 1
            turn = turns[low][depth][0]
            child = rest & postings[depth, turn]
            rest &= ~child
            stack.append((child, depth + 1, hashlib.blake2b(node + turn, digest_size=16).digest(), node))


def _shards(rows: DataFrame, shard_turns: int) -> DataFrame:
    """Nodes of every shard, from rows in the order of shard, conversation and position."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, turns, held, shard = [], [], 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            batch = []
            for row in walk(convs, turns):
                batch.append(row)
                if len(batch) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), _TYPES)], _NAMES)
                    batch = []
            if batch:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), _TYPES)], _NAMES)

        for got in batches:
            for at, conv, turn, words in zip(*(got.column(c).to_pylist() for c in ("shard", "conv_id", "turn", "words"))):
                if not convs or conv != convs[-1]:
                    if convs and (at != shard or held >= shard_turns):
                        yield from flush()
                        convs, turns, held = [], [], 0
                    shard = at
                    convs.append(conv)
                    turns.append([])
                if turn is not None:
                    turns[-1].append((turn, words))
                    held += 1
        yield from flush()

    return rows.mapInArrow(run, _NODES)


def _end_digests(parts: DataFrame) -> DataFrame:
    """(node, ends_sha256) from end lists in the order of node and conversation, hashed as they stream by."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for got in batches:
            names, digests = [], []
            for at, ends in zip(got.column("node").to_pylist(), got.column("ends").to_pylist()):
                if at == node:
                    sha.update(f",{ends}".encode())
                    continue
                if sha:
                    names.append(node)
                    digests.append(sha.hexdigest())
                node, sha = at, hashlib.sha256(ends.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], ["node", "ends_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])

    return parts.mapInArrow(run, "node binary, ends_sha256 string")


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """node, leaves and saved summed over the subtrees of (node, anc, depth, leaves, saved); anc is the parent."""
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    out = shared.drop("depth")
    for _ in range(int(deepest).bit_length()):
        # Below a node at distance 2^k: what those nodes have summed up within distance 2^k.
        below = out.where("anc is not null").groupBy(F.col("anc").alias("node")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = out.where("anc is not null").select(F.col("node").alias("anc"), F.col("anc").alias("next"))
        out = stored(
            out.join(below, "node", "left").join(above, "anc", "left").select(
                "node", F.col("next").alias("anc"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ), "trie-sums"
        )
    return out.drop("anc")


def build(turns: DataFrame, conversations: DataFrame, shard_ids: int = SHARD_IDS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per trie node: node and parent (16-byte names), depth, conv_id (least member), parent_conv_id, n_convs,
    n_children, n_leaves and saved_tokens (over its subtree), words (of its last text), ends_sha256.

    turns: (conv_id, pos, turn, words), pos ascending but not gapless, see turns_of(); conversations: distinct conv_id,
    also of those without turns, which end at the root. Members count conversations, so equal ones share all nodes.
    ends_sha256 is the hex digest of the ids that end at the node, ascending and comma-joined. No conversations: no nodes.
    """
    marks = conversations.select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("bigint").alias("words"))
    rows = turns.select("conv_id", "pos", "turn", "words").unionByName(marks)
    rows = rows.withColumn("shard", F.floor(F.col("conv_id") / shard_ids))
    sorted_rows = rows.repartition("shard").sortWithinPartitions("shard", "conv_id", "pos")
    found = stored(_shards(sorted_rows, shard_turns), "trie-shards")
    nodes = stored(
        found.groupBy("node", "parent", "depth", "words").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs")), "trie-nodes"
    )
    ends = _end_digests(found.where("ends is not null").select("node", "conv_id", "ends").repartition("node").sortWithinPartitions("node", "conv_id"))
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("tails")
    )
    shared = nodes.where("n_convs > 1").join(kids, "node", "left").select(
        "node", F.col("parent").alias("anc"), "depth",
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("tails")).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    sums = _subtree_sums(stored(shared, "trie-shared"))
    # Only a shared parent can have a least member other than its child's.
    owners = nodes.where("n_convs > 1").select(F.col("node").alias("parent"), F.col("conv_id").alias("owner"))
    return (
        nodes.join(ends, "node", "left").join(kids, "node", "left").join(sums, "node", "left").join(owners, "parent", "left")
        .select(
            "node", "parent", F.col("depth").cast("bigint").alias("depth"), "conv_id",
            F.when(F.col("parent").isNotNull(), F.coalesce("owner", "conv_id")).alias("parent_conv_id"),
            "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce("leaves", F.lit(1)).cast("bigint").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved_tokens"),
            "words", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def branch(turns: DataFrame, block: int = 20, keep: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations that share openings: conversation c gets the first h turns of c - c % block and its
    own after its first h, with h = crc32(c) % keep. A missing head gives none, a shorter one all it has."""
    convs = turns.select("conv_id").distinct().select(
        "conv_id", (F.crc32(F.col("conv_id").cast("string")) % keep).alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("head")
    )
    heads = turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < keep)).withColumnRenamed("conv_id", "head")
    opening = convs.join(heads, "head").where("pos <= h").select("conv_id", "pos", "turn", "words")
    own = turns.where(F.col("pos") > F.crc32(F.col("conv_id").cast("string")) % keep)
    return opening.unionByName(own), convs.select("conv_id")
