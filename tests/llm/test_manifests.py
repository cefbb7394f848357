"""Merkle manifest, prefix trie and token counts against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F, types as T

from msgrisk.llm import merkle, prefix_trie, token_cache
from msgrisk.llm.oracle import MERKLE_MANIFEST, PREFIX_TRIE
from msgrisk.llm.queries import op11_merkle_manifest, op12_prefix_trie, op13_token_counts
from msgrisk.session import scratch_path
from workload.check import compare


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fields(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


class Tree:
    """Levels of a hash tree over a list of leaves."""

    def __init__(self, leaves, arity):
        self.arity, self.levels = arity, [leaves]
        while len(self.levels[-1]) > 1:
            row = self.levels[-1]
            self.levels.append([sha("".join(row[i:i + arity])) for i in range(0, len(row), arity)])
        self.top = self.levels[-1][0]

    def path(self, at):
        for row in self.levels[:-1]:
            start = at - at % self.arity
            yield "".join(row[start:at]), "".join(row[at + 1:start + self.arity])
            at //= self.arity


def brute_manifest(rows, arity):
    """rows: (key, group, leaf). (leaf, subroot, root, path) of each in the order of group and key."""
    order = lambda v: (v is not None, str(v).encode() if isinstance(v, str) else v)
    groups = collections.defaultdict(list)
    for key, group, leaf in rows:
        groups[group].append((order(key), leaf))
    names = sorted(groups, key=order)
    trees = {g: Tree([leaf for _, leaf in sorted(groups[g])], arity) for g in names}
    upper = Tree([trees[g].top for g in names], arity)
    return sorted(
        (leaf, trees[g].top, upper.top, [*trees[g].path(i), *upper.path(k)])
        for k, g in enumerate(names) for i, leaf in enumerate(trees[g].levels[0])
    )


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest(spark, arity):
    rng = random.Random(arity)
    rows = [(rng.choice([None, *range(90)]), g) for g, n in [(None, 1), ("", 7), ("a", 130), ("é", 33), ("z", 2), ("Z", 1)] for _ in range(n)]
    table = spark.createDataFrame([(k, g, "x") for k, g in rows], "doc_id long, lang string, text string")
    got = merkle.manifest(table.withColumn("leaf", merkle.leaf([F.col("doc_id"), F.col("lang")])), "leaf", "lang", "doc_id", arity)
    got = got.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).withColumn("proof", merkle.proof_digest(F.col("path"))).collect()
    wanted = brute_manifest([(k, g, sha(fields(k, g))) for k, g in rows], arity)
    assert sorted((r.leaf.hex(), r.subroot.hex(), r.root.hex(), [(e.before.hex(), e.after.hex()) for e in r.path]) for r in got) == wanted
    assert {r.folded for r in got} == {wanted[0][2]}
    assert sorted((r.leaf.hex(), r.proof) for r in got) == sorted((w[0], sha("".join(b + a for b, a in w[3]))) for w in wanted)


def test_manifest_of_odd_tables(spark, odd, empty):
    leaves = lambda docs: docs.withColumn("leaf", merkle.leaf([F.col(c) for c in docs.columns]))
    got = merkle.manifest(leaves(odd), "leaf", "lang", "doc_id").collect()
    rows = odd.collect()
    wanted = brute_manifest([(r.doc_id, r.lang, sha(fields(*r))) for r in rows], 2)
    assert sorted(r.leaf.hex() for r in got) == [w[0] for w in wanted]
    assert {r.root.hex() for r in got} == {wanted[0][2]}
    assert merkle.manifest(leaves(empty), "leaf", "lang", "doc_id").count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(leaves(odd).withColumn("path", F.lit(1)), "leaf", "lang", "doc_id")


def saved(spark, df, name, folder):
    df.write.parquet(f"{folder}/{name}.parquet")


def duck_of(folder, *names):
    import duckdb

    con = duckdb.connect()
    for name in names:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return con


def test_manifest_query_on_odd_rows(spark, odd, tmp_path):
    rows = odd.withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars"))).unionByName(
        spark.range(20, 80).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(None).cast("string").alias("lang"),
                                   F.lit(None).cast("string").alias("source"), F.lit(2**63 - 1).alias("n_chars")))
    saved(spark, rows.coalesce(2), "documents", tmp_path)
    got = op11_merkle_manifest(spark, str(tmp_path)).toPandas()
    assert compare(got, duck_of(tmp_path, "documents").execute(MERKLE_MANIFEST).df()) == ""
    assert set(got.verified) == {True, False}


def brute_trie(rows):
    """Nodes from (conv, turn, role, text) rows whose turns differ, rebuilt with shared openings."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + mine[h:])
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    words = lambda node: len(re.findall(rb"[^\x20\x09-\x0D]+", node[-1][1].encode())) if node else 0
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        kids = [m for m in below if len(m) == len(node) + 1]
        inner = {m[:-1] for m in members if m}
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids),
                    sum(m not in inner for m in below), sum((len(members[m]) - 1) * words(m) for m in below), sha(ends)))
    return sorted(out, key=str)


TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])


def conversations():
    rng = random.Random(7)
    rows = []
    for c in [*range(-45, 70), 10**15, 10**15 + 3]:
        n = rng.choice([1, 2, 3, 5, 9])
        rows += [(c, t if t else None, rng.choice(["user", None]), rng.choice(["a b", "", None, "ä ö c", "x"])) for t in range(n)]
    # Copies of one conversation, each a prefix of the next, and a long one.
    rows += [(1000 + c, t, "u", f"same {t}") for c in range(30) for t in range(4 + c)]
    rows += [(5000, t, "u", f"turn {t % 7}") for t in range(300)] + [(None, 1, "u", "nobody's")]
    return rows


@pytest.mark.parametrize("shard_ids,shard_turns", [(1000, 100_000), (7, 100_000), (1000, 5)])
def test_trie(spark, shard_ids, shard_turns):
    turns = prefix_trie.turns_of(spark.createDataFrame(conversations(), TURNS).withColumn("node", F.lit(1)))
    got = prefix_trie.build(*prefix_trie.branch(turns), shard_ids, shard_turns).collect()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == brute_trie(conversations())
    assert len({r.node for r in got}) == len(got)


def test_walk_takes_deep_and_equal_conversations():
    turns = [[(bytes([t % 251]), 1) for t in range(5000)]] * 3 + [[]]
    nodes = list(prefix_trie.walk([4, 5, 6, 9], turns))
    assert len(nodes) == 5001
    assert nodes[0][4:] == (4, 0, "9") and nodes[-1][4:] == (3, 1, "4,5,6")


def test_trie_query_on_odd_rows(spark, tmp_path):
    rows = conversations() + [(3, 1, "user", "again"), (3, 1, "user", "again"), (3, 1, None, "other"), (8000, None, None, None)]
    saved(spark, spark.createDataFrame(rows, TURNS).coalesce(2), "conversations", tmp_path)
    got = op12_prefix_trie(spark, str(tmp_path)).toPandas()
    assert compare(got, duck_of(tmp_path, "conversations").execute(PREFIX_TRIE).df()) == ""


def test_trie_of_nothing(spark):
    assert prefix_trie.build(*prefix_trie.branch(prefix_trie.turns_of(spark.createDataFrame([], TURNS)))).count() == 0
    only = spark.createDataFrame([(None, 1, "u", "x")], TURNS)
    assert prefix_trie.build(*prefix_trie.branch(prefix_trie.turns_of(only))).count() == 0
    # Its only turn gives way to an absent head's.
    lone = next(c for c in itertools.count(1) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    (root,) = prefix_trie.build(*prefix_trie.branch(prefix_trie.turns_of(spark.createDataFrame([(lone, 1, "u", "x")], TURNS)))).collect()
    assert (root.conv_id, root.depth, root.parent_conv_id, root.n_leaves, root.ends_sha256) == (lone, 0, None, 1, sha(str(lone)))


MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = [None, "", " ", "a", "<s> x </s>", " two  blanks ", "▁ ▁", "ﬁ ½ Ａ\x00\n\n", "漢字 😀", "a", "word " * 50_000, "w" * 3000]


def test_parts_count_alone():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(["a", "the", " ", "  ", "▁", "\n", "é", "<s>", "漢", "ing"]) for _ in range(300))
        for limit in (1, 7, 50):
            assert sum(len(model.encode(p)) for p in token_cache.parts(text, limit)) == len(model.encode(text))


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_and_cache(spark, make_docs, name, monkeypatch):
    path = str(public_tokenizers.path(name))
    if path.endswith("model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False))
    folder = scratch_path(spark, "cache")
    wanted = lambda rows: sorted(((k, len((t or "").encode()), count(t or "")) for k, t in rows), key=str)
    first = [(i if i else None, t) for i, t in enumerate(TEXTS)]
    got = token_cache.count_tokens(make_docs(first).withColumn("n_tokens", F.lit("x")), path, folder)
    assert sorted((tuple(r) for r in got.collect()), key=str) == wanted(first)
    stored = f"{folder}/{token_cache.tokenizer_version(path)}"
    assert spark.read.parquet(stored).count() == len({t or "" for t in TEXTS})
    # Known texts are not encoded again; both ways of fetching new ones.
    for new, limit in ((["new", "new", "a"], 100), (["newer", "newest", "newer", "a"], 0), (["a", None], 100)):
        monkeypatch.setattr(token_cache, "BROADCAST_DIGESTS", limit)
        before = spark.read.parquet(stored).count()
        rows = [(i, t) for i, t in enumerate(new)]
        got = token_cache.count_tokens(make_docs(rows), path, folder).collect()
        assert sorted((tuple(r) for r in got), key=str) == wanted(rows)
        assert spark.read.parquet(stored).count() - before == len({t or "" for t in new} - {"", "a"})
    # Repeated cache rows, as a job run twice would leave.
    spark.read.parquet(stored).coalesce(1).write.mode("append").parquet(f"{folder}-twice/{token_cache.tokenizer_version(path)}")
    spark.read.parquet(stored).coalesce(1).write.mode("append").parquet(f"{folder}-twice/{token_cache.tokenizer_version(path)}")
    assert token_cache.count_tokens(make_docs(first), path, f"{folder}-twice").count() == len(first)


def test_counts_of_nothing(spark, empty, odd):
    folder = scratch_path(spark, "cache")
    assert token_cache.count_tokens(empty, MODEL, folder).count() == 0
    with pytest.raises(ValueError):
        token_cache.count_tokens(odd.withColumn("digest", F.lit(1)), MODEL, folder, carry=("digest",))
    with pytest.raises(ValueError):
        token_cache.tokenizer_version("words.txt")


def test_limit(spark, make_docs, tmp_path):
    saved(spark, make_docs([(1, "a" * 10), (2, "x y " * 5000)]), "documents", tmp_path)
    assert sorted((r.doc_id, r.over_limit) for r in op13_token_counts(spark, str(tmp_path)).collect()) == [(1, False), (2, True)]
