"""N-gram join, suffix dedup, line dedup and search against brute force."""

import collections
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from msgrisk.llm import line_dedup, ngram_join, suffix_dedup, topk_search


def sentences(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def near(rng, text, share):
    return " ".join(f"x{rng.randrange(999)}" if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [sentences(rng, rng.randrange(8, 150), 100_000) for _ in range(6)]
    rows = [(k, near(rng, rng.choice(base), rng.choice([0, 0.005, 0.02, 0.04]))) for k in range(160)]
    rows += [(200 + k, base[0]) for k in range(5)] + [(300, "A b"), (301, "a B"), (302, "a"), (303, ""), (304, None), (304, None)]
    return rows


def brute_components(rows, n, percent):
    sets = []
    for key, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((key, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = collections.defaultdict(list)
    for k in range(len(sets)):
        least[find(k)].append(sets[k][0])
    return sorted((sets[k][0], len(sets[k][1]), min(least[find(k)]) if sets[k][1] else sets[k][0]) for k in range(len(sets)))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_ngram_join(make_docs, corpus, n, percent):
    got = ngram_join.join(make_docs(corpus), n=n, percent=percent).collect()
    assert sorted(tuple(r) for r in got) == brute_components(corpus, n, percent)


def test_ngram_join_of_short_sets(make_docs):
    """At 50 % sets of one and two words link by a single shared word."""
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 6)))) for k in range(60)]
    assert sorted(tuple(r) for r in ngram_join.join(make_docs(rows), n=1, percent=50).collect()) == brute_components(rows, 1, 50)


def test_ngram_join_of_a_group_at_the_limit(make_docs):
    """Copies of one text of which about half of all pairs link: rounds merge them, and what remains is verified."""
    rng = random.Random(9)
    base = sentences(rng, 120, 100_000)
    rows = [(k, near(rng, base, 0.02)) for k in range(150)]
    assert sorted(tuple(r) for r in ngram_join.join(make_docs(rows)).collect()) == brute_components(rows, 4, 85)


def test_ngram_join_shuffles_few_whole_sets(make_docs, corpus, monkeypatch):
    """Whole sets of one row are not shuffled to be stored, and pairs that the fine parts rule out are not verified."""
    plans, kept = collections.defaultdict(list), collections.defaultdict(list)

    def keep(df, name, inner=ngram_join.stored):
        plans[name].append(df._jdf.queryExecution().executedPlan().toString())
        kept[name].append(inner(df, name))
        return kept[name][-1]

    monkeypatch.setattr(ngram_join, "stored", keep)
    rng = random.Random(12)
    base = sentences(rng, 300, 100_000)
    rows = corpus + [(400 + k, near(rng, base, 0.07)) for k in range(20)]
    assert sorted(tuple(r) for r in ngram_join.join(make_docs(rows)).collect()) == brute_components(rows, 4, 85)
    assert "Exchange" not in plans["ngram-whole"][0]
    whole = kept["ngram-whole"][0].where("kind = 1").select("sig").unionByName(kept["ngram-whole"][1].select("sig"))
    assert whole.count() == whole.distinct().count() == kept["ngram-bits"][0].count()
    pairs, checked = (t[0] if len(t) == 1 else t[0].unionByName(t[1]) for t in (kept["ngram-pairs"][:2], kept["ngram-checked"][:2]))
    assert checked.count() == pairs.count() and pairs.where("not likely").count() > 0
    assert pairs.where("not likely").join(checked.where("linked"), ["a", "b"]).count() == 0


def test_ngram_join_odd(odd, empty):
    got = ngram_join.join(odd).collect()
    assert len(got) == odd.count()
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert by[5, 1] == by[6, 1] == 5 and by[1, 0] == 1 and by[2, 0] == 2
    assert ngram_join.join(empty).count() == 0


def brute_repeats(rows, length=50):
    texts = sorted(((k, (t or "").encode()) for k, t in rows), key=lambda r: r[0])
    first = {}
    for k, b in texts:
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], k)
    out = []
    for k, b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < k:
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.r_[0, gone.astype(np.int8)]) == 1))
        out.append((k, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup(make_docs):
    rng = random.Random(9)
    passages = [sentences(rng, rng.randrange(5, 40)) for _ in range(12)]
    rows = []
    for k in range(80):
        text = " ".join(rng.choice(passages) if rng.random() < 0.5 else sentences(rng, 12, 50) for _ in range(5))
        rows.append((k, near(rng, text, 0.02)))
    rows += [(90, rows[0][1]), (91, rows[0][1]), (91, rows[0][1]), (92, "é" * 60), (93, "é" * 60), (94, "ab" * 80), (95, "b" + "ab" * 70), (96, None), (97, "")]
    got = suffix_dedup.remove_repeats(make_docs(rows)).collect()
    assert sorted(tuple(r) for r in got) == brute_repeats(rows)


def test_suffix_dedup_of_a_text_that_repeats_itself(make_docs):
    rng = random.Random(11)
    line, other = ("".join(rng.choice("abcdefghij klmnop") for _ in range(60)) for _ in range(2))
    rows = [(3, f"start {line} end"), (5, f"{line}\n" * 5), (5, f"{line}\n" * 7 + "more"), (6, None), (8, f"{other}\n" * 5), (7, other), (9, f"{other}\n" * 5)]
    got = suffix_dedup.remove_repeats(make_docs(rows)).collect()
    assert sorted(tuple(r) for r in got) == brute_repeats(rows)


def test_suffix_dedup_odd(odd, empty):
    got = suffix_dedup.remove_repeats(odd, with_text=True).collect()
    assert len(got) == odd.count() and all(r.n_removed == 0 for r in got)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_deep_shallow_leaves():
    rng = np.random.default_rng(3)
    strings = rng.integers(97, 99, (3000, 50)).astype(np.uint8)
    strings[:, 5:] = strings[rng.integers(0, 30, 3000), 5:]
    doc = rng.integers(0, 500, 3000)
    leader = suffix_dedup.deep_shallow(strings, doc)
    least = collections.defaultdict(lambda: 10**9)
    for s, d in zip(strings, doc):
        least[s.tobytes()] = min(least[s.tobytes()], d)
    assert [doc[k] for k in leader] == [least[s.tobytes()] for s in strings]


def brute_lines(rows, min_words):
    seqs = sorted({(k, t) for k, t in rows if t is not None})
    seqs = [(k, [x for x in t.split("\n") if x.strip()]) for k, t in seqs]
    first, out = {}, {}
    for mark in (True, False):
        for d, (k, lines) in enumerate(seqs):
            gone = [False] * len(lines)
            for a in range(len(lines)):
                for b in range(a + 1, len(lines) + 1):
                    if sum(len(x.split()) for x in lines[a:b]) >= min_words:
                        run = tuple(lines[a:b])
                        if mark:
                            first.setdefault(run, (d, a))
                        elif first[run] < (d, a):
                            gone[a:b] = [True] * (b - a)
            out[k] = "\n".join(x for x, g in zip(lines, gone) if not g)
    return out


def test_line_dedup(make_docs):
    rng = random.Random(2)
    pool = [sentences(rng, rng.randrange(1, 6), 30) for _ in range(25)]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 14)))) for k in range(60)]
    got = {r.doc_id: r.text for r in line_dedup.dedup(make_docs(rows), min_words=6).collect()}
    assert got == brute_lines(rows, 6)


def test_line_dedup_odd(odd, empty, make_docs):
    got = line_dedup.dedup(odd)
    assert got.count() == odd.count() and got.columns[:5] == odd.columns
    assert line_dedup.dedup(empty).count() == 0
    line = "one two three four five six seven eight nine"
    rows = line_dedup.dedup(make_docs([(1, f"x\n\n{line}\n{line}"), (2, line), (2, line), (3, None)])).collect()
    assert sorted((r.doc_id, r.text, r.n_removed) for r in rows) == [(1, f"x\n\n{line}", 1), (2, "", 1), (2, "", 1), (3, None, 0)]


def brute_search(rows, queries, k):
    bags = [(d, collections.Counter((t or "").encode().lower().split())) for d, t in rows if d is not None]
    n, df = len(bags), collections.Counter(w for _, c in bags for w in c)
    mean = sum(sum(c.values()) for _, c in bags) / n
    out = {}
    for q, c in queries:
        scores = []
        for d, other in bags:
            length = sum(other.values())
            s = sum(
                m * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * other[w] * 2.2 / (other[w] + 1.2 * (0.25 + 0.75 * length / mean))
                for w, m in c.items() if w in other
            )
            if s > 0:
                scores.append((-round(s, 7), d))
        out[q] = [d for _, d in sorted(scores)[:k]]
    return {q: v for q, v in out.items() if v}


def test_search(make_docs, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_ROWS", 37)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 3)
    rng = random.Random(4)
    rows = [(k, " ".join(f"v{int(rng.paretovariate(0.6))}" for _ in range(rng.randrange(1, 60)))) for k in range(150)]
    rows += [(160, rows[10][1]), (161, rows[10][1]), (162, None), (163, ""), (None, "v1 v2")]
    docs = make_docs(rows)
    got = collections.defaultdict(list)
    for r in topk_search.search(docs, docs.where("doc_id % 20 = 0"), k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.doc_id)
    bags = [(d, collections.Counter((t or "").encode().lower().split())) for d, t in rows if d is not None and d % 20 == 0]
    assert dict(got) == brute_search(rows, bags, 5)


def test_search_of_a_word_repeated_very_often(make_docs):
    n, rows = 100_000, [(1, "a " * 100_000), (2, "a b"), (3, "b c"), (4, "c"), (5, "a")]
    mean = (n + 6) / 5
    norm = 1.2 * (0.25 + 0.75 * n / mean)
    got = topk_search.search(make_docs(rows), make_docs(rows[-1:])).where("doc_id = 1").first()
    assert abs(got.score - math.log(1 + 2.5 / 3.5) * n * 2.2 / (n + norm)) < 1e-8


def test_search_odd(odd, empty):
    assert topk_search.search(odd, odd).where("query_id = 5").count() == 3  # 5, 6 and the repeated 6
    assert topk_search.search(empty, empty).count() == 0


def test_search_prunes_by_the_best_of_earlier_shards():
    texts = pa.array([f"a b {'c ' * (i % 7)}d{i}" for i in range(200)])
    lengths, code, row, count = topk_search._postings(texts)
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    ends = np.r_[first[1:], len(code)].astype(np.int32)
    arrays = {"ids": np.arange(200), "lengths": lengths.astype(np.int32), "terms": code[first], "ends": ends,
              "rows": row.astype(np.uint16), "counts": count.astype(np.uint8)}
    shard = topk_search._Shard({name: a.tobytes() for name, a in arrays.items()}, float(lengths.mean()))
    at = np.array([np.flatnonzero(shard.ends - shard.starts > 180)[0], np.flatnonzero(shard.ends - shard.starts == 1)[0]])
    of, weight = np.array([0, 1]), np.array([1.0, 2.0])
    query, rows, score = shard.open_rows(of, at, weight, np.zeros(2), 3)
    best = topk_search._Best(2, 3)
    best.add(0, 2, query, shard.ids[rows], score)
    impact = shard.impact[shard.starts[at[0]]:shard.ends[at[0]]]
    assert best.score[0].tolist() == np.round(np.sort(impact)[::-1][:3], topk_search.DIGITS).tolist()
    assert best.score[1].tolist()[1:] == [0, 0]
    # Nothing of a shard is looked at again once no row of it can reach the third best.
    assert not len(shard.open_rows(of, at, weight, np.array([99.0, 99.0]), 3)[0])


def test_whole_sets_are_shuffled_only_where_a_pair_needs_them(spark, make_docs):
    docs = make_docs([(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "f g h i j"), (None, "k l m n o")])
    rows = ngram_join._prefixes(docs, "doc_id", "text", 4, 85)
    needed = rows.groupBy("sig").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    whole = ngram_join._whole_sets(docs, "doc_id", "text", 4, needed)
    assert sorted(len(r.members) for r in whole.collect()) == [12, 12, 12]
    a, b, c = sorted(r.sig for r in needed.collect())
    pairs = spark.createDataFrame([(a, b), (a, a)], "a bigint, b bigint")
    checked = ngram_join._verify(pairs, whole, 85)
    assert sorted(map(tuple, checked.collect())) == sorted([(a, a, True), (a, b, False)])
    assert "LeftSemi" in checked._jdf.queryExecution().optimizedPlan().toString()
