"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

Words fall into classes: the most frequent words into classes of equal size by rank, all other words into
classes by a hash of their last letters. With h the two words before a word w,

    P(w | h) = P(class of w | h) * P(w | class of w, h)

Both factors are softmaxes over weights of hashed features: a bias, the word before (n-gram feature) and the
word before that (skip feature), each hashed to one of BUCKETS rows. In the classes of infrequent words the
second factor has the bias feature alone, for which the best weights are the logarithms of the smoothed
counts; every such class holds one place for words never seen. Training starts from smoothed log ratios of
counts over all training texts and goes on with gradient updates, each scaled by the diagonal of the
curvature: tasks add up observed minus expected feature counts, Spark sums them, the driver moves the weights,
whose number is fixed. Each round takes another share of the training texts; together they take all.

Counts of all words stay a distributed table. The BROADCAST_WORDS most frequent words go to every task; the
other tokens are looked up by a shuffled join, so no table that grows with the corpus is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from msgrisk.llm import sums
from msgrisk.llm.tables import stored
from msgrisk.llm.tokens import Words, hash64, mix, pieces, tails, words

END = b"\n"  # no word holds it
HEAD_CLASSES, CLASS_SIZE, TAIL_CLASSES = 8, 32, 24
CLASSES, HEAD = HEAD_CLASSES + TAIL_CLASSES, HEAD_CLASSES * CLASS_SIZE
BUCKETS, OWN_BUCKETS = 1024, 512
BROADCAST_WORDS = 1 << 18
ROUNDS, RATE, PRIOR, LIMIT = 3, 0.5, 4.0, 8.0
SMOOTHING = 0.1
_RUN = 1 << 15
#: Columns of a row of weights: classes by the word before, by the skip word, then frequent words by both.
_PARTS = np.cumsum([0, CLASSES, CLASSES, HEAD, HEAD])
_LOG10 = float(np.log(10))


@dataclass
class Model:
    """Weights (bounded), head words with counts (bounded), class totals, and the table of all counts."""

    weights: np.ndarray  # BUCKETS x _PARTS[-1]
    class_bias: np.ndarray
    word_bias: np.ndarray
    head: pa.Array
    head_counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    distinct: int
    counts: DataFrame


def _tail_class(vocab: pa.Array) -> np.ndarray:
    return HEAD_CLASSES + (mix(tails(vocab, 3)) % np.uint64(TAIL_CLASSES)).astype(np.int64)


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """word (binary), tail class and count over all texts, one end token a text included. Tasks add up first."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0

        def flush():
            table = pa.Table.from_batches(held).group_by("word").aggregate([("count", "sum")])
            vocab = table["word"].combine_chunks()
            return pa.RecordBatch.from_arrays(
                [vocab, pa.array(_tail_class(vocab), pa.int32()), table["count_sum"].combine_chunks()],
                ["word", "class", "count"],
            )

        for piece in pieces(batches, text_col):
            found = words(piece.column(text_col))
            seen = np.bincount(found.ids, minlength=len(found.vocab))
            used = np.flatnonzero(seen)
            ends += piece.num_rows
            held.append(pa.RecordBatch.from_arrays(
                [found.vocab.take(pa.array(used)), pa.array(seen[used], pa.int64())], ["word", "count"]
            ))
            size += len(used)
            if size > 800_000:
                yield flush()
                held, size = [], 0
        if ends:
            held.append(pa.RecordBatch.from_arrays(
                [pa.array([END], pa.binary()), pa.array([ends], pa.int64())], ["word", "count"]
            ))
        if held:
            yield flush()

    parts = texts.select(text_col).mapInArrow(count, "word binary, class int, count bigint")
    return parts.groupBy("word", "class").agg(F.sum("count").alias("count"))


class _Coder:
    """Turns texts into arrays of class, head place and context bucket per token."""

    def __init__(self, head: pa.Array):
        self.head = head
        self.end = pc.index(head.slice(0, OWN_BUCKETS), pa.scalar(END, pa.binary())).as_py()

    def ranks(self, vocab: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(vocab, value_set=self.head), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def describe(self, vocab: pa.Array, rank: np.ndarray):
        """Class, place among frequent words (-1: none) and bucket of each entry."""
        tail = _tail_class(vocab)
        top = (rank >= 0) & (rank < HEAD)
        own = (rank >= 0) & (rank < OWN_BUCKETS)
        hashed = OWN_BUCKETS + (hash64(vocab) % np.uint64(BUCKETS - OWN_BUCKETS)).astype(np.int64)
        return np.where(top, rank // CLASS_SIZE, tail), np.where(top, rank, -1), np.where(own, rank, hashed)

    def sequence(self, texts: pa.Array):
        """Tokens of all texts with an end after each: word number (len(vocab) - 1: end), bounds, previous, skip."""
        found = words(texts)
        n = len(found.starts) - 1
        vocab = pa.concat_arrays([found.vocab, pa.array([END], pa.binary())])
        bounds = found.starts + np.arange(n + 1)
        ids = np.full(len(found.ids) + n, len(vocab) - 1, np.int64)
        inner = np.ones(len(ids), bool)
        inner[bounds[1:] - 1] = False
        ids[inner] = found.ids
        before = np.roll(ids, 1)
        before[bounds[:-1]] = len(vocab) - 1
        skip = np.roll(before, 1)
        skip[bounds[:-1]] = len(vocab) - 1
        return Words(ids, bounds, vocab), before, skip


def _run_log_probabilities(weights, class_bias, word_bias, cls, place, prev, skip, want_gradient=None):
    """log P of class and, for frequent words, of the word in its class. Adds to want_gradient if given."""
    a, b, c, d, _ = _PARTS
    logits = weights[prev, a:b]
    logits += weights[skip, b:c]
    logits += class_bias
    p = np.exp(logits)
    total = p.sum(1)
    out = logits[np.arange(len(cls)), cls] - np.log(total)
    top = np.flatnonzero(place >= 0)
    k, tp, ts = place[top] // CLASS_SIZE, prev[top], skip[top]
    by_prev = weights[:, c:d].reshape(BUCKETS, HEAD_CLASSES, CLASS_SIZE)
    by_skip = weights[:, d:].reshape(BUCKETS, HEAD_CLASSES, CLASS_SIZE)
    inner = by_prev[tp, k] + by_skip[ts, k] + word_bias.reshape(HEAD_CLASSES, CLASS_SIZE)[k]
    q = np.exp(inner)
    mass = q.sum(1)
    out[top] += inner[np.arange(len(top)), place[top] % CLASS_SIZE] - np.log(mass)
    if want_gradient is not None:
        p /= total[:, None]
        q /= mass[:, None]
        for rows, low, key in ((p, a, prev), (p, b, skip)):
            _add_rows(want_gradient[1][:, low:low + CLASSES], key, rows)
        for low, key in ((c, tp), (d, ts)):
            flat = np.zeros((BUCKETS * HEAD_CLASSES, CLASS_SIZE))
            _add_rows(flat, key * HEAD_CLASSES + k, q)
            want_gradient[1][:, low:low + HEAD] += flat.reshape(BUCKETS, HEAD)
    return out


def _add_rows(target: np.ndarray, key: np.ndarray, rows: np.ndarray) -> None:
    """target[key] += rows, with repeated keys."""
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    target[key[first]] += np.add.reduceat(rows[order], first, axis=0)


def _observe(into: np.ndarray, cls, place, prev, skip) -> None:
    """Observed feature counts."""
    a, b, c, d, _ = _PARTS
    for low, key in ((a, prev), (b, skip)):
        into[:, low:low + CLASSES] += np.bincount(key * CLASSES + cls, minlength=BUCKETS * CLASSES).reshape(BUCKETS, CLASSES)
    top = place >= 0
    for low, key in ((c, prev), (d, skip)):
        into[:, low:low + HEAD] += np.bincount(key[top] * HEAD + place[top], minlength=BUCKETS * HEAD).reshape(BUCKETS, HEAD)


def _sums(texts: DataFrame, text_col: str, shared, gradient: bool) -> tuple[np.ndarray, np.ndarray]:
    """Observed and expected feature counts over the texts. Their size is fixed; tasks and salts add up first."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, weights, class_bias, word_bias = shared.value
        coder = _Coder(pa.array(head, pa.binary()))
        both = np.zeros((2, BUCKETS, _PARTS[-1]))
        for piece in pieces(batches, text_col):
            seq, before, skip = coder.sequence(piece.column(text_col))
            cls, place, bucket = coder.describe(seq.vocab, coder.ranks(seq.vocab))
            for s in range(0, len(seq.ids), _RUN):
                part = slice(s, s + _RUN)
                ids = seq.ids[part]
                args = cls[ids], place[ids], bucket[before[part]], bucket[skip[part]]
                _observe(both[0], *args)
                if gradient:
                    _run_log_probabilities(weights, class_bias, word_bias, *args, want_gradient=both)
        yield sums.part(both)

    both = sums.total(texts.select(text_col).mapInArrow(add, sums.PART), 2 * BUCKETS * _PARTS[-1])
    return tuple(both.reshape(2, BUCKETS, _PARTS[-1]))


def _biases(observed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by_class = observed[:, :CLASSES].sum(0) + SMOOTHING
    by_word = observed[:, _PARTS[2]:_PARTS[3]].sum(0).reshape(HEAD_CLASSES, CLASS_SIZE) + SMOOTHING
    class_bias = np.log(by_class / by_class.sum())
    return class_bias.astype(np.float32), np.log(by_word / by_word.sum(1, keepdims=True)).ravel().astype(np.float32)


def _start(observed: np.ndarray, class_bias: np.ndarray, word_bias: np.ndarray) -> np.ndarray:
    """Half of each smoothed log ratio of counts, since the features before and skip share what they know."""
    weights = np.zeros(observed.shape)
    for low, width, size, bias in ((0, 1, CLASSES, class_bias), (CLASSES, 1, CLASSES, class_bias),
                                   (_PARTS[2], HEAD_CLASSES, CLASS_SIZE, word_bias), (_PARTS[3], HEAD_CLASSES, CLASS_SIZE, word_bias)):
        n = observed[:, low:low + width * size].reshape(BUCKETS, width, size)
        prior = np.exp(bias.astype(np.float64)).reshape(width, size)
        ratio = (n + PRIOR * prior * size) / ((n.sum(2, keepdims=True) + PRIOR * size) * prior)
        weights[:, low:low + width * size] = 0.5 * np.log(ratio).reshape(BUCKETS, -1)
    return np.clip(weights, -LIMIT, LIMIT)


def fit(texts: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> Model:
    """Train on all rows of texts. Null and empty texts count as texts of one end token."""
    spark = texts.sparkSession
    texts = texts.select(text_col)
    counts = stored(word_counts(texts, text_col), "lm-counts")
    totals = counts.agg(F.sum("count"), F.count("*")).first()
    top = counts.orderBy(F.desc("count"), "word").limit(BROADCAST_WORDS).select("word", "count").toArrow()
    head, head_counts = top["word"].combine_chunks(), top["count"].to_numpy().astype(np.int64)
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    taken = head.slice(0, HEAD)
    for row in counts.groupBy("class").agg(F.sum("count").alias("n"), F.count("*").alias("v")).collect():
        class_tokens[row["class"]], class_words[row["class"]] = row.n, row.v
    for k, n in zip(_tail_class(taken), head_counts[:HEAD]):  # frequent words have classes of their own
        class_tokens[k] -= n
        class_words[k] -= 1
    model = Model(
        np.zeros((BUCKETS, _PARTS[-1]), np.float32), np.zeros(CLASSES, np.float32), np.zeros(HEAD, np.float32), head,
        head_counts, class_tokens, class_words, int(totals[0] or 0), int(totals[1]), counts,
    )
    if not model.tokens:
        return model
    near = head.slice(0, OWN_BUCKETS).to_pylist()
    shared = spark.sparkContext.broadcast((near, None, None, None))
    observed, _ = _sums(texts, text_col, shared, False)
    shared.destroy()
    model.class_bias, model.word_bias = _biases(observed)
    weights = _start(observed, model.class_bias, model.word_bias)
    for k in range(rounds):
        share = texts.where(F.pmod(F.xxhash64(text_col), F.lit(rounds)) == k)
        shared = spark.sparkContext.broadcast((near, weights.astype(np.float32), model.class_bias, model.word_bias))
        seen, expected = _sums(share, text_col, shared, True)
        shared.destroy()
        step = RATE * (seen - expected) / (np.maximum(seen, expected) + PRIOR)
        weights = np.clip(weights + step, -LIMIT, LIMIT)
    model.weights = weights.astype(np.float32)
    return model


def score(model: Model, texts: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of texts: carried columns, n_tokens, n_known, train_tokens, base_score and score.

    A null or empty text has one token, its end. Repeated rows are scored one by one. An untrained model
    (no training rows) gives base scores of log10(0.1 / 0.1) = 0 and the score of uniform classes.
    """
    spark = texts.sparkSession
    clash = {"lm_key", "lm_base", "lm_score", "lm_n", "lm_known", "lm_rare"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    shared = spark.sparkContext.broadcast((
        model.head.to_pylist(), model.head_counts, model.weights, model.class_bias, model.word_bias,
        model.class_tokens, model.class_words, model.tokens, model.distinct,
    ))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*carry).schema)
    out = (fields + ", " if fields else "") + (
        "lm_key bigint, lm_n bigint, lm_known bigint, lm_base double, lm_score double, lm_rare array<binary>"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_counts, weights, class_bias, word_bias, class_tokens, class_words, n, v = shared.value
        head = pa.array(head, pa.binary())
        coder = _Coder(head.slice(0, OWN_BUCKETS))
        base_under = np.log10(n + SMOOTHING * (v + 1))
        class_under = np.log10(class_tokens + SMOOTHING * (class_words + 1))
        key = TaskContext.get().partitionId() << 40
        for piece in pieces(batches, text_col):
            seq, before, skip = coder.sequence(piece.column(text_col))
            place_of = pc.fill_null(pc.index_in(seq.vocab, value_set=head), -1).to_numpy(zero_copy_only=False)
            cls, place, bucket = coder.describe(seq.vocab, place_of)
            count = np.where(place_of >= 0, head_counts[place_of], 0) if len(head_counts) else np.zeros(len(place_of))
            log_count = np.where(place_of >= 0, np.log10(count + SMOOTHING), 0.0)
            first = seq.starts[:-1]
            p = np.empty(len(seq.ids))
            for s in range(0, len(seq.ids), _RUN):
                part = slice(s, s + _RUN)
                ids = seq.ids[part]
                p[part] = _run_log_probabilities(
                    weights, class_bias, word_bias, cls[ids], place[ids], bucket[before[part]], bucket[skip[part]]
                )
            in_class = np.where(place >= 0, 0.0, log_count - class_under[cls])
            p = p / _LOG10 + in_class[seq.ids]
            base = (log_count - base_under)[seq.ids]
            rare = (place_of < 0)[seq.ids]
            n_rare = np.add.reduceat(rare.astype(np.int64), first)
            offsets = np.r_[0, np.cumsum(n_rare)].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), seq.vocab.take(pa.array(seq.ids[rare])))
            sizes = np.diff(seq.starts)
            rows = piece.num_rows
            yield pa.RecordBatch.from_arrays(
                [piece.column(name) for name in carry] + [
                    pa.array(np.arange(key, key + rows)), pa.array(sizes), pa.array(sizes - n_rare),
                    pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(p, first)), lists,
                ],
                [*carry, "lm_key", "lm_n", "lm_known", "lm_base", "lm_score", "lm_rare"],
            )
            key += rows

    rows = stored(texts.select(*dict.fromkeys((*carry, text_col))).mapInArrow(run, out), "lm-rows")
    last = (model.head_counts[-1], model.head[-1].as_py()) if len(model.head) else (0, b"")
    rest = model.counts.where(
        (F.col("count") < int(last[0])) | ((F.col("count") == int(last[0])) & (F.col("word") > F.lit(last[1])))
    ).select("word", "count")
    tail = (
        rows.select("lm_key", F.explode("lm_rare").alias("word")).join(rest, "word", "left").groupBy("lm_key")
        .agg(F.sum(F.log10(F.coalesce("count", F.lit(0)) + SMOOTHING)).alias("tail"), F.count("count").alias("tail_known"))
    )
    added = F.coalesce("tail", F.lit(0.0))
    return rows.drop("lm_rare").join(tail, "lm_key", "left").select(
        *carry,
        F.col("lm_n").alias("n_tokens"),
        (F.col("lm_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("lm_base") + added).alias("base_score"),
        (F.col("lm_score") + added).alias("score"),
    )
