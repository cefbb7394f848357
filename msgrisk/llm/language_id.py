"""Language of code-switched text by a linear-chain conditional random field over words.

Every word is a node of the chain, labelled with a language. Node features are hashed byte n-grams of the word
between two marks, so that those with a mark are its affixes, and the word itself (lexicon feature); edge
features are the pairs of languages. Weights are fitted by gradient ascent on the conditional likelihood of the
training texts, whose words all carry the language of their text: tasks run forward-backward and add up observed
minus expected feature counts, Spark sums them, the driver moves the weights, whose number is fixed. The fit
takes about FIT_ROWS labelled texts, chosen by a hash of the text; whole texts, never prefixes.

Scoring runs forward-backward over all words of each text. A text's score for a language is the mean
probability of that language over its words with a letter; `word_languages` gives the words one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from msgrisk.llm import sums
from msgrisk.llm.tables import stored
from msgrisk.llm.tokens import Words, hash64, mix, owners, pieces, raw, words

FIT_ROWS = 4000
FEATURES = 1 << 16
ORDERS = (1, 2, 3, 4)
STEPS, RATE, DECAY = 10, 0.15, 1e-4
#: Bound on a learned transition, so that a chain can change language inside a text.
STAY_LIMIT = 4.0
UNKNOWN = "und"
_LETTER = r"\p{L}"


@dataclass
class Tagger:
    labels: list[str]
    nodes: np.ndarray  # FEATURES x labels
    edges: np.ndarray  # labels x labels


def node_features(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in one array, and the first of each word."""
    offsets, data = raw(vocab)
    n = len(offsets) - 1
    lengths = np.diff(offsets) + 2
    starts = np.r_[0, np.cumsum(lengths)]
    marked = np.full(starts[-1], 1, np.uint64)  # byte 1 stands on both sides of a word
    inside = np.ones(starts[-1], bool)
    inside[starts[:-1]] = inside[starts[1:] - 1] = False
    marked[inside] = data
    word = np.repeat(np.arange(n), lengths)
    ids, of = [(hash64(vocab) & np.uint64(FEATURES - 1)).astype(np.int64)], [np.arange(n)]
    padded = np.r_[marked, np.zeros(max(ORDERS), np.uint64)]
    code = np.zeros(starts[-1], np.uint64)
    room = starts[1:][word] - np.arange(starts[-1])
    for k in range(max(ORDERS)):
        code = code | padded[k:k + len(marked)] << np.uint64(8 * k)
        if k + 1 in ORDERS:
            at = np.flatnonzero(room > k)
            ids.append((mix(code[at] + np.uint64((k + 1) << 40)) & np.uint64(FEATURES - 1)).astype(np.int64))
            of.append(word[at])
    ids, of = np.concatenate(ids), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return ids[order], np.r_[0, np.cumsum(np.bincount(of, minlength=n))]


def _emissions(nodes: np.ndarray, vocab: pa.Array):
    """Node scores of each word, its features, and whether it has a letter. Words without one score 0."""
    letter = pc.match_substring_regex(vocab.cast(pa.string()), _LETTER).to_numpy(zero_copy_only=False).astype(bool)
    ids, first = node_features(vocab)
    score = np.add.reduceat(nodes[ids], first[:-1], axis=0) if len(ids) else np.zeros((0, nodes.shape[1]), np.float32)
    score = score / np.sqrt(np.diff(first))[:, None].astype(np.float32)
    score[~letter] = 0
    return score, ids, first, letter


def forward_backward(score: np.ndarray, starts: np.ndarray, edges: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of every token. Texts run side by side, one word a step; pairs gets the sums of edge probabilities."""
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    tokens = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(tokens[-1]) - np.repeat(tokens[:-1], lengths)
    rank = np.repeat(np.arange(len(lengths)), lengths)
    by_time = np.lexsort((rank, place))  # all first words, then all second words, longest texts first
    source = (np.repeat(starts[:-1][order], lengths) + place)[by_time]
    local = np.exp(score[source] - score[source].max(1, keepdims=True))
    step = np.r_[0, np.cumsum(np.bincount(place))] if len(place) else np.zeros(1, np.int64)
    move = np.exp(edges - edges.max())
    ahead = np.empty_like(local)
    for t in range(len(step) - 1):
        now = slice(step[t], step[t + 1])
        n = step[t + 1] - step[t]
        value = local[now] * (ahead[step[t - 1]:step[t - 1] + n] @ move) if t else local[now]
        ahead[now] = value / value.sum(1, keepdims=True)
    out = np.empty_like(local)
    behind = np.ones((0, local.shape[1]), local.dtype)
    for t in range(len(step) - 2, -1, -1):
        now = slice(step[t], step[t + 1])
        value = np.ones((step[t + 1] - step[t], local.shape[1]), local.dtype)
        if len(behind):
            back = behind * local[step[t + 1]:step[t + 2]]
            value[:len(back)] = back @ move.T
            value /= value.sum(1, keepdims=True)
            if pairs is not None:
                left = ahead[step[t]:step[t] + len(back)]
                norm = np.einsum("ni,ij,nj->n", left, move, back)
                pairs += move * ((left / norm[:, None]).T @ back)
        behind = value
        out[now] = ahead[now] * value
    out /= out.sum(1, keepdims=True)
    result = np.empty_like(out)
    result[source] = out
    return result


def fit(rows: DataFrame, text_col: str, label_col: str, fit_rows: int = FIT_ROWS, steps: int = STEPS) -> Tagger:
    """Learn from rows with a label. No labelled row gives a tagger without labels, which answers `und`."""
    spark = rows.sparkSession
    rows = rows.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")
    )
    counts = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}  # one row a language
    labels = sorted(counts)
    total = sum(counts.values())
    size = FEATURES * len(labels) + len(labels) ** 2
    tagger = Tagger(labels, np.zeros((FEATURES, len(labels)), np.float32), np.zeros((len(labels), len(labels)), np.float32))
    if len(labels) < 2:
        return tagger
    bar = int(2**31 * min(1.0, fit_rows / total))
    chosen = stored(rows.where(F.pmod(F.xxhash64("text"), F.lit(2**31)) < bar), "language-fit")
    weights, squares = np.zeros(size), np.full(size, 1e-8)

    def gradient(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, nodes, edges = shared.value
        k = len(names)
        out_nodes, out_edges = np.zeros((FEATURES, k)), np.zeros((k, k))
        for piece in pieces(batches, "text"):
            found = words(piece.column("text"))
            if not len(found.ids):
                continue
            score, ids, first, letter = _emissions(nodes, found.vocab)
            pairs = np.zeros((k, k))
            p = forward_backward(score[found.ids], found.starts, edges, pairs)
            label = pc.index_in(piece.column("label"), value_set=pa.array(names)).to_numpy()
            true = label[owners(found.starts)]
            off = -p
            off[np.arange(len(true)), true] += 1
            off[~letter[found.ids]] = 0
            by_word = np.zeros((len(found.vocab), k))
            for j in range(k):
                by_word[:, j] = np.bincount(found.ids, off[:, j], len(found.vocab))
            by_word /= np.sqrt(np.diff(first))[:, None]
            for j in range(k):
                out_nodes[:, j] += np.bincount(ids, np.repeat(by_word[:, j], np.diff(first)), FEATURES)
            out_edges += np.diag(np.bincount(label, np.maximum(np.diff(found.starts) - 1, 0), k)) - pairs
        yield sums.part(np.r_[out_nodes.ravel(), out_edges.ravel()])

    for _ in range(steps):
        nodes = weights[:FEATURES * len(labels)].reshape(FEATURES, -1).astype(np.float32)
        edges = weights[FEATURES * len(labels):].reshape(len(labels), -1).astype(np.float32)
        shared = spark.sparkContext.broadcast((labels, nodes, edges))
        step = sums.total(chosen.mapInArrow(gradient, sums.PART), size) - DECAY * weights
        shared.destroy()
        squares += step**2
        weights += RATE * step / np.sqrt(squares)
        weights[FEATURES * len(labels):] = np.clip(weights[FEATURES * len(labels):], -STAY_LIMIT, STAY_LIMIT)
    tagger.nodes = weights[:FEATURES * len(labels)].reshape(FEATURES, -1).astype(np.float32)
    tagger.edges = weights[FEATURES * len(labels):].reshape(len(labels), -1).astype(np.float32)
    return tagger


def _tag(tagger: Tagger, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    found = words(texts)
    score, _, _, letter = _emissions(tagger.nodes, found.vocab)
    return found, forward_backward(score[found.ids], found.starts, tagger.edges), letter[found.ids]


def identify(tagger: Tagger, docs: DataFrame, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """All columns of docs but the text, with the language and its mean probability over words.

    Null texts and texts without a letter give `und` and 0. A tie goes to the first language by name.
    """
    kept = [c for c in docs.columns if c != text_col]
    clash = {pred_col, score_col} & set(kept)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken; name others")
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    schema = (fields + ", " if fields else "") + f"`{pred_col}` string, `{score_col}` double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        names = pa.array([*tagger.labels, UNKNOWN], pa.string())
        for piece in pieces(batches, text_col):
            n, k = piece.num_rows, len(tagger.labels)
            best, score = np.full(n, k), np.zeros(n)
            if k:
                found, p, letter = _tag(tagger, piece.column(text_col))
                of = owners(found.starts)[letter]
                mass = np.stack([np.bincount(of, p[letter, j], n) for j in range(k)], 1)
                count = np.bincount(of, minlength=n)
                some = count > 0
                best = np.where(some, mass.argmax(1), k)
                score[some] = np.minimum(1.0, mass.max(1)[some] / count[some])
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in kept), names.take(pa.array(best)), pa.array(score)], [*kept, pred_col, score_col]
            )

    return docs.select(*kept, text_col).mapInArrow(run, schema)


def word_languages(tagger: Tagger, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, position, word, language and probability of every word; `und` for words without a letter."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        names = pa.array([*tagger.labels, UNKNOWN], pa.string())
        for piece in pieces(batches, text_col):
            if not tagger.labels:
                continue
            found, p, letter = _tag(tagger, piece.column(text_col))
            of = owners(found.starts)
            best = np.where(letter, p.argmax(1), len(tagger.labels))
            yield pa.RecordBatch.from_arrays([
                piece.column(id_col).take(pa.array(of)), pa.array(np.arange(len(of)) - found.starts[of]),
                found.vocab.take(pa.array(found.ids)).cast(pa.string()), names.take(pa.array(best)),
                pa.array(np.where(letter, p.max(1), 0.0).astype(np.float64)),
            ], [id_col, "position", "word", "language", "probability"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, position bigint, word string, language string, probability double")
