"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon turns words into symbols: insult, threat, target, negation, report, quote or other. A transducer that
reads a clause from its end rewrites a threat with a target up to TARGET_REACH words after it. Four more,
composed into one machine, then read the clause from its start and weigh its symbols:

    report     an insult or threat after a reporting word in the clause is reported speech
    negation   an insult or threat up to NEGATION_REACH words after a negation is negated
    target     a target up to TARGET_REACH words before an insult or threat aims it at somebody
    scorer     gives each rewritten symbol its weight

The score of a clause is the sum of lexicon weights times machine weights; single words outside their clause
count for nothing. A text is scored by logistic regression on what its matched clauses add up to.

Fixed seed words start the lexicon. Insults of any language are learned from labelled rows: words and word
stems that mark toxic texts, chosen one after another so that each explains toxic texts that those before it
don't; copies of one toxic text therefore teach no chance words. Stems with a family of many words are added. The fit takes about FIT_ROWS labelled rows,
chosen by a hash of the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from msgrisk.llm.tables import stored
from msgrisk.llm.tokens import owners, pieces, words

FIT_ROWS = 12_000
MIN_TEXTS = 4
MIN_RATIO = 20.0
LEXICON_SIZE = 4096
STEMS = (4, 5, 6, 7, 8)
#: A stem of so many words, in so many toxic texts, that clean texts lack is a family of insults.
FAMILY_WORDS, FAMILY_TEXTS, FAMILY_RATIO = 5, 8, 100.0
THRESHOLD = 0.7
NEGATION_REACH, TARGET_REACH = 3, 4

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
# A threat with its target behind it; no word has this symbol.
THREAT_AT = 7
# Fixed seed words of the grammar.
SEEDS = {
    INSULT: "idiot idiots moron morons scum stupid pathetic worthless loser losers trash disgusting imbecile",
    THREAT: "kill hurt destroy beat burn strangle stab töten tuer matar frapper schlagen golpear",
    TARGET: "you your yours u they them he she him her du dich ihr euch tu toi vous ton usted ustedes tú",
    NEGATION: "not no never isn't aren't wasn't don't nicht kein keine nie pas jamais nunca jamás",
    REPORT: "said says called claimed wrote quoted reported according sagte nannte disait écrivait dijo llamó",
    QUOTE: "quote quoted zitat citation cita",
}
# Symbols after rewriting, with their weights.
PLAIN, AIMED, NEGATED, REPORTED = 1.0, 1.5, 0.25, 0.4
_CLAUSE_END = r"[.,;:!?|]$"
_STRIP = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


@dataclass
class Transducer:
    """arcs[state][symbol] = (next state, symbol out, weight). Symbols without an arc loop unchanged to `rest`."""

    arcs: dict[int, dict] = field(default_factory=dict)
    rest: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol):
        return self.arcs.get(state, {}).get(symbol) or (self.rest.get(state, state), symbol, 1.0)


def compose(first: Transducer, second: Transducer, symbols: Iterable) -> Transducer:
    """One machine that feeds what `first` writes to `second`. State pairs are numbered as they are reached."""
    out, numbers, todo = Transducer(), {(0, 0): 0}, [(0, 0)]
    symbols = list(symbols)
    while todo:
        pair = todo.pop()
        for symbol in symbols:
            a, middle, w = first.step(pair[0], symbol)
            b, written, v = second.step(pair[1], middle)
            if (a, b) not in numbers:
                numbers[a, b] = len(numbers)
                todo.append((a, b))
            out.arcs.setdefault(numbers[pair], {})[symbol] = (numbers[a, b], written, w * v)
    return out


def _reach(trigger: int, reach: int, mark: str) -> Transducer:
    """Marks insults and threats up to `reach` symbols after the trigger."""
    machine = Transducer()
    for state in range(reach + 1):
        machine.rest[state] = max(0, state - 1)
        machine.arcs[state] = {trigger: (reach, trigger, 1.0)}
        if state:
            for base in (INSULT, THREAT, THREAT_AT):
                for marks in ((), ("reported",), ("negated",), ("reported", "negated")):
                    symbol = (base, *marks) if marks else base
                    machine.arcs[state][symbol] = (max(0, state - 1), (base, *marks, mark), 1.0)
    return machine


def ends_on_target() -> Transducer:
    """Read from the end of a clause: threats up to TARGET_REACH words before a target."""
    machine = Transducer()
    for state in range(TARGET_REACH + 1):
        machine.rest[state] = max(0, state - 1)
        machine.arcs[state] = {TARGET: (TARGET_REACH, TARGET, 1.0)}
        if state:
            machine.arcs[state][THREAT] = (state - 1, THREAT_AT, 1.0)
    return machine


def grammar() -> Transducer:
    report = Transducer(arcs={
        0: {REPORT: (1, REPORT, 1.0), QUOTE: (1, QUOTE, 1.0)},
        1: {INSULT: (1, (INSULT, "reported"), 1.0), THREAT: (1, (THREAT, "reported"), 1.0),
            THREAT_AT: (1, (THREAT_AT, "reported"), 1.0)},
    })
    scorer = Transducer(arcs={0: {}})
    for base in (INSULT, THREAT, THREAT_AT):
        for reported in (False, True):
            for negated in (False, True):
                for aimed in (False, True):
                    marks = ("reported",) * reported + ("negated",) * negated + ("aimed",) * aimed
                    weight = (AIMED if aimed or base == THREAT_AT else PLAIN) * (NEGATED if negated else 1) * (REPORTED if reported else 1)
                    if base == THREAT and not aimed:
                        weight = 0.0  # a threat needs somebody it is aimed at
                    scorer.arcs[0][(base, *marks) if marks else base] = (0, "hit", weight)
    symbols = range(8)
    machine = compose(report, _reach(NEGATION, NEGATION_REACH, "negated"), symbols)
    machine = compose(machine, _reach(TARGET, TARGET_REACH, "aimed"), symbols)
    return compose(machine, scorer, symbols)


@dataclass
class ToxicityModel:
    """Lexicon (word or stem + '*' to weight), bounded by LEXICON_SIZE, and the weights of the regression."""

    lexicon: dict[str, float]
    coefficients: np.ndarray

    def __post_init__(self):
        self.machine, self.behind = grammar(), ends_on_target()
        self.fixed = {word: symbol for symbol, text in SEEDS.items() for word in text.split() if symbol != INSULT}

    def symbol(self, word: str) -> tuple[int, float]:
        weight = self.lexicon.get(word, 0.0)
        for k in STEMS:
            if len(word) >= k:
                weight = max(weight, self.lexicon.get(word[:k] + "*", 0.0))
        if weight:
            return INSULT, weight
        return self.fixed.get(word, OTHER), 1.0


def _plain(vocab: pa.Array) -> list[str]:
    return pc.replace_substring_regex(vocab.cast(pa.string()), _STRIP, "").to_pylist()


def _features(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in STEMS if len(word) >= k)] if word else []


def _evidence(chosen: DataFrame) -> tuple[pa.Table, set[str]]:
    """(feature, keys of its toxic texts, number of words, ratio) of the features that mark toxic texts; the seeds
    that are common among toxic texts.

    Features are weighed on the executors. The driver gets the names of common features, and texts of those that
    mark; both are bounded by the fit rows.
    """

    def toxic_features(batches):
        for piece in pieces(batches, "text"):
            found = words(pc.utf8_lower(piece.column("text")))
            plain, of = _plain(found.vocab), owners(found.starts)
            key = np.unique(of * len(found.vocab) + found.ids)
            names, rows, from_words = [], [], []
            ids = piece.column("key").to_pylist()
            for row, word in zip(key // max(1, len(found.vocab)), key % max(1, len(found.vocab))):
                got = _features(plain[word])
                names += got
                rows += [ids[row]] * len(got)
                from_words += [plain[word]] * len(got)
            columns = [pa.array(names, pa.string()), pa.array(rows, pa.int64()), pa.array(from_words, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "key", "word"])

    toxic = chosen.where("label = 1").mapInArrow(toxic_features, "feature string, key bigint, word string")
    common = stored(toxic.groupBy("feature").agg(
        F.collect_set("key").alias("keys"), F.count_distinct("word").alias("words")
    ).where(F.size("keys") >= MIN_TEXTS), "toxicity-features")
    n_toxic = common.select(F.explode("keys").alias("key")).distinct().count()
    known = frozenset(common.select("feature").toArrow().column("feature").to_pylist())
    shared = chosen.sparkSession.sparkContext.broadcast(known)

    def clean_counts(batches):
        wanted, counts = shared.value, {}
        for piece in pieces(batches, "text"):
            found = words(pc.utf8_lower(piece.column("text")))
            of = owners(found.starts)
            number = [[f for f in _features(w) if f in wanted] for w in _plain(found.vocab)]
            key = np.unique(of * len(found.vocab) + found.ids)
            seen: dict[str, int] = {}
            for row, word in zip((key // max(1, len(found.vocab))).tolist(), (key % max(1, len(found.vocab))).tolist()):
                for f in number[word]:
                    if seen.get(f) != row:
                        seen[f] = row
                        counts[f] = counts.get(f, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["feature", "n"])

    clean = chosen.where("label = 0").mapInArrow(clean_counts, "feature string, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    n_clean = chosen.where("label = 0").count()
    share = (F.size("keys") + 0.5) / F.lit(n_toxic + 1) / ((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(n_clean + 1))
    marking = common.join(clean, "feature", "left").withColumn("ratio", share).where(F.col("ratio") >= MIN_RATIO)
    found = marking.select("feature", "keys", "words", "ratio").toArrow().sort_by("feature")
    shared.destroy()
    return found, set(SEEDS[INSULT].split()) & known


def _learn_lexicon(found: pa.Table, common_seeds: set[str]) -> dict[str, float]:
    """Greedy cover of the toxic texts by features that clean texts lack."""
    names = found.column("feature").to_pylist()
    keys = found.column("keys").combine_chunks()
    sizes = keys.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    texts = np.unique(keys.flatten().to_numpy(), return_inverse=True)[1]
    words_of, ratio = found.column("words").to_numpy(), found.column("ratio").to_numpy()
    weight = [math.log(r) for r in ratio.tolist()]
    seeds = set(SEEDS[INSULT].split())
    family = (words_of >= FAMILY_WORDS) & (sizes >= FAMILY_TEXTS) & (ratio >= FAMILY_RATIO)
    first = [i for i, name in enumerate(names) if name in seeds or family[i]]
    lexicon = {}
    uncovered = np.ones(int(texts.max()) + 1 if len(texts) else 0, bool)

    def take(i: int) -> None:
        lexicon[names[i]] = weight[i]
        uncovered[texts[starts[i]:starts[i] + sizes[i]]] = False

    for i in sorted(first, key=lambda i: (-weight[i], names[i]))[:LEXICON_SIZE]:
        take(i)
    for feature in seeds - common_seeds:
        lexicon[feature] = math.log(MIN_RATIO)
    while names and len(lexicon) < LEXICON_SIZE:
        # Rarity among clean texts first counts by its logarithm, the number of new texts in full.
        left = np.add.reduceat(uncovered[texts].astype(np.int64), starts)
        gain = np.where(left >= MIN_TEXTS, left * np.array(weight), -1.0)
        # Of equal gains the last name.
        best = len(gain) - 1 - int(np.argmax(gain[::-1]))
        if gain[best] < 0:
            break
        take(best)
    return lexicon


def clause_hits(model: ToxicityModel, texts: pa.Array) -> list[tuple[int, int, int, float]]:
    """(text, first token, last token, score) of every clause with an insult or threat that the machine scores."""
    found = words(pc.utf8_lower(pc.fill_null(texts, "")))
    symbols = [model.symbol(w) for w in _plain(found.vocab)]
    kind = np.array([s for s, _ in symbols], np.int64)
    if not len(found.ids):
        return []
    ends = pc.match_substring_regex(found.vocab.cast(pa.string()), _CLAUSE_END).to_numpy(zero_copy_only=False).astype(bool)[found.ids]
    last = found.starts[1:] - 1
    ends[last[np.diff(found.starts) > 0]] = True
    token_kind = kind[found.ids]
    stops = np.flatnonzero(ends)
    clause = np.searchsorted(stops, np.flatnonzero((token_kind == INSULT) | (token_kind == THREAT)))
    of, out = owners(found.starts), []
    for k in np.unique(clause).tolist():
        start, stop = (int(stops[k - 1]) + 1 if k else 0), int(stops[k])
        state, read = 0, []
        for symbol in token_kind[start:stop + 1][::-1].tolist():
            state, written, _ = model.behind.step(state, symbol)
            read.append(written)
        state, score = 0, 0.0
        for at, symbol in zip(range(start, stop + 1), reversed(read)):
            state, written, weight = model.machine.step(state, symbol)
            if written == "hit":
                score += weight * symbols[int(found.ids[at])][1]
        if score > 0:
            text = int(of[start])
            out.append((text, start - int(found.starts[text]), stop - int(found.starts[text]), score))
    return out


def _summary(model: ToxicityModel, texts: pa.Array) -> np.ndarray:
    """Per text: 1, log of 1 + the summed clause scores, and log of 1 + the best clause score."""
    total, best = np.zeros(len(texts)), np.zeros(len(texts))
    for text, _, _, score in clause_hits(model, texts):
        total[text] += score
        best[text] = max(best[text], score)
    return np.stack([np.ones(len(texts)), np.log1p(total), np.log1p(best)], 1)


def fit(rows: DataFrame, text_col: str, label_col: str, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn from rows with label 0 or 1. Without toxic rows the lexicon is the seeds and scores are near 0 or 1 by them."""
    rows = rows.where(F.col(label_col).isin(0, 1) & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), F.xxhash64(text_col).alias("key")
    )
    total = rows.count()
    bar = int(2**31 * min(1.0, fit_rows / max(1, total)))
    chosen = stored(rows.where(F.pmod("key", F.lit(2**31)) < bar), "toxicity-fit")
    lexicon = _learn_lexicon(*_evidence(chosen))
    model = ToxicityModel(lexicon, np.zeros(3))
    shared = chosen.sparkSession.sparkContext.broadcast(model)

    def summarise(batches):
        for piece in pieces(batches, "text"):
            x = _summary(shared.value, piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("label"), pa.array(x[:, 1]), pa.array(x[:, 2])], ["y", "a", "b"])

    # Texts with equal summaries count once with their number; the fit rows bound what the driver gets.
    data = chosen.mapInArrow(summarise, "y int, a double, b double").groupBy("y", "a", "b").count().orderBy("y", "a", "b").toPandas()
    shared.destroy()
    x = np.stack([np.ones(len(data)), data["a"], data["b"]], 1) if len(data) else np.zeros((0, 3))
    y, n = data["y"].to_numpy(float), data["count"].to_numpy(float)
    w = np.array([-4.0, 1.0, 1.0])
    ridge = np.diag([0.01, 0.1, 0.1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + ridge @ (w - [-4.0, 1.0, 1.0])
        w = w - np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, slope)
    model.coefficients = w
    return model


def score(model: ToxicityModel, docs: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of docs with the toxicity of the whole text, 0 to 1. Null and empty texts get the score of no match."""
    if score_col in docs.columns:
        raise ValueError(f"column {score_col} is taken; name another")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{score_col}` double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_col):
            z = np.clip(_summary(shared.value, piece.column(text_col)) @ shared.value.coefficients, -30, 30)
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(1 / (1 + np.exp(-z)))], [*piece.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def matched_clauses(model: ToxicityModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, first and last word position and score of every clause that the grammar matches."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_col):
            hits = clause_hits(shared.value, piece.column(text_col))
            cols = list(zip(*hits)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([
                piece.column(id_col).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()),
            ], [id_col, "first_word", "last_word", "clause_score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, first_word bigint, last_word bigint, clause_score double")
