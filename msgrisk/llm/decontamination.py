"""Benchmark decontamination by template canonicalisation.

Words of benchmark items and documents become template words: numbers, names (capitalised words inside a
sentence) and units after a number turn into typed placeholders, all other words are lower-cased and stripped
of punctuation. Windows of WINDOW template words (whole items where they are shorter) are hashed and joined by
hash. Beside typed words, windows come in a form with names as plain words, for copies in other case, and in forms
with a run of equal placeholders as one slot, for values of several words. Matches of a document with an item are
lined up by the distance between their positions; along such a line the values in the slots must map one to one,
so that a question with other numbers or names is caught and a chance mixture is not. Pieces of several lines, as
inserted and dropped words leave them, add up if they keep the item's order, agree in their slots and stand no
further apart than the item is long. A document holds an item if the pieces cover COVERAGE of its words, or one
piece RUN_WORDS words in a row. Fewer than WINDOW unbroken tokens of a longer item are no evidence.

The benchmark is a stated query set taken against all rows, in blocks of BLOCK_WINDOWS windows: each block is
broadcast, whatever the size of the benchmark, and all documents pass over it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from msgrisk.llm.tokens import hash64, mix, owners, pieces, words

WINDOW = 8
SHORTEST_ITEM = 4
COVERAGE = 0.5
RUN_WORDS = 13
BLOCK_WINDOWS = 200_000
_FILTER_BITS = 22

# Words for numbers and units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fifteen twenty thirty forty fifty sixty "
    "seventy eighty ninety hundred thousand million eins zwei drei vier fünf sechs sieben acht neun zehn deux trois quatre "
    "cinq sept huit neuf dix dos tres cuatro cinco seis siete ocho nueve diez"
).split()
UNITS = (
    "mm cm m km in ft yd mi mile miles meter meters metre metres inch inches foot feet g kg mg lb lbs oz ton tons gram grams "
    "kilogram kilograms pound pounds l ml litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr "
    "hour hours day days week weeks month months year years percent % degrees °c °f k usd eur gbp dollar dollars cent cents euro "
    "euros mph kmh w kw v hz pa j kj cal bytes kb mb gb tb"
).split()
_NUMBER = r"^[+\-]?[$€£]?\d+([.,:/]\d+)*(%|st|nd|rd|th)?$"
_EDGES = r"^[^\p{L}\p{N}$€£%°+\-]+|[^\p{L}\p{N}%°]+$"
_CAPITAL = r"^\p{Lu}[\p{Ll}'’\-]+$"
_SENTENCE_END = r"[.!?:;…]['\"”’)\]]*$"
WORD, NUMBER, NAME, UNIT = range(4)


def templates(texts: pa.Array):
    """Found words, and per token: 64-bit template word, kind, and number of its plain lower-case word."""
    found = words(texts, lower=False)
    vocab = found.vocab.cast(pa.string())
    plain = pc.replace_substring_regex(vocab, _EDGES, "")
    lower = pc.utf8_lower(plain)
    coded = lower.dictionary_encode()
    number = pc.match_substring_regex(plain, _NUMBER)
    number = pc.or_(number, pc.is_in(lower, pa.array(NUMBER_WORDS))).to_numpy(zero_copy_only=False)
    unit = pc.is_in(lower, pa.array(UNITS)).to_numpy(zero_copy_only=False)
    capital = pc.match_substring_regex(plain, _CAPITAL).to_numpy(zero_copy_only=False)
    ends = pc.match_substring_regex(vocab, _SENTENCE_END).to_numpy(zero_copy_only=False)
    hashed = hash64(lower)
    ids = found.ids
    if not len(ids):
        return found, np.zeros(0, np.uint64), np.zeros(0, np.int8), ids, coded
    first = np.zeros(len(ids), bool)
    first[found.starts[:-1][np.diff(found.starts) > 0]] = True
    after = np.roll(ids, 1)
    kind = np.where(number[ids], NUMBER, WORD)
    kind[unit[ids] & number[after] & ~first] = UNIT
    kind[capital[ids] & ~first & ~ends[after] & (kind == WORD)] = NAME
    code = np.where(kind == WORD, hashed[ids], mix(kind.astype(np.uint64) + np.uint64(1)))
    return found, code, kind.astype(np.int8), coded.indices.to_numpy()[ids], coded


def rolling(code: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n template words from each position; shorter by n - 1."""
    out = np.zeros(max(0, len(code) - n + 1), np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + code[k:k + len(out)]
    return mix(out + np.uint64(n))


def _windows(code: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the windows of n words that lie inside one text."""
    hashes = rolling(code, n)
    room = np.repeat(starts[1:], np.diff(starts))[:len(hashes)] - np.arange(len(hashes))
    at = np.flatnonzero(room >= n)
    return hashes[at], at


class _Form(NamedTuple):
    """Tokens of texts in one form: codes, first word and number of words of each, and first token of each text, and the end.

    told: tokens by which windows differ from those of the forms before; windows without one are left out.
    """

    code: np.ndarray
    word: np.ndarray
    width: np.ndarray
    starts: np.ndarray
    told: list[np.ndarray]


def _forms(code: np.ndarray, kind: np.ndarray, folded: np.ndarray, starts: np.ndarray) -> list[_Form]:
    """Typed words; names as plain words in any case; and both with runs of one placeholder as one slot."""
    place, ones = np.arange(len(code)), np.ones(len(code), np.int64)
    name = kind == NAME
    plain = np.where(name, folded, code)
    out = [_Form(code, place, ones, starts, [])]
    if name.any():
        out.append(_Form(plain, place, ones, starts, [name]))
    begins = np.zeros(len(code) + 1, bool)
    begins[starts] = True
    for codes, slot in ((code, kind != WORD), (plain, (kind != WORD) & ~name)):
        joined = np.zeros(len(code), bool)
        joined[1:] = slot[1:] & (kind[1:] == kind[:-1]) & ~begins[1:-1]
        if not joined.any():
            continue
        word = np.flatnonzero(~joined)
        width = np.diff(np.r_[word, len(code)])
        out.append(_Form(codes[word], word, width, np.searchsorted(word, starts), [width > 1] + ([name[word]] if codes is plain else [])))
    return out


def _told(form: _Form, at: np.ndarray, n: int) -> np.ndarray:
    """Whether the windows of n tokens at `at` have a token of each kind that tells the form from others."""
    keep = np.ones(len(at), bool)
    for flags in form.told:
        sums = np.r_[0, np.cumsum(flags)]
        keep &= sums[at + n] > sums[at]
    return keep


class _Items:
    """A block of benchmark items: sorted window hashes with item, form and position, and the items' words."""

    def __init__(self, ids: list, texts: list):
        found, code, kind, plain, coded = templates(pa.array(texts, pa.string()))
        self.ids, self.starts, self.kind = ids, found.starts, kind
        self.plain = [coded.dictionary[int(k)].as_py() for k in plain]
        self.sizes = np.diff(found.starts)
        self.forms = _forms(code, kind, hash64(coded.dictionary)[plain] if len(plain) else code, found.starts)
        parts = defaultdict(list)
        for f, form in enumerate(self.forms):
            for item, size in enumerate(np.diff(form.starts).tolist()):
                if size >= SHORTEST_ITEM:
                    n = min(WINDOW, size)
                    got = rolling(form.code[form.starts[item]:form.starts[item + 1]], n)
                    at = form.starts[item] + np.arange(len(got))
                    keep = _told(form, at, n)
                    parts[n].append((got[keep], np.full(int(keep.sum()), item), np.full(int(keep.sum()), f), at[keep]))
        self.by_length = {}
        for n, rows in parts.items():
            hashes, item, form, at = (np.concatenate(x) for x in zip(*rows))
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[(hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
            self.by_length[n] = hashes[order], item[order], form[order], at[order], seen


class _Slots:
    """Values of an item's slots and a document's, one to one."""

    def __init__(self, there: dict | None = None, back: dict | None = None):
        self.there, self.back = there or {}, back or {}

    def fit(self, pairs: Iterable[tuple]) -> bool:
        return all(self.there.get(a, b) == b and self.back.get(b, a) == a for a, b in pairs)

    def add(self, pairs: Iterable[tuple]) -> None:
        for a, b in pairs:
            self.there[a], self.back[b] = b, a


class _Piece(NamedTuple):
    """Words of a document from low to high that are words of an item from first to last; slots as (item's word, values)."""

    low: int
    high: int
    first: int
    last: int
    pairs: frozenset


def _line(items: _Items, ours: _Form, theirs: _Form, plain: np.ndarray, shift: int, windows: list[tuple[int, int]]) -> list[_Piece]:
    """Unbroken pieces of the windows (item's token, number of tokens) at one shift that share one map of slots."""
    slots, taken = _Slots(), []
    for at, n in sorted(set(windows)):
        pairs, where = set(), set()
        for k in range(at, at + n):
            kind = int(items.kind[theirs.word[k]])
            if kind != WORD:
                a, b = int(theirs.word[k]), int(ours.word[k + shift])
                value = tuple(items.plain[a:a + int(theirs.width[k])]), tuple(plain[b:b + int(ours.width[k + shift])].tolist())
                pairs.add(((kind, value[0]), (kind, value[1])))
                where.add((a, ((kind, value[0]), (kind, value[1]))))
        if slots.fit(pairs) and len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs):
            slots.add(pairs)
            if taken and at <= taken[-1][1]:
                taken[-1] = taken[-1][0], max(taken[-1][1], at + n), taken[-1][2] | where
            else:
                taken.append((at, at + n, where))
    return [
        _Piece(
            int(ours.word[a + shift]), int(ours.word[b - 1 + shift] + ours.width[b - 1 + shift]),
            int(theirs.word[a]), int(theirs.word[b - 1] + theirs.width[b - 1]), frozenset(where),
        )
        for a, b, where in taken
    ]


def _chain(found: list[_Piece], size: int) -> tuple[int, int, int]:
    """Most item words of pieces in one order, no more than `size` words apart: words, first document word, longest piece."""
    found = sorted(set(found), key=lambda p: p[:4])
    states: list[tuple[int, int, int, _Slots]] = []
    for j, now in enumerate(found):
        best, before, mine = (now.last - now.first, now.low, now.last - now.first), None, [pair for _, pair in now.pairs]
        for i in range(j - 1, -1, -1):
            old = found[i]
            if old.low < now.low - 3 * size:
                break
            if not (old.low < now.low and old.high < now.high and old.first < now.first and old.last < now.last) or now.low - old.high > size:
                continue
            # Words that both pieces have count once, on either side, and so do their slots.
            fresh = now.last - now.first - max(0, old.last - now.first, old.high - now.low)
            total = states[i][0] + fresh
            if fresh > 0 and total > best[0]:
                rest = [pair for word, pair in now.pairs if word >= now.last - fresh]
                if states[i][3].fit(rest):
                    best, before, mine = (total, states[i][1], max(states[i][2], now.last - now.first)), states[i][3], rest
        slots = _Slots(dict(before.there), dict(before.back)) if before else _Slots()
        slots.add(mine)
        states.append((*best, slots))
    return max(states, key=lambda s: s[0])[:3]


def _matches(items: _Items, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """(text, item, first matching word, covered words, longest run) of every text that holds an item."""
    found, code, kind, plain, coded = templates(texts)
    of = owners(found.starts)
    forms = _forms(code, kind, hash64(coded.dictionary)[plain] if len(plain) else code, found.starts)
    lines = defaultdict(lambda: defaultdict(list))
    for n, (hashes, item, form, at, seen) in items.by_length.items():
        for f, ours in enumerate(forms):
            got, where = _windows(ours.code, ours.starts, n)
            hit = seen[(got & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)]
            got, where = got[hit], where[hit]
            hit = _told(ours, where, n)
            got, where = got[hit], where[hit]
            low, high = np.searchsorted(hashes, got), np.searchsorted(hashes, got, side="right")
            for k in np.flatnonzero(high > low).tolist():
                text = int(of[ours.word[where[k]]])
                for j in range(low[k], high[k]):
                    lines[text, int(item[j])][f, int(form[j]), int(where[k]) - int(at[j])].append((int(at[j]), n))
    out = []
    for (text, item), by_shift in sorted(lines.items()):
        size, every, best, run = int(items.sizes[item]), [], (0, 0), 0
        for (f, form, shift), windows in sorted(by_shift.items()):
            line = _line(items, forms[f], items.forms[form], plain, shift, windows)
            every += line
            if line:
                best = max(best, (sum(p.last - p.first for p in line), -line[0].low))
                run = max(run, *(p.last - p.first for p in line), 0)
        if best[0] < size and len(every) > 1:
            total, low, _ = _chain(every, size)
            best = max(best, (total, -low))
        if best[0] and (best[0] >= COVERAGE * size or run >= RUN_WORDS):
            out.append((text, item, -best[1] - int(found.starts[text]), best[0], run))
    return out


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list]]:
    """Items in blocks of about BLOCK_WINDOWS words, streamed to the driver one partition at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.where(F.col(text_col).isNotNull()).select(item_col, text_col).orderBy(item_col)
    for row in rows.toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1].split())
        if size >= BLOCK_WINDOWS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """id, item, first_word, n_words, n_covered, longest_run of every document and item it holds.

    Null and empty texts hold nothing; items of fewer than SHORTEST_ITEM words are left out; repeated documents
    are reported each, repeated items once per item id. An empty benchmark gives no rows.
    """
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, first_word bigint, n_words bigint, n_covered bigint, longest_run bigint"
    names = [id_col, item_col, "first_word", "n_words", "n_covered", "longest_run"]
    item_kind = to_arrow_type(benchmark.schema[item_col].dataType)
    sources = docs.select(id_col, text_col)
    found = []
    for ids, texts in item_blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = None
            for piece in pieces(batches, text_col):
                items = items or _Items(*shared.value)
                hits = _matches(items, piece.column(text_col))
                cols = list(zip(*hits)) or [()] * 5
                numbers = [pa.array(c, pa.int64()) for c in cols]
                words_of = pa.array([int(items.sizes[k]) for k in cols[1]], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    piece.column(id_col).take(numbers[0]), pa.array([items.ids[k] for k in cols[1]], item_kind), numbers[2], words_of, numbers[3], numbers[4],
                ], names)

        found.append(sources.mapInArrow(run, schema))
    if not found:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def count_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", count_col: str = "n_leaks",
) -> DataFrame:
    """docs with the number of benchmark items that each row's text holds. Rows without a text hold none."""
    if count_col in docs.columns:
        raise ValueError(f"column {count_col} is taken; name another")
    spark = docs.sparkSession
    out = docs.withColumn(count_col, F.lit(0).cast("bigint"))
    for ids, texts in item_blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = None
            for piece in pieces(batches, text_col):
                items = items or _Items(*shared.value)
                counts = piece.column(count_col).to_numpy() + np.bincount(
                    [hit[0] for hit in _matches(items, piece.column(text_col))], minlength=piece.num_rows
                ).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(counts)], piece.schema.names)

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
        out = out.mapInArrow(run, fields)
    return out
