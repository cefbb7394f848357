"""Set-similarity join of texts on word n-grams: prefix filtering, rare n-grams first.

A text is the set of its distinct `n`-word shingles. Two texts link if 100 * |A and B| >= percent * |A or B|.

1. A sketch of fixed size counts shingles by hash over all rows. Sorting a set by (sketch count, hash) puts rare
   shingles first; any fixed order gives the same links, the counts only make prefixes selective.
2. Rows with equal sets become one set. A set of size s sends its first s - ceil(percent * s / 100) + 2 shingles
   as postings; linked sets share two of them (or all, if they share less). A posting stays if the list's next
   smaller or next larger set passes the length filter, a set if enough of its postings stay.
3. Postings of a shingle stand in order of set size. Pairs pass the length filter (sizes), the positional filter
   (what the places in both prefixes leave to share) and the suffix filter (shingles are parted at fixed hash
   values; parts with an odd number in one set alone bound the sets' difference), then a suffix filter of finer parts,
   and are then verified once, on whole sets.
4. Not all pairs of a group are looked at. Each round, every set proposes candidates outside its component, those
   that the parts put closest among its neighbours in the order of each posting list and the list's first set. The
   first round takes few postings of a set and its closest candidate, which merges most copies; later rounds take the
   lists that hold more than one component, without those of three sets at most of which no two pass the filters, and
   end when a round links nothing or after PROPOSAL_ROUNDS. Then all remaining pairs between
   different components are verified, each emitted at the first list that both are in; pairs inside a component
   cannot change it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from msgrisk.llm import sums
from msgrisk.llm.components import components
from msgrisk.llm.tables import stored
from msgrisk.llm.tokens import Words, hash64, mix, owners, pieces, powers, words

SKETCH_BITS = 20
PARTS = 512
# Parts of the second, finer look at a pair.
FINE_PARTS = 4096
NEEDED_BITS = 22
_MASK = (1 << NEEDED_BITS) - 1
# Rounds of proposals: postings a set takes in the first, candidates it proposes in the later ones, and the most of them.
FIRST_POSTINGS = 4
CANDIDATES = 8
PROPOSAL_ROUNDS = 5
# Earlier lists of a set that a posting knows in the last step; more only save repeated rows.
KNOWN_LISTS = 32
_STEP = 0xD1B54A32D192ED03 | 1


def shingles(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle, repeats included. A text of 1 to n - 1 words has one shingle."""
    token = hash64(found.vocab)[found.ids] if len(found.ids) else np.zeros(0, np.uint64)
    sizes = np.diff(found.starts)
    of = owners(found.starts)
    place = np.arange(len(token)) - found.starts[:-1][of] if len(token) else np.zeros(0, np.int64)
    code = np.zeros(len(token), np.uint64)
    padded = np.r_[token, np.zeros(n, np.uint64)]
    weights = powers(_STEP, n)
    room = sizes[of] - place
    for k in range(n):
        code += np.where(room > k, padded[k:k + len(token)] * weights[k], np.uint64(0))
    starts = (room >= n) | (place == 0)
    code = mix(code + np.minimum(sizes[of], n).astype(np.uint64))
    return code[starts], of[starts]


def _sets(found: Words, n: int, sketch: np.ndarray | None = None):
    """Distinct shingles of all texts, text by text, and the bounds; sorted by (sketch, hash), else by hash."""
    code, of = shingles(found, n)
    texts = len(found.starts) - 1
    keys = (code, sketch[(code >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], of) if sketch is not None else (code, of)
    order = np.lexsort(keys)
    code, of = code[order], of[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
    code, of = code[fresh], of[fresh]
    return code, np.r_[0, np.cumsum(np.bincount(of, minlength=texts))]


def _signature(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit value of each set that does not depend on order. 0 for the empty set."""
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(mix(code ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    return mix(total[starts[1:]] - total[starts[:-1]])


def _sketch(docs: DataFrame, text_col: str, n: int) -> np.ndarray:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SKETCH_BITS, np.int64)
        for piece in pieces(batches, text_col):
            code, _ = shingles(words(piece.column(text_col)), n)
            seen += np.bincount((code >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(seen))
        yield sums.part(seen)

    seen = sums.total(docs.select(text_col).mapInArrow(count, sums.PART), 1 << SKETCH_BITS)
    return np.minimum(255, 4 * np.log2(seen + 1)).astype(np.uint8)


def _prefixes(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """Per row: its id, set signature, size, prefix, and the parity of its members in each part as bits."""
    sketch = _sketch(docs, text_col, n)
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_col):
            code, starts = _sets(words(piece.column(text_col)), n, shared.value)
            size = np.diff(starts)
            length = np.minimum(size, size + (-percent * size) // 100 + 2)
            of = owners(starts)
            head = np.arange(len(code)) - starts[:-1][of] < length[of]
            part = (code >> np.uint64(8)) % np.uint64(PARTS)
            bits = _odd_bits(part, of, len(size), PARTS).view(np.int64)
            words_of = np.arange(0, len(bits) + 1, PARTS // 64, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                piece.column("id"), pa.array(_signature(code, starts).view(np.int64)), pa.array(size),
                pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(code[head].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(words_of), pa.array(bits)),
            ], ["id", "sig", "size", "prefix", "bits"])

    rows = docs.select(F.col(id_col).alias("id"), text_col)
    out = stored(rows.mapInArrow(run, f"id {kind}, sig bigint, size bigint, prefix array<bigint>, bits array<bigint>"), "ngram-rows")
    shared.destroy()
    return out


def _id_mark(key: Column) -> Column:
    """Place of an id in a bitmap of fixed size."""
    return F.xxhash64(key.cast("string")).bitwiseAND(_MASK).cast("int")


def _sig_mark(sig: Column) -> Column:
    """Place of a signature, which is a hash, in a bitmap of fixed size."""
    return sig.bitwiseAND(_MASK).cast("int")


def _bitmap(keys: DataFrame, mark: Column) -> np.ndarray:
    """The places of all keys, as packed bits."""
    marks = keys.select(mark.alias("mark")).distinct().toArrow()["mark"].to_numpy()  # 2 ** NEEDED_BITS at most
    bitmap = np.zeros(1 << NEEDED_BITS, bool)
    bitmap[marks] = True
    return np.packbits(bitmap)


def _in_bitmap(mark: Column, shared: Broadcast) -> Column:
    @F.pandas_udf("boolean")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits = np.unpackbits(shared.value).astype(bool)
        for marks in batches:
            yield pd.Series(bits[marks.to_numpy()])

    return held(mark)


def _prefix_of_sets(filled: DataFrame, sets: DataFrame) -> DataFrame:
    """sig, size and prefix of every set once. Only sets that several rows may have are shuffled for that."""
    shared = filled.sparkSession.sparkContext.broadcast(_bitmap(sets.where("copies > 1"), _sig_mark(F.col("sig"))))
    marked = filled.select("sig", "size", "prefix", _in_bitmap(_sig_mark(F.col("sig")), shared).alias("several"))
    again = marked.where("several").groupBy("sig", "size").agg(F.first("prefix").alias("prefix"))
    return marked.where("not several").drop("several").unionByName(again)


def _odd_bits(part: np.ndarray, of: np.ndarray, sets: int, parts: int) -> np.ndarray:
    """For each set one bit per part: whether it has an odd number of members there."""
    return np.packbits(np.bincount(of * parts + part.astype(np.int64), minlength=sets * parts).astype(np.uint8) & 1)


def _whole_sets(docs: DataFrame, id_col: str, text_col: str, n: int, needed: DataFrame) -> DataFrame:
    """sig, members (48 bits of each hash, sorted), odd (parity of the members in each fine part) and size of the needed
    sets (sig, least id of a row that has it, copies: rows), and of few others.

    Bitmaps of fixed size keep most other rows from being read word by word, and say which sets several rows may have;
    only these are shuffled to be taken once.
    """
    of_sig = _sig_mark(F.col("sig"))
    bitmaps = _bitmap(needed, _id_mark(F.col("least"))), _bitmap(needed, of_sig), _bitmap(needed.where("copies > 1"), of_sig)
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, held, twice = (np.unpackbits(x).view(bool) for x in shared.value)
        for batch in batches:
            some = batch.filter(pa.array(wanted[batch.column("mark").to_numpy()]))
            for piece in pieces([some], "text"):
                code, starts = _sets(words(piece.column("text")), n)
                sig = _signature(code, starts)
                mark = (sig & np.uint64(_MASK)).astype(np.int64)
                out = []
                for k in np.flatnonzero(held[mark]).tolist():
                    one = code[starts[k]:starts[k + 1]]
                    odd = _odd_bits((one >> np.uint64(8)) % np.uint64(FINE_PARTS), np.zeros(len(one), np.int64), 1, FINE_PARTS)
                    one = one >> np.uint64(16)
                    packed = (one >> np.uint64(16)).astype(np.uint32).tobytes() + one.astype(np.uint16).tobytes()
                    out.append((sig[k:k + 1].view(np.int64)[0], packed, odd.tobytes(), len(one), 1 + int(twice[mark[k]])))
                kinds = pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32()
                columns = zip(*out) if out else ((),) * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["sig", "members", "odd", "size", "kind"])

    rows = docs.select(_id_mark(F.col(id_col)).alias("mark"), F.col(text_col).alias("text"))
    # kind 1: of one row, 2: maybe of several.
    told = stored(rows.mapInArrow(run, "sig bigint, members binary, odd binary, size bigint, kind int"), "ngram-whole")
    shared.destroy()
    again = stored(told.where("kind = 2").groupBy("sig").agg(*[F.first(c).alias(c) for c in ("members", "odd", "size")]), "ngram-whole")
    return told.where("kind = 1").drop("kind").unionByName(again)


def _unpack(data: bytes) -> np.ndarray:
    n = len(data) // 6
    return np.frombuffer(data, np.uint32, n).astype(np.uint64) << np.uint64(16) | np.frombuffer(data, np.uint16, n, 4 * n)


def _likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b and likely of every pair: false if the fine parts alone show that the sets differ too much."""
    bits = sets.select("sig", F.struct("odd", "size").alias("set"))
    first = pairs.select("a", "b").join(bits.select(F.col("sig").alias("a"), F.col("set").alias("x")), "a")
    both = first.join(bits.select(F.col("sig").alias("b"), F.col("set").alias("y")), "b")

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (odd_x, size_x), (odd_y, size_y) = batch.column("x").flatten(), batch.column("y").flatten()
            x, y = (np.frombuffer(b"".join(o.to_pylist()), np.uint64).reshape(len(batch), -1) for o in (odd_x, odd_y))
            apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            total = size_x.to_numpy() + size_y.to_numpy()
            # Linked sets share percent * total / (100 + percent) members at least; the rest makes their difference.
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(apart * (100 + percent) <= total * (100 - percent))], ["a", "b", "likely"])

    return both.select("a", "b", "x", "y").mapInArrow(look, "a bigint, b bigint, likely boolean")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b and linked of every pair, from whole sets if likely (all pairs where that is not given). Sets of no pair are left
    out before any shuffle, if pairs are few."""
    if "likely" not in pairs.columns:
        pairs = pairs.withColumn("likely", F.lit(True))
    likely = pairs.where("likely")
    members = sets.select("sig", "members")
    first = likely.select("a", "b").join(members.select(F.col("sig").alias("a"), F.col("members").alias("set_a")), "a")
    second = members.join(likely.select(F.col("b").alias("sig")), "sig", "left_semi")
    both = first.join(second.select(F.col("sig").alias("b"), F.col("members").alias("set_b")), "b")

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = _unpack(x.as_buffer()), _unpack(y.as_buffer())
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                out.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.bool_())], ["a", "b", "linked"])

    checked = both.select("a", "b", "set_a", "set_b").mapInArrow(check, "a bigint, b bigint, linked boolean")
    return checked.unionByName(pairs.where("not likely").select("a", "b", F.lit(False).alias("linked")))


def _apart(x: Column, y: Column) -> Column:
    """Differing bits of two part bitmaps."""
    return reduce(lambda a, b: a + b, [F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(PARTS // 64)])


def _passes(x, y, percent: int) -> Column:
    """Length, positional and suffix filters for postings x and y of one shingle (functions from name to column)."""
    total = x("size") + y("size")
    length = F.least(x("size"), y("size")) * 100 >= F.greatest(x("size"), y("size")) * percent
    most = F.least(x("place"), y("place")) + F.least(x("size") - x("place"), y("size") - y("place"))
    # Linked sets share percent * total / (100 + percent) members at least; the rest makes their difference.
    position = most * (100 + percent) >= total * percent
    suffix = _apart(x("bits"), y("bits")) * (100 + percent) <= total * (100 - percent)
    return (x("root") != y("root")) & length & position & suffix


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """sig, size, place, shingle and turn (1 for a set's first posting that stays, and so on)."""
    listed = sets.select("sig", "size", F.posexplode("prefix").alias("place", "shingle"))
    order = Window.partitionBy("shingle").orderBy("size", "sig")
    smaller, larger = F.lag("size").over(order), F.lead("size").over(order)
    fits = (smaller * 100 >= F.col("size") * percent) | (F.col("size") * 100 >= larger * percent)
    near = listed.withColumn("fits", fits).where("fits").drop("fits")
    needed = F.least(F.lit(2), F.ceil(F.col("size") * percent / 100))
    turn = F.row_number().over(Window.partitionBy("sig").orderBy("place"))
    held = near.withColumn("n", F.count("*").over(Window.partitionBy("sig"))).withColumn("turn", turn)
    return held.where(F.col("n") >= needed).drop("n")


def _proposals(postings: DataFrame, percent: int, salt: int, most: int) -> DataFrame:
    """(a, b): for each set its closest candidates in other components: of all sets one before it in its lists, two
    before it, and first of its lists, `most` in all.

    The order inside a size changes with the salt, so that rounds propose different pairs.
    """
    order = Window.partitionBy("shingle").orderBy("size", F.xxhash64("sig", F.lit(salt)), "sig")
    me = F.struct("sig", "root", "size", "place", "bits")
    near = postings
    for name, column in (("prev", F.lag(me, 1)), ("second", F.lag(me, 2)), ("head", F.first(me))):
        near = near.withColumn(name, column.over(order))

    def candidate(name: str) -> Column:
        other = lambda c: F.col(f"{name}.{c}")
        distance = _apart(F.col("bits"), other("bits")) / (F.col("size") + other("size"))
        return F.when(_passes(F.col, other, percent), F.struct(distance.alias("apart"), other("sig").alias("other")))

    found = near.select("sig", F.explode(F.array_compact(F.array(*map(candidate, ("prev", "second", "head"))))).alias("c"))
    # A set has three candidates at most for each shingle of its prefix.
    closest = found.groupBy("sig").agg(F.slice(F.array_sort(F.collect_set("c")), 1, most).alias("closest"))
    proposed = closest.select("sig", F.explode("closest").alias("c"))
    return proposed.select(F.least("sig", "c.other").alias("a"), F.greatest("sig", "c.other").alias("b")).distinct()


def _open(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings of the lists that hold more than one component, with the component (root) of their set."""
    named = postings.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    everyone = Window.partitionBy("shingle")
    spread = named.withColumn("low", F.min("root").over(everyone)).withColumn("high", F.max("root").over(everyone))
    return spread.where("low <> high").drop("low", "high")


def _live(postings: DataFrame, percent: int) -> DataFrame:
    """Postings without the lists of two or three sets of which no two in different components pass the filters."""
    order, everyone = Window.partitionBy("shingle").orderBy("size", "sig"), Window.partitionBy("shingle")
    me = F.struct("sig", "root", "size", "place", "bits")
    near = postings.withColumn("prev", F.lag(me, 1).over(order)).withColumn("second", F.lag(me, 2).over(order))
    other = lambda name: lambda c: F.col(f"{name}.{c}")
    passes = reduce(Column.__or__, (F.coalesce(_passes(F.col, other(n), percent), F.lit(False)) for n in ("prev", "second")))
    told = near.select("*", passes.alias("passes"), F.count("*").over(everyone).alias("n"))
    told = told.withColumn("passes", F.max("passes").over(everyone))
    return told.where("n > 3 or passes").drop("prev", "second", "passes", "n")


def _crossing(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b): all candidates between different components; a pair comes from the first list that both sets are in.

    Where more than KNOWN_LISTS lists of a set lie between two that a pair shares, the pair comes twice.
    """
    before = Window.partitionBy("sig").orderBy("place").rowsBetween(-KNOWN_LISTS, -1)
    held = postings.withColumn("known", F.collect_list("shingle").over(before))
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    first = ~F.arrays_overlap(x("known"), y("known"))
    on = (x("shingle") == y("shingle")) & (x("sig") < y("sig")) & _passes(x, y, percent) & first
    return held.alias("x").join(held.alias("y"), on).select(x("sig").alias("a"), y("sig").alias("b")).distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """id, n_shingles and component_id (least id reachable by links, itself included), one row per row of docs.

    Null and empty texts have 0 shingles and are linked with nothing. Rows with equal sets are linked. A row with
    a null id takes part; a component of null ids alone has a null component_id.
    """
    rows = _prefixes(docs, id_col, text_col, n, percent)
    filled = rows.where("size > 0")
    named = F.min("id").alias("least"), F.first("bits").alias("bits"), F.count("*").alias("copies")
    sets = stored(filled.groupBy("sig", "size").agg(*named), "ngram-sets")
    # Prefixes, most of what there is, are not written a second time.
    postings = stored(_postings(_prefix_of_sets(filled, sets), percent), "ngram-postings")
    alike = sets.join(postings.select("sig").distinct(), "sig", "left_semi")
    bits = stored(alike.select("sig", "least", "copies", "bits"), "ngram-bits")
    whole = _whole_sets(docs, id_col, text_col, n, bits.select("sig", "least", "copies"))
    mine = F.col("sig").alias("root")
    todo = postings.where(F.col("turn") <= FIRST_POSTINGS).select("*", mine)
    done = roots = None
    for k in range(PROPOSAL_ROUNDS + 1):
        told = todo.join(bits.select("sig", "bits"), "sig")
        if k == 1:
            postings = stored(_live(told, percent).drop("root", "bits"), "ngram-postings")
            told = postings.join(todo.select("sig", "root").distinct(), "sig").join(bits.select("sig", "bits"), "sig")
        last = k == PROPOSAL_ROUNDS or (k > 1 and not found)
        pairs = _crossing(told, percent) if last else _proposals(told, percent, k, CANDIDATES if k else 1)
        if done is not None:
            pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        checked = stored(_verify(stored(_likely(pairs, whole, percent), "ngram-pairs"), whole, percent), "ngram-checked")
        done = checked if done is None else done.unionByName(checked)
        links = checked.where("linked").select("a", "b")
        found = not links.isEmpty()
        if found:
            # A component so far counts as the star of its root.
            stars = links if roots is None else links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
            roots = stored(components(stars, "a", "b"), "ngram-roots")
        if last:
            break
        if roots is not None:
            todo = stored(_open(postings, roots), "ngram-open")
        else:
            todo = postings.select("*", mine)
    if roots is None:
        roots = bits.select(F.col("sig").alias("node"), F.col("sig").alias("root"))
    roots = roots.withColumnRenamed("node", "sig")
    named = sets.select("sig", "least").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = named.select("sig", "root").join(least, "root").select("sig", "component_id")
    out = rows.select("id", "sig", F.col("size").alias("n_shingles")).join(by_set, "sig", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"))
