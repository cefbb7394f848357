"""Remove byte strings of LENGTH bytes that start in an earlier document as well, by sparse suffix sorting.

Not all suffixes are sorted. Every LENGTH-byte window picks an anchor inside itself from its own bytes alone
(its ANCHOR-byte substring of least hash, the first of several), so equal windows pick anchors at equal places, and
about two positions in LENGTH - ANCHOR + 2 are anchors.

1. Tasks send the hashes of anchors, packed by bucket. Buckets answer which hashes two documents have.
2. Documents compute their anchors again and send, for those hashes, the anchor with all bytes that can share a
   window with it. A task first combines equal contexts: all but the one of the least document are repeats.
3. Per bucket, equal contexts combine again. Where an anchor has several contexts, the windows around it are
   sorted as suffixes, deep-shallow: a multikey quicksort on 8-byte words to SHALLOW bytes, then, for groups that
   still share their prefix, blind tries, which compare every string with the first of its group only, branch at
   the first different byte, and never look at shared bytes again. Leaves of equal windows keep the least document;
   the windows of the others are repeats, in every place where their document has the same context.
4. The spans of a document are merged and cut out of its bytes.

Texts travel compressed. Hashes only propose; contexts and windows are compared as bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from msgrisk.llm.tokens import mix, pieces, raw
from msgrisk.session import scratch_path

LENGTH, ANCHOR = 50, 20
SIDE = LENGTH - ANCHOR
CONTEXT = ANCHOR + 2 * SIDE
SHALLOW = 16
RUN, STRINGS = 1 << 18, 1 << 16
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def anchors(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions of the anchors of all windows inside the texts that `starts` bounds."""
    room = np.zeros(len(data), bool)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        room[a:max(a, b - LENGTH + 1)] = True
    chosen = np.zeros(len(data), bool)
    width = LENGTH - ANCHOR + 1
    for s in range(0, max(0, len(data) - LENGTH + 1), RUN):
        part = data[s:s + RUN + LENGTH - 1]
        windows = len(part) - LENGTH + 1
        word = part.astype(np.uint64)
        for shift in (1, 2, 4):  # eight bytes from each position
            word = word[:-shift] | word[shift:] << np.uint64(8 * shift)
        seeds = len(part) - ANCHOR + 1
        h = word[:seeds] * _A ^ word[8:8 + seeds] * _B ^ word[ANCHOR - 8:ANCHOR - 8 + seeds] * _D
        h = (h ^ h >> np.uint64(29)) * _C
        least = h >> np.uint64(32) << np.uint64(32) | np.arange(seeds, dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:windows], least[width - span:width - span + windows])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        chosen[s + place[room[s:s + windows]]] = True
    return np.flatnonzero(chosen)


def anchor_hash(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """40-bit hash of the anchor at each position."""
    h = np.zeros(len(at), np.uint64)
    for low in (0, 8, ANCHOR - 8):
        if len(at):
            h = mix(h * _B + np.ascontiguousarray(data[at[:, None] + np.arange(low, low + 8)]).view(np.uint64).ravel())
    return h >> np.uint64(24)


def contexts(data: np.ndarray, starts: np.ndarray, at: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CONTEXT bytes around each anchor, zero outside its text, and how many bytes there are on the left and right."""
    left = np.minimum(SIDE, at - starts[of])
    right = np.minimum(SIDE, starts[of + 1] - at - ANCHOR)
    place = np.arange(CONTEXT) - SIDE
    index = np.clip(at[:, None] + place, 0, max(0, len(data) - 1))
    out = data[index]
    out[(place < -left[:, None]) | (place >= ANCHOR + right[:, None])] = 0
    return out, left, right


def _rows_hash(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, :rows.shape[1]] = rows
    words, h = padded.view(np.uint64), np.zeros(len(rows), np.uint64)
    for k in range(words.shape[1]):
        h = mix(h * _A + words[:, k])
    return h


def first_of_equal(group: np.ndarray, rows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row, the row of least doc with the same group and bytes."""
    code = _rows_hash(rows)
    order = np.lexsort((doc, code, group))
    fresh = np.ones(len(order), bool)
    same = (group[order][1:] == group[order][:-1]) & (rows[order][1:] == rows[order][:-1]).all(1)
    fresh[1:] = ~same
    leader = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    out = np.empty(len(order), np.int64)
    out[order] = leader
    return out


def deep_shallow(strings: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each string (a row of bytes), the row of least doc with an equal string.

    Shallow: multikey quicksort on words of 8 bytes. Deep: blind tries for the groups that are still tied.
    """
    n = len(strings)
    leader = np.arange(n)
    if not n:
        return leader
    order = np.argsort(doc, kind="stable")
    group = np.zeros(n, np.int64)
    for low in range(0, SHALLOW, 8):
        word = np.ascontiguousarray(strings[order, low:low + 8]).view(">u8").ravel().astype(np.uint64)
        step = np.lexsort((word, group))  # stable: least doc first inside a group
        order, word, group = order[step], word[step], group[step]
        fresh = np.r_[True, (word[1:] != word[:-1]) | (group[1:] != group[:-1])]
        group = np.cumsum(fresh) - 1
        tied = np.bincount(group)[group] > 1  # single strings have found their place
        order, group = order[tied], group[tied]
    while len(order):
        first = np.r_[True, group[1:] != group[:-1]]
        head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        differs = strings[order] != strings[head]
        depth = np.where(differs.any(1), differs.argmax(1), strings.shape[1])
        equal = depth == strings.shape[1]
        leader[order[equal]] = head[equal]
        order, group, depth = order[~equal], group[~equal], depth[~equal]
        branch = strings[order, depth]
        step = np.lexsort((branch, depth, group))
        order, group, depth, branch = order[step], group[step], depth[step], branch[step]
        if not len(order):
            break
        fresh = np.r_[True, (group[1:] != group[:-1]) | (depth[1:] != depth[:-1]) | (branch[1:] != branch[:-1])]
        group = np.cumsum(fresh) - 1
        tied = np.bincount(group)[group] > 1
        order, group = order[tied], group[tied]
    return leader


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """k (id and text in 64 bits), id (null: least) and z, the compressed bytes."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for piece in pieces(batches, "text"):
            z = [press.compress(t.encode()) if t else None for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("k"), piece.column("id"), pa.array(z, pa.binary())], ["k", "id", "z"])

    rows = docs.select(
        F.xxhash64(F.col(id_col).cast("string"), text_col).alias("k"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("id"), F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(pack, "k bigint, id bigint, z binary")


def _shared_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """k and the hashes of its anchors that other documents have."""
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "bucket int, hashes binary, places binary, keys binary"
    names = ["bucket", "hashes", "places", "keys"]

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            keys = piece.column("k").to_numpy()
            starts, data = raw(piece.column("text").fill_null(""))
            at = anchors(data, starts)
            if not len(at):
                continue
            code, of = anchor_hash(data, at), np.searchsorted(starts, at, side="right") - 1
            bucket = (mix(code) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((of, code, bucket))
            code, of, bucket = code[order], of[order], bucket[order]
            fresh = np.r_[True, (code[1:] != code[:-1]) | (of[1:] != of[:-1])]
            code, of, bucket = code[fresh], of[fresh], bucket[fresh]
            rows = []
            bounds = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            for a, b in zip(bounds[:-1], bounds[1:]):
                used, place = np.unique(of[a:b], return_inverse=True)
                c = code[a:b]
                hashes = (c >> np.uint64(8)).astype(np.uint32).tobytes() + c.astype(np.uint8).tobytes()
                rows.append((int(bucket[a]), hashes, place.astype(np.uint32 if len(used) > 65536 else np.uint16).tobytes(), keys[used].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names)

    def answer(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, docs_of = [], []
        for batch in batches:
            for hashes, places, keys in zip(*(batch.column(c) for c in names[1:])):
                hashes, keys = hashes.as_buffer(), np.frombuffer(keys.as_buffer(), np.int64)
                n = len(hashes) // 5
                codes.append(np.frombuffer(hashes, np.uint32, n).astype(np.uint64) << np.uint64(8) | np.frombuffer(hashes, np.uint8, n, 4 * n))
                places = places.as_buffer()
                docs_of.append(keys[np.frombuffer(places, np.uint16 if len(places) == 2 * n else np.uint32)])
        code, doc = np.concatenate(codes), np.concatenate(docs_of)
        order = np.argsort(code, kind="stable")
        code, doc = code[order], doc[order]
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        two = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        keep = np.repeat(two, np.diff(np.r_[first, len(code)]))
        yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(code[keep].view(np.int64))], ["k", "code"])

    rows = docs.select(F.xxhash64(F.col(id_col).cast("string"), text_col).alias("k"), F.col(text_col).alias("text"))
    packed = rows.mapInArrow(send, kind)
    return packed.groupBy("bucket").applyInArrow(answer, "k bigint, code bigint").groupBy("k").agg(F.collect_set("code").alias("codes"))


def _mark(spans: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Cover all windows around the anchors (positions in the whole array)."""
    for a, x, y in zip(at.tolist(), left.tolist(), right.tolist()):
        if x + y + ANCHOR >= LENGTH:
            spans[a - x:a + ANCHOR + y] = True


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return edges[::2], edges[1::2]


_OUT = "k bigint, id bigint, at bigint, size int, bucket int, context binary"


def _send_contexts(joined: DataFrame, buckets: int) -> DataFrame:
    """Rows with a context (bucket >= 0, size = 100 * left + right) and rows with a span of repeats (bucket -1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                texts = pa.array([expand.decompress(z.as_py()) for z in part.column("z")], pa.large_binary())
                starts, data = raw(texts)
                at = anchors(data, starts)
                lists = part.column("codes")
                wanted = np.unique(lists.flatten().to_numpy().view(np.uint64))
                code = anchor_hash(data, at)
                hit = wanted[np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)] == code
                at, code = at[hit], code[hit]
                of = np.searchsorted(starts, at, side="right") - 1
                ids, keys = part.column("id").to_numpy(), part.column("k").to_numpy()
                rows, left, right = contexts(data, starts, at, of)
                size = 100 * left + right
                lead = first_of_equal(size, rows, ids[of])
                repeat = ids[of][lead] < ids[of]
                covered = np.zeros(len(data), bool)
                _mark(covered, at[repeat], left[repeat], right[repeat])
                low, high = [], []
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):  # spans end with their text
                    x, y = _runs(covered[a:b])
                    low.append(x)
                    high.append(y)
                n_spans = [len(x) for x in low]
                span_of = np.repeat(np.arange(len(keys)), n_spans)
                low, high = np.concatenate(low), np.concatenate(high)
                # Equal contexts of one document are sent once each; those of the least document stand for all.
                send = np.flatnonzero(~repeat & ((lead == np.arange(len(at))) | (ids[of][lead] == ids[of])))
                bucket = (mix(code[send]) % np.uint64(buckets)).astype(np.int32)
                flat = np.ascontiguousarray(rows[send])
                offsets = np.arange(len(send) + 1, dtype=np.int32) * CONTEXT
                held = pa.BinaryArray.from_buffers(pa.binary(), len(send), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[of[send]]), pa.array(ids[of[send]]), pa.array(at[send] - starts[of[send]]),
                    pa.array(size[send].astype(np.int32)), pa.array(bucket), held,
                ], ["k", "id", "at", "size", "bucket", "context"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[span_of]), pa.array(ids[span_of]), pa.array(low), pa.array((high - low).astype(np.int32)),
                    pa.array(np.full(len(low), -1, np.int32)), pa.nulls(len(low), pa.binary()),
                ], ["k", "id", "at", "size", "bucket", "context"])

    return joined.select("k", "id", "z", "codes").mapInArrow(run, _OUT)


def _compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeats among the contexts of a bucket."""
    held = [b for b in batches if b.num_rows]
    k, ids, at, size = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("k", "id", "at", "size"))
    rows = np.concatenate([raw(b.column("context"))[1] for b in held]).reshape(-1, CONTEXT)
    left, right = size // 100, size % 100
    out = []

    def found(which, low, high):
        out.append(pa.RecordBatch.from_arrays([pa.array(k[which]), pa.array(low), pa.array((high - low).astype(np.int32))], ["k", "at", "size"]))

    lead = first_of_equal(size, rows, ids)
    repeat = np.flatnonzero(ids[lead] < ids)
    long = repeat[(left + right + ANCHOR)[repeat] >= LENGTH]
    found(long, (at - left)[long], (at + ANCHOR + right)[long])
    # One of each context is left, and stands for the equal ones of its document; anchors with one context are done.
    twins = np.flatnonzero(ids[lead] == ids)
    twins = twins[np.argsort(lead[twins], kind="stable")]
    stands = lead[twins]
    rest = np.flatnonzero(lead == np.arange(len(lead)))
    _, anchor = np.unique(_rows_hash(rows[rest, SIDE:SIDE + ANCHOR]), return_inverse=True)
    many = np.bincount(anchor)[anchor] > 1
    rest, anchor = rest[many], anchor[many]
    order = np.argsort(anchor, kind="stable")
    rest, anchor = rest[order], anchor[order]
    # Whole anchors at a time, so that memory is bounded by the contexts of one anchor.
    firsts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True]) if len(rest) else np.zeros(1, int)
    per_part = max(1, STRINGS // (SIDE + 1))
    cut = 0
    while cut < len(firsts) - 1:
        stop = max(cut + 1, int(np.searchsorted(firsts, firsts[cut] + per_part, side="right")) - 1)
        part = rest[firsts[cut]:firsts[stop]]
        cut = stop
        before = np.tile(np.arange(SIDE + 1), len(part))  # bytes of the window left of the anchor
        of = np.repeat(part, SIDE + 1)
        inside = (before <= left[of]) & (SIDE - before <= right[of])
        before, of = before[inside], of[inside]
        strings = rows[of[:, None], (SIDE - before)[:, None] + np.arange(LENGTH)]
        # Windows with unlike anchors inside never match, and equal windows have their anchor at the same place.
        best = deep_shallow(strings, ids[of])
        dup = np.flatnonzero(ids[of[best]] < ids[of])
        low = at[of[dup]] - before[dup]
        order = np.lexsort((low, of[dup]))
        low, mine = low[order], of[dup][order]
        new = np.r_[True, (mine[1:] != mine[:-1]) | (low[1:] != low[:-1] + 1)] if len(low) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(low)] - 1 if len(first) else first
        low, high, mine = low[first], low[last] + LENGTH, mine[first]
        begin = np.searchsorted(stands, mine)
        n = np.searchsorted(stands, mine, side="right") - begin
        which = twins[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())]
        shift = at[which] - np.repeat(at[mine], n)
        found(which, np.repeat(low, n) + shift, np.repeat(high, n) + shift)
    yield from out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 of every row; with_text adds the remaining bytes as `kept`.

    A byte goes if a string of LENGTH bytes that covers it also starts in a row with a smaller id. Null and empty
    texts have 0 bytes. A null id counts as smaller than all others; rows with equal ids never remove each other.
    `kept` can begin or end inside a character. Ids are integers.
    """
    packed = _keyed(docs, id_col, text_col)
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    codes = _shared_hashes(docs, id_col, text_col)
    once = packed.where("z is not null").join(codes, "k")
    path = scratch_path(docs.sparkSession, "suffix-contexts")
    _send_contexts(once, buckets).write.option("compression", "zstd").parquet(path)
    sent = docs.sparkSession.read.schema(_OUT).parquet(path)
    spans = sent.where("bucket < 0").select("k", "at", "size").unionByName(
        sent.where("bucket >= 0").groupBy("bucket").applyInArrow(_compare, "k bigint, at bigint, size int")
    )
    gone = spans.groupBy("k").agg(F.collect_list(F.struct("at", "size")).alias("spans"))
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_text else "")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            lists = batch.column("spans")
            for k in range(batch.num_rows):
                z = batch.column("z")[k].as_py()
                data = expand.decompress(z) if z else b""
                if not lists[k].is_valid:
                    rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data))
                    continue
                flat = lists[k].values
                low, size = flat.field("at").to_numpy(), flat.field("size").to_numpy()
                steps = np.zeros(len(data) + 1, np.int64)
                np.add.at(steps, low, 1)
                np.add.at(steps, low + size, -1)
                flags = np.cumsum(steps[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~flags].tobytes()
                rows.append((len(data), int(flags.sum()), len(_runs(flags)[0]), hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*rows))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds)][:5 if with_text else 4]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *arrays], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
            )

    out = packed.join(gone, "k", "left").select("id", "z", "spans").mapInArrow(cut, schema)
    real = F.when(F.col("id") != -(2**63), F.col("id")).cast(docs.schema[id_col].dataType)
    return out.select(real.alias(id_col), *[c for c in out.columns if c != "id"])
