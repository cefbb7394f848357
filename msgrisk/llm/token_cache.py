"""Token counts with a digest cache.

A count depends on the content and on the tokenizer alone. The cache holds (digest, n_tokens) under one folder per
tokenizer version; the version is a digest of the model file, the library and its release. Contents are normalised
(null is the empty text) and named by their SHA-256. Known digests are joined to the stored counts; of the others each
distinct content is encoded once, whole, and appended. Where few digests are new, only their texts are shuffled.

Appending twice (two jobs at once, or a retry after a lost driver) leaves repeated equal rows, which reading merges.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache
from importlib.metadata import version as release

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from msgrisk.llm.tables import stored
from msgrisk.llm.tokens import pieces

_COUNTS = "digest binary, n_tokens bigint"
# Longer texts are encoded in parts where the model cannot merge across the cut.
PART_CHARS = 1 << 20
# New digests up to this number (32 bytes each) are sent to all tasks, so that stored texts are not shuffled.
BROADCAST_DIGESTS = 100_000
# A content is common if more than one row in this many has it, so there are fewer common ones than this.
COMMON_SHARE = 500
_CUT = re.compile(r"(?<=[^ ▁]) (?!\Z)")


def _library(path: str) -> str:
    kind = os.path.splitext(path)[1]
    if kind not in (".json", ".model"):
        raise ValueError(f"no tokenizer library for {path}")
    return {".json": "tokenizers", ".model": "sentencepiece"}[kind]


def tokenizer_version(path: str) -> str:
    """Digest of the model file, the library that reads it and that library's release."""
    name = _library(path)
    with open(path, "rb") as f:
        model = hashlib.file_digest(f, "sha256").hexdigest()
    return hashlib.sha256(f"{name} {release(name)} {model}".encode()).hexdigest()


def parts(text: str, limit: int = PART_CHARS) -> list[str]:
    """A long text cut before single blanks, each of which the next part leaves out for the one the model puts in front."""
    out = []
    while len(text) > limit:
        cut = _CUT.search(text, limit)
        if not cut:
            break
        out.append(text[:cut.start()])
        text = text[cut.end():]
    return [*out, text]


@cache
def _counter(path: str, expected: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts. The file must be the one that the driver named the cache after."""
    if tokenizer_version(path) != expected:
        raise RuntimeError(f"{path} or its library differs between machines")
    if _library(path) == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces_of = map(model.id_to_piece, range(model.vocab_size()))
        # Parts count alone if no piece holds a blank behind another character and blanks are neither added nor lost.
        apart = not any(re.search("[^▁]▁", p) for p in pieces_of) and model.normalize("  a  b ﬁ") == "▁▁▁a▁▁b▁ﬁ"

        def count(texts: list[str]) -> list[int]:
            cut = [parts(t) if apart and len(t) > PART_CHARS else [t] for t in texts]
            flat = iter(model.encode([p for c in cut for p in c], num_threads=1))
            return [sum(len(next(flat)) for _ in c) for c in cut]
    else:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()

        def count(texts: list[str]) -> list[int]:
            return [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    return count


def _encode(misses: DataFrame, path: str, expected: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, expected)
        for piece in pieces(batches, "text"):
            n = count(piece.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([piece.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return misses.select("digest", "text").mapInArrow(run, _COUNTS)


def cached_counts(spark, folder: str) -> DataFrame:
    """(digest, n_tokens) of one version's folder; none if nothing is stored yet."""
    try:
        found = spark.read.schema(_COUNTS).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COUNTS)
    return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache_folder: str, text_col: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """carry columns of every row with n_bytes (UTF-8) and n_tokens of the whole text; new counts go to the cache.

    tokenizer is a file that every machine has, cache_folder one that all share. Counts are the library's own, without
    begin, end or added special tokens, truncation or padding. Null counts as the empty text, which has no tokens.
    Repeated rows each get a row; a missing key stays null. An empty table leaves the cache as it was.
    """
    clash = {"n_bytes", "n_tokens", "digest"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    spark = docs.sparkSession
    expected = tokenizer_version(tokenizer)
    folder = f"{cache_folder.rstrip('/')}/{expected}"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    rows = stored(named.select("digest", F.octet_length("text").cast("bigint").alias("n_bytes"), *[f"c{i}" for i in range(len(carry))]), "token-rows")
    contents = stored(rows.groupBy("digest").agg(F.count("*").alias("n")), "token-contents")
    missing = stored(contents.select("digest").join(cached_counts(spark, folder), "digest", "left_anti"), "token-misses")
    n_missing = missing.count()
    once = lambda df: df.groupBy("digest").agg(F.any_value("text").alias("text"))
    if n_missing:
        texts = named.select("digest", "text")
        if n_missing <= BROADCAST_DIGESTS:
            new = once(texts.join(F.broadcast(missing), "digest", "left_semi"))
        else:
            # Copies meet in their tasks before the shuffle, so a text that most rows share is sent once a task.
            new = once(texts).join(missing, "digest", "left_semi")
        _encode(new, tokenizer, expected).write.mode("append").parquet(folder)
    counts = cached_counts(spark, folder)
    # Contents that many rows share get their counts by broadcast, the others by a shuffle.
    frequent = contents.where(F.col("n") * COMMON_SHARE > contents.agg(F.sum("n")).scalar()).select("digest")
    common = stored(counts.join(F.broadcast(frequent), "digest"), "token-common").withColumnRenamed("n_tokens", "known")
    placed = rows.join(F.broadcast(common), "digest", "left")
    rest = placed.where("known is null").drop("known").join(counts, "digest")
    counted = placed.where("known is not null").withColumnRenamed("known", "n_tokens").unionByName(rest)
    return counted.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "n_bytes", "n_tokens")
