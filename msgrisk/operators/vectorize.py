"""TF-IDF over word n-grams plus scaled manual features.

Fitting needs two aggregates over the training rows. Applying a fitted model is row by row: the
vocabulary holds at most `max_features` terms, so it travels with the model and nothing is shuffled.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import cached_property, reduce

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from msgrisk.constants import MANUAL_FEATURES, MANUAL_SCALE, VOCABULARY_SIZE
from msgrisk.functions.text import WORD
from msgrisk.session import materialised

# Hash buckets that bound the counts of terms. A task holds and sends that many sums at most.
SKETCH_BUCKETS = 1 << 20
# Characters of training text beyond which fitting counts terms by way of the sketch. Either way gives the same terms.
SKETCH_FROM_CHARS = 1 << 30


def word_tokens(clean_text: Column) -> Column:
    """Runs of word characters; brackets and combining marks separate."""
    return F.regexp_extract_all(clean_text, F.lit(f"([{WORD}]+)"), 1)


def joined_runs(tokens: Column, n: int) -> Column:
    """All runs of n neighbouring tokens, joined by spaces."""
    length = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    shifted = [F.slice(tokens, i + 1, length) for i in range(n)]
    return reduce(
        lambda left, right: F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(" "), b)), shifted
    )


def with_grams(df: DataFrame, text: str = "clean_text", ngrams: tuple[int, int] = (1, 2)) -> DataFrame:
    """Append grams: the n-grams of every size in the range."""
    if text not in df.columns:
        raise KeyError(f"Missing text column: {text}")
    staged = df.withColumn("_words", word_tokens(F.coalesce(F.col(text), F.lit(""))))
    runs = [joined_runs(F.col("_words"), n) for n in range(ngrams[0], ngrams[1] + 1)]
    return staged.withColumn("grams", F.concat(*runs)).drop("_words")


def _marked_terms(with_gram_column: DataFrame) -> DataFrame:
    """(term, last): every gram; the last copy of each in its row is marked by 1.

    Sorting a row's own grams brings its copies together, so document frequency is a sum beside the term frequency
    and no (row, term) pair is ever shuffled.
    """
    ordered = with_gram_column.select(F.sort_array("grams").alias("g"))
    following = F.slice(F.col("g"), 2, F.greatest(F.size("g"), F.lit(1)))
    marked = F.zip_with(
        F.col("g"),
        following,
        lambda a, b: F.struct(a.alias("term"), F.when(b.isNull() | (a != b), 1).otherwise(0).alias("last")),
    )
    # The plain form would have rows filtered by the size of their grams first, computed from the text once more.
    return ordered.select(F.inline_outer(marked)).where(F.col("term").isNotNull())


def _summed(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.count("*").alias("tf"), F.sum("last").alias("df"))


def term_counts(with_gram_column: DataFrame) -> DataFrame:
    """(term, tf, df) of all terms in one shuffle; partial sums keep hot terms cheap."""
    return _summed(_marked_terms(with_gram_column))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def top_terms(
    with_gram_column: DataFrame, max_features: int = VOCABULARY_SIZE, buckets: int = SKETCH_BUCKETS
) -> DataFrame:
    """(term, tf, df) of the most frequent terms; equal counts go by term. Exact, without a shuffle of all terms.

    A table of hash buckets with the sum of their terms' counts, of fixed size in every task, bounds each count from
    above. Only terms of heavy buckets are counted one by one. If the last of the chosen terms is as frequent as the
    lightest bucket looked into, no other term can be among them; else its count is the bound of a second recount,
    which settles it.
    """
    if max_features < 1:
        raise ValueError("at least one term is wanted")
    grams = with_gram_column.select("grams")
    hashed = grams.select(F.explode_outer("grams").alias("term")).where(F.col("term").isNotNull())
    sketch = materialised(hashed.groupBy(_bucket(F.col("term"), buckets).alias("bucket")).agg(F.count("*").alias("n")), "term-buckets")
    heaviest = sketch.orderBy(F.desc("n"), "bucket").limit(2 * max_features).agg(F.min("n").alias("n"), F.count("*").alias("k")).first()
    bound = heaviest.n if heaviest.k == 2 * max_features else 0
    while True:
        # At most `buckets` rows.
        heavy = F.broadcast(sketch.where(F.col("n") >= bound).select("bucket"))
        terms = _marked_terms(grams).withColumn("bucket", _bucket(F.col("term"), buckets))
        wanted = terms if not bound else terms.join(heavy, "bucket", "left_semi")
        top = materialised(vocabulary(_summed(wanted.drop("bucket")), max_features), "top-terms")
        last = top.agg(F.min("tf").alias("tf"), F.count("*").alias("k")).first()
        if not bound or last.k == max_features and last.tf >= bound:
            return top
        bound = last.tf if last.k == max_features else 0


def vocabulary(counts: DataFrame, max_features: int = VOCABULARY_SIZE) -> DataFrame:
    """The most frequent terms; equal counts go by term."""
    return counts.orderBy(F.desc("tf"), "term").limit(max_features)


def frequent_terms(with_gram_column: DataFrame, n_chars: int, max_features: int = VOCABULARY_SIZE) -> DataFrame:
    """top_terms of a text of about n_chars. All terms of a small text are one small shuffle, without a second reading."""
    if n_chars <= SKETCH_FROM_CHARS:
        return vocabulary(term_counts(with_gram_column), max_features)
    return top_terms(with_gram_column, max_features)


def idf(df: Column, n_rows: Column) -> Column:
    return F.log((n_rows + 1) / (df + 1)) + 1


def manual_columns(df: DataFrame, names=MANUAL_FEATURES) -> list[Column]:
    """The named features in order as doubles; absent columns and nulls are 0."""
    return [
        (F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in df.columns else F.lit(0.0)).alias(n)
        for n in names
    ]


def scaled(value: Column, low: Column, high: Column, factor: float = MANUAL_SCALE) -> Column:
    """Min-max scaling times factor. A constant feature becomes value - low; nothing is clipped."""
    width = F.coalesce(F.nullif(high - low, F.lit(0.0)), F.lit(1.0))
    return (value - low) / width * F.lit(factor)


@dataclass(frozen=True)
class FeatureModel:
    """Fitted vocabulary (in column order), idf weights and manual feature ranges."""

    terms: tuple[str, ...]
    idf: tuple[float, ...]
    manual: tuple[str, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    text: str = "clean_text"
    ngrams: tuple[int, int] = (1, 2)

    @staticmethod
    def fit(
        train: DataFrame,
        text: str = "clean_text",
        manual=MANUAL_FEATURES,
        max_features: int = VOCABULARY_SIZE,
        ngrams: tuple[int, int] = (1, 2),
    ) -> "FeatureModel":
        ranges = train.select(*manual_columns(train, manual), F.length(text).alias("_chars")).agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("_chars"), F.lit(0)).alias("chars"),
            *[F.min(n).alias(f"low_{n}") for n in manual],
            *[F.max(n).alias(f"high_{n}") for n in manual],
        ).first()
        top = frequent_terms(with_grams(train, text, ngrams), ranges["chars"], max_features)
        weighted = top.select("term", idf(F.col("df"), F.lit(ranges["n"])).alias("idf"))
        # At most max_features rows.
        rows = sorted(weighted.collect())
        if not rows:
            raise ValueError("empty vocabulary")
        return FeatureModel(
            tuple(r.term for r in rows),
            tuple(r.idf for r in rows),
            tuple(manual),
            tuple(ranges[f"low_{n}"] for n in manual),
            tuple(ranges[f"high_{n}"] for n in manual),
            text,
            tuple(ngrams),
        )

    @cached_property
    def _counter(self) -> CountVectorizerModel:
        """Handing thousands of terms to the JVM takes a while, so it is done once per model."""
        return _count_model(self.terms, "grams", "_tf")

    @property
    def size(self) -> int:
        return len(self.terms) + len(self.manual)

    @property
    def names(self) -> list[str]:
        return [*self.terms, *self.manual]

    @property
    def allowed_tokens(self) -> list[str]:
        """Vocabulary terms of one word."""
        return [t for t in self.terms if " " not in t]

    def names_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.names)), "idx int, term string")

    def text_vectors(self, df: DataFrame, output: str = "tfidf") -> DataFrame:
        """Append L2-normalised TF-IDF vectors; terms outside the vocabulary are ignored."""
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_weighted")
        unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=output)
        staged = with_grams(df, self.text, self.ngrams)
        return unit.transform(weigh.transform(self._counter.transform(staged))).drop("grams", "_tf", "_weighted")

    def scale_manual(self, df: DataFrame) -> DataFrame:
        """Replace the manual features by their scaled values."""
        values = manual_columns(df, self.manual)
        return df.withColumns({
            name: scaled(value, F.lit(low), F.lit(high))
            for name, value, low, high in zip(self.manual, values, self.low, self.high)
        })

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Append one vector: text weights, then scaled manual features."""
        kept = [c for c in df.columns]
        values = manual_columns(df, self.manual)
        staged = self.text_vectors(df, "_tfidf").withColumns({
            f"_m{i}": scaled(value, F.lit(low), F.lit(high))
            for i, (value, low, high) in enumerate(zip(values, self.low, self.high))
        })
        inputs = ["_tfidf", *[f"_m{i}" for i in range(len(self.manual))]]
        return VectorAssembler(inputCols=inputs, outputCol=output).transform(staged).select(*kept, output)

    def save(self, spark: SparkSession, path: str, mode: str = "error") -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "model string").coalesce(1).write.mode(mode).text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureModel":
        fields = json.loads(spark.read.text(path, wholetext=True).first()[0])
        return FeatureModel(**{k: tuple(v) if isinstance(v, list) else v for k, v in fields.items()})


def _count_model(terms, source: str, target: str, binary: bool = False) -> CountVectorizerModel:
    model = CountVectorizerModel.from_vocabulary(list(terms), inputCol=source, outputCol=target)
    return model.setBinary(binary)


def member_indices(df: DataFrame, source: str, members, target: str) -> DataFrame:
    """Append the sorted positions in `members` of a row's distinct tokens, by hash lookup per row."""
    counted = _count_model(members, source, "_members", binary=True).transform(df)
    return counted.withColumn(target, F.unwrap_udt("_members")["indices"]).drop("_members")


def long_weights(vectors: DataFrame, model: FeatureModel, key: str = "msg_id", column: str = "tfidf") -> DataFrame:
    """(key, term, weight), one row per non-zero entry. No shuffle: the name table is small."""
    entries = vectors.select(key, F.unwrap_udt(column).alias("_v")).select(
        key, F.inline_outer(F.arrays_zip(F.col("_v.indices").alias("idx"), F.col("_v.values").alias("weight")))
    ).where(F.col("idx").isNotNull())
    names = model.names_table(vectors.sparkSession)
    return entries.join(F.broadcast(names), "idx").select(key, "term", "weight")
