"""One query per operator over the given tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from msgrisk.constants import FLAG_ITEMS, MANUAL_FEATURES, TOP_KEYWORDS
from msgrisk.functions import scoring
from msgrisk.functions.arrays import squared_distance
from msgrisk.functions.labels import coerce_label
from msgrisk.functions.text import (
    capital_ratio, message_features, normalized, preprocess, safe_text, tokenize,
)
from msgrisk.operators import clustering as cl, dedupe, imbalance, metrics, projection, rules as ru, sampling
from msgrisk.operators import vectorize as ve
from msgrisk.operators.bagging import bag_class_weights
from msgrisk.operators.neighbours import nearest_neighbours
from msgrisk.operators.forest import feature_importance as importance_table, fit_forest, with_forest_scores
from msgrisk.operators.pairwise import width_of
from msgrisk.plans import report as reporting, training
from msgrisk.plans.scoring import OUTPUT, score_messages
from msgrisk.session import materialised, scratch_path
from msgrisk.sources import sinks
from msgrisk.sources.csv import read_csv
from msgrisk.sources.messages import load_email, load_sms
from msgrisk.streaming import messages as streaming, refresh
from msgrisk.streaming.dedupe import dedupe_by_rank
from workload import inputs

DIGITS = 6
BAGS = 10


def rounded(name: str):
    return F.round(name, DIGITS).alias(name)


def joined(name: str, separator: str = "|"):
    return F.array_join(name, separator).alias(name)


# --- sources and sinks -------------------------------------------------------------------------

CSV_OUT = dict(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written in Latin-1 where they fit it and in UTF-8 otherwise, read as one table."""
    documents = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    fits = F.col("text").rlike(r"^[\x00-\xff]*$")
    paths = []
    for encoding, rows in (("ISO-8859-1", documents.filter(fits)), ("UTF-8", documents.filter(~fits))):
        paths.append(scratch_path(spark, "csv"))
        rows.write.csv(paths[-1], encoding=encoding, **CSV_OUT)
    return read_csv(spark, paths).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5")
    )


def csv_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as quoted cells between short and over-long rows."""
    key = F.col("doc_id").cast("string")
    quoted = F.concat(F.lit('"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    kind = F.col("doc_id") % 4
    line = (
        F.when(kind == 0, F.concat(F.lit("ham"), key))
        .when(kind == 1, F.concat(F.lit("spam,"), quoted, F.lit(",b")))
        .when(kind == 2, F.concat(F.lit("ham,"), key, F.lit(",")))
        .otherwise(F.concat(F.lit("spam,"), quoted))
    )
    path = scratch_path(spark, "csv-lines")
    lines = inputs.spread(inputs.table(spark, sf_dir, "documents")).select(line.alias("value"))
    # One file per task, each with its own heading.
    numbered = lines.withColumn("file", F.spark_partition_id()).select("file", F.lit(1).alias("at"), "value")
    headings = numbered.select("file").distinct().select("file", F.lit(0).alias("at"), F.lit("v1,v2").alias("value"))
    rows = headings.unionByName(numbered).repartition("file").sortWithinPartitions("file", "at")
    rows.select("file", "value").write.partitionBy("file").text(path)
    return read_csv(spark, path).select("v1", F.md5("v2").alias("v2_md5"))


def _as_csv(df: DataFrame, names: dict[str, str]) -> str:
    path = scratch_path(df.sparkSession, "messages")
    df.select(*[F.col(old).alias(new) for old, new in names.items()]).write.csv(path, **CSV_OUT)
    return path


def load_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sms = _as_csv(inputs.sms_table(spark, sf_dir), {"msg_id": "id", "label": "V1", "text": "v2"})
    email = _as_csv(inputs.email_table(spark, sf_dir), {"msg_id": "id", "text": "Email Text", "label": "Email Type"})
    loaded = load_sms(spark, sms, id_column="id").unionByName(load_email(spark, email, id_column="id"))
    return loaded.select("msg_id", "source", "label", F.md5("text").alias("text_md5"))


def _merged(spark, sf_dir) -> DataFrame:
    return dedupe.merge_sources(inputs.sms_table(spark, sf_dir), inputs.email_table(spark, sf_dir), keep_ids=True)


def merge_sources(spark, sf_dir):
    return _merged(spark, sf_dir).select("msg_id", "source", "source_rank", F.md5("text").alias("text_md5"))


def dedupe_messages(spark, sf_dir):
    return dedupe.dedupe_messages(_merged(spark, sf_dir)).select("msg_id", "source", F.md5("text").alias("text_md5"))


def dataset_summary(spark, sf_dir):
    merged = _merged(spark, sf_dir)
    return dedupe.dataset_summary(merged, dedupe.dedupe_messages(merged))


def label_counts(spark, sf_dir):
    return dedupe.label_counts(inputs.labelled(spark, sf_dir))


# --- text --------------------------------------------------------------------------------------

SPELLINGS = ("spam", " FRAUD ", "Scam", "phishing\t", "Lừa đảo", "1", "ham", "legit", "Safe", "hợp lệ", "0",
             "1.0", "2", "Safe Email")


def coerce_labels(spark, sf_dir):
    """Documents labelled by spellings in turn; unknown ones give -1."""
    spelling = F.array(*map(F.lit, SPELLINGS))
    raw = F.get(spelling, (F.col("doc_id") % len(SPELLINGS)).cast("int"))
    return inputs.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("msg_id"), F.coalesce(coerce_label(raw, strict=False), F.lit(-1)).alias("y")
    )


def normalize_text(spark, sf_dir):
    return normalized(inputs.all_messages(spark, sf_dir)).select("msg_id", "normalized")


def tokens(spark, sf_dir):
    return (
        normalize_text(spark, sf_dir).withColumn("t", tokenize(F.col("normalized")))
        .select("msg_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))
    )


def preprocessed(spark, sf_dir):
    return preprocess(inputs.all_messages(spark, sf_dir)).select(
        "msg_id", "token_count", F.md5("clean_text").alias("clean_md5"), *MANUAL_FEATURES
    )


def features(spark, sf_dir):
    return message_features(inputs.all_messages(spark, sf_dir)).select("msg_id", *MANUAL_FEATURES)


def caps_ratio_raw(spark, sf_dir):
    ratio = F.round(capital_ratio(safe_text(F.col("text"))), DIGITS)
    return inputs.all_messages(spark, sf_dir).select("msg_id", ratio.alias("ratio"))


def feature_profile(spark, sf_dir):
    """Mean of each manual feature per label, beside the raw capital ratio and token count."""
    rows = preprocess(inputs.labelled(spark, sf_dir)).withColumn("caps_ratio", capital_ratio(F.col("text")))
    names = [*MANUAL_FEATURES, "caps_ratio", "token_count"]
    return rows.groupBy("label").agg(
        F.count("*").alias("n"), *[F.round(F.avg(n), DIGITS).alias(f"avg_{n}") for n in names]
    )


# --- rows, splits, samples ---------------------------------------------------------------------

def fraud_rows(spark, sf_dir):
    return cl.fraud_rows(inputs.labelled(spark, sf_dir)).select("msg_id", "y")


def cluster_source(spark, sf_dir):
    return cl.cluster_source(inputs.labelled(spark, sf_dir)).select("msg_id", "y")


def class_weights(spark, sf_dir):
    return imbalance.class_weights(inputs.labelled(spark, sf_dir)).select("y", rounded("weight"))


def bag_weights(spark, sf_dir):
    """Rows of each class in ten bootstraps of the labelled documents, and the class weights inside them."""
    return bag_class_weights(inputs.labelled(spark, sf_dir), BAGS).select("bag", "y", "n", rounded("weight"))


def hash_split(spark, sf_dir):
    return sampling.hash_split(inputs.labelled(spark, sf_dir)).select("msg_id", "fold")


def stratified_split(spark, sf_dir):
    return sampling.stratified_split(inputs.labelled(spark, sf_dir)).select("msg_id", "y", "fold")


def capped_sample(spark, sf_dir):
    """The metric sample of the notices, turns and documents together."""
    return sampling.capped_sample(inputs.all_messages(spark, sf_dir).select("msg_id"), 10_000)


# --- vectors -----------------------------------------------------------------------------------

def _prepared(spark, sf_dir) -> DataFrame:
    return preprocess(inputs.labelled(spark, sf_dir))


def _all_prepared(spark, sf_dir) -> DataFrame:
    return preprocess(inputs.all_documents(spark, sf_dir))


def manual_features_scaled(spark, sf_dir):
    """Ranges from the training fold, applied to all rows."""
    rows = sampling.hash_split(_prepared(spark, sf_dir).select("msg_id", *MANUAL_FEATURES))
    train = rows.filter("fold = 'train'")
    bounds = train.agg(F.struct(
        *[F.min(n).alias(f"low_{n}") for n in MANUAL_FEATURES], *[F.max(n).alias(f"high_{n}") for n in MANUAL_FEATURES]
    )).scalar()
    return rows.select("msg_id", *[
        F.round(ve.scaled(F.col(n), bounds[f"low_{n}"], bounds[f"high_{n}"]), DIGITS).alias(n) for n in MANUAL_FEATURES
    ])


def tfidf_tokens(spark, sf_dir):
    return _all_prepared(spark, sf_dir).select("msg_id", ve.word_tokens(F.col("clean_text")).alias("t")).select(
        "msg_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens_md5")
    )


def ngrams(spark, sf_dir):
    return ve.with_grams(_all_prepared(spark, sf_dir)).select(
        "msg_id", F.size("grams").alias("n"), F.md5(F.array_join("grams", "|")).alias("grams_md5")
    )


def vocabulary(spark, sf_dir):
    n_chars = inputs.labelled(spark, sf_dir).agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return ve.frequent_terms(ve.with_grams(_prepared(spark, sf_dir)), n_chars)


def _fitted(spark, sf_dir) -> tuple[ve.FeatureModel, DataFrame]:
    rows = materialised(_prepared(spark, sf_dir).drop("text"), "prepared")
    return ve.FeatureModel.fit(rows), rows


def feature_names(spark, sf_dir):
    model, _ = _fitted(spark, sf_dir)
    return model.names_table(spark)


def tfidf_weights(spark, sf_dir):
    model, rows = _fitted(spark, sf_dir)
    return ve.long_weights(model.text_vectors(rows), model).select("msg_id", "term", rounded("weight"))


def tfidf_transform(spark, sf_dir):
    """Fitted on the training fold, applied to the test fold."""
    rows = sampling.hash_split(materialised(_prepared(spark, sf_dir).drop("text"), "prepared"))
    model = ve.FeatureModel.fit(rows.filter("fold = 'train'"))
    return ve.long_weights(model.text_vectors(rows.filter("fold = 'test'")), model).select(
        "msg_id", "term", rounded("weight")
    )


def _vector_shape(df, column):
    inner = F.unwrap_udt(column)
    values = inner["values"]
    return df.select(
        "msg_id",
        F.coalesce(inner["size"], F.size(values)).alias("size"),
        F.size(F.filter(values, lambda v: v != 0)).alias("nnz"),
        F.round(F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, v: s + v * v)), DIGITS).alias("l2norm"),
    )


def tfidf_vectors(spark, sf_dir):
    model, rows = _fitted(spark, sf_dir)
    return _vector_shape(model.text_vectors(rows), "tfidf")


def feature_vectors(spark, sf_dir):
    model, rows = _fitted(spark, sf_dir)
    return _vector_shape(model.transform(rows), "features")


# --- rules -------------------------------------------------------------------------------------

def _transactions(spark, sf_dir) -> DataFrame:
    """Transactions of the fraud rows over the vocabulary of all labelled rows."""
    model, rows = _fitted(spark, sf_dir)
    return ru.build_transactions(cl.fraud_rows(rows), extra_items=FLAG_ITEMS, allowed_tokens=model.allowed_tokens)


def transactions(spark, sf_dir):
    return _transactions(spark, sf_dir).select("msg_id", F.size("items").alias("n"), joined("items", " "))


def frequent_itemsets(spark, sf_dir):
    return ru.frequent_itemsets(_transactions(spark, sf_dir)).select(
        joined("items"), F.round(F.col("n") / F.col("n_rows"), DIGITS).alias("support")
    )


def _rules(spark, sf_dir) -> DataFrame:
    return ru.association_rules(ru.frequent_itemsets(_transactions(spark, sf_dir)))


def _shown(rules: DataFrame) -> DataFrame:
    return rules.select(joined("antecedents"), joined("consequents"), *map(rounded, ("support", "confidence", "lift")))


def association_rules(spark, sf_dir):
    return _shown(_rules(spark, sf_dir))


def top_rules(spark, sf_dir):
    """Equal rules are ordered by the digits shown, then by items."""
    return ru.top_rules(_shown(_rules(spark, sf_dir)))


def rule_hits(spark, sf_dir):
    """Rules of the labelled fraud rows met by every document."""
    return ru.rule_hits(_all_prepared(spark, sf_dir), _rules(spark, sf_dir)).select("msg_id", "rule_hits")


# --- evaluation --------------------------------------------------------------------------------

def _judged(spark, sf_dir) -> DataFrame:
    rows = inputs.with_probability(inputs.labelled(spark, sf_dir))
    return rows.withColumn("pred", (F.col("fraud_probability") >= 0.5).cast("int"))


def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_judged(spark, sf_dir))


def classification_report(spark, sf_dir):
    report = metrics.classification_report(metrics.confusion_matrix(_judged(spark, sf_dir)))
    return report.select("label", "metric", rounded("value"))


def roc_auc(spark, sf_dir):
    return metrics.roc_auc(_judged(spark, sf_dir)).select(rounded("auc"))


# --- clusters ----------------------------------------------------------------------------------

def _centres(vectors: DataFrame) -> DataFrame:
    """Fixed centres: the mean of each label."""
    return cl.centroids(vectors, "label", "x").select(
        F.col("label").alias("cluster_id"), F.col("centroid").alias("centre")
    )


def assign_clusters(spark, sf_dir):
    vectors = inputs.vectors(spark, sf_dir)
    return cl.assign_clusters(vectors, _centres(vectors), "x").select("vec_id", "cluster_id")


def cluster_sizes(spark, sf_dir):
    vectors = inputs.vectors(spark, sf_dir)
    return cl.cluster_sizes(cl.assign_clusters(vectors, _centres(vectors), "x"))


def inertia(spark, sf_dir):
    vectors = inputs.vectors(spark, sf_dir)
    centres = _centres(vectors)
    return cl.inertia(cl.assign_clusters(vectors, centres, "x"), centres, "cluster_id", "x").select(rounded("value"))


def silhouette_exact(spark, sf_dir):
    return cl.silhouette_exact(inputs.vectors(spark, sf_dir), "vec_id", "label", "x").select(rounded("value"))


def davies_bouldin(spark, sf_dir):
    return cl.davies_bouldin(cl.dispersion(inputs.vectors(spark, sf_dir), "label", "x"), "label").select(rounded("value"))


def calinski_harabasz(spark, sf_dir):
    return cl.calinski_harabasz(cl.dispersion(inputs.vectors(spark, sf_dir), "label", "x")).select(rounded("value"))


def _quality(spark, sf_dir):
    vectors = inputs.vectors(spark, sf_dir)
    centres = _centres(vectors).withColumnRenamed("cluster_id", "label")
    cost = cl.inertia(vectors, centres, "label", "x").scalar()
    return cl.cluster_quality(vectors, cost, "vec_id", "label", "x", exact=True)


def cluster_quality(spark, sf_dir):
    return _quality(spark, sf_dir)


def quality_table(spark, sf_dir):
    return sinks.quality_table(_quality(spark, sf_dir))


def cluster_risk(spark, sf_dir):
    return cl.cluster_risk(inputs.with_cluster(inputs.labelled(spark, sf_dir))).select("cluster_id", rounded("cluster_risk"))


def _grouped(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Labelled rows with a given cluster, and the centres in long form."""
    rows = materialised(inputs.with_cluster(_prepared(spark, sf_dir)), "grouped")
    model = ve.FeatureModel.fit(rows)
    return rows, cl.mean_term_weights(model.text_vectors(rows), model.names_table(spark))


def cluster_keywords(spark, sf_dir):
    _, centre_weights = _grouped(spark, sf_dir)
    return cl.cluster_keywords(centre_weights).select("cluster_id", "term", rounded("weight"), "rank")


def cluster_examples(spark, sf_dir):
    return sampling.cluster_examples(inputs.with_cluster(inputs.all_documents(spark, sf_dir)))


def _report(spark, sf_dir) -> DataFrame:
    rows, centre_weights = _grouped(spark, sf_dir)
    return cl.cluster_report(rows, centre_weights)


def cluster_report(spark, sf_dir):
    return _report(spark, sf_dir).select(
        "cluster_id", "suggested_name", "n_samples", joined("top_keywords"), F.md5(F.array_join("examples", "|")).alias("examples_md5")
    )


def cluster_table(spark, sf_dir):
    return sinks.cluster_table(_report(spark, sf_dir))


def cluster_markdown(spark, sf_dir):
    return sinks.cluster_markdown(_report(spark, sf_dir))


# --- imbalance ---------------------------------------------------------------------------------

def smote_neighbors(spark, sf_dir):
    return nearest_neighbours(inputs.vectors(spark, sf_dir), "vec_id", "x", imbalance.NEIGHBOURS).select(
        "vec_id", "nn_id", "nn_rank", rounded("distance")
    )


def smote_rows(spark, sf_dir):
    rows = inputs.vectors(spark, sf_dir)
    made = imbalance.synthetic_rows(materialised(rows, "vectors"), "label", "vec_id", "x")
    return made.select("synth_id", "label", "nn_id", F.posexplode("x").alias("pos", "value")).select(
        "synth_id", "label", "nn_id", "pos", rounded("value")
    )


# --- scores ------------------------------------------------------------------------------------

def _scored_input(spark, sf_dir) -> DataFrame:
    return inputs.with_probability(inputs.with_cluster(_all_prepared(spark, sf_dir)))


def _risks(spark, sf_dir) -> DataFrame:
    return cl.cluster_risk(inputs.with_cluster(inputs.labelled(spark, sf_dir)).select("cluster_id", "y"))


def risk_score(spark, sf_dir):
    """Cluster risk from the language and hits from the id, over the whole table."""
    rows = inputs.with_probability(inputs.with_cluster(inputs.all_documents(spark, sf_dir)))
    score = scoring.risk_score(F.col("fraud_probability"), F.col("cluster_id") / 3.0, F.col("msg_id") % 8)
    return rows.select("msg_id", F.round(score, DIGITS).alias("risk_score"))


def severity(spark, sf_dir):
    rows = inputs.with_probability(inputs.with_cluster(inputs.all_documents(spark, sf_dir)))
    score = scoring.risk_score(F.col("fraud_probability"), F.col("cluster_id") / 3.0, F.col("msg_id") % 8)
    return rows.select("msg_id", scoring.severity(F.round(score, DIGITS)).alias("severity"))


def _scored(spark, sf_dir) -> DataFrame:
    return score_messages(_scored_input(spark, sf_dir), _risks(spark, sf_dir), _rules(spark, sf_dir))


def scored(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "msg_id", F.md5("text").alias("text_md5"), *OUTPUT[1:3], rounded("risk_score"), "severity"
    )


def alerts(spark, sf_dir):
    return _scored(spark, sf_dir).select("msg_id", rounded("risk_score"), "severity", joined("reasons"))


# --- fitted models -----------------------------------------------------------------------------

def _model_vectors(spark, sf_dir) -> DataFrame:
    rows = inputs.vectors(spark, sf_dir).select("vec_id", "label", array_to_vector("x").alias("features"))
    return materialised(rows, "model-vectors")


def kmeans_fit(spark, sf_dir):
    """Centres of the best of ten fits, with their sizes."""
    rows = _model_vectors(spark, sf_dir).persist()
    model = cl.fit_kmeans(rows, 5)
    sizes = cl.cluster_sizes(model.transform(rows))
    return cl.centre_table(model, spark).join(sizes, "cluster_id").select(
        "cluster_id", "n", F.round(F.sqrt(squared_distance(F.col("centre"), F.transform("centre", lambda v: F.lit(0.0)))), DIGITS).alias("centre_norm")
    )


def k_sweep(spark, sf_dir):
    rows = _model_vectors(spark, sf_dir).persist()
    models = cl.fit_kmeans_many(rows, cl.sweep_values(range(2, 6), rows.count()))
    return cl.k_sweep(rows, models, key="vec_id", exact=True).select("k", rounded("inertia"), rounded("silhouette"))


def silhouette_fast(spark, sf_dir):
    return cl.silhouette_fast(inputs.vectors(spark, sf_dir), "label", "x").select(rounded("value"))


def pca_2d(spark, sf_dir):
    return projection.pca_coordinates(inputs.vectors(spark, sf_dir), "vec_id", "x")


def pca_norms(spark, sf_dir):
    """All components together keep each row's squared distance to the mean, whatever their signs."""
    vectors = inputs.vectors(spark, sf_dir)
    width = width_of(vectors, "x")
    axes = [F.col(f"pc{i + 1}") for i in range(width)]
    whole = projection.pca_coordinates(vectors, "vec_id", "x", width)
    return whole.select("vec_id", F.aggregate(F.array(*axes), F.lit(0.0), lambda a, x: a + x * x).alias("norm")).select("vec_id", rounded("norm"))


def svd_project(spark, sf_dir):
    coordinates, values = projection.svd_coordinates(inputs.vectors(spark, sf_dir), "vec_id", "x", 10)
    return coordinates.select("vec_id", F.posexplode("coords").alias("component", "value"))


def _forest(spark, sf_dir, bags: int | None = None):
    """A forest fitted on the training fold and the vectors of the test fold."""
    rows = sampling.stratified_split(materialised(_prepared(spark, sf_dir).drop("text"), "prepared"))
    rows = materialised(rows, "split")
    model = ve.FeatureModel.fit(rows.filter("fold = 'train'"))
    forest = fit_forest(model.transform(rows.filter("fold = 'train'")), bags=bags)
    return model, forest, model.transform(rows.filter("fold = 'test'"))


def rf_scores(spark, sf_dir):
    _, forest, test = _forest(spark, sf_dir)
    return with_forest_scores(forest, test).select("msg_id", "y", "fraud_probability", "pred")


def rf_bagged_scores(spark, sf_dir):
    """Scores of a forest whose bootstraps are balanced one by one."""
    _, forest, test = _forest(spark, sf_dir, BAGS)
    return with_forest_scores(forest, test).select("msg_id", "y", "fraud_probability", "pred")


def feature_importance(spark, sf_dir):
    model, forest, _ = _forest(spark, sf_dir)
    return importance_table(forest, model.names, spark)


def _fit(spark, sf_dir):
    return training.fit(inputs.labelled(spark, sf_dir).drop("y"))


def fit_summary(spark, sf_dir):
    return training.summary_table(_fit(spark, sf_dir)[1])


def predict_messages(spark, sf_dir):
    """A model of the labelled rows applied to every message."""
    model, _ = _fit(spark, sf_dir)
    return model.predict(inputs.all_messages(spark, sf_dir)).withColumn("text", F.md5("text"))


def run_report(spark, sf_dir):
    """Both sources merged, de-duplicated, fitted and reported."""
    merged = dedupe.merge_sources(inputs.sms_table(spark, sf_dir), inputs.email_table(spark, sf_dir))
    deduped = materialised(dedupe.dedupe_messages(merged), "deduped")
    model, summary = training.fit(deduped)
    views = reporting.cluster_views(model, deduped)
    report = reporting.run_report(merged, deduped, summary, views.report)
    reporting.export(views, report, scratch_path(spark, "report"))
    return report.select(*[F.to_json(F.struct(c)).alias(c) for c in report.columns])


# --- streams -----------------------------------------------------------------------------------

def _run(stream: DataFrame, keyed_state: bool = False) -> DataFrame:
    """Run a stream over what has arrived and read its sink."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "stream")
    streaming.write_available(stream, f"{path}/rows", f"{path}/progress", keyed_state).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def _stream(spark, sf_dir, name: str) -> DataFrame:
    schema = inputs.table(spark, sf_dir, name).schema
    return streaming.read_messages(spark, f"{sf_dir}/{name}*.parquet", schema)


def _document_stream(spark, sf_dir) -> DataFrame:
    return _stream(spark, sf_dir, "documents")


def stream_score(spark, sf_dir):
    """Arriving documents scored batch by batch with the published cluster risks and rules."""
    path = scratch_path(spark, "stream-score")
    refresh.publish(spark, f"{path}/models", _risks(spark, sf_dir), _rules(spark, sf_dir))
    documents = _document_stream(spark, sf_dir).select(F.col("doc_id").alias("msg_id"), "text", "lang")
    rows = inputs.with_probability(inputs.with_cluster(preprocess(documents)))
    shown = lambda scored: scored.select(
        "msg_id", F.md5("text").alias("text_md5"), *OUTPUT[1:3], rounded("risk_score"), "severity"
    )
    refresh.score_arrivals(rows, f"{path}/models", path, f"{path}/progress", shown).awaitTermination()
    return refresh.scored_rows(spark, path).drop("batch", "model_version")


def stream_dedupe(spark, sf_dir):
    """Each text once, whichever copy arrived first."""
    arrived = _document_stream(spark, sf_dir).withColumn("arrived", F.timestamp_seconds(1_700_000_000 + F.col("doc_id") % 86_400))
    return _run(streaming.dedupe_stream(arrived, "arrived", "2 days").select(F.md5("text").alias("text_md5")))


def stream_dedupe_ranked(spark, sf_dir):
    """Each text of both sources once. Turns come a day after documents and win all the same; a tick closes the stream."""
    sms, email = inputs.sms_rows(_stream(spark, sf_dir, "conversations")), inputs.email_rows(_stream(spark, sf_dir, "documents"))
    merged = dedupe.merge_sources(sms, email, keep_ids=True)
    day, start = 86_400, 1_700_000_000
    arrived = merged.withColumn("arrived", F.timestamp_seconds(start + F.col("msg_id") % day + F.when(F.col("source") == "sms", day).otherwise(0)))
    path = scratch_path(spark, "tick")
    spark.range(1).select(
        *[F.lit("tick" if f.name == "source" else None).cast(f.dataType).alias(f.name) for f in merged.schema],
        F.timestamp_seconds(F.lit(start + 30 * day)).alias("arrived"),
    ).write.parquet(path)
    ticks = streaming.read_messages(spark, path, arrived.schema)
    kept = dedupe_by_rank(arrived.unionByName(ticks), "arrived", "1 hour", 3 * day, tick=F.col("source") == "tick")
    return _run(kept.select("msg_id", "source", F.md5("text").alias("text_md5")), keyed_state=True)


QUERIES = {
    "csv_scan": csv_scan,
    "csv_bad_lines": csv_bad_lines,
    "load_messages": load_messages,
    "merge_sources": merge_sources,
    "dedupe_messages": dedupe_messages,
    "dataset_summary": dataset_summary,
    "label_counts": label_counts,
    "coerce_labels": coerce_labels,
    "normalize_text": normalize_text,
    "tokens": tokens,
    "preprocess": preprocessed,
    "message_features": features,
    "caps_ratio_raw": caps_ratio_raw,
    "feature_profile": feature_profile,
    "fraud_rows": fraud_rows,
    "cluster_source": cluster_source,
    "class_weights": class_weights,
    "bag_weights": bag_weights,
    "hash_split": hash_split,
    "stratified_split": stratified_split,
    "capped_sample": capped_sample,
    "manual_features_scaled": manual_features_scaled,
    "tfidf_tokens": tfidf_tokens,
    "ngrams": ngrams,
    "vocabulary": vocabulary,
    "feature_names": feature_names,
    "tfidf_weights": tfidf_weights,
    "tfidf_transform": tfidf_transform,
    "tfidf_vectors": tfidf_vectors,
    "feature_vectors": feature_vectors,
    "transactions": transactions,
    "frequent_itemsets": frequent_itemsets,
    "association_rules": association_rules,
    "top_rules": top_rules,
    "rule_hits": rule_hits,
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "roc_auc": roc_auc,
    "assign_clusters": assign_clusters,
    "cluster_sizes": cluster_sizes,
    "inertia": inertia,
    "silhouette_exact": silhouette_exact,
    "davies_bouldin": davies_bouldin,
    "calinski_harabasz": calinski_harabasz,
    "cluster_quality": cluster_quality,
    "quality_table": quality_table,
    "cluster_risk": cluster_risk,
    "cluster_keywords": cluster_keywords,
    "cluster_examples": cluster_examples,
    "cluster_report": cluster_report,
    "cluster_table": cluster_table,
    "cluster_markdown": cluster_markdown,
    "smote_neighbors": smote_neighbors,
    "smote_rows": smote_rows,
    "risk_score": risk_score,
    "severity": severity,
    "score_messages": scored,
    "alerts": alerts,
    "kmeans_fit": kmeans_fit,
    "k_sweep": k_sweep,
    "silhouette_fast": silhouette_fast,
    "pca_2d": pca_2d,
    "pca_norms": pca_norms,
    "svd_project": svd_project,
    "rf_scores": rf_scores,
    "rf_bagged_scores": rf_bagged_scores,
    "feature_importance": feature_importance,
    "fit_summary": fit_summary,
    "predict_messages": predict_messages,
    "run_report": run_report,
    "stream_score": stream_score,
    "stream_dedupe": stream_dedupe,
    "stream_dedupe_ranked": stream_dedupe_ranked,
}
