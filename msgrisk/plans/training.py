"""The training job, and the fitted model that scores message tables and streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from msgrisk.constants import FLAG_ITEMS, N_CLUSTERS, N_RESTARTS, SEED, TEST_SHARE
from msgrisk.functions.labels import coerce_label
from msgrisk.functions.text import preprocess
from msgrisk.operators import clustering, metrics
from msgrisk.operators.bagging import BaggedForest
from msgrisk.operators.forest import MAX_DEPTH, feature_importance, fit_forest, with_forest_scores
from msgrisk.operators.rules import association_rules, build_transactions, frequent_itemsets
from msgrisk.operators.sampling import stratified_split
from msgrisk.operators.vectorize import FeatureModel
from msgrisk.plans.scoring import OUTPUT, score_messages
from msgrisk.session import materialised


@dataclass(frozen=True)
class MessageRiskModel:
    """Fitted features, classifier, clusters, cluster risks and rules."""

    features: FeatureModel
    forest: RandomForestClassificationModel | BaggedForest
    kmeans: KMeansModel | None
    risks: DataFrame
    rules: DataFrame

    def vectors(self, messages: DataFrame, text: str = "text") -> DataFrame:
        """Append the prepared columns and the feature vector."""
        return self.features.transform(preprocess(messages, text))

    def probabilities(self, messages: DataFrame, text: str = "text") -> DataFrame:
        """Append fraud_probability and pred beside the prepared columns and the vector."""
        return with_forest_scores(self.forest, self.vectors(messages, text))

    def assigned(self, vectors: DataFrame) -> DataFrame:
        """Append cluster_id, 0 without a cluster model."""
        return self.kmeans.transform(vectors) if self.kmeans else vectors.withColumn("cluster_id", F.lit(0))

    def score(self, messages: DataFrame, text: str = "text", key: str = "msg_id") -> DataFrame:
        """All columns of the scored messages, reasons included. Row by row, so it also takes a stream."""
        return score_messages(self.assigned(self.probabilities(messages, text)), self.risks, self.rules, key)

    def predict(self, messages: DataFrame, text: str = "text", key: str = "msg_id") -> DataFrame:
        """key, text, fraud_probability, cluster_id, risk_score, severity."""
        scored = self.score(messages, text, key)
        return scored.select(key, F.col(text).alias("text"), *OUTPUT[1:])

    def save(self, path: str, overwrite: bool = False) -> None:
        """Write all parts below a path. A path that holds a model is refused at once, or overwritten on request."""
        spark, mode = self.risks.sparkSession, "overwrite" if overwrite else "error"
        # The list of parts comes first, so that an existing model stops the save before anything is written.
        bags = len(self.forest.parts) if isinstance(self.forest, BaggedForest) else 0
        spark.createDataFrame([(bool(self.kmeans), bags)], "clustered boolean, bags int").write.mode(mode).parquet(f"{path}/parts")
        self.features.save(spark, f"{path}/features", mode)
        if bags:
            self.forest.save(f"{path}/forest", overwrite)
        for name, part in (("forest", None if bags else self.forest), ("kmeans", self.kmeans)):
            if part:
                (part.write().overwrite() if overwrite else part.write()).save(f"{path}/{name}")
        self.risks.write.mode(mode).parquet(f"{path}/risks")
        self.rules.write.mode(mode).parquet(f"{path}/rules")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "MessageRiskModel":
        clustered, bags = spark.read.schema("clustered boolean, bags int").parquet(f"{path}/parts").first()
        forest = f"{path}/forest"
        return MessageRiskModel(
            FeatureModel.load(spark, f"{path}/features"),
            BaggedForest.load(forest, bags) if bags else RandomForestClassificationModel.load(forest),
            KMeansModel.load(f"{path}/kmeans") if clustered else None,
            spark.read.parquet(f"{path}/risks"),
            spark.read.parquet(f"{path}/rules"),
        )


@dataclass(frozen=True)
class TrainingSummary:
    """What a training run reports; every table is small."""

    confusion: DataFrame
    report: DataFrame
    auc: DataFrame
    importance: DataFrame
    diagnostics: DataFrame
    rules: DataFrame
    rejected: DataFrame


def fit(
    messages: DataFrame,
    text: str = "text",
    label: str = "label",
    key: str = "msg_id",
    test_size: float = TEST_SHARE,
    use_smote: bool = True,
    n_clusters: int = N_CLUSTERS,
    restarts: int = N_RESTARTS,
    num_trees: int = 300,
    max_depth: int = MAX_DEPTH,
    strict_labels: bool = True,
    exact_silhouette: bool = False,
    risk_from_all_rows: bool = False,
    seed: int = SEED,
    bags: int | None = None,
) -> tuple[MessageRiskModel, TrainingSummary]:
    """Fit all parts on the training fold and evaluate on the test fold.

    Tables that several stages read are written once to the shared folder: the split rows, the
    training vectors, the cluster rows and the rules.

    Ids must be unique. Lenient labels leave out rows whose label is unknown and count them. The silhouettes of
    the sweep are by squared distance unless exact_silhouette is set.

    With `bags` the trees are spread over as many bootstraps, each balanced by its own class weights.

    By default the risk of a cluster is the mean label of the rows it was fitted on, which are the
    fraud rows. risk_from_all_rows takes the mean over all training rows nearest to it instead.
    """
    for column, kind in ((text, "text"), (label, "label")):
        if column not in messages.columns:
            raise KeyError(f"Missing {kind} column: {column}")
    labelled = preprocess(messages, text).withColumn("y", coerce_label(F.col(label), strict_labels))
    known = materialised(labelled.drop(text, label), "prepared")
    prepared = known.filter("y IS NOT NULL")
    repeated = prepared.groupBy(key).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{key} {repeated[0][0]} occurs more than once; ids must be unique (see merge_sources)")
    rejected = known.agg(F.count_if(F.col("y").isNull()).alias("rejected"))
    split = materialised(stratified_split(prepared, "y", key, test_size, seed), "split")
    train, test = split.filter("fold = 'train'"), split.filter("fold = 'test'")

    features = FeatureModel.fit(train)
    vectors = materialised(features.transform(train), "vectors")
    forest = fit_forest(vectors, "y", key, "features", use_smote, num_trees, max_depth, seed, bags)
    judged = materialised(with_forest_scores(forest, features.transform(test)).select("y", "pred", "fraud_probability"), "judged")
    confusion = metrics.confusion_matrix(judged)

    source = materialised(clustering.cluster_source(vectors), "cluster-source")
    n_rows = source.count()
    k = clustering.effective_k(n_clusters, n_rows)
    rows = source.select(key, "features").persist()
    # The sweep is reported only; its model for the wanted k is the one kept.
    swept = clustering.sweep_values(range(2, max(3, k + 1)), n_rows)
    models = clustering.fit_kmeans_many(rows, swept, "features", restarts, seed)
    diagnostics = materialised(clustering.k_sweep(rows, models, key, exact=exact_silhouette), "diagnostics")
    kmeans = models.get(k)
    rows.unpersist()
    rated = vectors if risk_from_all_rows else source
    placed = kmeans.transform(rated) if kmeans else rated.withColumn("cluster_id", F.lit(0))
    risks = materialised(clustering.cluster_risk(placed), "risks")

    transactions = build_transactions(source, extra_items=FLAG_ITEMS, allowed_tokens=features.allowed_tokens, key=key)
    rules = materialised(association_rules(frequent_itemsets(transactions)), "rules")
    spark = messages.sparkSession
    summary = TrainingSummary(
        confusion, metrics.classification_report(confusion), metrics.roc_auc(judged),
        feature_importance(forest, features.names, spark), diagnostics, rules, rejected,
    )
    return MessageRiskModel(features, forest, kmeans, risks, rules), summary


def summary_table(summary: TrainingSummary) -> DataFrame:
    """(metric, value): one flat table of a training run."""
    parts = [
        summary.report.select(F.concat_ws("/", "label", "metric").alias("metric"), "value"),
        summary.auc.select(F.lit("roc_auc").alias("metric"), F.col("auc").alias("value")),
        summary.rules.agg(F.count("*").cast("double").alias("value")).select(F.lit("rules").alias("metric"), "value"),
        summary.rejected.select(F.lit("rejected_labels").alias("metric"), F.col("rejected").cast("double").alias("value")),
        summary.diagnostics.select(F.format_string("inertia/%d", "k").alias("metric"), F.col("inertia").alias("value")),
        summary.diagnostics.select(F.format_string("silhouette/%d", "k").alias("metric"), F.col("silhouette").alias("value")),
    ]
    table, *rest = parts
    for part in rest:
        table = table.unionByName(part)
    return table
