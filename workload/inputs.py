"""The given tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from msgrisk.functions.hashing import unit_hash
from msgrisk.functions.labels import coerce_label


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of fewer splits, such as one small file. Larger inputs stay as read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sms_rows(conversations: DataFrame) -> DataFrame:
    """Conversation turns; the role decides the label."""
    return conversations.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"),
        "text",
        F.when(F.col("role") == "system", "spam").otherwise("ham").alias("label"),
        F.lit("sms").alias("source"),
    )


def email_rows(documents: DataFrame) -> DataFrame:
    """Documents; the language decides the label."""
    return documents.select(
        F.col("doc_id").alias("msg_id"),
        "text",
        F.when(F.col("lang") == "en", "ham").otherwise("spam").alias("label"),
        F.lit("email").alias("source"),
    )


def sms_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sms_rows(table(spark, sf_dir, "conversations"))


def email_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return email_rows(table(spark, sf_dir, "documents"))


def order_notice() -> Column:
    """A message about an order with links, phones, amounts, accounts and known phrases."""
    key, amount = F.col("o_orderkey").cast("string"), F.floor("o_totalprice").cast("string")
    kind = F.col("o_orderkey") % 4
    return (
        F.when(kind == 0, F.concat(F.lit("Vietcombank: tài khoản bị khóa! Click http://bit.ly/"), key, F.lit(" để xác nhận OTP")))
        .when(kind == 1, F.concat(F.lit("Gọi 0912 345 "), F.lpad(key, 7, "0"), F.lit(" nhận "), amount, F.lit(" triệu ngay_liền!!")))
        .when(kind == 2, F.concat(F.lit("FREE free Click tinyurl.com/"), key, F.lit(" chuyển tiền 12345678"), key, F.lit(" và của")))
        .otherwise(F.concat(F.lit("ĐƠN HÀNG "), key, F.lit(" TRỊ GIÁ "), amount, F.lit(",5 USD\u00a0mb bank t.co/x")))
    )


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text under one id: documents, turns, page sources with their link, order notices."""
    pages = table(spark, sf_dir, "pages").select(
        (F.lit(2_000_000_000) + F.col("page_id")).alias("msg_id"),
        F.concat_ws(" ", "url", "html").alias("text"),
    )
    orders = table(spark, sf_dir, "orders").select(
        (F.lit(3_000_000_000) + F.col("o_orderkey")).alias("msg_id"), order_notice().alias("text")
    )
    turns = sms_table(spark, sf_dir).select((F.lit(1_000_000_000) + F.col("msg_id")).alias("msg_id"), "text")
    return spread(email_table(spark, sf_dir).select("msg_id", "text")).unionByName(turns).unionByName(spread(pages)).unionByName(spread(orders))


def all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: msg_id, text and the language as a given grouping."""
    return spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("msg_id"), "text", "lang"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents, for what is fitted on labels: msg_id, text, lang, label and y."""
    documents = all_documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("msg_id"),
        F.when(F.col("toxic") == 1, "spam").otherwise("ham").alias("label"),
    )
    return documents.join(labels, "msg_id").withColumn("y", coerce_label(F.col("label")))


def with_cluster(df: DataFrame) -> DataFrame:
    """cluster_id from the language."""
    ids = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "de", 2)
    return df.withColumn("cluster_id", ids.otherwise(3))


def with_probability(df: DataFrame, key: str = "msg_id") -> DataFrame:
    """A probability fixed by the key's hash, to four digits so that ties occur."""
    return df.withColumn("fraud_probability", F.round(unit_hash(F.col(key), "probability"), 4))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label and the embedding as doubles."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("x")
    )
