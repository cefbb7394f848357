"""Message tables of any layout to one schema: msg_id, text, label, source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from msgrisk.constants import (
    CSV_MISSING, EMAIL_LABEL_COLUMNS, EMAIL_TEXT_COLUMNS, SMS_LABEL_COLUMNS, SMS_TEXT_COLUMNS,
)
from msgrisk.sources.csv import read_csv


def matching_column(df: DataFrame, wanted: Sequence[str]) -> str:
    """The first wanted name that df has, whatever its case; of columns that differ in case alone, the last."""
    for name in wanted:
        same = [c for c in df.columns if c.casefold() == name.casefold()]
        if same:
            return same[-1]
    raise KeyError(f"none of the columns {', '.join(wanted)} is among {', '.join(df.columns)}")


def unify(
    df: DataFrame,
    source: str,
    text_candidates: Sequence[str],
    label_candidates: Sequence[str],
    id_column: str | None = None,
) -> DataFrame:
    """Pick the text and label columns; rows whose text is missing are dropped.

    Without an id column rows are numbered in file order, from 0 in every source: merge_sources makes the
    numbers of several sources unique.
    """
    text, label = matching_column(df, text_candidates), matching_column(df, label_candidates)
    msg_id = F.monotonically_increasing_id() if id_column is None else df[id_column].cast("bigint")

    def value(name):
        cell = df[name].cast("string")
        return F.when(~cell.isin(*CSV_MISSING), cell)

    return df.select(
        msg_id.alias("msg_id"),
        value(text).alias("text"),
        value(label).alias("label"),
        F.lit(source.lower()).alias("source"),
    ).na.drop(subset=["text"])


def load_sms(
    spark: SparkSession,
    path: str | list[str],
    text_col: str = "text",
    label_col: str = "label",
    id_column: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    return unify(
        read_csv(spark, path, multi_line), "SMS",
        (text_col, *SMS_TEXT_COLUMNS), (label_col, *SMS_LABEL_COLUMNS), id_column,
    )


def load_email(
    spark: SparkSession,
    path: str | list[str],
    text_col: str = "Email Text",
    label_col: str = "Email Type",
    id_column: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    return unify(
        read_csv(spark, path, multi_line), "Email",
        (text_col, *EMAIL_TEXT_COLUMNS), (label_col, *EMAIL_LABEL_COLUMNS), id_column,
    )
