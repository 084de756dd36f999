"""Features of a signed amount, and the derived table that holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def amount_features(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Adds the absolute amount and whether it is a credit (zero included) or a debit."""
    col = F.col(amount)
    return df.withColumns(
        {
            "absolute_amount": F.abs(col),
            "transaction_type": F.when(col >= 0, F.lit("credit")).when(col < 0, F.lit("debit")),
        }
    )


def preview(df: DataFrame, order_by: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order; Spark keeps that many per task and never sorts it all."""
    return df.orderBy(*order_by).limit(rows)


def derive_table(spark: SparkSession, source: str = "valid_data", target: str = "transformed_data", amount: str = "amount") -> DataFrame:
    """Writes ``target`` anew from the catalog table ``source``; a missing source is an analysis error."""
    amount_features(spark.table(source), amount).write.mode("overwrite").saveAsTable(target)
    return spark.table(target)
