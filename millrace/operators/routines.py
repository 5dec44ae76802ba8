"""Functions, parameters and result contracts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_external(spark: SparkSession) -> None:
    """Functions implemented outside the SQL engine, as Arrow-batched UDFs."""

    @F.pandas_udf("string")
    def join_text(a: pd.Series, b: pd.Series) -> pd.Series:
        return a + b

    @F.pandas_udf("string")
    def join_tagged(a: pd.Series, b: pd.Series) -> pd.Series:
        return a + "_NDT_" + b

    @F.pandas_udf("bigint")
    def add_numbers(a: pd.Series, b: pd.Series) -> pd.Series:
        return a + b

    spark.udf.register("join_text", join_text)
    spark.udf.register("join_tagged", join_tagged)
    spark.udf.register("add_numbers", add_numbers)


def with_result_schema(df: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """Rename and retype by position; a different number of columns is an error."""
    if len(df.columns) != len(columns):
        raise ValueError(f"expected {len(columns)} columns, got {len(df.columns)}")
    return df.select(*[F.col(old).cast(kind).alias(new) for old, (new, kind) in zip(df.columns, columns)])
