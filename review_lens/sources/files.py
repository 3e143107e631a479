"""Parquet folders that a job fills and others may read before it has."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of a folder; none, rather than an error, while it does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
