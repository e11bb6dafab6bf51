"""Reading stores that may not have been written yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH = "batch_id"


def read_stored(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A stored table, empty before the first write.

    Spark adds the partition columns; naming them keeps their types fixed.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
