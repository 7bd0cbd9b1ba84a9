"""Stable output types for comparison: doubles as float32, dates and timestamps as ISO text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.col(f.name).cast("float").alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
