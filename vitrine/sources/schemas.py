"""Row types of requests."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


REQUEST_BODY = _struct(
    name=T.StringType(),
    color=T.StringType(),
    category=T.StringType(),
    top_k=T.IntegerType(),
)
REQUEST = _struct(
    query_id=T.LongType(),
    name=T.StringType(),
    color=T.StringType(),
    category=T.StringType(),
    top_k=T.IntegerType(),
)
