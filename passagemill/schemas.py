"""Declared schemas of the tables that pass between operators."""

from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType


def _schema(kind, names: str) -> list[StructField]:
    return [StructField(name, kind) for name in names.split()]


CONTENT = StructType(
    _schema(StringType(), "id content file") + _schema(LongType(), "file_order line_num sequence")
)
SOURCES = StructType(_schema(StringType(), "id words genre year source title pubInfo"))
MERGED = StructType(CONTENT.fields + SOURCES.fields[1:])
MESSAGE = StructType(_schema(StringType(), "from value"))
RECORD = StructType(
    [
        StructField("conversations", ArrayType(MESSAGE)),
        StructField("source", StringType()),
        StructField("score", LongType()),
    ]
)


def empty(spark, schema: StructType):
    """A table of the schema without rows."""
    return spark.createDataFrame([], schema)


def conform(df, schema: StructType):
    """Select the schema's columns, each cast to its declared type."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
