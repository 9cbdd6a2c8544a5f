"""Record layouts of the files and tables the library reads and writes."""

from pyspark.sql import types as T

# Listing of traded codes.
LISTING = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("industry", T.StringType()),
    ]
)

# One short position as reported for a day.
POSITION = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("shorts", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("percent", T.FloatType()),
    ]
)

# One code of a normalised day.
SNAPSHOT_ROW = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("shorts", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("percent", T.FloatType()),
        T.StructField("industry", T.StringType()),
    ]
)

# A normalised day as one JSON document.
SNAPSHOT_DOCUMENT = T.StructType(
    [T.StructField("result", T.ArrayType(SNAPSHOT_ROW))]
)

# Named high-water marks.
MARKS = T.StructType(
    [
        T.StructField("name_id", T.StringType()),
        T.StructField("date", T.StringType()),
    ]
)
