"""Table schemas shared by the operators."""

from pyspark.sql import types as T

NODE = T.StructType(
    [
        T.StructField("pre", T.IntegerType(), False),
        T.StructField("parent", T.IntegerType(), False),
        T.StructField("last", T.IntegerType(), False),
        T.StructField("depth", T.IntegerType(), False),
        T.StructField("tag", T.StringType(), False),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType(), False), True),
        T.StructField("text", T.StringType(), True),
    ]
)

NODES = T.ArrayType(NODE, False)

TARGETS = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("url", T.StringType()),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

JOBS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("ats_provider", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("apply_url", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("relevance_score", T.IntegerType()),
        T.StructField("decision_reason", T.StringType()),
        T.StructField("raw_path", T.StringType()),
    ]
)

RESPONSES = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("raw", T.StringType())]
)

IDENTITY_FIELDS = ("first_name", "last_name", "location", "phone", "email", "linkedin")
