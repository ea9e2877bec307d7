"""Declared schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

PAIRS = T.StructType(
    [
        T.StructField("Context", T.StringType()),
        T.StructField("Response", T.StringType()),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

MESSAGES = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])

EVAL_PROMPTS = T.StructType(
    [
        T.StructField("messages", T.ArrayType(MESSAGE)),
        T.StructField("prompt", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

RESPONSES = T.StructType(
    [
        T.StructField("sample_id", T.LongType()),
        T.StructField("response", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

RESULTS = T.StructType(
    [
        T.StructField("sample_id", T.LongType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "generation_params",
            T.StructType(
                [
                    T.StructField("max_new_tokens", T.IntegerType()),
                    T.StructField("temperature", T.DoubleType()),
                    T.StructField("top_p", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("error", T.StringType()),
    ]
)
