"""Fixed schemas of the inputs.

Schemas are declared, never inferred: inference reads the whole input once more
and gives a different schema for a file in which no post is an extended one.
"""

from pyspark.sql import types as T

TWEET = T.StructType([
    T.StructField("timestamp_ms", T.StringType()),
    T.StructField("extended_tweet", T.StructType([
        T.StructField("full_text", T.StringType()),
        T.StructField("entities", T.StructType([
            T.StructField("hashtags", T.ArrayType(T.StructType([
                T.StructField("text", T.StringType()),
            ]))),
        ])),
    ])),
])

# What the operators work on. `timestamp_ms` may also be a bigint.
POST = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("timestamp_ms", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])

TERM = T.StructType([T.StructField("term", T.StringType())])

LEXICON = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("weight", T.LongType()),
])

WINDOW = T.StructType([
    T.StructField("bucket", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("lo_ms", T.LongType()),
    T.StructField("hi_ms", T.LongType()),
])
