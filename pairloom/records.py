"""Record schemas. Every reader passes one of these; nothing is inferred."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.ArrayType(MESSAGE)

INSTRUCTION = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("context", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
    ]
)

# line_no carries the position a line has in the file: Spark keeps no line order.
CHAT = T.StructType(
    [T.StructField("line_no", T.LongType()), T.StructField("messages", MESSAGES)]
)

PREDICTION = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("gold", T.StringType()),
        T.StructField("raw_response", T.StringType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("match", T.BooleanType()),
    ]
)

PAIR = T.StructType(
    [
        T.StructField("line_no", T.LongType()),
        T.StructField("prompt", MESSAGES),
        T.StructField("chosen", MESSAGES),
        T.StructField("rejected", MESSAGES),
        T.StructField("source", T.StringType()),
    ]
)

VERDICTS = ("match", "mismatch", "gold_error", "non_discriminative")

# Report order of the pair yield.
OUTCOMES = (
    "paired",
    "paired_gold_chosen",
    "all_correct",
    "all_wrong",
    "skipped_gold_error",
    "skipped_non_discriminative",
)
