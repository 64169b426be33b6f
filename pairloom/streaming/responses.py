"""Scoring model responses as they arrive.

The cleaning and matching steps keep no state, so the batch operator runs on a
file stream unchanged.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.chats import score_responses
from ..records import PREDICTION

RESPONSE = T.StructType([f for f in PREDICTION.fields if f.name not in ("prediction", "match")])


def read_responses(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Response rows from JSON files appearing in a folder."""
    reader = spark.readStream.schema(RESPONSE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def write_predictions(
    responses: DataFrame, path: str, checkpoint: str | None = None, once: bool = True
) -> StreamingQuery:
    """Score the stream and append prediction rows, one folder per model.

    The checkpoint belongs to the sink, beside it by default, so a second start goes on
    where the first one ended and each row is written once. ``once`` handles what is there
    and stops.
    """
    writer = (
        score_responses(responses)
        .select(*PREDICTION.fieldNames())
        .writeStream.format("json")
        .partitionBy("model")
        .option("checkpointLocation", checkpoint or f"{path.rstrip('/')}.checkpoint")
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start(path)
