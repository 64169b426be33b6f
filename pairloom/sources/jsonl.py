"""Readers and writers of the record types.

Schemas are always given. Records that are written carry their place as ``line_no``, since a
DataFrame keeps no order of lines. Files of others do not: their records get the place of
their line (``lines``), from 0, and files of one folder count on in the order of their names.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import render
from ..records import CHAT, INSTRUCTION, PAIR, PREDICTION
from .lines import read_placed


def read_instructions(
    spark: SparkSession, path: str, fmt: str = "json", row_id: str | Column | None = None
) -> DataFrame:
    """(row_id, context, question, answer) from JSON lines, Parquet or CSV.

    ``row_id`` is read from the data, from the named column, or computed by the
    given expression over the three texts. It never follows partition order.
    """
    fields = list(INSTRUCTION.fields)
    if isinstance(row_id, Column):
        fields = fields[1:]
    elif row_id:
        fields = [T.StructField(row_id, T.LongType()), *fields[1:]]
    reader = spark.read.schema(T.StructType(fields))
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    df = reader.format(fmt).load(path)
    if row_id is not None:
        df = df.withColumn("row_id", row_id if isinstance(row_id, Column) else F.col(row_id))
    return df.select("row_id", "context", "question", "answer")


def _write_counted(df: DataFrame, path: str, mode: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write JSON lines and return the row count, taken during the same job."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        # Only the folders that get rows are replaced: other models' stay.
        out = out.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    out.json(path)
    return seen.get["rows"]


def write_chat_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> int:
    """One chat record per line from (line_no, context, question, answer) rows."""
    messages = render.chat_messages(
        render.prompt_text(F.col("context"), F.col("question")), F.col("answer")
    )
    return _write_counted(rows.select("line_no", messages.alias("messages")), path, mode)


def read_chat_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return read_placed(spark, path, CHAT).select(*CHAT.fieldNames())


def model_label(name: str) -> str:
    """The last part of a model name or adapter folder."""
    return name.rstrip("/").rsplit("/", 1)[-1]


def write_predictions(predictions: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Prediction rows, one folder per model, so a reader prunes to one model."""
    return _write_counted(predictions.select(*PREDICTION.fieldNames()), path, mode, ("model",))


def read_predictions(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    """Prediction rows, all or those of one model.

    Records that name no model belong to the one in their file's name
    (``predictions-<model>.jsonl``, else the whole name), and are numbered for each of them.
    """
    name = F.regexp_extract(F.url_decode(F.regexp_replace("file", r"\+", "%2B")), r"(?:predictions-)?([^/]*?)(?:\.jsonl?)?$", 1)
    df = read_placed(spark, path, PREDICTION, within=F.coalesce("record.model", name))
    if "file" in df.columns:
        df = df.withColumn("model", F.coalesce("model", name))
    df = df.select(*PREDICTION.fieldNames())
    return df if model is None else df.filter(F.col("model") == model_label(model))


def write_pairs(pairs: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Preference records (line_no, prompt, chosen, rejected, source)."""
    return _write_counted(pairs.select(*PAIR.fieldNames()), path, mode)


def read_pairs(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """One DataFrame per pair file, in the given order."""
    return [read_placed(spark, p, PAIR).select(*PAIR.fieldNames()) for p in paths]
