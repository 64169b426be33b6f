"""Token counts by source, language and tokenizer version, kept up to date by deltas.

A store is a folder with a sub-folder for each batch of changes. A batch retracts what the
store holds of the documents it touches and adds what they are now: signed rows by
document (the ledger) and their sums (the totals). Totals over any set of batches are
sums, so a total costs time with the number of batches and groups, not of documents.

A batch counts once: it becomes visible by a marker that is made last. A batch that
is already marked is left alone when it comes again; one that failed half-way is
overwritten. Changes are inserts, revisions (an insert of a known document is one) and
deletes; of a batch's changes of one document the last in ``seq`` counts, then that with
the greatest counts.

Null texts are empty; null sources and languages are groups of their own. Documents
without an id cannot be addressed: their inserts and revisions count each and are never
retracted, their deletes do nothing. A delete of an unknown document does nothing. An
empty batch is committed and changes nothing.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import raw_text, ship, slices, with_fields
from .wordtokens import encoder

GROUP = ["source", "lang", "tokenizer"]
LEDGER = "doc_id bigint, source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
TOTALS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
#: The version without a vocabulary: words between ASCII white space.
WORDS = "words"


def _count(vocabularies: dict[str, str]):
    def count(batches):
        for batch in slices(batches, keep=True):
            raws = batch.column("raw").to_pylist()
            counts = []
            for name, path in vocabularies.items():
                if name == WORDS:
                    counts.append([len(r.split()) for r in raws])
                else:
                    counts.append([len(ids) // 4 for ids in encoder(path).encode([r.decode() for r in raws])])
            kept = [n for n in batch.schema.names if n != "raw"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(list(zip(*counts)), pa.list_(pa.int64()))],
                names=[*kept, "counts"],
            )

    return count


class RollupStore:
    """Totals in the folder ``path``, which all executors share. ``vocabularies``: version -> file."""

    def __init__(self, spark: SparkSession, path: str, vocabularies: dict[str, str]):
        self.spark, self.path, self.vocabularies = spark, path, {WORDS: "", **vocabularies}

    def _files(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def committed(self) -> list[str]:
        """Names of the batches that count."""
        fs, path = self._files("batch=*/_COMMITTED")
        return sorted(s.getPath().getParent().getName().removeprefix("batch=") for s in fs.globStatus(path) or [])

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/batch={b}/{part}" for b in self.committed()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all that is committed."""
        sums = self._read("totals", TOTALS).groupBy(*GROUP).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        )
        return sums.filter("n_docs != 0 OR n_tokens != 0")

    def _counted(self, changes: DataFrame) -> DataFrame:
        ship(self.spark)
        rows = changes.select(
            "op", "seq", "doc_id", "source", "lang",
            raw_text(F.when(F.col("op") != "delete", F.col("text"))).alias("raw"),
        )
        kept = ["op", "seq", "doc_id", "source", "lang"]
        return rows.mapInArrow(_count(self.vocabularies), with_fields(rows, kept, "counts array<bigint>"))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch of (op, seq, doc_id, source, lang, text); False if it was committed before.

        ``op`` is 'insert', 'revise' or 'delete'.
        """
        if batch in self.committed():
            return False
        folder = f"{self.path}/batch={batch}"
        # Texts end here: what follows moves counts only.
        self._counted(changes).write.mode("overwrite").parquet(f"{folder}/changes")
        counted = self.spark.read.parquet(f"{folder}/changes")
        known = counted.filter("doc_id IS NOT NULL")
        order = F.struct("seq", "counts", "op", "source", "lang")
        last = known.groupBy("doc_id").agg(F.max(order).alias("last")).select("doc_id", "last.*")
        nameless = counted.filter("doc_id IS NULL")
        names = F.array(*(F.lit(n) for n in self.vocabularies))
        added = (
            last.unionByName(nameless.select(*last.columns))
            .filter("op != 'delete'")
            .select("doc_id", "source", "lang", F.explode(F.arrays_zip(names.alias("n"), F.col("counts").alias("c"))).alias("x"))
            .select("doc_id", "source", "lang", F.col("x.n").alias("tokenizer"), F.lit(1).cast("bigint").alias("n_docs"), F.col("x.c").alias("n_tokens"))
        )
        touched = last.select("doc_id")
        retracted = self._read("ledger", LEDGER).join(touched, "doc_id", "left_semi").select(
            "doc_id", *GROUP, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens")
        )
        signed = (
            added.unionByName(retracted)
            .groupBy("doc_id", *GROUP)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .filter("n_docs != 0 OR n_tokens != 0")
        )
        signed.write.mode("overwrite").parquet(f"{folder}/ledger")
        ledger = self.spark.read.schema(LEDGER).parquet(f"{folder}/ledger")
        ledger.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.mode(
            "overwrite"
        ).parquet(f"{folder}/totals")
        fs, marker = self._files(f"batch={batch}/_COMMITTED")
        fs.create(marker, False).close()
        return True
