"""Spelling variant grouping with a dictionary of trie-node pairs.

The distinct words are laid out in sorted order twice, forward and reversed, and the nodes of
both tries are numbered in one pass each: a word opens a node for every code point behind
what it shares with the word before it. A word that skips position ``i`` then leaves a pair of
numbers, the node of the prefix before ``i`` and the (reversed) node of the suffix behind it, and a
word that could take an insertion at ``i`` leaves the pair of its two halves. Equal pairs are
exact neighbours, whatever the words' lengths and letters:

* two skips: the words differ in that position alone;
* a skip and a pair of halves: one word has one code point more. Of a run of equal code
  points only the first is skipped for this, so a pair of words meets once.

Nodes that only one word passes cannot meet anything and are left out; how deep a word
shares its path is known from its neighbours in the order. What is shuffled are numbers, so
a very long word costs its length, not its square.

A group of equal pairs holds words that differ in one given code point, and at most one pair of
halves. It is never expanded into pairs of words: every member takes its count of
neighbours from the group's sizes, and its best neighbour from the group's two best.

A range partition is sorted by itself. The nodes on the path that its first word shares with
the partition before are renumbered from a list of one entry a partition, which goes through
the driver: the words at the partitions' ends.

Null texts have no words; a null id is empty in what the hash reads; repeated documents count
each time; an empty table has no words. Other columns of the table are not read.
"""

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

import numpy as np
import pyarrow as pa

from ..staging import drop_stage, new_stage, staged
from .common import lower_ascii, ship, slices, with_fields

#: What words consist of.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form occurs at least this many times as often as its variant.
RATIO = 10
#: Bits of the number of a node or a word in its partition.
_LOCAL = 42

SPLIT, SKIP, FIRST_SKIP = 0, 1, 2


def _lowered(run: Column) -> Column:
    """``lower_ascii``, by the faster built-in where nothing but A-Z would change."""
    return F.when(run.rlike("[À-Þ]"), lower_ascii(run)).otherwise(F.lower(run))


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    slip_every: int | None = None,
) -> DataFrame:
    """(word, n): the lower-cased runs of letters of whole texts and how often they occur.

    With ``slip_every``, a run loses a code point if that number divides the hash of the id and
    the run: a known share of slips, to measure a grouping by.
    """
    # A shorter run cannot become a word, with or without a slip.
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    words = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run"))
    words = words.select("id", _lowered(F.col("run")).alias("word"))
    if slip_every:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "word").cast("binary"))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.withColumn("h", h).select(F.when(F.col("h") % slip_every == 0, cut).otherwise(F.col("word")).alias("word"))
        words = words.filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    for k, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return k
    return min(len(a), len(b))


def _numbered(batches):
    """Words in order: an id and the nodes of the shared part of each path.

    Words at the partition's ends keep their whole path and are marked: 1 the first, 2 the last.
    """
    base = TaskContext.get().partitionId() << _LOCAL
    path, fresh, word, shared, ends, row = [base], base + 1, None, 0, 1, None
    count = 0

    def batch_of(rows: list[tuple], kept: pa.RecordBatch) -> pa.RecordBatch:
        at, ids, nodes, marks = zip(*rows)
        whole = kept.take(pa.array(at, pa.int32()))
        columns = [pa.array(ids, pa.int64()), pa.array(nodes, pa.list_(pa.int64())), pa.array(marks, pa.int32())]
        return pa.RecordBatch.from_arrays([*whole.columns, *columns], names=[*kept.schema.names, "id", "nodes", "ends"])

    held = None  # the batch that the waiting row is in
    for batch in slices(batches):
        out = []
        for k, new in enumerate(batch.column("key").to_pylist()):
            if word is not None:
                common = _shared(word, new)
                known = len(word) if ends else max(shared, common)
                done = (row, base + count, path[: known + 1], ends)
                if held is not None:
                    yield batch_of([done], held)
                    held = None
                else:
                    out.append(done)
                count, ends, shared = count + 1, 0, common
                path = path[: common + 1]
            opened = len(new) + 1 - len(path)
            path = [*path, *range(fresh, fresh + opened)]
            fresh, word, row = fresh + opened, new, k
        if out:
            yield batch_of(out, batch)
        if batch.num_rows:
            held = batch.slice(row, 1)
            row = 0
    if word is not None:
        yield batch_of([(row, base + count, path, ends | 2)], held)


def _numbered_trie(rows: DataFrame, key: Column, name: str) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """``rows`` in the order of ``key`` with ``id`` and ``nodes``, and the paths of the partitions' starts.

    The second result maps a partition to the numbers of the nodes that its first word
    shares with the partition before.
    """
    keyed = rows.withColumn("key", key)
    ordered = keyed.repartitionByRange("key").sortWithinPartitions("key")
    schema = with_fields(keyed, keyed.columns, "id bigint, nodes array<bigint>, ends int")
    found = staged(ordered.mapInArrow(_numbered, schema), name)
    starts: dict[int, np.ndarray] = {}
    before: tuple[str, np.ndarray] | None = None
    for edge in found.filter("ends > 0").select("key", "id", "nodes", "ends").orderBy("id").toLocalIterator():
        part, word, nodes = edge["id"] >> _LOCAL, edge["key"], np.array(edge["nodes"], np.int64)
        if edge["ends"] & 1 and before is not None:
            starts[part] = before[1][: _shared(before[0], word) + 1]
        if edge["ends"] & 2:
            before = word, _renumbered(nodes, part, starts)
    return found, starts


def _renumbered(nodes: np.ndarray, part: int, starts: dict[int, np.ndarray]) -> np.ndarray:
    """Nodes on the shared path of a partition's first word, by the numbers they had before."""
    start = starts.get(part)
    if start is None:
        return nodes
    local = nodes - (part << _LOCAL)
    return np.where(local < len(start), start[np.minimum(local, len(start) - 1)], nodes)


def _node_pairs(shared):
    """The pairs that a word leaves, as (prefix, suffix, id, n, kind)."""

    def pairs(batches):
        prefix_starts, suffix_starts = shared.value
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], []]
            columns = [batch.column(c).to_pylist() for c in ("key", "word_id", "id", "n", "prefixes")]
            for word, word_id, place, n, before, behind in zip(*columns, batch.column("nodes").to_pylist()):
                before = _renumbered(np.array(before, np.int64), word_id >> _LOCAL, prefix_starts)
                behind = _renumbered(np.array(behind, np.int64), place >> _LOCAL, suffix_starts)
                size, a, b = len(word), len(before), len(behind)  # the word is reversed here
                skips = np.arange(max(0, size - b), min(size, a))
                halves = np.arange(max(0, size + 1 - b), min(size + 1, a))
                first = [i == 0 or word[size - 1 - i] != word[size - i] for i in skips.tolist()]
                out[0] += [before[skips], before[halves]]
                out[1] += [behind[size - 1 - skips], behind[size - halves]]
                out[4] += [np.where(first, FIRST_SKIP, SKIP).astype(np.int8), np.full(len(halves), SPLIT, np.int8)]
                count = len(skips) + len(halves)
                out[2].append(np.full(count, word_id))
                out[3].append(np.full(count, n))
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out], names=["prefix", "suffix", "word_id", "n", "kind"]
                )

    return pairs


def _neighbours(pairs: DataFrame) -> DataFrame:
    """(word_id, n_near, best): how many neighbours, and the best as (minus its count, its id)."""
    same = Window.partitionBy("prefix", "suffix")
    ranked = same.orderBy(F.col("kind") == SPLIT, F.desc("n"), "word_id")
    me, skips = F.struct((-F.col("n")).alias("less"), F.col("word_id").alias("near_id")), F.col("kind") != SPLIT
    grouped = pairs.withColumn("place", F.row_number().over(ranked)).withColumns(
        {
            "skips": F.count_if(skips).over(same),
            "first_skips": F.count_if(F.col("kind") == FIRST_SKIP).over(same),
            "best_skip": F.min(F.when(skips & (F.col("place") == 1), me)).over(same),
            "next_skip": F.min(F.when(skips & (F.col("place") == 2), me)).over(same),
            "best_first": F.min(F.when(F.col("kind") == FIRST_SKIP, me)).over(same),
            "halves": F.min(F.when(~skips, me)).over(same),
        }
    )
    longer = F.when(F.col("kind") == FIRST_SKIP, F.col("halves"))
    other = F.when(F.col("place") == 1, F.col("next_skip")).otherwise(F.col("best_skip"))
    met = grouped.select(
        "word_id",
        F.when(skips, F.col("skips") - 1 + longer.isNotNull().cast("bigint")).otherwise(F.col("first_skips")).alias("n_near"),
        F.when(skips, F.least(other, longer)).otherwise(F.col("best_first")).alias("best"),
    ).filter("n_near > 0")
    return met.groupBy("word_id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word_id, form_id, root_id): paths of forms followed to their ends, twice as far each round.

    A form occurs ``RATIO`` times as often as its variant, so there is no ring, and few rounds.
    """
    spark = forms.sparkSession
    path = new_stage(spark, "roots")
    forms.withColumn("root_id", F.col("form_id")).write.parquet(path)
    while True:
        here = spark.read.parquet(path)
        ahead = here.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("further"))
        moved = Observation()
        longer = (
            here.join(ahead, "root_id", "left")
            .observe(moved, F.count("further").alias("rows"))
            .select("word_id", "form_id", F.coalesce("further", "root_id").alias("root_id"))
        )
        reached = new_stage(spark, "roots")
        longer.write.parquet(reached)
        drop_stage(spark, path)
        path = reached
        if not moved.get["rows"]:
            return spark.read.parquet(path)


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of a (word, n) table of distinct words.

    Near words differ by one inserted, deleted or replaced code point. The form is the near
    word of the largest ``n`` (ties: the smallest in code-point order) if that is at least ``ratio``
    times the word's own, else null; the root follows forms to the last.
    """
    spark = words.sparkSession
    ship(spark)
    forward, prefix_starts = _numbered_trie(words.select("word", "n"), F.col("word"), "prefixes")
    named = forward.select("word", "n", F.col("id").alias("word_id"))
    carried = forward.select("n", F.col("id").alias("word_id"), F.col("nodes").alias("prefixes"), F.col("key").alias("word"))
    backward, suffix_starts = _numbered_trie(carried.withColumn("word", F.reverse("word")), F.col("word"), "suffixes")
    starts = spark.sparkContext.broadcast((prefix_starts, suffix_starts))
    pairs = backward.select("key", "word_id", "id", "n", "prefixes", "nodes").mapInArrow(
        _node_pairs(starts), "prefix bigint, suffix bigint, word_id bigint, n bigint, kind tinyint"
    )
    near = staged(_neighbours(pairs), "near")
    chosen = near.select("word_id", F.col("best.near_id").alias("form_id"), (-F.col("best.less")).alias("form_n"))
    forms = named.join(chosen, "word_id").filter(F.col("form_n") >= ratio * F.col("n")).select("word_id", "form_id")
    roots = _roots(forms)
    form = named.select(F.col("word_id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = named.select(F.col("word_id").alias("root_id"), F.col("word").alias("root"))
    grouped = staged(roots.join(form, "form_id").join(root, "root_id").select("word_id", "form", "form_n", "root"), "grouped")
    return (
        named.join(near.select("word_id", "n_near"), "word_id", "left")
        .join(grouped, "word_id", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
