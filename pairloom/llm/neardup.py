"""Near-duplicates by the Jaccard similarity of their word shingles, verified exactly.

1. A text becomes the set of its five-word shingles (64-bit hashes); texts with equal
   sets are one node. The set has a SimHash fingerprint, and nodes whose fingerprints the ball
   hashing of ``simhash`` joins are compared by their whole sets and linked if they are similar.
   Most pairs at 0.8 differ in more bits than a ball reaches. For those ``BANDS`` keys of ``BAND_HASHES`` least hashes each say where it
   meets others. Two sets of similarity 0.8 share no key in 3 of a million cases.
2. Nodes that share a key meet one of them, the pivot. Pairs are compared by their whole
   sets and linked if they are similar; groups of near copies become few components.
3. That repeats with other pivots while it helps and many pairs of unlinked nodes
   share a key. Then all of those are compared, so no pair that shares a key is left out
   unless links join it already.

Only sets of nodes that share a key are moved, once for each pair that is compared.

Words are cut at ASCII white space after A-Z is lower-cased; a text of fewer than
``SHINGLE_WORDS`` words is one shingle. Null and word-less texts have the empty set and are
copies of each other.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.staging import staged

from .common import raw_text, ship, slices
from .components import components
from . import simhash
from .simhash import first_of_each

SHINGLE_WORDS = 5
#: The least similarity of near copies, as a fraction.
SIMILAR = (4, 5)
BANDS, BAND_HASHES = 32, 5
#: Shingles whose permuted hashes are in memory at once.
HASHES_AT_ONCE = 2048

_draw = np.random.default_rng(42)
_FACTORS = _draw.integers(0, 1 << 64, (BANDS * BAND_HASHES, 1), np.uint64) | np.uint64(1)
_SHIFTS = _draw.integers(0, 1 << 64, (BANDS * BAND_HASHES, 1), np.uint64)


def shingles(raw: bytes) -> np.ndarray:
    """The sorted hashes of a UTF-8 text's shingles, each once."""
    words = raw.lower().split()
    if len(words) < SHINGLE_WORDS:
        joined = [b" ".join(words)] if words else []
    else:
        joined = map(b" ".join, zip(*(words[k : len(words) - SHINGLE_WORDS + 1 + k] for k in range(SHINGLE_WORDS))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), np.uint64))


def band_keys(found: np.ndarray) -> list[int]:
    """The signed 64-bit keys of a set of hashes; the empty set has none."""
    if not len(found):
        return []
    least = np.full(BANDS * BAND_HASHES, ~np.uint64(0))
    for start in range(0, len(found), HASHES_AT_ONCE):
        mixed = found[None, start : start + HASHES_AT_ONCE] * _FACTORS
        mixed += _SHIFTS
        np.minimum(least, mixed.min(1), out=least)
    bands = least.reshape(BANDS, BAND_HASHES)
    keys = [xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of hashes have at least the similarity ``SIMILAR``."""
    part, whole = SIMILAR
    if whole * min(len(a), len(b)) < part * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return whole * common >= part * (len(a) + len(b) - common)


def _prints(batches):
    for batch in slices(batches):
        nodes, keys, sims = [], [], []
        for raw in batch.column("text").to_pylist():
            found = shingles(raw)
            nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
            keys.append(band_keys(found))
            sims.append(simhash.majority([found], len(found)))
        yield pa.RecordBatch.from_arrays(
            [
                *batch.drop_columns(["text"]).columns,
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(sims, pa.int64()),
            ],
            names=[*(n for n in batch.schema.names if n != "text"), "fp", "bands", "sim"],
        )


def _sets(batches):
    for batch in slices(batches):
        found = [shingles(raw).tobytes() for raw in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "found"])


def _compared(batches):
    for batch in slices(batches):
        sides = zip(*(batch.column(n) for n in ("found_a", "found_b")))
        near = [similar(*(np.frombuffer(s.as_buffer(), np.uint64) for s in pair)) for pair in sides]
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the staged pairs (a, b) whose sets are similar."""
    first = sets.select(F.col("node").alias("a"), F.col("found").alias("found_a"))
    second = sets.select(F.col("node").alias("b"), F.col("found").alias("found_b"))
    # Staged between the joins: each then has two plain sides, of which a hot node's is split.
    half = staged(pairs.join(first, "a"), "half")
    return staged(half.join(second, "b").mapInArrow(_compared, "a bigint, b bigint"), "near")


def _ordered(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def met_in_balls(sims: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes that join all whose fingerprints ``simhash.links`` joins.

    ``sims`` (node, sim) is a staged table with one row per node. Nodes of one fingerprint meet the
    least of them, and these meet each other, so no common fingerprint makes all its pairs.
    """
    heads = staged(sims.groupBy("sim").agg(F.min("node").alias("head")), "heads")
    same = sims.join(heads, "sim").filter("node != head").select(*_ordered("node", "head"))
    one, other = (heads.select(F.col("sim").alias(n), F.col("head").alias(f"head_{n}")) for n in ("a", "b"))
    near = staged(simhash.links(heads.select(F.col("sim").alias("fp"))), "balls")
    half = staged(near.join(one, "a"), "half")
    return same.unionByName(half.join(other, "b").select(*_ordered("head_a", "head_b")))


def links(shared: DataFrame, sets: DataFrame, met: DataFrame) -> DataFrame:
    """(a, b): similar pairs that join all similar nodes with a common band, and those of the pairs ``met``.

    ``shared`` (band, node), ``sets`` (node, found) and ``met`` (a, b) are staged tables without repeats.
    """
    rows, before = shared.count(), None
    tested, found = met, _near(met, sets)
    roots = staged(components(found), "roots")
    members = staged(
        shared.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root")), "members"
    )
    turn = 0
    while True:
        drawn = F.struct(F.xxhash64("node", F.lit(turn)), "node", "root")
        pivots = staged(members.groupBy("band").agg(F.min(drawn).alias("pivot")), "pivots")
        met = members.join(pivots, "band").filter(F.col("root") != F.col("pivot.root"))
        pairs = staged(met.select(*_ordered("node", "pivot.node")).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        found = staged(found.unionByName(_near(pairs, sets)), "found")
        tested = staged(tested.unionByName(pairs), "tested")
        roots = staged(components(found), "roots")
        members = staged(
            shared.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root")), "members"
        )
        counts = staged(members.groupBy("band", "root").count(), "counts")
        apart = counts.groupBy("band").agg(
            F.max(F.struct("count", "root")).getField("root").alias("top"),
            F.count("*").alias("parts"),
            ((F.pow(F.sum("count"), 2) - F.sum(F.pow("count", 2))) / 2).alias("pairs"),
        )
        apart = staged(apart.filter("parts > 1").select("band", "top", "pairs"), "apart")
        unlinked = apart.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0]
        if unlinked <= rows or (before is not None and unlinked > 0.7 * before):
            break
        before, turn = unlinked, turn + 1
    mixed = staged(members.join(apart, "band").select("band", "node", "root", "top"), "mixed")
    # What is outside a band's largest component meets all of the band's other components.
    rest = mixed.filter("root != top").select("band", F.col("node").alias("other"), F.col("root").alias("other_root"))
    met = mixed.join(rest, "band").filter(
        (F.col("root") != F.col("other_root")) & ((F.col("root") == F.col("top")) | (F.col("node") < F.col("other")))
    )
    pairs = staged(met.select(*_ordered("node", "other")).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
    return found.unionByName(_near(pairs, sets))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group left, columns unchanged.

    The one that stays is as in ``simhash.keep_one``.
    """
    ship(docs.sparkSession)
    digest = F.xxhash64(F.col(text_col))
    texts = docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"), raw_text(text_col).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    prints = staged(
        texts.mapInArrow(_prints, f"doc_id {id_type}, digest bigint, fp bigint, bands array<bigint>, sim bigint"), "prints"
    )
    bands = staged(prints.select(F.explode("bands").alias("band"), F.col("fp").alias("node")).distinct(), "bands")
    often = staged(bands.groupBy("band").count().filter("count > 1").select("band"), "often")
    shared = staged(bands.join(often, "band"), "shared")
    sims = prints.filter(F.size("bands") > 0).groupBy(F.col("fp").alias("node")).agg(F.min("sim").alias("sim"))
    met = staged(met_in_balls(staged(sims, "sims")), "met")
    # One document of each node; no broadcast at any size, so that small inputs show what large ones cost.
    meeting = met.select(F.explode(F.array("a", "b")).alias("fp"))
    wanted = shared.select(F.col("node").alias("fp")).unionByName(meeting).distinct()
    one = staged(
        prints.groupBy("fp").agg(F.min(F.struct("doc_id", "digest")).alias("one")).join(wanted, "fp").select("fp", "one.*"),
        "one",
    )
    chosen = one.select(F.col("fp").alias("node"), F.col("doc_id").alias("i"), F.col("digest").alias("d"))
    picked = texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")))
    repeated = staged(picked.select("node", "text").mapInArrow(_sets, "node bigint, found binary"), "repeated")
    sets = staged(repeated.dropDuplicates(["node"]), "sets")
    rows = staged(prints.groupBy("fp", "doc_id", "digest").agg(F.count("*").alias("copies")), "rows")
    members = staged(components(links(shared, sets, met)), "members")
    return first_of_each(docs, rows, members, id_col, digest)
