"""Near duplicates by HyperMinHash.

The hashes of a text's distinct shingles fall into 128 buckets by their top bits. A bucket keeps of its least
hash only the count of leading zeros and ten bits after them, 16 bits in all. An empty bucket borrows the
register of another one, chosen by a fixed priority among those that are filled. Bands of five registers give
the candidates; the share of equal registers, corrected for chance collisions, discards most false ones;
what is left is decided on the full sets.

Equal sets are one class and only its least document takes part, so copies never meet. A small bucket gives
all its pairs. A large one is a star: every member against the least. Members of large buckets that are then
still in several components meet again by the rarest shingles of their sets (two sets this similar share
one of their first ``n - ceil(0.85 n) + 1`` in any fixed order), pairs within one component excepted. So no
bucket is capped and no link that could join two components is lost, save by the banding itself: at the
threshold a pair misses all 25 bands with a probability below one in a million.

Null and blank texts have no shingles and are linked with nothing. Repeated rows of one id are one document. An id
with several texts has a row, and so a verdict, for each; ``keep_first`` keeps all its rows if one of them is kept, so
that no text is lost. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirgate.llm.common import WordHashes, encoded, in_arrow, mixed, small, stage, windows
from weirgate.llm.components import components

WIDTH = 5
SIMILAR = 85  # per cent of the union
REGISTERS = 128
BAND_ROWS = 5
MANTISSA = 10
SMALL_BUCKET = 4
#: Below this estimate a pair at the threshold is more than five standard deviations off.
LEAST_ESTIMATE = 0.66
#: Chance that two unequal minima share a register, for sets of like size (HyperMinHash, section on collisions).
COLLISION = 0.1699 * 2.0 ** (1 - MANTISSA)


def shingles(text: bytes, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text: words between ASCII blanks, A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = hashes.of(words)
    if len(words) < width:
        return windows(ids, len(words)) ^ np.uint64(len(words))
    return np.unique(windows(ids, width))


def priorities() -> np.ndarray:
    """For each register, the order in which it turns to the others when its bucket is empty."""
    cells = np.arange(REGISTERS * REGISTERS, dtype=np.uint64).reshape(REGISTERS, REGISTERS)
    return mixed(cells + np.uint64(0x5851F42D4C957F2D))


def registers(sorted_hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers of a non-empty sorted set."""
    top = (sorted_hashes >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    filled = top[first]
    low = (sorted_hashes[first] >> np.uint64(4)) & np.uint64((1 << 53) - 1)
    zeros = 53 - np.frexp(low.astype(np.float64))[1]
    after = (low << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA) & np.uint64((1 << MANTISSA) - 1)
    values = (zeros << MANTISSA) | after.astype(np.int64)
    out = np.zeros(REGISTERS, np.int64)
    out[filled] = values
    if len(filled) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), filled, assume_unique=True)
        out[empty] = values[order[np.ix_(empty, filled)].argmin(1)]
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    hashes, order = WordHashes(), priorities()
    for batch in small(batches):
        counts, sets, sketches = [], [], []
        for text in encoded(batch, "text"):
            found = shingles(text, hashes)
            counts.append(len(found))
            sets.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            sketches.append(registers(found, order).astype(np.int32) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(sets, pa.binary()),
                pa.array(sketches, pa.list_(pa.int32())),
            ],
            ["doc_id", "n_shingles", "set_id", "sketch"],
        )


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id (128-bit hash of the set), sketch (registers)."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return in_arrow(texts, _sketch, "doc_id bigint, n_shingles bigint, set_id binary, sketch array<int>")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in small(batches):
        found = [shingles(text, hashes).view(np.int64) for text in encoded(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "items"])


def estimate(a: Column, b: Column) -> Column:
    """The Jaccard similarity that two sketches suggest, chance collisions taken off."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return (equal / REGISTERS - COLLISION) / (1 - COLLISION)


def _sizes_fit(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)


def _banded(reps: DataFrame) -> DataFrame:
    bands = [
        F.xxhash64(F.slice("sketch", i + 1, BAND_ROWS), F.lit(i)) for i in range(0, REGISTERS - BAND_ROWS + 1, BAND_ROWS)
    ]
    members = reps.select("id", "n", F.explode(F.array(*bands)).alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("id").alias("leader")).where("size > 1")
    return members.join(shared, "bucket")


def _candidates(buckets: DataFrame) -> DataFrame:
    small = buckets.where(F.col("size") <= SMALL_BUCKET).select("bucket", "id", "n")
    other = small.select("bucket", F.col("id").alias("other"), F.col("n").alias("m"))
    pairs = small.join(other, "bucket").where(F.col("id") < F.col("other")).where(_sizes_fit(F.col("n"), F.col("m")))
    stars = buckets.where((F.col("size") > SMALL_BUCKET) & (F.col("id") != F.col("leader")))
    return pairs.select(F.col("id").alias("a"), F.col("other").alias("b")).union(stars.select("leader", "id")).distinct()


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the wanted similarity."""
    one = reps.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = reps.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    both = pairs.join(one, "a").where("n_a > 0").join(two, "b")
    fits = _sizes_fit(F.col("n_a"), F.col("n_b")) & (estimate(F.col("s_a"), F.col("s_b")) >= LEAST_ESTIMATE)
    return both.where(fits).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("i")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("items").alias("j")), "b"
    )
    shared = F.size(F.array_intersect("i", "j"))
    return both.where(100 * shared >= SIMILAR * (F.size("i") + F.size("j") - shared)).select("a", "b")


def _by_rare_shingles(unsettled: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of ids in different components that share one of the rarest shingles of each."""
    items = unsettled.join(sets, "id").select("id", "component", F.size("items").alias("n"), F.explode("items").alias("item"))
    items = stage(items, "items")
    counts = items.groupBy("item").agg(F.count("*").alias("uses"))
    ranked = items.join(counts, "item").withColumn(
        "rank", F.row_number().over(Window.partitionBy("id").orderBy("uses", "item"))
    )
    prefix = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100) + 1
    rare = ranked.where((F.col("rank") <= prefix) & (F.col("uses") > 1)).select("item", "id", "n", "rank", "component")
    rare = stage(rare, "rare")
    parts = rare.groupBy("item", "component").agg(F.count("*").alias("part"))
    groups = parts.groupBy("item").agg(
        F.count("*").alias("n_parts"), F.max_by("component", F.struct("part", "component")).alias("major")
    )
    spread = rare.join(groups.where("n_parts > 1"), "item")
    minor = spread.where("component <> major").select(
        "item", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("rank").alias("r_a"), F.col("component").alias("c_a")
    )
    any_ = spread.select(
        "item", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("rank").alias("r_b"), F.col("component").alias("c_b"), "major"
    )
    meet = (F.col("c_a") != F.col("c_b")) & ((F.col("c_b") == F.col("major")) | (F.col("a") < F.col("b")))
    # At the first shingle a pair shares, what either set has from there on must hold all that they need to share.
    for n, rank in (("n_a", "r_a"), ("n_b", "r_b")):
        meet &= (100 + SIMILAR) * (F.col(n) - F.col(rank) + 1) >= SIMILAR * (F.col("n_a") + F.col("n_b"))
    return minor.join(any_, "item").where(meet & _sizes_fit(F.col("n_a"), F.col("n_b"))).select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    component_id is the least doc_id reachable over links of a similarity of 0.85 or more. A null doc_id has a
    null component and is kept.
    """
    sketched = stage(sketch(docs), "sketch")
    known = sketched.where("doc_id is not null and n_shingles > 0")
    classes = known.groupBy("set_id").agg(F.min("doc_id").alias("id"))
    picked = known.select("set_id", F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch")
    # An id given to several texts stands for the largest set among them when it is a representative.
    reps = picked.join(classes, ["set_id", "id"], "left_semi").groupBy("id").agg(
        F.max_by("n", F.struct("n", "set_id")).alias("n"), F.max_by("sketch", F.struct("n", "set_id")).alias("sketch")
    )
    reps = stage(reps, "reps")
    buckets = stage(_banded(reps), "buckets")
    likely = stage(_likely(_candidates(buckets), reps), "likely")

    large = buckets.where(F.col("size") > SMALL_BUCKET)
    wanted = likely.select(F.col("a").alias("id")).union(likely.select(F.col("b").alias("id"))).union(large.select("id"))
    # Written, so that Catalyst knows their size: where it may broadcast the ids it shuffles no texts.
    wanted = stage(wanted.distinct(), "wanted")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string"))
    chosen = texts.join(wanted, "id", "left_semi")
    sets = in_arrow(chosen, _sets, "id bigint, items array<bigint>")
    sets = stage(sets, "sets")
    links = stage(_verified(likely, sets), "links")

    found = components(links)
    labelled = large.select("bucket", "id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed_buckets = labelled.groupBy("bucket").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p <> q")
    unsettled = labelled.join(mixed_buckets, "bucket", "left_semi").select("id", "component").distinct()
    unsettled = stage(unsettled, "unsettled")
    if not unsettled.isEmpty():
        more = _verified(_likely(_by_rare_shingles(unsettled, sets), reps), sets)
        found = components(stage(links.union(more), "links"))

    at_class = sketched.join(classes, "set_id", "left").withColumn("id", F.coalesce("id", "doc_id"))
    component = F.coalesce("component", "id")
    return at_class.join(found, "id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that repeat one of a smaller id. Rows without doc_id stay."""
    kept = near_duplicates(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    repeats = stage(kept.where(~F.col("kept")).select("doc_id"), "repeats")
    return docs.join(repeats, "doc_id", "left_anti").select(docs.columns)
