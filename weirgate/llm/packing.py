"""Best-fit packing of token pieces after Martello-Toth dominance reduction.

Only how many pieces have each length matters for where pieces can go, and there are at most ``CAPACITY``
lengths. So the plan is made from a histogram, whatever the number of documents, and it is the plan that the
whole corpus as one instance would get. Then every piece finds its place from its length and its rank among
the pieces of that length. Ranks need no window over all pieces of a length: a task numbers its own pieces as
it cuts them, and the counts by (task, length) give where each task begins.

Reduction: take each length, longest first. If a set of one or two pieces dominates every other set of the pieces
left that fits beside it, that sequence is fixed, for as many copies as there are: when nothing fits, when one piece is as
long as any sum that fits, or when no three pieces fit and one pair has no smaller member than any other pair.
Lengths for which this cannot be shown remain, and go best-fit in decreasing order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirgate.llm.common import in_arrow, small, stage, texts

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
_SPECIAL = "<|endoftext|>"
_LONG_BLANKS = 2000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"


class Encoder:
    """Token ids of whole texts with the files of a public byte-level vocabulary.

    Ranks and JSON file hold the same vocabulary and give the same ids; the ranks are faster. The JSON file is
    used where they could differ: a special token spelt out in the text, or blanks beyond what one match takes.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import base64

        import public_tokenizers
        import tiktoken

        self.json = public_tokenizers.path(f"{vocabulary}.json")
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = None

    def ids(self, text: str) -> list[int]:
        if _SPECIAL in text or " " * _LONG_BLANKS in text or "\n" * _LONG_BLANKS in text:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.json)
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` ids: all full but perhaps the first."""
    first = total % capacity or min(total, capacity)
    return [(0, first)] + [(start, capacity) for start in range(first, total, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its place in the document, the checksum of its ids, the task that cut it, and its
    number among that task's pieces of the same length. Null text counts as empty: one piece, the end id."""

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder(), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in small(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch, "text")):
                ids = np.array(encoder.ids(text) + [END_ID], "<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((doc_id, number, start, length, crc, task, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "place")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return in_arrow(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), cut_all, PIECES)


def _reachable(counts: np.ndarray, room: int) -> int:
    """The largest sum of pieces left that is at most ``room``."""
    sums, mask = 1, (1 << (room + 1)) - 1
    for size in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, step = min(int(counts[size]), room // size), 1
        while left:  # copies in powers of two
            take = min(step, left)
            sums |= (sums << (size * take)) & mask
            left -= take
            step *= 2
        if sums >> room:
            return room
    return sums.bit_length() - 1


def _dominant(counts: np.ndarray, capacity: int, length: int) -> tuple[int, ...] | None:
    """The pieces of the set that dominates all others beside a piece of the given length; None if none is shown.

    ``counts`` is without that piece.
    """
    room = capacity - length
    fitting = np.flatnonzero(counts[: room + 1])
    if not len(fitting):
        return ()
    best = int(fitting[-1])
    if best == room or _reachable(counts, room) <= best:
        return (best,)
    smallest = np.repeat(fitting[:3], np.minimum(counts[fitting[:3]], 3))[:3]
    if len(smallest) == 3 and smallest.sum() <= room:
        return None
    # At most two fit: the pair whose smaller and larger members are both the largest of any pair.
    low = high = 0
    for small in fitting.tolist():
        partners = fitting[(fitting >= small) & (fitting <= room - small)]
        partners = partners[(partners > small) | (counts[partners] > 1)]
        if len(partners):
            low, high = max(low, small), max(high, int(partners[-1]))
    high = max(high, best)
    if low + high <= room and (low != high or counts[low] > 1):
        return (high, low)
    return None


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (piece lengths, number of such sequences), from the number of pieces of each length."""
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in lengths.items():
        if not 0 < size <= capacity:
            raise ValueError(f"a piece of {size} does not fit in {capacity}")
        counts[size] += n
    done: list[tuple[tuple[int, ...], int]] = []
    fixed = True
    while fixed:  # what one pass takes away may make another set dominant
        fixed = False
        for size in range(capacity, 0, -1):
            while counts[size]:
                counts[size] -= 1
                beside = _dominant(counts, capacity, size)
                counts[size] += 1
                if beside is None:
                    break
                use = np.bincount([size, *beside], minlength=capacity + 1)
                copies = int((counts[use > 0] // use[use > 0]).min())
                counts -= copies * use
                done.append(((size, *beside), copies))
                fixed = True
    # Best fit, decreasing: open sequences by room left, each kind with its number.
    open_: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        for room in range(size, capacity + 1):
            # A sequence that takes one copy is then the tightest for the next, while it has room.
            fill = room // size
            while left and open_[room]:
                kind, n = open_[room].popitem()
                full = min(n, left // fill)
                for copies, number in ((fill, full), (left % fill, int(n > full and left // fill == full))):
                    if copies and number:
                        key, space = (*kind, *[size] * copies), room - size * copies
                        open_[space][key] = open_[space].get(key, 0) + number
                        left -= copies * number
                        n -= number
                if n:
                    open_[room][kind] = n
        while left:
            fill = capacity // size
            whole, over = divmod(left, fill)
            kind, n = ((size,) * fill, whole) if whole else ((size,) * over, 1)
            space = capacity - size * len(kind)
            open_[space][kind] = open_[space].get(kind, 0) + n
            left -= n * len(kind)
    for kinds in open_:
        done.extend(kinds.items())
    return done


def slots(sequences: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset) of every place in a plan."""
    out, used, first = [], {}, 0
    for kind, n in sequences:
        offset = 0
        for size in kind:
            rank = used.get(size, 0)
            out.append((size, rank, n, first, offset))
            used[size] = rank + n
            offset += size
        first += n
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    cut_pieces = stage(pieces(docs, capacity), "pieces")
    counts = stage(cut_pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(plan(histogram, capacity))

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut_pieces.join(begun, ["task", "length"]).withColumn("rank", F.col("before") + F.col("place"))

    # The plan has no more kinds than lengths and open rooms allow, whatever the number of pieces.
    table = np.array(sorted(places) or [(0, 0, 0, 0, 0)], np.int64).reshape(-1, 5)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        keys = at[:, 0] * (1 << 50) + at[:, 1]
        for batch in small(batches):
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(False) for c in ("length", "rank"))
            row = at[np.searchsorted(keys, length * (1 << 50) + rank, side="right") - 1]
            found = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays(
                [*found.columns, pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])],
                [*found.schema.names, "sequence_id", "offset"],
            )

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return in_arrow(ranked, place, schema)
