"""Spelling variants of the words of a corpus, grouped by their nearest more frequent form.

Two words are near if one inserted, deleted or replaced code point makes one of the other. Near words are found on a
bit-sliced position index: for every position and letter a bitset over the vocabulary, one bit a word. A query word
is read letter by letter. Three bitsets follow at once which words agree so far without an error, which after one
replacement, and, from the bitsets of the next position, which after one inserted letter; each step is a few
operations on whole bitsets, for all words of the index together. Deletions are insertions seen from the other word.

The vocabulary is dealt to cells so that near words meet in one: one error leaves either the first or the last
``m div 2`` letters of both words alone, m being the length of the shorter one. A cell's words share that half. A pair
is taken where its first halves agree, else where its last ones do, so it is found once. Half the letters of words of
one length may still be the same in a large part of the vocabulary: such a cell is split, its queries and its index
into parts of ``BLOCK_LETTERS`` that meet pairwise. Tasks take shards of many cells.

Counts are over all texts; each task adds up what it reads before words are shuffled. Null and empty texts have no
words. Texts and words may be of any length. Runs of rows without id stay as they are. Repeated rows count
each. Ties go to the first word in code-point order. An empty table gives no words. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import encoded, small, stage

#: What a run of letters is.
RUNS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
FORM_RATIO = 2
BLOCK_LETTERS = 200_000
SHARD_LETTERS = 1_000_000
#: Distinct words that a task counts before it sends them on.
HELD_WORDS = 300_000


def words_of(text: bytes, doc_id: int | None, slip_every: int | None) -> Iterator[tuple[str, int]]:
    """The distinct words of a text after slips, with their counts; a word may come more than once.

    Where ``slip_every`` divides the checksum of id and run, the run loses the letter that the checksum names.
    """
    found = Counter(re.findall(RUNS, text.lower().decode()))  # bytes have lower case for A-Z only
    if doc_id is None or slip_every is None:
        yield from found.items()
        return
    start = zlib.crc32(f"{doc_id}:".encode())
    for word, n in found.items():
        checksum = zlib.crc32(word.encode(), start)
        if checksum % slip_every == 0:
            at = checksum % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def _counter(slip_every: int | None, least_length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = defaultdict(int)

        def sent() -> pa.RecordBatch:
            words, counts = pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])

        for batch in small(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), encoded(batch, "text")):
                for word, n in words_of(text, doc_id, slip_every):
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield sent()
        yield sent()

    return run


def vocabulary(docs: DataFrame, slip_every: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of at least so many code points and occurrences in ``docs`` (doc_id, text)."""
    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    counted = read.mapInArrow(_counter(slip_every, least_length), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class PositionIndex:
    """For every position and letter the set of words that have it there, as the bits of an integer."""

    def __init__(self, words: list[str]):
        # Long words first: their far positions then are small integers.
        self.words = sorted(words, key=len, reverse=True)
        self.at: dict[tuple[int, str], int] = defaultdict(int)
        self.of_length: dict[int, int] = defaultdict(int)
        for k, word in enumerate(self.words):
            bit = 1 << k
            self.of_length[len(word)] |= bit
            for place in enumerate(word):
                self.at[place] |= bit

    def near(self, query: str) -> tuple[int, int]:
        """Words of the query's length with one other letter, and words with one letter more."""
        exact = (1 << len(self.words)) - 1
        replaced = inserted = 0
        at = self.at.get
        for p, letter in enumerate(query):
            here = at((p, letter), 0)
            inserted = (inserted | exact) & at((p + 1, letter), 0)
            replaced = replaced & here | exact & ~here
            exact &= here
            if not (exact or replaced or inserted):
                return 0, 0
        return replaced & self.of_length.get(len(query), 0), (inserted | exact) & self.of_length.get(len(query) + 1, 0)

    def members(self, bits: int) -> Iterator[str]:
        while bits:
            low = bits & -bits
            yield self.words[low.bit_length() - 1]
            bits ^= low


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs within the cells of a shard, in both directions; rows come sorted by cell."""
    shard = pa.Table.from_batches(list(batches)).sort_by("cell")
    rows = zip(*(shard.column(c).to_pylist() for c in ("cell", "side", "role", "word", "n")))
    out: tuple[list, list, list] = ([], [], [])
    for _, cell in groupby(rows, key=lambda row: row[0]):
        cell = list(cell)
        counts = {word: n for _, _, _, word, n in cell}
        index = PositionIndex([word for _, _, role, word, _ in cell if role == "index"])
        for _, side, role, word, n in cell:
            if role == "index":
                continue
            half = len(word) // 2
            for bits, both in zip(index.near(word), (False, True)):
                for other in index.members(bits):
                    if side == "last" and word[:half] == other[:half]:
                        continue  # this pair is taken by its first half
                    for column, value in zip(out, (word, other, counts[other])):
                        column.append(value)
                    if both:
                        for column, value in zip(out, (other, word, n)):
                            column.append(value)
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], ["word", "near", "near_n"])


def cells(words: DataFrame, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """cell, side, role, word, n, length: where each word is a query or in an index; cells without pairs are left out."""
    sized = words.withColumn("length", F.char_length("word"))
    # In the cells of m a word of m letters asks; words of m and of m + 1 letters are in the index.
    halves = F.array(
        *[
            F.struct(m.alias("m"), F.lit(side).alias("side"), half(F.col("word"), F.expr(f"int(({extra}) div 2)")).alias("half"))
            for m, extra in ((F.col("length"), "length"), (F.col("length") - 1, "length - 1"))
            for side, half in (("first", F.left), ("last", F.right))
        ]
    )
    keyed = sized.select("word", "n", "length", F.explode(halves).alias("k")).select("word", "n", "length", "k.*")
    asks = F.col("length") == F.col("m")
    groups = keyed.groupBy("m", "side", "half").agg(
        F.count_if(asks).alias("asking"), F.count("*").alias("members"), F.sum("length").alias("letters")
    )
    met = groups.where("asking > 0 AND members > 1").withColumn("parts", F.ceil(F.col("letters") / block_letters).cast("int"))
    joined = keyed.join(met.select("m", "side", "half", "parts"), ["m", "side", "half"])
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    role = F.explode(F.when(asks, F.array(F.lit("query"), F.lit("index"))).otherwise(F.array(F.lit("index"))))
    placed = joined.select("*", own.alias("own"), role.alias("role")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asking = F.when(F.col("role") == "query", F.col("own")).otherwise(F.col("other"))
    asked = F.when(F.col("role") == "query", F.col("other")).otherwise(F.col("own"))
    cell = F.concat_ws("/", "m", "side", asking.cast("string"), asked.cast("string"), "half")
    return placed.select(cell.alias("cell"), "side", "role", "word", "n", "length")


def near_pairs(words: DataFrame, block_letters: int = BLOCK_LETTERS, shard_letters: int = SHARD_LETTERS) -> DataFrame:
    """word, near, near_n: every pair of near words of ``words`` (word, n), in both directions."""
    placed = stage(cells(words, block_letters), "cells")
    letters = placed.agg(F.sum("length")).first()[0] or 0
    shard = F.pmod(F.xxhash64("cell"), F.lit(letters // shard_letters + 1))
    return placed.withColumn("shard", shard).groupBy("shard").applyInArrow(_shard, "word string, near string, near_n bigint")


def _shard(rows: pa.Table) -> pa.Table:
    return pa.Table.from_batches(_pairs(iter(rows.to_batches())))


def roots(forms: DataFrame, most_rounds: int = 12) -> DataFrame:
    """word, root: where following ``forms`` (word, form) ends. Each round doubles the steps taken.

    Counts at least double with each form, so no chain is longer than a count has bits.
    """
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(most_rounds):
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = at.join(further, "root", "left")
        if joined.where("next IS NOT NULL").isEmpty():
            return at
        at = stage(joined.select("word", F.coalesce("next", "root").alias("root")), "roots")
    raise RuntimeError("forms run in a circle")


def group_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of ``words`` (word, n); a form has at least ``ratio`` times the count."""
    words = stage(words.select("word", "n"), "words")
    pairs = near_pairs(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    found = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left")
    taken = -F.col("best.less") >= ratio * F.col("n")
    grouped = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"),
        F.when(taken, -F.col("best.less")).alias("form_n"),
    )
    grouped = stage(grouped, "forms")
    ended = roots(grouped.where("form IS NOT NULL"))
    return grouped.join(ended, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
