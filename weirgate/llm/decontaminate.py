"""Benchmark decontamination over templates.

A text is read as bare lower-case words, and as a template: numbers (in digits or spelt out), units after numbers,
and names turn into typed placeholders. A run of capitalised words is one name. Whether one that begins a sentence
or a line is a name cannot be seen, so a text that has such words, other than common ones, gives two templates: in
one they are words, in the other names. Windows of eight words of the documents are joined by hash with those of
the benchmark. A question asked again with other numbers or names has the same template windows; that it is the
same question shows in its slots: within one occurrence, a value of the benchmark must always stand for the same
value of the document and the other way round. Windows of slots alone say nothing and are not joined, but count.

A document is contaminated by an item when equal bare windows, or consistent occurrences of a template, cover at
least half of the item's windows; it is exact when the bare windows cover as much as any template does.
Documents are read whole in one pass; a bit table of the benchmark's hashes, of bounded size, keeps windows
that cannot join from being shuffled. Items with fewer than eight words are one window of their own length
(a run of names counts as one in a template). Items of one or two words are in documents that have these words and
no other. Null and blank texts on either side match nothing; of an item_id with several texts each is looked for by
its own windows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import HELD_WORDS, in_arrow, mixed, slices, small, stage, texts, windows

WIDTH = 8
LEAST_WIDTH = 3
COVERAGE = 0.5
#: Readings of a text: bare words, and templates whose sentence openers are words or names.
BARE, WORDS, NAMES = 0, 1, 2
LEAST_BITS, MOST_BITS = 20, 24
#: Characters of the texts that are read at a time; a longer text is read by itself.
READ_CHARS = 500_000
NUMBER, UNIT, NAME = (np.uint64(k) for k in (11, 12, 13))
SEPARATOR = "\x1f"

# Unit words.
UNITS = frozenset(
    "mm cm m km mg g kg t ml l s min h hours hour minutes minute seconds second days day weeks week months month"
    " years year miles mile feet foot ft inches inch in yards yard pounds pound lb lbs ounces oz percent dollars"
    " dollar euros euro cents cent usd eur meters meter metres metre kilometers kilometres grams gram kilograms"
    " liters litres degrees".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
# Words that begin sentences and are no names.
OPENERS = frozenset(
    "a an the this that these those there here it its he she they we you i his her their our your my what which who"
    " whom whose when where why how if then is are was were do does did has have had can could will would shall should"
    " may might must in on at by for from to of with without after before during while since until as and or but so"
    " not no all each every some any many most both one two let given suppose find calculate compute solve write".split()
)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?$")


class Templates(dict):
    """Number of every blank-separated word, with its hash and kind, kept for words seen before."""

    def __init__(self, most: int = HELD_WORDS):
        super().__init__()
        self.most = most
        self.hashes, self.flags = array("Q"), array("B")

    def __missing__(self, word: str) -> int:
        import xxhash

        core = word if word.isalpha() else _EDGE.sub("", word)
        low = core.lower()
        if core.isalpha():
            number = low in NUMBER_WORDS
        else:
            number = bool(_NUMBER.match(core) or _NUMBER.match(word)) or bool(core) and all(p in NUMBER_WORDS for p in low.split("-"))
        capital = core[:1].isupper() and core[1:2].islower()
        self.hashes.append(xxhash.xxh64_intdigest(low) if core else 0)
        self.flags.append(
            number
            | (low in UNITS) << 1
            | capital << 2
            | word.endswith((".", "!", "?", ":", ".)", '."')) << 3
            | (not core) << 4
            | (low in OPENERS) << 5
        )
        k = self[word] = len(self)
        return k

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each word; when too many words are known, all are forgotten first."""
        if len(self) > self.most:
            self.clear()
            self.hashes, self.flags = array("Q"), array("B")
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def of(self, texts: list[str]) -> tuple[list[str], list[Reading]]:
        """The words of some texts, one after the other, and their readings: bare words, and templates whose openers are
        words, of all texts; templates whose openers are names, of the texts that have openers which may be names."""
        words: list[str] = []
        lines, sizes = [], []
        for text in texts:
            before = len(words)
            for line in text.split("\n"):
                lines.append(len(words))
                words += line.split()
            sizes.append(len(words) - before)
        ids = self.numbers(words)
        flags, hashes = np.array(self.flags, np.uint8)[ids], np.array(self.hashes, np.uint64)[ids]
        owner = np.repeat(np.arange(len(texts)), sizes)
        begins = np.r_[False, (flags & 8) > 0]
        begins[lines] = True
        begins = begins[:-1]
        number = (flags & 1) > 0
        unit = (flags & 2) > 0
        unit[1:] &= number[:-1] & (owner[1:] == owner[:-1])
        unit[:1] = False
        capital = ((flags & 4) > 0) & ~number
        opens = begins & capital & ((flags & 32) == 0)
        place = np.arange(len(words))
        keep = (flags & 16) == 0
        if not keep.all():
            place, owner, hashes, number, unit, capital, begins, opens = (
                x[keep] for x in (place, owner, hashes, number, unit, capital, begins, opens)
            )
        out = [Reading(BARE, hashes, np.zeros(len(hashes), bool), place, place + 1, owner)]
        name = capital & ~begins
        out.append(_template(WORDS, hashes, number, unit & ~name, name, begins, place, owner))
        if opens.any():
            some = np.zeros(len(texts), bool)
            some[owner[opens]] = True
            of = some[owner]
            hashes, number, unit, capital, begins, opens, place, owner = (
                x[of] for x in (hashes, number, unit, capital, begins, opens, place, owner)
            )
            name = capital & (~begins | opens)
            out.append(_template(NAMES, hashes, number, unit & ~name, name, begins, place, owner))
        return words, out


@dataclass
class Reading:
    """Of each word with a letter or digit (a run of names is one) its hash, whether it is a slot, the numbers of its
    first word and of the word after its last one, and the text it belongs to."""

    kind: int
    hashes: np.ndarray
    slot: np.ndarray
    place: np.ndarray
    end: np.ndarray
    owner: np.ndarray

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows within one text that have a word which is no slot."""
        if len(self.hashes) < width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        found = mixed(_windows(self.hashes, width) + np.uint64(width if self.kind else width << 32))
        inside = self.owner[width - 1 :] == self.owner[: len(found)]
        if self.slot.any():
            plain = np.cumsum(np.r_[0, ~self.slot])
            inside &= plain[width:] > plain[:-width]
        at = np.flatnonzero(inside)
        return at, found[at]

    def values(self, words: list[str], at: int, width: int) -> str:
        """The values of a window's slots; words without letter or digit count for nothing."""
        runs = [words[self.place[i] : self.end[i]] for i in range(at, at + width) if self.slot[i]]
        return SEPARATOR.join(" ".join(v for v in map(_value, run) if v) for run in runs)


def _template(kind, hashes, number, unit, name, begins, place, owner) -> Reading:
    slot = number | unit | name
    if not slot.any():
        return Reading(kind, hashes, slot, place, place + 1, owner)
    made = hashes.copy()
    made[number], made[unit], made[name] = NUMBER, UNIT, NAME
    more = name[1:] & name[:-1] & ~begins[1:] & (owner[1:] == owner[:-1])
    if more.any():
        first = np.r_[True, ~more]
        return Reading(kind, made[first], slot[first], place[first], place[np.r_[first[1:], True]] + 1, owner[first])
    return Reading(kind, made, slot, place, place + 1, owner)


def _value(word: str) -> str:
    return _EDGE.sub("", word).lower()


def _windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """``windows``; a power of two is doubled up to."""
    if width & (width - 1):
        return windows(hashes, width)
    factor, span = 0x9E3779B97F4A7C15, 1
    while span < width:
        hashes = hashes[:-span] * np.uint64(factor) + hashes[span:]
        factor, span = factor * factor % (1 << 64), 2 * span
    return mixed(hashes)


def _window_rows(id_name: str, widths, bits: np.ndarray | None, whole_item: bool):
    """A function that turns (id, text) batches into rows of windows that the bit table knows. Items are read one by
    one, in windows of their own width; documents some at a time, in windows of each given width."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        table = bits.value if bits is not None else None
        for batch in small(batches):
            out: list[tuple] = []
            keys = batch.column(0).to_pylist()
            first = 0
            for part in slices(texts(batch, "text"), 0 if whole_item else READ_CHARS):
                words, readings = templates.of(part)
                for reading in readings:
                    sizes = np.bincount(reading.owner, minlength=len(part))
                    starts = np.cumsum(sizes) - sizes
                    for width in [min(WIDTH, len(reading.hashes))] if whole_item else widths:
                        if not width or width < LEAST_WIDTH and reading.kind:
                            continue
                        at, found = reading.windows(width)
                        if width < LEAST_WIDTH:  # nothing but the whole text tells anything
                            whole = sizes[reading.owner[at]] == width
                            at, found = at[whole], found[whole]
                        if table is not None and len(found):
                            cell = found & np.uint64(len(table) * 8 - 1)
                            hit = (table[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
                            at, found = at[hit], found[hit]
                        of = reading.owner[at]
                        out.extend(
                            (keys[first + k], reading.kind, width, i - start, h, reading.values(words, i, width), size - width + 1)
                            for i, k, start, size, h in zip(
                                at.tolist(), of.tolist(), starts[of].tolist(), sizes[of].tolist(), found.view(np.int64).tolist()
                            )
                        )
                first += len(part)
            columns = list(zip(*out)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            names = (id_name, "reading", "width", "at", "window", "slots", "total")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return rows, f"{id_name} bigint, reading int, width int, at bigint, window bigint, slots string, total bigint"


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, reading, width, at, window, slots, total (windows of the item)."""
    rows, schema = _window_rows("item_id", None, None, True)
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return in_arrow(items.distinct(), rows, schema)


def bit_table(hashes: DataFrame) -> np.ndarray:
    """A bit per cell that some window falls in; 16 cells a window, within bounds on the table's size.

    Spark sets the bits of each 64-bit word; the driver gets one row a word, ``2 ** (MOST_BITS - 6)`` at most.
    """
    n = hashes.count()
    size = 1 << min(max(LEAST_BITS, int(np.ceil(np.log2(16 * n + 1)))), MOST_BITS)
    cell = F.col("window").bitwiseAND(F.lit(size - 1))
    words = hashes.select(F.shiftright(cell, 6).alias("word"), F.expr("shiftleft(1L, cast(window & 63 as int))").alias("bit"))
    table = np.zeros(size // 64, np.int64)
    for row in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        table[row["word"]] = row["bits"]
    return table.view(np.uint8)


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, coverage, kind ('exact' or 'reparameterised') of each contaminated document and item."""
    items = stage(benchmark_windows(benchmark), "items")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(items))
    rows, schema = _window_rows("doc_id", widths, bits, False)
    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    hits = in_arrow(named, rows, schema).select(
        "doc_id", F.col("reading").alias("doc_reading"), "at", "window", F.col("slots").alias("values")
    )

    joined = hits.join(
        items.select("window", "item_id", "reading", F.col("at").alias("item_at"), "slots", "total"), "window"
    ).select("doc_id", "item_id", "reading", "doc_reading", "item_at", "total", (F.col("at") - F.col("item_at")).alias("shift"), "slots", "values")
    # An occurrence is a run at one shift; an item bounds its windows, so these groups are small.
    occurrence = joined.groupBy("doc_id", "item_id", "reading", "doc_reading", "shift").agg(
        F.collect_set("item_at").alias("places"),
        F.first("total").alias("total"),
        F.array_distinct(
            F.flatten(F.collect_set(F.arrays_zip(F.split("slots", SEPARATOR).alias("theirs"), F.split("values", SEPARATOR).alias("ours"))))
        ).alias("pairs"),
    )
    theirs, ours = (F.size(F.array_distinct(F.col(f"pairs.{c}"))) for c in ("theirs", "ours"))
    consistent = (theirs == F.size("pairs")) & (ours == F.size("pairs"))
    covered = occurrence.where(consistent)
    per_reading = covered.groupBy("doc_id", "item_id", "reading", "doc_reading").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"),
        F.max("total").alias("total"),
    )
    share = F.least(F.col("n") / F.col("total"), F.lit(1.0))
    bare = F.max(F.when(F.col("reading") == BARE, share).otherwise(0.0))
    per_item = per_reading.groupBy("doc_id", "item_id").agg(F.max(share).alias("coverage"), bare.alias("bare"))
    kind = F.when(F.col("bare") >= F.col("coverage"), "exact").otherwise("reparameterised")
    return per_item.where(F.col("coverage") >= coverage).select("doc_id", "item_id", "coverage", kind.alias("kind"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents. Rows without doc_id stay.

    The ids are written first: Catalyst then knows their size, and shuffles no texts where it may broadcast them.
    """
    leaked = stage(contamination(docs, benchmark).select("doc_id").distinct(), "leaked")
    return docs.join(leaked, "doc_id", "left_anti").select(docs.columns)
