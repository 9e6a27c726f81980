"""Language identification by interpolated Kneser-Ney character models, one per language.

A word is its letters with a border on both sides; four symbols of 16 bits make one n-gram of exactly 64 bits, so
the context and the shorter n-gram of an n-gram are shifts of it. Tasks count n-grams of all training texts and
combine them before the shuffle; no n-gram is dropped. Discounts, continuation counts, backoffs and probabilities
are Spark tables, one per order: discounted counts at order four, continuation counts below, each order
interpolated with the next one. A group of n-grams of one context, or of one ending, has at most a row per symbol.

Models of at most ``SENT_CELLS`` cells are sent to the tasks as sorted arrays of hashes with a row of
log-probabilities per language, looked up by binary search. Larger ones stay tables, and the distinct n-grams of the
texts are joined with them; both ways give the same sums, only the order of additions differs.

A text's language has the least cross-entropy per symbol. How sure that is comes from a logistic fit, over texts
that trained no model, of being right on the margin to the second language and on the length; below a wanted
probability the text is rejected as ``und``. Texts without a letter, and null texts, are ``und`` with score 0.

Null languages teach nothing. Ties go to the language that sorts first. Runs of more than 32 letters are read in parts
of 32, texts are read whole however long. Each row of a repeated id has its own result; repeated rows teach each time.
Without a text that teaches, all are ``und``; an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import mixed, shared, slices, small, stage, texts
from weirgate.llm.toxicity import logistic

ORDER = 4
BITS = np.uint64(16)
#: Cells (n-grams of all orders, times languages) of the largest models that are sent to tasks; larger ones are joined.
SENT_CELLS = 16_000_000
CALIBRATION_DOCS = 4000
#: Distinct words that a task holds before it gives their n-grams on.
HELD_WORDS = 200_000
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]{1,32}")


def runs(word: str) -> list[str]:
    """The runs of letters of a piece of text; longer ones than 32 letters are cut."""
    return [word] if word.isalpha() and len(word) <= 32 else _LETTERS.findall(word)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that end at each letter and at the end of each word, and how many each word has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    joined = "".join(["\0\0\0" + w + " " for w in words])
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    points = np.where(points < 1 << 16, points, 0xE000 + points % 6400)
    out = points.copy()
    for k in range(1, ORDER):
        out[k:] |= points[:-k] << np.uint64(k * BITS)
    return out[points > 0], sizes


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            parts = [(r, n) for w, n in words.items() for r in runs(w)]
            if parts:
                keys, sizes = grams([p[0] for p in parts])
                keys, n = _summed(keys, np.repeat(np.array([p[1] for p in parts], np.int64), sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                    ["lang", "gram", "n"],
                )
        held.clear()

    for batch in small(batches):
        for text, lang in zip(texts(batch, "text"), batch.column(batch.schema.get_field_index("lang")).to_pylist()):
            held.setdefault(lang, Counter()).update(text.lower().split())
        if sum(map(len, held.values())) > HELD_WORDS:
            yield from counted()
    yield from counted()


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all texts with a language."""
    known = docs.where("lang is not null and text is not null").select(
        F.col("text").cast("string"), F.col("lang").cast("string")
    )
    counted = known.mapInArrow(_count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """One order: hashes of n-grams and contexts, each with a row of logarithms per language."""

    keys: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    backoffs: np.ndarray


@dataclass
class Arrays:
    """Models as they are sent."""

    langs: list[str]
    levels: list[Level]
    #: Log-probability of an unseen symbol.
    floor: float

    def gram_logs(self, keys: np.ndarray) -> np.ndarray:
        """Log-probability of the last symbol of each n-gram after its others, per language."""
        out = np.full((len(keys), len(self.langs)), self.floor)
        for k, level in enumerate(self.levels, 1):
            if k > 1:
                out += _rows(level.contexts, level.backoffs, _hash(_tail(keys, k) >> BITS, k), 0.0)
            else:
                out += level.backoffs[0]
            seen = _rows(level.keys, level.logs, _hash(_tail(keys, k), k), np.nan)
            out = np.where(np.isnan(seen), out, seen)
        return out

    def word_logs(self, words: list[str]) -> np.ndarray:
        """For each word the sum of logs per language, and last its number of symbols."""
        out = np.zeros((len(words), len(self.langs) + 1))
        parts = [(i, r) for i, w in enumerate(words) for r in runs(w)]
        if parts:
            keys, sizes = grams([r for _, r in parts])
            distinct, place = np.unique(keys, return_inverse=True)
            logs = np.c_[self.gram_logs(distinct), np.ones(len(distinct))][place]
            sums = np.add.reduceat(logs, np.r_[0, np.cumsum(sizes)[:-1]])
            np.add.at(out, np.array([i for i, _ in parts]), sums)
        return out


def _tail(keys: np.ndarray, order: int) -> np.ndarray:
    return keys if order == ORDER else keys & np.uint64((1 << (16 * order)) - 1)


def _hash(keys: np.ndarray, order: int) -> np.ndarray:
    return mixed(keys ^ np.uint64(order * 0x9E3779B97F4A7C15 % (1 << 64)))


def _rows(keys: np.ndarray, rows: np.ndarray, wanted: np.ndarray, absent: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    if not len(keys):
        return np.full((len(wanted), rows.shape[1]), absent)
    return np.where((keys[at] == wanted)[:, None], rows[at], absent)


@dataclass
class LanguageModels:
    langs: list[str]
    floor: float
    #: Per order, from one: lang, gram, log, context, backoff (a logarithm too).
    tables: list[DataFrame]
    arrays: Arrays | None
    #: Margin, log length and constant, to the probability of being right.
    scale: np.ndarray = field(default_factory=lambda: np.array([8.0, 0.0, 0.0, 0.0]))


def _ending(gram: str, order: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << 16 * order) - 1)) if order < ORDER else F.col(gram)


def kneser_ney(counts: DataFrame) -> tuple[list[DataFrame], DataFrame, float]:
    """Per order, from one, the written table (lang, gram, log, context, backoff); the table of n-grams and discounts by
    order and language; and the logarithm of an unseen symbol's share."""
    tables = [counts]
    for k in range(ORDER - 1, 0, -1):  # continuation counts: kinds of longer n-grams with this end
        ends = tables[0].groupBy("lang", _ending("gram", k).alias("gram")).agg(F.count("*").alias("n"))
        tables.insert(0, stage(ends, f"ends_{k}"))
    once, twice = F.sum((F.col("n") == 1).cast("bigint")), F.sum((F.col("n") == 2).cast("bigint"))
    discount = F.when(once > 0, F.least(F.greatest(once / (once + 2 * twice), F.lit(0.1)), F.lit(0.95))).otherwise(0.5)
    of_orders = [
        t.groupBy("lang").agg(F.count("*").alias("grams"), discount.alias("discount")).select(F.lit(k).alias("k"), "*")
        for k, t in enumerate(tables, 1)
    ]
    rates = stage(reduce(DataFrame.unionByName, of_orders), "rates")
    symbols = tables[0].select("gram").distinct().agg((F.count("*") + 1).alias("symbols")).first().symbols
    same = Window.partitionBy("lang", "context")
    out: list[DataFrame] = []
    for k, table in enumerate(tables, 1):
        rows = (
            table.withColumn("context", F.shiftrightunsigned("gram", 16))
            .withColumn("total", F.sum("n").over(same))
            .withColumn("kinds", F.count("*").over(same))
            .join(rates.where(F.col("k") == k).select("lang", "discount"), "lang")
            .withColumn("backoff", F.col("discount") * F.col("kinds") / F.col("total"))
            .withColumn("ending", _ending("gram", k - 1))
        )
        if out:
            lower = out[-1].select("lang", F.col("gram").alias("ending"), F.exp("log").alias("lower"))
            rows = rows.join(lower, ["lang", "ending"])
        else:
            rows = rows.withColumn("lower", F.lit(1 / symbols))
        p = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("backoff") * F.col("lower")
        found = rows.select("lang", "gram", F.log(p).alias("log"), "context", F.log("backoff").alias("backoff"))
        out.append(stage(found, f"order_{k}"))
    return out, rates, -float(np.log(symbols))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]], order: int, absent: float) -> tuple[np.ndarray, np.ndarray]:
    hashes = [_hash(keys, order) for keys, _ in parts]
    keys = np.unique(np.concatenate(hashes))
    rows = np.full((len(keys), len(parts)), absent, np.float32)
    for lang, (found, (_, values)) in enumerate(zip(hashes, parts)):
        rows[np.searchsorted(keys, found), lang] = values
    return keys, rows


def build(counts: DataFrame, sent_cells: int = SENT_CELLS) -> LanguageModels:
    """The models of all languages in (lang, gram, n); to be sent if they have ``sent_cells`` cells at most."""
    tables, rates, floor = kneser_ney(counts)
    sizes = rates.groupBy("lang").agg(F.sum("grams").alias("grams")).collect()  # a row per language
    langs = sorted(r.lang for r in sizes)
    arrays = None
    if sum(r.grams for r in sizes) * len(langs) <= sent_cells:
        arrays = Arrays(langs, [_level(t, langs, k) for k, t in enumerate(tables, 1)] if langs else [], floor)
    return LanguageModels(langs, floor, tables, arrays)


def _level(table: DataFrame, langs: list[str], order: int) -> Level:
    found = table.select("lang", "gram", F.col("log").cast("float"), "context", F.col("backoff").cast("float")).toArrow()
    coded = found.column("lang").combine_chunks().dictionary_encode()
    names, lang = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    gram, context = (found.column(c).to_numpy().view(np.uint64) for c in ("gram", "context"))
    log, backoff = found.column("log").to_numpy(), found.column("backoff").to_numpy()
    seen, backed = [], []
    for name in langs:
        own = np.flatnonzero(lang == names.index(name))
        contexts, first = np.unique(context[own], return_index=True)
        seen.append((gram[own], log[own]))
        backed.append((contexts, backoff[own][first]))
    return Level(*_merged(seen, order, np.nan), *_merged(backed, order, 0.0))


def _scores(models: Arrays):
    """A function from texts to (best language, margin, symbols); it keeps the sums of words seen before."""
    known: dict[str, int] = {}
    rows = np.zeros((0, len(models.langs) + 1))

    def sums_of(part: list[str]) -> np.ndarray:
        nonlocal rows
        words = [t.lower().split() for t in part]
        if len(known) > HELD_WORDS:
            known.clear()
            rows = rows[:0]
        new = list({w for ws in words for w in ws if w not in known})
        known.update(zip(new, range(len(known), len(known) + len(new))))
        rows = np.concatenate([rows, models.word_logs(new)])
        return np.array([rows[np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))].sum(0) for ws in words])

    def scored(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sums = np.concatenate([np.zeros((0, len(models.langs) + 1)), *map(sums_of, slices(batch))])
        size = sums[:, -1]
        if not models.langs:
            return np.zeros(len(batch), np.int64), np.zeros(len(batch)), np.zeros(len(batch))
        entropy = -sums[:, :-1] / np.maximum(size, 1)[:, None]
        best = entropy.argmin(1)
        ranked = np.sort(entropy, 1)
        return best, ranked[:, 1] - ranked[:, 0] if len(models.langs) > 1 else np.ones(len(batch)), size

    return scored


def _sent(docs: DataFrame, arrays: Arrays) -> DataFrame:
    """doc_id, lang as given, best, margin, symbols of each text, with the models in the tasks."""
    sent = shared(docs.sparkSession, arrays)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent()
        scored = _scores(models)
        for batch in small(batches):
            best, margin, size = scored(texts(batch, "text"))
            names = pa.array([models.langs[b] if n else None for b, n in zip(best, size)], pa.string())
            columns = [batch.column(0), batch.column(1), names, pa.array(margin, pa.float64()), pa.array(size, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "best", "margin", "size"])

    return docs.mapInArrow(judged, "doc_id bigint, lang string, best string, margin double, size double")


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's n-grams with their number there, and one row without n-gram."""
    for batch in small(batches, 100):
        found, count = [], []
        for text in texts(batch, "text"):
            parts = [(r, n) for w, n in Counter(text.lower().split()).items() for r in runs(w)]
            keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if parts:
                keys, sizes = grams([p[0] for p in parts])
                keys, n = _summed(keys, np.repeat(np.array([p[1] for p in parts], np.int64), sizes))
            found.append((pa.array([None], pa.int64()), pa.array(keys.view(np.int64)), pa.array([0], pa.int64()), pa.array(n)))
            count.append(len(keys) + 1)
        if count:
            place = pa.array(np.repeat(np.arange(len(count)), count))
            gram = pa.concat_arrays([a for f in found for a in f[:2]])
            n = pa.concat_arrays([a for f in found for a in f[2:]])
            columns = [batch.column(i).take(place) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, gram, n], ["doc_id", "lang", "row", "gram", "n"])


def _joined(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """As ``_sent``, with the distinct n-grams of all texts joined with the models' tables.

    Spelt texts are written once, so that their row numbers stand. No side is broadcast unless Catalyst measures it to be
    small; a frequent n-gram repeats on the side of the texts only, which adaptive execution splits.
    """
    spelt = stage(
        docs.select("doc_id", "lang", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
            _spell, "doc_id bigint, lang string, row bigint, gram bigint, n bigint"
        ),
        "spelt",
    )
    looked = spelt.select("gram").where("gram is not null").distinct()
    by_lang = F.map_from_entries(F.collect_list(F.struct("lang", "value")))
    for k, table in enumerate(models.tables, 1):
        seen = table.withColumnRenamed("log", "value").groupBy(F.col("gram").alias("key")).agg(by_lang.alias(f"seen{k}"))
        backed = table.select("lang", F.col("context").alias("key"), F.col("backoff").alias("value")).distinct()
        backed = backed.groupBy("key").agg(by_lang.alias(f"backed{k}"))
        looked = looked.withColumn("key", _ending("gram", k)).join(seen, "key", "left").drop("key")
        looked = looked.withColumn("key", F.shiftrightunsigned(_ending("gram", k), 16)).join(backed, "key", "left").drop("key")

    def log_of(lang: str) -> Column:
        log = F.lit(models.floor)
        for k in range(1, ORDER + 1):
            log = F.coalesce(F.col(f"seen{k}")[lang], F.coalesce(F.col(f"backed{k}")[lang], F.lit(0.0)) + log)
        return log

    looked = looked.select("gram", F.array(*map(log_of, models.langs)).alias("logs"))
    sums = [F.coalesce(F.sum(F.col("n") * F.col("logs")[i]), F.lit(0.0)) for i in range(len(models.langs))]
    found = spelt.join(looked, "gram", "left").groupBy("row", "doc_id", "lang").agg(F.sum("n").alias("size"), F.array(*sums).alias("sums"))
    entropy = F.transform("sums", lambda x: -x / F.greatest(F.col("size"), F.lit(1)))
    ranked = found.withColumn("entropy", entropy).withColumn("ranked", F.array_sort("entropy"))
    best = F.array(*map(F.lit, models.langs))[(F.array_position("entropy", F.col("ranked")[0]) - 1).cast("int")]
    margin = F.col("ranked")[1] - F.col("ranked")[0] if len(models.langs) > 1 else F.lit(1.0)
    return ranked.select(
        "doc_id", "lang", F.when(F.col("size") > 0, best).alias("best"), margin.alias("margin"), F.col("size").cast("double").alias("size")
    )


def _judged(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """doc_id, lang, best, and the features margin and size of (doc_id, lang, text)."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return _joined(rows, models) if models.arrays is None else _sent(rows, models.arrays)


def _features() -> list[Column]:
    length = F.log1p("size") / 10
    return [F.least("margin", F.lit(3.0)), length, F.col("margin") * length]


def calibration_ids(docs: DataFrame, part: Column, most: int = CALIBRATION_DOCS) -> DataFrame:
    """At most ``most`` ids out of ``part``, the same whatever their order; the first text of a language is not among them."""
    known = docs.where("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang", part.alias("part"))
    order = F.struct(F.xxhash64("doc_id"), "doc_id")
    first = known.groupBy("lang").agg(F.min(order).alias("first")).select("first.doc_id")
    return known.where("part").join(first, "doc_id", "left_anti").select("doc_id").distinct().orderBy(order).limit(most)


def calibrate(models: LanguageModels, known: DataFrame) -> LanguageModels:
    """Fit the probability of being right on texts with a language, as few as ``calibration_ids`` gives."""
    found = _judged(known, models).where("size > 0")
    names = ["a", "b", "c"]
    rows = found.select(*(f.alias(c) for f, c in zip(_features(), names)), (F.col("best") == F.col("lang")).cast("double").alias("right")).toArrow()
    x = np.column_stack([rows.column(c).to_numpy() for c in names])
    models.scale = logistic(x, rows.column("right").to_numpy(), ridge=1.0) if len(x) else np.zeros(4)
    return models


def train(docs: DataFrame, part: Column, sent_cells: int = SENT_CELLS) -> LanguageModels:
    """Models from ``docs`` (doc_id, text, lang): some texts where ``part`` is false calibrate, all others teach."""
    aside = stage(calibration_ids(docs, ~part), "calibration_ids")
    set_aside = F.broadcast(aside)  # CALIBRATION_DOCS ids at most
    counts = stage(count_grams(docs.join(set_aside, "doc_id", "left_anti")), "grams")
    known = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    return calibrate(build(counts, sent_cells), known.join(set_aside, "doc_id"))


def identify(docs: DataFrame, models: LanguageModels, reject_below: float = 0.0) -> DataFrame:
    """doc_id, lang_pred, score of every row; ``und`` without letters, or where the score is below the wanted one."""
    found = _judged(docs.select("doc_id", F.lit(None).alias("lang"), "text"), models)
    x = sum((f * float(w) for f, w in zip(_features(), models.scale)), F.lit(float(models.scale[-1])))
    score = F.when(F.col("size") > 0, 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-30.0)), F.lit(30.0))))).otherwise(0.0)
    scored = found.select("doc_id", "best", score.alias("score"))
    sure = F.col("best").isNotNull() & (F.col("score") >= reject_below)
    return scored.select("doc_id", F.when(sure, F.col("best")).otherwise(UNKNOWN).alias("lang_pred"), "score")
