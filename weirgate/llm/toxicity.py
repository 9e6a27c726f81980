"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

The kernel of two words counts the letter triples they have in common, gaps allowed: a triple that spans ``s``
letters weighs ``DECAY ** s``, up to a span of seven. So an insult with a letter put in, left out or attached
still shares most of its weight. Words are lower-cased and stripped of all but letters, which undoes characters
put between the letters; runs of single letters are read as one word. The parts of a word between other characters
are read as well, and what has more than ``MOST_WHOLE`` letters is read in short overlapping windows: a word is as
bad as its worst piece, so what an insult weighs does not depend on how long the text goes on without a blank.

Landmarks are words picked by pivoted Cholesky; the machine is linear on the Nyström features of the landmarks.
As the kernel is a product of triple counts, landmarks and weights fold into one table of triple weights, of
fixed size, and a word is scored by sums over that table without meeting any landmark again.

Training sentences are labelled by their documents. A sentence scores as its worst word, and the sentence of a
toxic document that scores highest is taken as its toxic one (multiple-instance learning), starting from the
word that tells most between the classes; words of clean sentences that score highest are added each round.
A document scores as its worst sentence, put on a probability scale by a logistic fit to labelled documents.

Training uses at most ``TRAIN_DOCS`` labelled documents, whole texts of at most ``TRAIN_CHARS`` characters
together; the scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import apart, in_arrow, shared, slices, small, texts

#: Documents and characters at most, by label: clean and toxic.
TRAIN_DOCS = (4000, 1500)
TRAIN_CHARS = (11_000_000, 4_000_000)
CLASSES = 64
SPAN = 7
DECAY = 0.6
LANDMARKS = 320
ROUNDS = 5
THRESHOLD = 0.3
LONGEST_WORD = 48
#: Longer runs of letters are read in windows of so many, that far apart: any run of nine letters lies whole in one.
MOST_WHOLE = 16
WINDOW, STEP = 12, 4
#: Pieces that are scored at a time.
SCORED_PIECES = 20_000
#: What a scoring task holds at a time: texts, characters of texts, words to be scored, scores of words seen before.
HELD_TEXTS, HELD_CHARS, HELD_WORDS, HELD_SCORES = 200, 500_000, 8_000, 120_000
#: Words of each kind that one fit takes: insults, frequent (and spread-out) clean words, high-scoring clean words a round.
MOST_BAD = 800
STRETCHED = 150
COMMON = 800
HARD = 700
#: A first suspect stands in that many different sentences per toxic document, and that much likelier in toxic ones.
FREQUENT, TELLING = 0.01, 8.0
#: The worst score of a text without words.
NO_WORDS = -3.0

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][\W_]*[ ]){2,}[^\W\d_](?!\w)")
_SENTENCE = re.compile(r"[.!?\n]+")
_GAPS = [(i, j) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN)]


def words_of(text: str) -> set[str]:
    """The distinct blank-separated pieces of a text, and its runs of single letters as one piece each."""
    text = text.lower()
    found = set(text.split())
    found.update(m.group().replace(" ", "") for m in _SPACED.finditer(text))
    return found


def pieces_of(word: str) -> list[str]:
    """A word and its parts between other characters, what is long in windows; never nothing."""
    if len(word) <= MOST_WHOLE and word.isalpha():
        return [word]
    parts = [p for p in _NOT_LETTERS.split(word) if p]
    letters = "".join(parts)
    out = [word if len(word) <= LONGEST_WORD else letters] if len(letters) <= MOST_WHOLE else _windows(letters)
    if len(parts) > 1:  # one or two letters of an alphabet tell nothing by themselves
        for part in parts:
            if len(part) > (2 if part.isascii() else 1):
                out += [part] if len(part) <= MOST_WHOLE else _windows(part)
    return list(dict.fromkeys(out))


def _windows(letters: str) -> list[str]:
    return [letters[i : i + WINDOW] for i in range(0, len(letters) - WINDOW + STEP, STEP)]


def piece_scores(pieces: list[str], table: np.ndarray) -> np.ndarray:
    """The weight of each piece in a table of triple weights, some pieces at a time."""
    parts = [Pieces.of(pieces[i : i + SCORED_PIECES]).scores(table) for i in range(0, len(pieces), SCORED_PIECES)]
    return np.concatenate([np.zeros(0), *parts])


@dataclass
class Pieces:
    """Words as one row of letter classes with a border on both sides of each."""

    codes: np.ndarray
    owner: np.ndarray
    ends: np.ndarray
    count: int

    @staticmethod
    def of(words: list[str]) -> Pieces:
        """Long words are cut into overlapping pieces that belong to the same word."""
        plain, owner = [], []
        for k, word in enumerate(words):
            letters = _NOT_LETTERS.sub("", word)
            step = LONGEST_WORD - SPAN
            for i in range(0, max(1, len(letters) - SPAN), step):
                plain.append(letters[i : i + LONGEST_WORD])
                owner.append(k)
        sizes = np.fromiter(map(len, plain), np.int64, len(plain)) + 2
        points = np.frombuffer(("\0" + "\0\0".join(plain) + "\0").encode("utf-32-le"), np.uint32) if plain else np.zeros(0, np.uint32)
        latin = (points >= 97) & (points <= 122)
        codes = np.where(points == 0, 0, np.where(latin, points - 96, 27 + points % 37)).astype(np.int32)
        return Pieces(codes, np.repeat(np.array(owner, np.int32), sizes), np.repeat(np.cumsum(sizes, dtype=np.int32), sizes), len(words))

    def triples(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """For every pair of gaps: the owners of its triples, the triples, and their weight."""
        at = np.arange(len(self.codes), dtype=np.int32)
        for i, j in _GAPS:
            start = at[: max(0, len(at) - j)]
            start = start[start + j < self.ends[start]]
            triple = (self.codes[start] * CLASSES + self.codes[start + i]) * CLASSES + self.codes[start + j]
            yield self.owner[start], triple, DECAY ** (j + 1)

    def scores(self, table: np.ndarray) -> np.ndarray:
        """The weight of each word in a table of triple weights, divided by the norm its length gives."""
        total, norm = np.zeros(self.count), np.zeros(self.count)
        for owner, triple, weight in self.triples():
            total += weight * np.bincount(owner, table[triple], self.count)
            norm += weight**2 * np.bincount(owner, minlength=self.count)
        return total / np.sqrt(np.maximum(norm, 1e-12))

    def self_kernel(self) -> np.ndarray:
        """The kernel of each word with itself."""
        keys, weights, norm = [], [], np.zeros(self.count)
        for owner, triple, weight in self.triples():
            keys.append(owner.astype(np.int64) * CLASSES**3 + triple)
            weights.append(np.full(len(owner), weight))
            norm += weight**2 * np.bincount(owner, minlength=self.count)
        cells, place = np.unique(np.concatenate(keys), return_inverse=True)
        summed = np.bincount(place, np.concatenate(weights))
        return np.bincount(cells // CLASSES**3, summed**2, self.count) / np.maximum(norm, 1e-12)


def triple_table(word: str) -> np.ndarray:
    """The normed triple weights of one word."""
    table, norm = np.zeros(CLASSES**3), 0.0
    for _, triple, weight in Pieces.of([word]).triples():
        np.add.at(table, triple, weight)
        norm += weight**2 * len(triple)
    return table / np.sqrt(max(norm, 1e-12))


def _landmarks(words: list[str], pieces: Pieces, count: int, n_bad: int) -> tuple[list[int], np.ndarray]:
    """Pivoted Cholesky: each pick is the word worst described by those before it, half of them bad words.

    Returns the picks and the kernel of all words with them.
    """
    left, picked = pieces.self_kernel(), []
    factors, kernel = np.zeros((2, len(words), min(count, len(words))))
    for k in range(factors.shape[1]):
        among = left[:n_bad] if 2 * k < count and left[:n_bad].max() >= 1e-3 else left
        best = int(among.argmax())
        if left[best] < 1e-6:
            break
        kernel[:, k] = pieces.scores(triple_table(words[best]))
        factors[:, k] = (kernel[:, k] - factors[:, :k] @ factors[best, :k]) / np.sqrt(left[best])
        left -= factors[:, k] ** 2
        picked.append(best)
    return picked, kernel[:, : len(picked)]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by Newton steps on its margin rows."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = penalty * weight.sum() * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(30):
        inside = y * (x @ w) < 1
        part = x[inside] * weight[inside, None]
        new = np.linalg.solve(part.T @ x[inside] + ridge, part.T @ y[inside])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w


def train_words(bad: list[str], good: list[str], weight: np.ndarray) -> tuple[np.ndarray, float]:
    """The table of triple weights and the bias that tell bad words from good ones."""
    words = bad + good
    marks, kernel = _landmarks(words, Pieces.of(words), LANDMARKS, len(bad))
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    y = np.r_[np.ones(len(bad)), -np.ones(len(good))]
    fit = _svm(kernel @ root, y, weight)
    table = np.zeros(CLASSES**3)
    for mark, alpha in zip(marks, root @ fit[:-1]):
        table += alpha * triple_table(words[mark])
    return table, float(fit[-1])


def stretched(words: list[str]) -> list[str]:
    """Each longer word with one letter put in at one third and at two thirds of it."""
    out = []
    for k, word in enumerate(w for w in words if len(w) >= 5):
        for i in (len(word) // 3, 2 * len(word) // 3):
            out.append(word[:i] + "xzqkjyw"[(k + i) % 7] + word[i:])
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights and bias (last) of a logistic fit."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return w


@dataclass
class ToxicityModel:
    """Triple weights, bias, and the scale from worst word to probability."""

    table: np.ndarray
    bias: float
    scale: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The score of the worst piece of each word."""
        if not words:
            return np.zeros(0)
        places: dict[str, int] = {}
        of = [[places.setdefault(p, len(places)) for p in pieces_of(w)] for w in words]
        sizes = np.fromiter(map(len, of), np.int64, len(of))
        scores = piece_scores(list(places), self.table) + self.bias
        flat = np.fromiter((k for ids in of for k in ids), np.int64, sizes.sum())
        return np.maximum.reduceat(scores[flat], np.cumsum(sizes) - sizes)

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.c_[np.clip(worst, NO_WORDS, -NO_WORDS), np.ones(len(worst))] @ self.scale, -30, 30)))


def train(labelled: Iterable[tuple[str, int]]) -> ToxicityModel:
    """Fit to (text, 0 or 1) pairs. With only one class every text gets the share of that class."""
    known: dict[str, int] = {}
    places: dict[str, tuple[int, ...]] = {}
    docs: list[np.ndarray] = []  # the pieces of words of each document, by number
    labels: list[int] = []
    bad_sentences: list[np.ndarray] = []
    # In how many different sentences of either class a piece stands; copies of a sentence count once.
    uses: list[Counter] = [Counter(), Counter()]
    met: list[set[int]] = [set(), set()]

    def numbered(words: set[str]) -> np.ndarray:
        ids: set[int] = set()
        for w in sorted(words):
            if w not in places:
                places[w] = tuple(known.setdefault(p, len(known)) for p in pieces_of(w))
            ids.update(places[w])
        return np.fromiter(sorted(ids), np.int32, len(ids))

    for text, y in labelled:
        docs.append(numbered(words_of(text)))
        labels.append(y)
        for words in map(words_of, _SENTENCE.split(text)):
            ids = numbered(words)
            if len(ids) and (key := hash(ids.tobytes())) not in met[y]:
                met[y].add(key)
                uses[y].update(ids.tolist())
                if y:
                    bad_sentences.append(ids)
    names, y = list(known), np.array(labels, np.int64)
    n_bad, n_good = int((y == 1).sum()), int((y == 0).sum())
    if not n_bad or not n_good:
        share = (n_bad + 0.5) / (n_bad + n_good + 1)
        return ToxicityModel(np.zeros(CLASSES**3), 0.0, np.array([0.0, np.log(share / (1 - share))]))
    in_good, in_bad = (np.array([c[k] for k in range(len(names))]) for c in uses)
    del uses
    odds = (in_bad / (len(met[1]) or 1)) / ((in_good + 0.5) / (len(met[0]) or 1))
    clean = np.flatnonzero(in_good)
    by_name = clean[np.argsort(np.array(names, object)[clean], kind="stable")]
    fixed = {*clean[np.argsort(-in_good[clean], kind="stable")][:COMMON].tolist(), *by_name[:: max(1, len(clean) // COMMON)].tolist()}
    del places
    has_letters = np.array([bool(_NOT_LETTERS.sub("", w)) for w in names], bool)
    hard: set[int] = set()
    model = None
    least = max(3, FREQUENT * n_bad)
    suspects = set(np.flatnonzero((in_bad >= least) & (odds >= TELLING) & has_letters).tolist())
    for _ in range(ROUNDS):
        chosen = sorted(suspects, key=lambda k: (-in_bad[k], names[k]))[:MOST_BAD]
        if not chosen:
            break
        bad = [names[k] for k in chosen]
        bad += [w for w in stretched(bad[:STRETCHED]) if w not in known or not in_good[known[w]]]
        good = sorted({names[k] for k in fixed | hard} - set(bad))
        weight = np.r_[np.full(len(bad), max(1.0, len(good) / len(bad) / 3)), np.ones(len(good))]
        model = ToxicityModel(*train_words(bad, good, weight), np.zeros(2))
        scores = piece_scores(names, model.table) + model.bias
        hard.update(clean[np.argsort(-scores[clean], kind="stable")[:HARD]].tolist())
        # The worst word of each toxic sentence joins, where the machine holds it for one.
        for ids in bad_sentences:
            worst = int(ids[scores[ids].argmax()])
            if scores[worst] > 0.5 and not in_good[worst] and has_letters[worst]:
                suspects.add(worst)
    if model is None:
        return ToxicityModel(np.zeros(CLASSES**3), 0.0, np.array([0.0, np.log(n_bad / n_good)]))
    worst = np.array([scores[ids].max() if len(ids) else NO_WORDS for ids in docs])
    model.scale = logistic(np.clip(worst, NO_WORDS, -NO_WORDS)[:, None], y, ridge=0.01)
    return model


def training_rows(
    docs: DataFrame, labels: DataFrame, most: tuple[int, int] = TRAIN_DOCS, chars: tuple[int, int] = TRAIN_CHARS
) -> DataFrame:
    """doc_id, text, kind of a bounded sample of labelled texts, the same for the same documents whatever their order.

    ``docs`` and ``labels`` share doc_id; rows without text or label are not taken, and of a repeated id the longest
    text is.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where("text is not null")
    marked = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    there = docs.select("doc_id").distinct().join(marked, "doc_id").withColumn("turn", F.xxhash64("doc_id"))
    first = [there.where(F.col("toxic") == kind).orderBy("turn", "doc_id").limit(most[kind]) for kind in (0, 1)]
    wanted = F.broadcast(first[0].union(first[1]))  # sum(most) rows at most
    size = F.max(F.length("text")).alias("size")
    sizes = docs.join(wanted, "doc_id").groupBy("turn", "doc_id", "toxic").agg(size)
    ids, room = [], list(chars)
    for row in sizes.orderBy("turn", "doc_id").collect():
        if row["size"] <= room[row["toxic"]]:
            ids.append((row["doc_id"], row["toxic"]))
            room[row["toxic"]] -= row["size"]
    # An Arrow table: rows of Python would start a second set of Python workers on the executors.
    kinds = pa.table({"doc_id": pa.array([i for i, _ in ids], pa.int64()), "kind": pa.array([k for _, k in ids], pa.int32())})
    picked = F.broadcast(docs.sparkSession.createDataFrame(kinds))  # sum(most) rows at most
    longest = F.max_by("text", F.struct(F.length("text"), "text")).alias("text")
    return docs.join(picked, "doc_id").groupBy("doc_id", "kind").agg(longest).select("doc_id", "text", "kind")


def training_texts(
    docs: DataFrame, labels: DataFrame, most: tuple[int, int] = TRAIN_DOCS, chars: tuple[int, int] = TRAIN_CHARS
) -> list[tuple[str, int]]:
    """The same sample as (text, kind), in the order of ids."""
    rows = training_rows(docs, labels, most, chars).collect()
    return [(r["text"], r["kind"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def fit(rows: DataFrame) -> ToxicityModel:
    """Train on the rows of a bounded sample (:func:`training_rows`).

    A child process of the driver trains: neither driver nor workers keep the memory that this takes.
    """
    held = rows.select("doc_id", "text", "kind").toArrow()

    def fields() -> tuple[bytes, float, list[float]]:
        labelled = sorted(zip(*(column.to_pylist() for column in held.columns)))
        model = train((text, kind) for _, text, kind in labelled)
        return model.table.tobytes(), float(model.bias), model.scale.tolist()

    weights, bias, scale = apart(fields)
    return ToxicityModel(np.frombuffer(weights), bias, np.array(scale))


def _worst_words(model: ToxicityModel):
    """A function that gives the worst word score of each text, and keeps the scores of words seen before."""
    known: dict[str, float] = {}

    def worst_of(part: list[str]) -> list[float]:
        found = [words_of(t) for t in part]
        if len(known) > HELD_SCORES:
            known.clear()
        new = list({w for words in found for w in words if w not in known})
        for i in range(0, len(new), HELD_WORDS):
            known.update(zip(new[i : i + HELD_WORDS], model.word_scores(new[i : i + HELD_WORDS]).tolist()))
        return [max(map(known.__getitem__, words), default=NO_WORDS) for words in found]

    def worst(batch: list[str]) -> np.ndarray:
        return np.array([score for part in slices(batch, HELD_CHARS) for score in worst_of(part)])

    return worst


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Adds ``score`` and ``predicted`` to doc_id and text; the text is dropped. Null texts count as empty."""
    sent = shared(docs.sparkSession, model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent()
        worst_of = _worst_words(model)
        for batch in small(batches, HELD_TEXTS):
            p = model.probability(worst_of(texts(batch, "text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return in_arrow(read, scored, "doc_id bigint, score double, predicted int")


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` without the texts scored as toxic; all columns stay, and no shuffle is needed."""
    sent = shared(docs.sparkSession, model)
    place = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent()
        worst_of = _worst_words(model)
        for batch in small(batches, HELD_TEXTS):
            p = model.probability(worst_of(["" if t is None else t for t in batch.column(place).to_pylist()]))
            yield batch.filter(pa.array(p < THRESHOLD))

    return in_arrow(docs, clean, docs.schema)
