import itertools
import random

import numpy as np
import pytest
from corpora import DOCS, no_docs, odd_docs, word

from weirgate.llm import toxicity
from weirgate.llm.queries import op7_string_kernel_toxicity

INSULTS = ["stupid", "moron", "worthless", "disgusting", "clown"]


def labelled(rng, n):
    out = []
    for i in range(n):
        sentences = [[word(rng) for _ in range(rng.randint(4, 12))] for _ in range(rng.randint(2, 6))]
        if i % 3 == 0:
            rng.choice(sentences).insert(1, rng.choice(INSULTS))
        out.append((". ".join(" ".join(s) for s in sentences) + ".", int(i % 3 == 0)))
    return out


@pytest.fixture(scope="module")
def model():
    return toxicity.train(labelled(random.Random(1), 600))


def probability(model, text):
    words = sorted(toxicity.words_of(text))
    worst = max(model.word_scores(words), default=toxicity.NO_WORDS)
    return float(model.probability(np.array([worst]))[0])


def test_unseen_texts(model):
    rows = labelled(random.Random(2), 300)
    said = [probability(model, t) >= toxicity.THRESHOLD for t, _ in rows]
    assert np.mean([s == bool(y) for s, (_, y) in zip(said, rows)]) > 0.95


@pytest.mark.parametrize("form", ["s.t.u.p.i.d", "STUPID!!", "stu-pid", "s t u p i d", "s*tupid", "stuupid", "st_upid"])
def test_disguised_insults(model, form):
    assert probability(model, f"bari tolen {form} sumok") > probability(model, "bari tolen rila sumok")
    assert probability(model, f"bari tolen {form} sumok") >= toxicity.THRESHOLD


@pytest.mark.parametrize("text", ["s t p d", "а с с", "σ τ υ π", "a s s", "a s s bari", "bari a s s", "bari\ns t u p i d"])
def test_single_letters_are_read_without_a_vowel_between_blanks(text):
    joined = "".join(w for w in text.split() if len(w) == 1)
    assert joined in toxicity.words_of(text)


@pytest.mark.parametrize("mark", ["/", "_", "-", ".", "1"])
def test_insults_within_joined_words(model, mark):
    rng = random.Random(4)
    for n in (1, 8, 100):
        before, after = ([word(rng) for _ in range(n)] for _ in range(2))
        joined = mark.join([*before, "stupid", *after])
        assert model.word_scores([joined])[0] >= model.word_scores(["stupid"])[0]
        assert probability(model, joined) >= toxicity.THRESHOLD


def test_insults_do_not_fade_in_long_runs_of_letters(model):
    rng = random.Random(4)

    def typical(n):
        runs = ["".join([*(word(rng) for _ in range(n)), "stupid", *(word(rng) for _ in range(n))]) for _ in range(40)]
        return np.median(model.word_scores(runs))

    assert typical(100) >= typical(3) - 0.1


def test_pieces_cover_every_run_of_nine_letters():
    for n in (1, 16, 17, 18, 19, 20, 48, 49, 200):
        letters = "".join(chr(0x4E00 + i) for i in range(n))
        pieces = toxicity.pieces_of(letters)
        assert all(any(letters[i : i + 9] in p for p in pieces) for i in range(max(1, n - 8)))
        assert max(map(len, pieces)) <= toxicity.MOST_WHOLE
    assert toxicity.pieces_of("12") == ["12"] and toxicity.pieces_of("s.t.u-pid") == ["s.t.u-pid", "pid"]
    assert toxicity.pieces_of("!" * 99) == [""]


def test_inserted_letter_scores_above_clean_words(model):
    clean = model.word_scores([word(random.Random(k)) for k in range(200)])
    assert model.word_scores(["stuxpid"])[0] > np.quantile(clean, 0.99)


def test_table_equals_the_kernel_expansion():
    """A word's score from the folded table is the sum over landmarks of weighted kernels."""
    words = ["stupid", "moron", "bari", "tolen", "s", ""]
    a, b = toxicity.triple_table("stupid"), toxicity.triple_table("moron")
    both = toxicity.Pieces.of(words).scores(2 * a - 3 * b)
    assert np.allclose(both, 2 * toxicity.Pieces.of(words).scores(a) - 3 * toxicity.Pieces.of(words).scores(b))
    kernel = np.array([toxicity.Pieces.of(words[:4]).scores(toxicity.triple_table(w)) for w in words[:4]])
    assert np.allclose(kernel, kernel.T) and np.linalg.eigvalsh(kernel).min() > -1e-9
    assert np.allclose(toxicity.Pieces.of(words[:4]).self_kernel(), kernel.diagonal())


def plain_kernel(one, other):
    """Gapped subsequences of three of the bordered words: products of their decays where the letters agree."""

    def triples(word):
        bordered = f"^{word}^"
        for p, q, r in itertools.combinations(range(len(bordered)), 3):
            if r - p < toxicity.SPAN:
                yield bordered[p] + bordered[q] + bordered[r], toxicity.DECAY ** (r - p + 1)

    norm = [sum(w**2 for _, w in triples(word)) for word in (one, other)]
    agreed = sum(v * w for s, v in triples(one) for t, w in triples(other) if s == t)
    return agreed / np.sqrt(norm[0] * norm[1])


def test_kernel_against_plain_subsequences():
    words = ["stupid", "stuxpid", "moron", "aa", "banana", "tolerance"]
    for one in words:
        found = toxicity.Pieces.of(words).scores(toxicity.triple_table(one))
        assert np.allclose(found, [plain_kernel(one, other) for other in words])


def test_long_words_keep_all_triples():
    word_ = "ab" * 60 + "stupid" + "cd" * 60
    assert toxicity.Pieces.of([word_]).scores(toxicity.triple_table("stupid"))[0] > 0


def test_one_class_or_none():
    for rows in ([], [("a b", 0)], [("a b", 1)]):
        assert 0 < probability(toxicity.train(rows), "a b") < 1


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op7_string_kernel_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in judged]) > 0.9


def test_sample_does_not_depend_on_order(spark):
    rng = random.Random(3)
    rows = [(i, t, "en", "s", len(t)) for i, (t, _) in enumerate(labelled(rng, 60))]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    first = toxicity.training_texts(spark.createDataFrame(rows, DOCS), labels, (10, 10))
    again = toxicity.training_texts(spark.createDataFrame(rows[::-1], DOCS).repartition(7), labels, (10, 10))
    assert first == again and len(first) == 20
    few = toxicity.training_texts(spark.createDataFrame(rows, DOCS), labels, (10, 10), (300, 300))
    assert sum(len(t) for t, _ in few) <= 600


def test_odd_rows(spark, model):
    docs = odd_docs(spark)
    assert toxicity.score(docs, model).count() == docs.count()
    kept = toxicity.keep_clean(docs, model)
    assert kept.schema.simpleString() == docs.schema.simpleString() and {r.doc_id for r in kept.collect()} >= {None, 1, 2, 3}
    assert toxicity.keep_clean(no_docs(spark), model).count() == 0
    some = spark.createDataFrame([(1, 1), (4, 0), (5, 1), (5, 0), (6, 1)], "doc_id bigint, toxic int")
    assert sorted(len(t) for t, _ in toxicity.training_texts(docs, some))[:2] == [len(docs.where("doc_id = 4").first().text)] * 2
    nothing = spark.createDataFrame([(None, None), (1, None)], "doc_id bigint, toxic int")
    assert toxicity.training_texts(docs, nothing) == []


def test_fit_in_a_child_process_is_the_same_fit(spark):
    rows = [(i, text, kind) for i, (text, kind) in enumerate(labelled(random.Random(3), 120))]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string, kind int").repartition(3))
    alone = toxicity.train([row[1:] for row in rows])
    assert np.allclose(model.table, alone.table) and np.allclose(model.scale, alone.scale) and np.isclose(model.bias, alone.bias)
    nothing = toxicity.fit(spark.createDataFrame([], "doc_id bigint, text string, kind int"))
    assert 0 < nothing.probability(np.zeros(1))[0] < 1
    with pytest.raises(Exception, match="child process failed"):
        toxicity.fit(spark.createDataFrame([(1, None, None), (2, None, None)], "doc_id bigint, text string, kind int"))


def test_sample_needs_no_python_workers(spark):
    """Rows of Python would run in Python workers of their own, beside those that score."""
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('bari tolen ', id) AS text")
    labels = spark.range(40).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    rows = toxicity.training_rows(docs, labels)
    assert "ExistingRDD" not in rows._jdf.queryExecution().executedPlan().toString()
    assert {(r["doc_id"], r["text"], r["kind"]) for r in rows.collect()} == {(k, f"bari tolen {k}", k % 2) for k in range(40)}
    assert rows.schema.simpleString() == "struct<doc_id:bigint,text:string,kind:int>"
    assert toxicity.training_rows(docs, labels.where("doc_id < 0")).collect() == []


def test_scoring_holds_few_words(model):
    """Words are scored some thousands at a time, and no more than ``HELD_SCORES`` and a part's are kept."""
    calls = []

    class Recorder:
        def word_scores(self, words):
            calls.append(set(words))
            return np.array([float(len(w)) for w in words])

    worst_of = toxicity._worst_words(Recorder())
    many = [" ".join(f"w{k}x{i}" for i in range(1000)) for k in range(200)]
    assert worst_of(["first", *many, "first"]).tolist() == [5.0, *(max(map(len, t.split())) for t in many), 5.0]
    assert max(map(len, calls)) <= toxicity.HELD_WORDS
    assert sum("first" in c for c in calls) == 2


def test_scores_do_not_depend_on_what_is_held(model, monkeypatch):
    rng = random.Random(9)
    batch = [t for t, _ in labelled(rng, 60)] + ["", " ", "stupid"]
    wanted = toxicity._worst_words(model)(batch).tolist()
    for name, value in (("HELD_CHARS", 50), ("HELD_WORDS", 3), ("HELD_SCORES", 10)):
        monkeypatch.setattr(toxicity, name, value)
    assert toxicity._worst_words(model)(batch).tolist() == wanted
