import random

import numpy as np
import pytest
from corpora import DOCS, no_docs, odd_docs
from pyspark.sql import functions as F

from weirgate.llm import langid
from weirgate.llm.common import fold
from weirgate.llm.queries import op1_kneser_ney_language

SYLLABLES = {"xx": ["ba", "ri", "to", "len"], "yy": ["zu", "kh", "ör", "ba"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng, lang, rng.randint(5, 40)), lang, "s", 0) for i, lang in enumerate(["xx", "yy"] * 100)]
    return spark.createDataFrame(rows + [(500, "text without a language", None, "s", 0), (501, None, "xx", "s", 0)], DOCS)


@pytest.fixture(scope="module")
def models(docs):
    return langid.train(docs, fold(F.col("doc_id")) < 2)


def test_counts_against_plain_python(spark, docs):
    found = {(r.lang, r.gram & (1 << 64) - 1): r.n for r in langid.count_grams(docs).collect()}
    expected = {}
    for r in docs.where("lang is not null and text is not null").collect():
        for w in r.text.lower().split():
            padded = "\0\0\0" + w + " "
            for i in range(3, len(padded)):
                key = sum(ord(padded[i - k]) << 16 * k for k in range(4))
                expected[r.lang, key] = expected.get((r.lang, key), 0) + 1
    assert found == expected


def plain_model(texts):
    """Interpolated Kneser-Ney from its definition: counts and, per order, discount, totals and kinds."""
    levels = [{}, {}, {}, {}]
    for text in texts:
        for w in text.lower().split():
            padded = "\0\0\0" + w + " "
            for i in range(3, len(padded)):
                levels[3][padded[i - 3 : i + 1]] = levels[3].get(padded[i - 3 : i + 1], 0) + 1
    for k in (2, 1, 0):
        for gram in levels[k + 1]:
            levels[k][gram[1:]] = levels[k].get(gram[1:], 0) + 1
    discounts = []
    for n in levels:
        once, twice = list(n.values()).count(1), list(n.values()).count(2)
        discounts.append(min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5)
    return levels, discounts


def plain_p(model, gram, symbols):
    """Probability of the last symbol of a gram after its others."""
    if not gram:
        return 1 / symbols
    levels, discounts = model
    n, d = levels[len(gram) - 1], discounts[len(gram) - 1]
    same = [c for g, c in n.items() if g[:-1] == gram[:-1]]
    if not same:
        return plain_p(model, gram[1:], symbols)
    return max(n.get(gram, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * plain_p(model, gram[1:], symbols)


def plain_entropies(models, text, symbols):
    grams = [p[i - 3 : i + 1] for w in text.lower().split() for p in ["\0\0\0" + w + " "] for i in range(3, len(p))]
    return {lang: -np.mean([np.log(plain_p(m, g, symbols)) for g in grams]) for lang, m in models.items()}


def test_whole_texts_against_plain_kneser_ney(spark):
    """Languages and margins, whether the models are sent or joined."""
    rng = random.Random(2)
    taught = {lang: [sentence(rng, lang, 30) for _ in range(4)] for lang in SYLLABLES}
    rows = [(i, t, lang, "s", 0) for i, (lang, t) in enumerate((lang, t) for lang, ts in taught.items() for t in ts)]
    counts = langid.count_grams(spark.createDataFrame(rows, DOCS)).persist()
    plain = {lang: plain_model(ts) for lang, ts in taught.items()}
    symbols = len({g for m in plain.values() for g in m[0][0]}) + 1
    asked = [sentence(rng, "xx", 9), sentence(rng, "yy", 1), "wholly unseen letters", "ba", "ba ba zu " + sentence(rng, "yy", 300)]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(asked)], DOCS)
    for cells in (langid.SENT_CELLS, 0):
        models = langid.build(counts, cells)
        assert (models.arrays is None) == (cells == 0)
        found = {r.doc_id: r for r in langid._judged(docs, models).collect()}
        for i, text in enumerate(asked):
            wanted = plain_entropies(plain, text, symbols)
            assert found[i].best == min(sorted(wanted), key=wanted.get)
            assert abs(found[i].margin - abs(wanted["xx"] - wanted["yy"])) < 1e-5
            assert found[i].size == len("".join(text.split())) + len(text.split())


def test_probabilities_sum_to_one(spark):
    """Over every symbol seen and one for all others, after contexts seen and unseen."""
    rows = [(1, sentence(random.Random(2), "xx", 400), "xx", "s", 0)]
    models = langid.build(langid.count_grams(spark.createDataFrame(rows, DOCS))).arrays
    keys, _ = langid.grams(rows[0][1].split())
    symbols = np.unique(keys & np.uint64(0xFFFF))
    for context in [*{int(g) >> 16 for g in keys[:200]}, 1 << 40 | 77]:
        after = np.array([context << 16 | int(s) for s in [*symbols, 0x4E00]], np.uint64)
        assert abs(np.exp(models.gram_logs(after)).sum() - 1) < 1e-4


def test_a_language_of_one_text_among_many(spark):
    """No n-gram is dropped, and the only text of a language teaches, whichever part it is in."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = random.Random(7)
    words = {f"l{i:02}": ["".join(rng.choice(letters) for _ in range(5)) for _ in range(6)] for i in range(40)}
    rows = [(i, " ".join(ws), lang, "s", 0) for i, (lang, ws) in enumerate(words.items())]
    rows += [(100 + i, " ".join(rng.choices(words["l00"], k=200)), "l00", "s", 0) for i in range(50)]
    docs = spark.createDataFrame(rows, DOCS)
    models = langid.train(docs, F.col("doc_id") < 0)
    assert models.langs == sorted(words)
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs, models).collect()}
    assert all(found[i] == lang for i, _, lang, _, _ in rows)


def test_all_but_the_calibration_texts_teach(spark):
    rows = [(i, f"w{'abcdefghij'[i % 10]}", "xx", "s", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    aside = {r.doc_id for r in langid.calibration_ids(docs, F.col("doc_id") % 4 == 3, most=5).collect()}
    assert len(aside) == 5 and all(i % 4 == 3 for i in aside)


def test_unseen_texts(spark, models):
    rng = random.Random(3)
    rows = [(i, sentence(rng, lang, 6), lang, "s", 0) for i, lang in enumerate(["xx", "yy"] * 50)]
    found = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, DOCS), models).collect()}
    assert all(found[i].lang_pred == lang and 0 <= found[i].score <= 1 for i, _, lang, _, _ in rows)


def test_rejection(spark, models):
    docs = spark.createDataFrame([(1, "ba", "xx", "s", 2), (2, sentence(random.Random(4), "yy", 60), "yy", "s", 0)], DOCS)
    sure = {r.doc_id: r.score for r in langid.identify(docs, models).collect()}
    assert sure[1] < sure[2]
    cut = (sure[1] + sure[2]) / 2
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs, models, reject_below=cut).collect()} == {1: "und", 2: "yy"}


def test_sent_and_joined_models_agree(spark, docs, models):
    """Odd rows and clashing names included."""
    joined = langid.LanguageModels(models.langs, models.floor, models.tables, None, models.scale)
    for asked in (docs, odd_docs(spark), no_docs(spark)):
        sent, found = (sorted(map(str, langid.identify(asked, m).withColumn("score", F.round("score", 4)).collect())) for m in (models, joined))
        assert sent == found


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_kneser_ney_language(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(langs)
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out and langs[r.doc_id]]
    assert np.mean(held) > 0.97


def test_odd_rows(spark, models):
    found = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(odd_docs(spark), models).collect()]
    assert len(found) == odd_docs(spark).count()
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (9, "und", 0.0)} <= set(found)
    assert langid.identify(no_docs(spark), models).count() == 0
    untaught = langid.train(no_docs(spark), F.col("doc_id") > 0)
    assert {r.lang_pred for r in langid.identify(odd_docs(spark), untaught).collect()} == {"und"}
