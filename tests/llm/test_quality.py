import math
import re
from collections import Counter

import numpy as np
import pytest
from corpora import no_docs, odd_docs

from weirgate.llm import quality
from weirgate.llm.queries import op5_weak_supervision_quality


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(triples)
    repeated = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    joined = "".join(words)
    return len(words), len(joined), len(re.findall(r"[#*$%&|<>]", joined)), len(lines) - len(set(lines)), len(repeated)


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@pytest.mark.parametrize("source", ["documents", "odd"])
def test_measures_against_plain_python(spark, source):
    docs = odd_docs(spark) if source == "odd" else spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = ["a b a b a b a b", "x x x x", "a\n\n a\na\n a", "é #|\x0b<b>\x0c c d e", "a b c\ta b c"]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string"))
    texts = Counter((r.doc_id, measured(r.text)) for r in docs.collect())
    found = Counter((r.doc_id, tuple(r[f] for f in FIELDS)) for r in quality.measures(docs).collect())
    assert found == texts


def test_no_python_on_the_main_path(spark):
    plan = quality.measures(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def votes_of(words, lines, text):
    """The votes of all rules on one text, from counts taken in plain Python."""
    n, chars, symbols, dup_lines, repeat = measured(text)
    kinds, lettered = len(set(words)), sum(any(c.isalpha() for c in w) for w in words)
    capitals = sum("A" <= c <= "Z" for w in words for c in w)

    def vote(bad, good):
        return -1 if bad else 1 if good else 0

    return (
        vote(n < 50, n >= 80),
        vote(symbols > 0.10 * n, symbols <= 0.02 * n),
        vote(symbols > 0.05 * chars, symbols <= 0.01 * chars),
        vote(lettered < 0.80 * n, lettered >= 0.95 * n),
        vote(repeat > 0.40 * n, repeat <= 0.20 * n),
        vote(dup_lines >= 3 and dup_lines > 0.30 * lines, dup_lines <= 0.10 * lines),
        vote(chars < 3 * n or chars > 12 * n, 3.5 * n <= chars <= 9 * n),
        vote(capitals > 0.40 * chars, capitals <= 0.15 * chars),
        vote(kinds < 0.20 * min(n, 400), kinds >= 0.35 * min(n, 400)),
    )


def plain_em(votes, rounds=500):
    """Expectation maximisation text by text; returns the probability that each is good."""
    votes = np.array(votes)
    cast = np.stack([votes == v for v in (1, -1, 0)], 2).astype(float)  # text, rule, vote
    start = np.array([[0.30, 0.50, 0.20], [0.80, 0.03, 0.17]])  # class, vote
    share, worth = 0.8, np.stack([start] * votes.shape[1], 1)  # class, rule, vote
    for _ in range(rounds):
        like = np.exp(np.einsum("trv,crv->tc", cast, np.log(worth))) * [1 - share, share]
        p = like / like.sum(1, keepdims=True)
        counts = np.einsum("tc,trv->crv", p, cast) + 10 * start[:, None]
        share, worth = (p[:, 1].sum() + 8) / (len(votes) + 10), counts / counts.sum(2, keepdims=True)
    like = np.exp(np.einsum("trv,crv->tc", cast, np.log(worth))) * [1 - share, share]
    return like[:, 1] / like.sum(1)


def test_verdicts_against_plain_expectation_maximisation(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    votes = []
    for r in docs:
        lines = [x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        votes.append(votes_of(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""), len(lines), r.text))
    wanted = dict(zip((r.doc_id for r in docs), plain_em(votes).tolist()))
    rows = op5_weak_supervision_quality(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(wanted)
    for r in rows:
        assert abs(r.p_good - wanted[r.doc_id]) < 1e-4
        assert r.kept == (not r.base_failed and wanted[r.doc_id] >= 0.5)


def test_fit_follows_the_votes():
    """A flaw that two rules see is junk; a rule that errs alone is outvoted, and learnt to be worth little."""
    patterns = [((1, 1, 1), 9000), ((-1, -1, 1), 600), ((1, 1, -1), 400), ((0, 1, 1), 50), ((-1, 1, 1), 20), ((1, -1, 1), 20)]
    share, table = quality.fit(patterns)
    odds = {
        votes: share / (1 - share) * math.prod(rule[v][1] / rule[v][0] for rule, v in zip(table, votes)) for votes, _ in patterns
    }
    assert 0.9 < share < 0.97
    assert odds[-1, -1, 1] < 0.01 and odds[1, 1, -1] > 100 and odds[1, 1, 1] > 100
    grown = quality.fit([(v, 1000 * n) for v, n in patterns])
    assert abs(grown[0] - share) < 0.01 and quality.fit([])[1] == []


def test_base_rules_and_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = op5_weak_supervision_quality(spark, sf).collect()
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    good = [k for q, k in judged if q == 1]
    bad = [k for q, k in judged if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = quality.judge(docs.select("doc_id", "text")).collect()
    assert len(rows) == docs.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 7, 8, 9))
    assert quality.judge(docs).count() == docs.count()
    assert quality.judge(no_docs(spark)).count() == 0
