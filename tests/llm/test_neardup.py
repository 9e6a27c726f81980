import random
from itertools import combinations

import numpy as np
import pytest
from corpora import docs_frame, edited, no_docs, odd_docs, prose

from weirgate.llm import neardup
from weirgate.llm.common import WordHashes
from weirgate.llm.components import components


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(texts):
    """Least index reachable over links, by all pairs."""
    sets = [shingle_set(t) for t in texts]
    least = list(range(len(texts)))

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
            a, b = sorted((top(i), top(j)))
            least[b] = a
    return [top(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        base = prose(rng, rng.choice([3, 7, 12, 60, 200]))
        texts += [base] * rng.randint(1, 3)
        texts += [edited(rng, base, rng.randint(1, 4)) for _ in range(rng.randint(0, 6))]
    shared = prose(rng, 60)  # one passage that many texts hold
    texts += [f"{prose(rng, rng.randint(5, 80))} {shared}" for _ in range(25)]
    core = prose(rng, 120)  # many near copies of one text, some just similar enough and some not
    texts += [edited(rng, core, rng.choice([1, 2, 3, 6])) for _ in range(60)]
    rng.shuffle(texts)
    least, sizes = brute(texts)
    rows = {r.doc_id: r for r in neardup.near_duplicates(docs_frame(spark, texts)).collect()}
    assert [rows[i].component_id for i in range(len(texts))] == least
    assert [rows[i].n_shingles for i in range(len(texts))] == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())


def test_case_and_blanks(spark):
    texts = ["A b\tC\x0bd e", "a B c d E", "a b c d é", "a b c d É", "a b c d e"]
    rows = sorted(neardup.near_duplicates(docs_frame(spark, texts)).collect())
    assert [r.component_id for r in rows] == [0, 0, 2, 3, 4]


def test_estimate_follows_similarity():
    rng = np.random.default_rng(3)
    order = neardup.priorities()
    for share in (0.5, 0.85, 0.95):
        found = []
        for _ in range(40):
            pool = np.unique(rng.integers(0, 1 << 63, 1500, dtype=np.uint64) * np.uint64(2))
            n = int(len(pool) * (1 - share) / 2)
            a, b = np.sort(pool[n:]), np.sort(pool[: len(pool) - n])
            found.append((neardup.registers(a, order) == neardup.registers(b, order)).mean())
        assert abs(np.mean(found) - share) < 0.03


def test_small_sets_fill_every_register():
    order = neardup.priorities()
    one = neardup.registers(np.array([12345], np.uint64), order)
    assert len(set(one.tolist())) == 1
    few = neardup.shingles(b"a b c d e f g h", WordHashes())
    assert len(few) == 4 and set(neardup.registers(few, order)) <= set(neardup.registers(few, order)[few >> np.uint64(57)].tolist())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    found = {(r.doc_id, r.component_id, r.kept) for r in rows}
    assert {(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (None, 4, False)} & found >= {
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False)}
    left = neardup.keep_first(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert 5 not in ids and None in ids and len(ids) == docs.count() - 2


def test_no_rows(spark):
    assert neardup.near_duplicates(no_docs(spark)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)] + [(7, 7), (None, 3)]
    least = {}
    for a, b in links:
        if a is not None:
            least.setdefault(a, a), least.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a is not None and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    linked = {x for a, b in links if a is not None and a != b for x in (a, b)}
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {x: least[x] for x in linked}


def test_no_text_of_an_id_with_several_is_lost(spark):
    rng = random.Random(9)
    a, b = prose(rng, 60), prose(rng, 60)
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (6, b), (7, a)], "doc_id bigint, text string")
    rows = [(r.doc_id, r.text) for r in neardup.keep_first(docs).collect()]
    assert sorted(rows) == sorted([(3, a), (5, a), (5, b)])
