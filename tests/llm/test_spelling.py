import random
import re
import zlib
from collections import Counter

import pytest
from corpora import docs_frame, no_docs, odd_docs

from weirgate.llm import spelling
from weirgate.llm.queries import op13_spelling_variants


def near(a, b):
    """One inserted, deleted or replaced code point, told letter by letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, slip_every=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            hashed = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and slip_every and hashed % slip_every == 0:
                run = "".join(c for i, c in enumerate(run) if i != hashed % len(run))
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_forms(words):
    near_to = {w: [o for o in words if abs(len(o) - len(w)) < 2 and near(w, o)] for w in words}
    form = {}
    for w, others in near_to.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near_to[w]), words.get(form[w])))
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()], key=repr)


def mutated(rng, word, letters):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


@pytest.mark.parametrize("letters", ["ab", "abcdeéÿ"])
def test_against_all_pairs(spark, letters):
    rng = random.Random(letters)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))): 2 ** rng.randint(2, 12) for _ in range(60)}
    for _ in range(400):
        word = mutated(rng, rng.choice(sorted(words)), letters)
        if len(word) >= 5:
            words.setdefault(word, rng.randint(3, 200))
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert found(spelling.group_variants(table)) == brute_forms(words)


@pytest.mark.parametrize("block,shard", [(60, 500), (1, 1), (10**6, 10**6)])
def test_hot_halves_are_split(spark, block, shard):
    """Many words share both halves; parts of a cell meet pairwise and each pair is found once a direction."""
    rng = random.Random(block)
    words = sorted({"hotwo" + "".join(rng.choice("xyz") for _ in range(rng.randint(1, 4))) + "rdend" for _ in range(120)})
    table = spark.createDataFrame([(w, 3 + i) for i, w in enumerate(words)], "word string, n bigint")
    pairs = spelling.near_pairs(table, block, shard).collect()
    assert Counter((r.word, r.near) for r in pairs) == Counter((a, b) for a in words for b in words if near(a, b))
    assert all(r.near_n == 3 + words.index(r.near) for r in pairs)


def test_index_against_plain_distance():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    index = spelling.PositionIndex(words)
    for query in words[::7]:
        same, longer = index.near(query)
        assert sorted(index.members(same)) == [w for w in words if len(w) == len(query) and near(query, w)]
        assert sorted(index.members(longer)) == [w for w in words if len(w) == len(query) + 1 and near(query, w)]


def test_words_and_slips(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["Straße", "naïve", "HELLO", "wörld's", "a1b2", "ÀÉÎÕÜ", "x×y÷z", "tomato", "tomatoe"]) for _ in range(40)) for _ in range(300)]
    rows = spelling.vocabulary(docs_frame(spark, texts), slip_every=97).collect()
    assert {r.word: r.n for r in rows} == brute_words(list(enumerate(texts)))
    assert any(len(r.word) == 5 and r.word in "tomatoe" for r in rows)  # some slips happen


def test_chains_of_forms(spark):
    words = {"aaaaa" + "b" * i: 3 * 2**i for i in range(20)}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert found(spelling.group_variants(table)) == brute_forms(words)


def test_odd_rows(spark, tmp_path):
    docs = odd_docs(spark)
    long = "y" * 50_000
    more = docs_frame(spark, [f"{long} {long} {long} {long}z {long}z {long}z {long}z {long}z {long}z", "same same words words words"], 50)
    docs = docs.unionByName(more, allowMissingColumns=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(op13_spelling_variants(spark, str(tmp_path))) == brute_forms(brute_words(rows))


def test_no_rows(spark, tmp_path):
    no_docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert op13_spelling_variants(spark, str(tmp_path)).collect() == []
