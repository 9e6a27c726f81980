import math
import random

import numpy as np
import pyarrow as pa
import pytest

from weirgate.llm import termscore
from weirgate.llm.queries import op11_term_at_a_time_top_k

VECTORS = "id bigint, vector array<double>"


def weights(vector):
    return [math.floor(256 * x) if abs(x) < 2**50 else 256 * int(x) for x in vector]


def brute(rows, k, asked=lambda i: i % 50 == 0):
    """The whole answer by plain loops over all pairs."""
    usable = [(i, weights(v)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if q is None or not asked(q):
            continue
        scores = [(min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), i) for i, b in usable if i != q]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(q, rank + 1, i, s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.query_id, r.rank, r.id, r.score) for r in df.collect()], key=repr)


@pytest.mark.parametrize("block_terms", [7, 300, 1 << 20])
def test_against_all_pairs(spark, block_terms):
    rng = random.Random(block_terms)
    rows = [(i, [rng.choice([0.0, rng.gauss(0, 0.2), 0.001, -0.5]) for _ in range(rng.choice([0, 3, 16, 16]))]) for i in range(-60, 190)]
    vectors = spark.createDataFrame(rows, VECTORS).repartition(5)
    queries = vectors.where("id % 50 = 0")
    assert found(termscore.top_k(vectors, queries, 5, block_terms)) == brute(rows, 5)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(None, [1.0]), (None, [2.0])]
    vectors = spark.createDataFrame(rows, VECTORS).repartition(7)
    assert found(termscore.top_k(vectors, vectors.where("id = 0"), 5)) == brute(rows, 5, lambda i: i == 0)


def test_odd_vectors(spark):
    rows = [
        (0, [0.5, 0.5]),
        (50, None),
        (100, [0.5, None]),
        (150, [float("nan"), 1.0]),
        (200, [float("inf"), 1.0]),
        (250, []),
        (None, [0.25, 0.25]),
        (7, [-0.001, 0.001]),
        (8, [1e30, 1.0]),
        (8, [1e30, 1.0]),
        (300, [1e300, -1e300]),
        (350, [0.5, 0.5]),
        (350, [0.5, 0.5]),
    ]
    vectors = spark.createDataFrame(rows, VECTORS)
    assert found(termscore.top_k(vectors, vectors.where("id % 50 = 0"), 5)) == brute(rows, 5)


def test_fewer_candidates_than_wanted(spark):
    one = spark.createDataFrame([(0, [1.0])], VECTORS)
    assert found(termscore.top_k(one, one)) == []
    assert found(termscore.top_k(one.where("id < 0"), one)) == []
    assert found(termscore.top_k(one, one.where("id < 0"))) == []


def test_postings_hold_each_weight_once():
    rows = termscore.sparse(pa.array([[0.5, 0.0, -0.25], [], [0.0, 0.5, 0.001]], pa.list_(pa.float64())).slice(0, 3))
    lists = termscore.postings(rows)
    assert {t: list(zip(r.tolist(), w.tolist())) for t, (r, w) in lists.items()} == {0: [(0, 128)], 2: [(0, -64)], 1: [(2, 128)]}
    assert np.array_equal(rows[0], [0, 2, 2, 3])


def test_query_with_extra_columns(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(8)], 1, 2, 3, "n") for i in range(120)] + [(None, None, None, None, None, None)]
    schema = "vec_id bigint, embedding array<float>, rank int, score bigint, id int, number string"
    made = spark.createDataFrame(rows, schema)
    made.write.parquet(str(tmp_path / "embeddings.parquet"))
    stored = [(r.vec_id, r.embedding) for r in made.collect()]
    answer = op11_term_at_a_time_top_k(spark, str(tmp_path)).withColumnRenamed("vec_id", "id")
    assert answer.columns == ["query_id", "rank", "id", "score"] and found(answer) == brute(stored, 5)


def test_candidates_are_not_shuffled(spark, tmp_path):
    """Only best lists cross the network: the one exchange of the result is by query."""
    path = str(tmp_path / "v")
    spark.range(500).selectExpr("id", "array(double(id % 7), 1D) vector").write.parquet(path)
    vectors = spark.read.parquet(path)
    plan = termscore.top_k(vectors, vectors.where("id % 50 = 0"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(number") == 1 and plan.count("Exchange") == 1 and "Cartesian" not in plan
