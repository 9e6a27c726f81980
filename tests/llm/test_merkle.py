import hashlib
import random
import zlib
from itertools import groupby

import pytest
from corpora import no_docs, odd_docs
from pyspark.sql import functions as F

from weirgate.llm import merkle
from weirgate.llm.queries import op12_merkle_manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root of some digests, and for each the (before, after) of every level, by plain lists."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i : i + 16] for i in range(0, len(level), 16)]
        for path, i in zip(paths, at):
            run, slot = runs[i // 16], i % 16
            path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        at, level = [i // 16 for i in at], [h("".join(run)) for run in runs]
    return level[0], paths


def brute(rows):
    """The rows of op12 for rows of FIELDS."""
    def lowered(text):
        return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    made = [(r[1], r[0], leaf(r), leaf((*r[:4], lowered(r[4])))) for r in rows]
    made.sort(key=lambda r: ((r[0] is not None, (r[0] or "").encode()), (r[1] is not None, r[1] or 0), r[2]))
    groups = [list(g) for _, g in groupby(made, key=lambda r: r[0])]
    trees = [tree([r[2] for r in g]) for g in groups]
    root, tops = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for g, (subroot, paths), top in zip(groups, trees, tops):
        for (_, doc_id, own, tampered), path in zip(g, paths):
            path = path + top
            node = tampered if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else own
            for before, after in path:
                node = h(before + node + after)
            out.append((doc_id, own, subroot, root, h("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def answered(spark, docs, path):
    docs.write.parquet(str(path / "documents.parquet"))
    return sorted([tuple(r) for r in op12_merkle_manifest(spark, str(path)).collect()], key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [16, 17, 1], [257, 3, 256, 15], [1] * 40])
def test_against_plain_python(spark, tmp_path, sizes):
    rng = random.Random(str(sizes))
    rows, k = [], 0
    for s, size in enumerate(sizes):
        for _ in range(size):
            k += rng.randint(1, 3)
            rows.append((k, None if s == 1 else f"source É{s}", rng.choice(["en", None]), k, rng.choice(["Some Text", "lower", "", None, "ÀÉ"])))
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars int, text string").repartition(6)
    assert answered(spark, docs, tmp_path) == brute(rows)


def test_odd_rows(spark, tmp_path):
    docs = odd_docs(spark)
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    assert answered(spark, docs, tmp_path) == brute(rows)


def test_no_rows(spark, tmp_path):
    assert answered(spark, no_docs(spark), tmp_path) == []
    empty = merkle.manifest(spark.createDataFrame([], "group string, id bigint, digest string, other string"))
    assert empty.root is None and empty.subroots.collect() == []


def test_any_change_is_found(spark):
    """A fold over every leaf's true digest ends in the root, over another digest it does not."""
    rows = spark.range(600).select(
        (F.col("id") % 3).cast("string").alias("group"), "id", merkle.leaf([F.col("id")]).alias("digest"), F.lit(None).cast("string").alias("other")
    )
    made = merkle.manifest(rows)
    assert made.subroots.count() == 3
    assert merkle.audit(made.proofs, made.root).where("verified").count() == 600
    wrong = made.proofs.withColumn("other", F.sha2(F.col("digest"), 256))
    assert merkle.audit(wrong, made.root).where("verified").count() == 0


def test_hot_group_spreads(spark):
    """All rows in one group: no window over rows and no exchange by group alone."""
    rows = spark.range(2000).select(
        F.lit("a").alias("group"), "id", merkle.leaf([F.col("id")]).alias("digest"), F.lit(None).cast("string").alias("other")
    )
    plan = merkle.manifest(rows).proofs._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning(group" not in plan and "SinglePartition" not in plan
