"""What executors hold for the Python workers of the corpus operators, whatever the number of rows in a task."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weirgate.llm import decontaminate, neardup, packing, pii, toxicity
from weirgate.llm.common import BATCH_BYTES, BATCH_OPTION, WordHashes, in_arrow


@pytest.fixture
def fresh(spark):
    """A session that has no batch size of its own."""
    spark.conf.unset(BATCH_OPTION)
    yield spark
    spark.conf.unset(BATCH_OPTION)


@pytest.fixture
def sizes():
    def measured(batches):  # local, so that it travels by value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    return measured


def test_batches_are_bounded_and_lose_nothing(fresh, sizes):
    long = F.when(F.col("id") == 700, F.repeat(F.lit("y"), 3_000_000)).otherwise(F.repeat(F.lit("x"), 2000))
    rows = in_arrow(fresh.range(0, 3000, 1, 1).select("id", long.alias("text")), sizes, "n long, size long").collect()
    assert sum(r.n for r in rows) == 3000
    assert sorted(r["size"] for r in rows)[-2] < 1.1 * (1 << 20)
    assert 3_000_000 < max(r["size"] for r in rows) < 3_000_000 + 1.1 * (1 << 20)
    assert in_arrow(fresh.range(0), sizes, "n long, size long").collect() == []


def test_a_batch_size_of_the_session_stays(fresh, sizes):
    fresh.conf.set(BATCH_OPTION, "50k")
    texts = fresh.range(0, 100, 1, 1).select("id", F.repeat(F.lit("x"), 2000).alias("text"))
    rows = in_arrow(texts, sizes, "n long, size long").collect()
    assert sum(r.n for r in rows) == 100 and max(r["size"] for r in rows) < 60_000
    assert fresh.conf.get(BATCH_OPTION) in ("50k", "51200b")


@pytest.mark.parametrize("operator", ["clean", "score", "sketch", "contamination", "replace", "pieces"])
def test_stages_of_the_pipeline_bound_their_batches(fresh, operator):
    docs = fresh.range(3).selectExpr("id AS doc_id", "concat('one two three four five six ', id) AS text")
    model = toxicity.train([("one two", 0), ("three four", 0)])
    {
        "clean": lambda: toxicity.keep_clean(docs, model),
        "score": lambda: toxicity.score(docs, model),
        "sketch": lambda: neardup.sketch(docs),
        "contamination": lambda: decontaminate.contamination(docs, fresh.createDataFrame([(1, "a b c")], "item_id bigint, text string")),
        "replace": lambda: pii.replace(docs, b"key"),
        "pieces": lambda: packing.pieces(docs),
    }[operator]()
    assert fresh.conf.get(BATCH_OPTION, None) == BATCH_BYTES


def test_few_words_are_kept():
    many = [b"w%d" % k for k in range(150_000)]
    hashes = WordHashes()
    first = hashes.of(many)
    assert hashes.of(many[:10]).tolist() == first[:10].tolist() and len(hashes) == 10
    templates = decontaminate.Templates()
    assert len(set(templates.numbers([w.decode() for w in many]).tolist())) == 150_000
    templates.numbers(["w1", "w2", "w1"])
    assert len(templates) == len(templates.hashes) == len(templates.flags) == 2
