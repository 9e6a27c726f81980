"""Registered corpus queries against their SQL, and the pipeline against its parts done by hand."""

import ast
import random
from pathlib import Path

import numpy as np
import pytest
from compare import connect, differences
from conftest import ROOT
from test_neardup import brute
from test_packing import check_packed

import corpus_pipeline
from weirgate.llm import decontaminate, pii, toxicity
from weirgate.llm.oracles import ORACLES
from weirgate.llm.queries import QUERIES, SURROGATE_KEY, toxicity_model

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == ""


def test_one_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    model = toxicity_model(spark, SMALL)
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)

    def toxic(text):
        worst = max(model.word_scores(sorted(toxicity.words_of(text))), default=toxicity.NO_WORDS)
        return model.probability(np.array([worst]))[0] >= toxicity.THRESHOLD

    rows = [r for r in rows if not toxic(r.text)]
    least, _ = brute([r.text for r in rows])
    rows = [r for i, r in enumerate(rows) if least[i] == i]
    left = spark.createDataFrame(rows, docs.schema)
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    flagged = {r.doc_id for r in decontaminate.contamination(left, benchmark).collect()}
    rows = [r for r in rows if r.doc_id not in flagged]

    def swapped(text):
        out, end = [], 0
        for a, b, kind in pii.find(text):
            out += [text[end:a], pii.render(kind, text[a:b], pii.surrogate(kind, pii.key_of(kind, text[a:b]), 0, SURROGATE_KEY))]
            end = b
        return "".join([*out, text[end:]])

    table = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        table = function(spark, table, SMALL)
        assert table.columns == columns and table.schema.simpleString() == docs.schema.simpleString(), name
    assert sorted((r.doc_id, r.text) for r in table.collect()) == [(r.doc_id, swapped(r.text)) for r in rows]
    check_packed([(r.doc_id, swapped(r.text)) for r in rows], corpus_pipeline.run(spark, SMALL).collect())


def test_pipeline_takes_odd_rows(spark, tmp_path):
    from corpora import odd_docs

    docs = odd_docs(spark)
    benchmark = [(1, " ".join(docs.where("doc_id = 6").first().text.split()[10:40])), (2, None)]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(k, 1, random.Random(k).randrange(2)) for k in range(4, 11)] + [(None, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({r.sequence_id for r in rows}) > 0 and all(r.offset + r.length <= 1024 for r in rows)
    for name in ("op1_kneser_ney_language", "op2_best_fit_packing", "op3_surrogates", "op4_hyperminhash_dedup",
                 "op5_weak_supervision_quality", "op7_string_kernel_toxicity"):
        assert {r.doc_id for r in QUERIES[name](spark, str(tmp_path)).collect()} == {r.doc_id for r in docs.collect()}, name
    leaked = QUERIES["op8_template_decontamination"](spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.item_id) for r in leaked] == [(6, 1)]


def test_nothing_else_imports_the_subpackage():
    for file in (ROOT / "weirgate").rglob("*.py"):
        if "llm" in file.relative_to(ROOT / "weirgate").parts:
            continue
        for node in ast.walk(ast.parse(file.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith(("weirgate.llm", "corpus_pipeline")) for n in names), file


def test_native_operators_hold_no_python_functions():
    for name in ("quality", "quotes", "urlfilter"):
        source = Path(ROOT / "weirgate" / "llm" / f"{name}.py").read_text()
        assert not any(x in source for x in ("udf", "mapIn", "applyIn", "rdd", "pandas", "pyarrow"))
