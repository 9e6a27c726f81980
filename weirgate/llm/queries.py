"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import decontaminate as leaks
from weirgate.llm import langid, merkle, neardup, packing, pii, quality, quotes, spelling, termscore, toxicity, urlfilter, warc
from weirgate.llm.common import HELD_OUT, fold, table

Query = Callable[[SparkSession, str], DataFrame]

#: Names the key of the surrogates; a deployment passes its own secret to ``pii.replace``.
SURROGATE_KEY = b"weirgate public test key"


def op1_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated on some texts of remainder 3, taught by all others; remainder 2 is held out."""
    docs = table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id"))
    models = langid.train(docs.where(remainder != HELD_OUT), remainder < HELD_OUT)
    found = langid.identify(docs, models)
    return found.withColumn("held_out", F.coalesce(remainder == HELD_OUT, F.lit(False)))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, SURROGATE_KEY, "n_entities")


def op4_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_weak_supervision_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*base, "p_good")


def op6_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    """Trained on labelled documents that are not held out."""
    learnt = table(spark, sf_dir, "documents").where(fold(F.col("doc_id")) != HELD_OUT)
    return toxicity.fit(toxicity.training_rows(learnt, table(spark, sf_dir, "labels")))


def op7_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.withColumn("held_out", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)))


def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, coverage and kind of each contaminated document and the item that it holds."""
    return leaks.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of all conversations, sent as replies that quote up to two turns, linked by their quotes alone."""
    linked = quotes.conversations(quotes.quoting_replies(table(spark, sf_dir, "conversations")))
    return linked.select("conversation_id", "depth", F.col("id").alias("message_id"), F.col("parent").alias("parent_id"), "text")


DAY = 86400
YEAR_START = 1704067200  # 2024-01-01


def captures(pages: DataFrame) -> DataFrame:
    """Every page as a capture, at a time of a year that its id gives."""
    time = YEAR_START + F.col("page_id") * 7919 % 365 * DAY + F.col("page_id") * 104729 % DAY
    return pages.select(F.col("page_id").alias("id"), "url", time.cast("bigint").alias("time"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries on the hosts and first directories of the pages; a hash of the pattern decides which and when."""
    host = urlfilter.host_of(F.col("url"))
    directory = F.regexp_extract("url", "^[^:]*://[^/?#]*(/[^/?#]*/)", 1)
    named = pages.select(F.explode(F.array(host, F.regexp_replace(host, "^[^.]*\\.", ""), F.concat(host, directory))).alias("pattern"))
    hashed = named.where("pattern <> ''").distinct().withColumn("h", F.conv(F.substring(F.md5("pattern"), 1, 7), 16, 10).cast("bigint"))
    listed = hashed.select(
        "pattern",
        "h",
        F.explode(F.expr("filter(array(if(h % 3 = 0, 'ads', null), if(h % 4 = 1, 'spam', null), if(h % 10 = 7, 'allow', null)), x -> x is not null)")).alias("list"),
    )
    start = F.lit(YEAR_START) + F.col("h") % 200 * DAY
    changes = F.array(
        F.struct(F.lit(1).alias("number"), F.lit("add").alias("action"), start.alias("time")),
        F.struct(F.lit(2).alias("number"), F.lit("remove").alias("action"), (start + 60 * DAY).alias("time")),
        F.struct(F.lit(3).alias("number"), F.when(F.col("h") % 2 == 0, "add").alias("action"), (start + 120 * DAY).alias("time")),
    )
    return listed.select("list", "pattern", F.explode(changes).alias("c")).select("list", "pattern", "c.time", "c.number", "c.action")


def op10_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = urlfilter.judge(captures(pages), list_entries(pages))
    return judged.withColumnRenamed("id", "page_id").withColumn("lists", F.array_join("lists", ","))


def op11_term_at_a_time_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id 50 divides, by the inner product of whole numbers."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = termscore.top_k(vectors, vectors.where(F.col("id") % 50 == 0), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's digests and proof; where 5 divides the id's checksum, a text in lower case is audited instead."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate(F.col("text"), UPPER, UPPER.lower())
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf([*fields, lowered]))
    own = merkle.leaf([*fields, F.col("text")])
    rows = docs.select(F.col("source").alias("group"), F.col("doc_id").alias("id"), own.alias("digest"), tampered.alias("other"))
    made = merkle.manifest(rows)
    return merkle.audit(made.proofs, made.root).withColumnRenamed("id", "doc_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of all documents, where one in 97 runs loses a letter, with their more frequent near forms."""
    return spelling.group_variants(spelling.vocabulary(table(spark, sf_dir, "documents"), slip_every=97))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_kneser_ney_language,
        op2_best_fit_packing,
        op3_surrogates,
        op4_hyperminhash_dedup,
        op5_weak_supervision_quality,
        op6_warc_chunks,
        op7_string_kernel_toxicity,
        op8_template_decontamination,
        op9_quotation_linking,
        op10_temporal_url_lists,
        op11_term_at_a_time_top_k,
        op12_merkle_manifest,
        op13_spelling_variants,
    )
}
