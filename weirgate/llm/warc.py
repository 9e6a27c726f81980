"""WARC archives, written and read as rows of records and chunks.

A payload larger than a chunk goes into several records: the first, then ``continuation`` records with a segment
number, the way the format foresees. So an oversized payload is a number of rows (record, chunk), and no task
holds more than a batch of chunks. Reading back, the chunks of a record arrive in order and feed one running
digest. The digest and length so far are carried with each chunk, so the last row of a record has its whole ones.

Archives are written by Spark's text sink, one record a line of that sink, and read by its text source with the
version line as separator: both work on any file system Spark reaches, split large files, and keep all bytes as
they are. The separator has no prefix of its own inside, and where a payload holds it, a chunk ends within it, so
it never stands inside a record.

Of records with equal payloads the one with the largest id is the response; the others become revisits that name
it and carry its digest, without payload. Records without an id are responses and are not revisited. Null
payloads are empty. Repeated rows are records of their own.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm.common import stage
from weirgate.session import scratch_path

CHUNK_BYTES = 64 * 1024
VERSION = "WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The base32 alphabet.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits, five digits (four characters) at a time."""
    parts = []
    for i in range(0, 40, 5):
        value = F.conv(F.substring(hexadecimal, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            parts.append(F.substring(F.lit(ALPHABET), place, F.lit(1)))
    return F.concat(*parts)


def _uuid(*columns: Column) -> Column:
    digits = F.md5(F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))
    parts = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null. Line ends within values are escaped."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _chunks(payload: str, size: int) -> str:
    """An array of the chunks of a binary column; an empty payload is one empty chunk."""
    cut = "transform(sequence(0, greatest(0, ceil(octet_length({0}) / {1}) - 1)), i -> substring({0}, int(i * {1}) + 1, {1}))"
    whole = cut.format(payload, size)
    version = VERSION.replace("/", "\\\\/").replace(".", "\\\\.").replace("\r\n", "\\\\r\\\\n")
    # As Latin-1 text every byte is one character, so that cutting and joining change none.
    pieces = f"split(decode({payload}, 'ISO-8859-1'), '(?<=WA)(?=RC{version[4:]})')"
    within = cut.format("encode(x, 'ISO-8859-1')", size)
    return f"CASE WHEN position(binary('{VERSION[:-2]}') IN {payload}) > 0 THEN flatten(transform({pieces}, x -> {within})) ELSE {whole} END"


def records(pages: DataFrame, record_id: str, url: str, payload: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per record segment with its text in column ``value``."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    read = pages.select(F.col(record_id).cast("bigint").alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    digested = read.withColumn("digest", F.sha1("payload"))
    groups = digested.where("id is not null").groupBy("digest").agg(F.max("id").alias("target"), F.count("*").alias("n"))
    # Written, so that Catalyst knows how few payloads repeat: where it may broadcast them it shuffles no payload.
    repeated = stage(groups.where("n > 1").select("digest", "target"), "repeated")
    joined = digested.join(repeated, "digest", "left")
    revisit = F.coalesce(F.col("id") < F.col("target"), F.lit(False))
    row = joined.withColumn("row", F.monotonically_increasing_id()).withColumn("revisit", revisit)
    row = row.withColumn("origin", _uuid(F.col("id"), F.col("digest"), F.col("row")))
    sent = F.expr(f"CASE WHEN revisit THEN array(binary('')) ELSE {_chunks('payload', chunk_bytes)} END")
    parts = row.withColumn("n_chunks", F.size(sent)).withColumn("length", F.octet_length("payload")).select(
        "*", F.posexplode(sent).alias("at", "chunk")
    )
    many, first = F.col("n_chunks") > 1, F.col("at") == 0
    kind = F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")
    own = F.when(first, F.col("origin")).otherwise(_uuid(F.col("origin"), F.col("at")))
    value = F.concat(
        F.lit(VERSION),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", own),
        _header("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
        _header("WARC-Payload-Length", F.col("length")),
        _header("WARC-Page-ID", F.col("id")),
        _header("WARC-Refers-To-Page-ID", F.when(F.col("revisit"), F.col("target"))),
        _header("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
        _header("WARC-Segment-Number", F.when(many, F.col("at") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(many & ~first, F.col("origin"))),
        _header("WARC-Segment-Total-Length", F.when(many & (F.col("at") + 1 == F.col("n_chunks")), F.col("length"))),
        _header("Content-Type", F.lit("text/html")),
        _header("Content-Length", F.octet_length("chunk")),
        F.lit("\r\n"),
        F.col("chunk").cast("string"),
        F.lit("\r\n\r"),  # the sink ends each row with the last line feed
    )
    return parts.select(value.alias("value"))


def write(pages: DataFrame, path: str, record_id: str, url: str, payload: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    records(pages, record_id, url, payload, chunk_bytes).write.option("lineSep", "\n").text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """One row per record segment: record, chunk, type, page_id, refers_to, digest and length as the header says,
    segmented, payload."""
    found = spark.read.option("lineSep", VERSION).text(path).where("value <> ''")
    head = F.substring_index("value", "\r\n\r\n", 1)
    split = found.select(F.concat(F.lit("\r\n"), head, F.lit("\r\n")).alias("head"), F.col("value").cast("binary").alias("raw"))

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", f"\r\n(?i:{name}): *([^\r]*)\r\n", 1), F.lit(""))

    length = field("Content-Length").cast("bigint")
    start = F.octet_length("head") + 1  # here the head has a line end before it, in the record one after it
    number = field("WARC-Segment-Number").cast("int")
    return split.select(
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("record"),
        F.coalesce(number, F.lit(1)).alias("chunk"),
        field("WARC-Type").alias("type"),
        field("WARC-Page-ID").cast("bigint").alias("page_id"),
        field("WARC-Refers-To-Page-ID").cast("bigint").alias("refers_to"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("said_digest"),
        field("WARC-Payload-Length").cast("bigint").alias("said_length"),
        number.isNotNull().alias("segmented"),
        F.substring(F.col("raw"), start, length.cast("int")).alias("payload"),
    )


_KEPT = ["record", "chunk", "type", "page_id", "refers_to", "said_length", "said_digest"]
_RUNNING = (
    "record string, chunk int, type string, page_id bigint, refers_to bigint, said_length bigint, said_digest string,"
    " length bigint, digest string"
)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and length up to each chunk; the chunks of a record follow one another in order."""
    current, digest, length, expected = None, hashlib.sha1(), 0, 1
    for batch in batches:
        lengths, digests = [], []
        for record, chunk, payload in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("record", "chunk", "payload"))):
            if record != current:
                current, digest, length, expected = record, hashlib.sha1(), 0, 1
            if chunk != expected:
                raise ValueError(f"segment {expected} of {record} is missing")
            digest.update(payload)
            length += len(payload)
            expected += 1
            lengths.append(length)
            digests.append(base64.b32encode(digest.digest()).decode())
        kept = batch.select(_KEPT)
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(lengths, pa.int64()), pa.array(digests, pa.string())], [*kept.schema.names, "length", "digest"]
        )


def chunk_table(chunks: DataFrame) -> DataFrame:
    """record, chunk, type, page_id, refers_to, what the header says, and length and digest up to that chunk.

    Only records of several segments are shuffled, by record; the others are whole where they are read.
    """
    chunks = chunks.select(*_KEPT, "payload", "segmented")
    single = chunks.where(~F.col("segmented")).drop("segmented").mapInArrow(_running, _RUNNING)
    many = chunks.where("segmented").drop("segmented").repartition("record").sortWithinPartitions("record", "chunk")
    return single.union(many.mapInArrow(_running, _RUNNING))


def round_trip(pages: DataFrame, record_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to per page.

    A revisit has no payload; its length and digest are the ones its record states.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path, record_id, url, payload)
    table = chunk_table(read_chunks(pages.sparkSession, path))
    # The first segment names the page and the type, the last one has the whole length and digest.
    whole = table.groupBy("record").agg(
        *[F.min_by(c, "chunk").alias(c) for c in ("page_id", "type", "refers_to", "said_length", "said_digest")],
        F.max("length").alias("length"),
        F.max_by("digest", "chunk").alias("digest"),
    )
    revisit = F.col("type") == "revisit"
    return whole.select(
        "page_id",
        F.when(revisit, F.col("said_length")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("said_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )
