"""What several operators share: reading a table, cutting lineage, folds, and Arrow columns."""

from __future__ import annotations

import os
import traceback
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.session import scratch_path

HELD_OUT = 2
#: Bytes of rows in an Arrow batch for a Python worker, and the session option that says so.
BATCH_BYTES, BATCH_OPTION = "1m", "spark.sql.execution.arrow.maxBytesPerBatch"
#: Words whose hashes a task keeps.
HELD_WORDS = 120_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors.

    Zstandard works in the heap. Snappy keeps buffers outside of it until the heap is collected, which for many small
    files is more than an executor has to spare.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column) -> Column:
    """The remainder that decides whether a document is held out."""
    return F.crc32(doc_id.cast("string")) % 4


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a model of bounded size; a task calls the result to have it.

    It travels with its classes, as bytes: a plain broadcast would name them, and executors have no copy of this package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


def apart(function: Callable[[], Any]) -> Any:
    """The result of a function run in a child process, whose memory is given back when it ends."""
    reader, writer = os.pipe()
    child = os.fork()
    if not child:
        try:
            os.close(reader)
            with os.fdopen(writer, "wb") as out:
                out.write(cloudpickle.dumps(function()))
            os._exit(0)
        except BaseException:
            traceback.print_exc()
        os._exit(1)
    os.close(writer)
    with os.fdopen(reader, "rb") as found:
        result = found.read()
    if os.waitpid(child, 0)[1]:
        raise RuntimeError("the child process failed; its error is on the standard error output")
    return cloudpickle.loads(result)


def in_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: Any) -> DataFrame:
    """``mapInArrow`` whose batches have about ``BATCH_BYTES``, so that neither the executor's JVM nor its Python worker
    holds thousands of whole texts outside the heap. Texts stay whole: the one that reaches the limit ends its batch.

    Spark reads the option when the rows are asked for, so it stays set in the session; a value of the session's own stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_OPTION, None) is None:
        conf.set(BATCH_OPTION, BATCH_BYTES)
    return df.mapInArrow(function, schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """A column as strings; null is empty."""
    return ["" if t is None else t for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def encoded(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A column as UTF-8 bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [b"" if t is None else t for t in column.to_pylist()]


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches in views of fewer rows, so that no more Python objects than theirs are held at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def slices(batch: list[str], most_chars: int = 2_000_000) -> Iterator[list[str]]:
    """A batch in parts of about that many characters, so that the words of a part are few; texts stay whole."""
    part, size = [], 0
    for text in batch:
        part.append(text)
        size += len(text)
        if size >= most_chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit integers that spreads near values apart."""
    v = values.astype(np.uint64)
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen before; emptied when it has grown large."""

    def __init__(self, most: int = HELD_WORDS):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def windows(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` ids."""
    count = len(ids) - width + 1
    out = np.zeros(count, np.uint64)
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + count]
    return mixed(out)
