"""Helpers of the training-data operators: shared scratch tables, document input, word codes of an Arrow batch."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handled at once inside a task: at most so many, and at most so many characters (one long text may exceed it).
CHUNK_TEXTS, CHUNK_CHARS = 2000, 4_000_000


#: Folders that scratch() has named in this process.
NAMED: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. drop() deletes it when it is not needed.

    Without that setting, only a local session gets a folder of its own (tests); a cluster must name one.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="seriesloom-")
    NAMED.append(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return NAMED[-1]


def drop(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders that scratch() named; no DataFrame that reads them can be used afterwards."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        NAMED.remove(folder)


#: With this setting Spark deletes the shuffle files of a statement when it ends; otherwise they stay until a garbage collection.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later stages neither recompute nor lose it.

    Nothing reads the shuffle files of the write once the table is there, so they go with it.
    """
    spark = df.sparkSession
    path, before = scratch(spark, name), spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns the operators read, so that extra or clashing columns do no harm."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text of a piece fits in a task's memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            to = min(at + CHUNK_TEXTS, max(at + 1, int(np.searchsorted(sizes, done + CHUNK_CHARS, side="right"))))
            yield batch.slice(at, to - at)
            at = to


def word_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of every word, distinct words, first word of each text) for words `[^\\x20\\x09-\\x0D]+`; a null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    full = np.asarray(pc.greater(pc.binary_length(values), 0))
    starts = np.concatenate(([0], np.cumsum(full)))[offsets]
    coded = values.filter(pa.array(full)).dictionary_encode()
    return np.asarray(coded.indices, dtype=np.int64), coded.dictionary, starts


def word_counts(texts: pa.Array) -> np.ndarray:
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    full = np.concatenate(([0], np.cumsum(np.asarray(pc.greater(pc.binary_length(lists.flatten()), 0)))))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    return np.diff(full[offsets - offsets[0]])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k codes; its last k - 1 places are short and mean nothing. Codes may be hashes."""
    out = np.zeros(len(codes), dtype=np.uint64)
    codes = codes.astype(np.uint64)
    for i in range(k):
        out *= np.uint64(0x9FB21C651E98DF25)
        if i < len(codes):
            out[: len(codes) - i] += codes[i:]
    return mix(out)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, first word of each text); equal in all tasks."""
    import xxhash

    codes, words, starts = word_codes(texts)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    return hashes[codes] if len(codes) else np.zeros(0, np.uint64), starts


def text_hash(column):
    """128 bits that stand for a text."""
    return F.unhex(F.md5(column.cast("binary")))
