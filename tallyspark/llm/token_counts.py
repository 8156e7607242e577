"""Token counts with a digest cache.

A text is known by the SHA-256 of its normalised content (null becomes the empty text, nothing else
changes, so equal digests have equal counts) and the tokenizer by the SHA-256 of its file. Counts
already in the cache are joined; of the others each distinct text is encoded once, and its count is
appended to the cache. The first copy (smallest doc_id) of a missing text stands for all: only its
row moves, by doc_id, so many copies of one text meet in no task.

The cache is a folder of Parquet files (version, digest, n_tokens). A job that is repeated after a
failure may append a count twice; reading takes one per key. Empty tables give empty results; rows
without doc_id are counted as any other; very long texts are encoded whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.shared import stored

CACHE = T.StructType(
    [T.StructField("version", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("n_tokens", T.LongType())]
)
BATCH_CHARS = 1 << 20


def tokenizer_version(model: bytes) -> str:
    return hashlib.sha256(model).hexdigest()


def _encode(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts, group, size = [], [], 0
            for text in texts:
                group.append(text or "")
                size += len(group[-1])
                if size >= BATCH_CHARS:
                    counts += map(len, processor.encode(group, num_threads=1))
                    group, size = [], 0
            if group:
                counts += map(len, processor.encode(group, num_threads=1))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """digest, n_tokens: what is stored for one tokenizer; nothing if there is no cache yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    stored = spark.read.schema(CACHE).parquet(path).where(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, path: str, model: bytes) -> None:
    """Encodes the distinct texts whose counts are missing, and appends their counts."""
    version = tokenizer_version(model)
    cached = read_cache(docs.sparkSession, path, version)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("digest"))
    missing = keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("doc_id").alias("ids"))
    missing = missing.join(cached, "digest", "left_anti")
    chosen = missing.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))
    texts = keyed.join(chosen.hint("shuffle_hash"), same, "left_semi").select("digest", "text")
    counts = texts.mapInArrow(_encode(model), "digest string, n_tokens long").dropDuplicates(["digest"])
    counts.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(path)


def count_tokens(docs: DataFrame, path: str, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; fills the cache at `path` first."""
    model = Path(model_file).read_bytes()  # half a megabyte, sent with the tasks
    fill_cache(docs, path, model)
    # One row per digest in files of its own, so the join below may split the rows of a frequent text.
    cached = stored(read_cache(docs.sparkSession, path, tokenizer_version(model)), "counts")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest"))
    return keyed.join(cached, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
