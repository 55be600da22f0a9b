"""Token ids of a corpus in binary files, in ascending order of the document ids.

A file is a Parquet file of one shard, so Spark's commit protocol makes a lost or repeated task harmless
and any store will do. A row is a document: its ids in Simple-8b words (:mod:`tidecast.llm.simple8b`,
little-endian), its number of ids and the first word of each block of 1024 ids, from which a reader
decodes any block by itself. Shard numbers ascend with the document ids, and so do rows in a shard.

Null text is empty: such a document holds the end id alone. Null document ids come first. Rows that
repeat a document id are all written, in the order of their lengths and checksums. An empty table gives
an empty shard. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm import simple8b, words
from tidecast.llm.staging import map_batches
from tidecast.llm.tokens import encoder

#: Documents aimed at for each shard.
SHARD_DOCS = 8192

#: Bytes of text that are encoded at a time.
SLICE_BYTES = 3_000_000


def _bounds(docs: DataFrame, doc_id: str, shard_docs: int) -> list[int]:
    """Document ids that end the shards, from the id column alone."""
    n = docs.count()
    shards = max(1, -(-n // shard_docs))
    if shards == 1:
        return []
    at = [i / shards for i in range(1, shards)]
    row = docs.agg(F.percentile_approx(doc_id, at, max(10000, 10 * shards)).alias("at")).first()
    return sorted(set(row["at"] or []))


def write_ids(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0,
    doc_id: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS,
) -> None:
    """Write the ids of all documents to ``path``."""
    bounds = np.array(_bounds(docs, doc_id, shard_docs), np.int64)
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("doc_id", docs.schema[doc_id].dataType),
        T.StructField("n_tokens", T.LongType()), T.StructField("crc", T.LongType()),
        T.StructField("words", T.BinaryType()), T.StructField("blocks", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            key = batch.column(0)
            shard = np.searchsorted(bounds, key.fill_null(-(2**63)).to_numpy(zero_copy_only=False))
            data, offsets = words.buffers(batch.column(1))
            for low, high in words.slices(offsets, SLICE_BYTES):
                ids, rows = enc.encode(data[offsets[low] : offsets[high]], offsets[low : high + 1], end_id)
                coded, at, blocks = simple8b.encode(ids, rows)
                n_blocks = -(-np.diff(rows) // simple8b.BLOCK)
                blocks = blocks - np.repeat(at[:-1], n_blocks)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[a:b]) for a, b in zip((rows[:-1] * 4).tolist(), (rows[1:] * 4).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[low:high], pa.int32()),
                        key.slice(low, high - low),
                        pa.array(np.diff(rows)),
                        pa.array(crc, pa.int64()),
                        _binary(coded.astype("<u8"), at),
                        _binary(blocks.astype("<i4"), np.append(0, np.cumsum(n_blocks))),
                    ],
                    names=schema.names,
                )

    (
        map_batches(docs.select(F.col(doc_id), F.col(text)), run, schema, most=10_000)
        .repartitionById(len(bounds) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "doc_id", "n_tokens", "crc")
        .drop("crc")
        .write.parquet(path)
    )


def _binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Rows of bytes: row ``i`` is ``values[at[i]:at[i + 1]]``."""
    offsets = (np.asarray(at) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _decoded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the documents of a batch with columns ``n_tokens, words, blocks``, and their bounds."""
    n = batch.column("n_tokens").to_numpy()
    data, at = words.buffers(batch.column("words"))
    heads, block_at = words.buffers(batch.column("blocks"))
    coded = data[at[0] : at[-1]].view("<u8") if at[-1] > at[0] else np.zeros(0, np.uint64)
    heads = heads[block_at[0] : block_at[-1]].copy().view("<i4").astype(np.int64)
    n_blocks = np.diff(block_at) // 4
    heads = heads + np.repeat((at[:-1] - at[0]) // 8, n_blocks)
    nth = np.arange(len(heads)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    sizes = np.minimum(simple8b.BLOCK, np.repeat(n, n_blocks) - nth * simple8b.BLOCK)
    return simple8b.decode(coded.astype(np.uint64), heads, sizes), np.append(0, np.cumsum(n))


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of the files: ``shard, doc_id, n_tokens, ids_crc32`` and, if wanted, ``ids``."""
    files = spark.read.parquet(path)
    fields = [*files.schema.fields[:3], T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                ids, rows = _decoded(part)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[a:b]) for a, b in zip((rows[:-1] * 4).tolist(), (rows[1:] * 4).tolist())]
                columns = [*part.columns[:3], pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return map_batches(files, run, T.StructType(fields))


def corpus_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, ``start`` counting all ids before it."""
    totals = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    # One row for each shard: the only step that sees all of them.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("shard").orderBy("doc_id", "n_tokens", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return (
        read_ids(spark, path)
        .withColumn("_before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(firsts, "shard")
        .select("doc_id", (F.col("_first") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")
    )
