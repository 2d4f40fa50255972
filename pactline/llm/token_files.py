"""Token ids of documents in Simple-8b files, and reading them back.

A file set is a Parquet table written by Spark's own committer, so it works on
any store and a lost task leaves nothing behind. A row is a chunk of whole
documents in ascending ``doc_id`` order:

``shard``, ``part``   place of the chunk: range of ids, then order within it
``first``             ids of the shard before the chunk
``size``              ids in the chunk
``doc_ids``, ``ends`` the chunk's documents and where each ends in it
``offsets``           word offset of each block of 1024 ids (see ``simple8b``)
``words``             the 64-bit words, little-endian

Defined cases: a null text is an empty one and holds the end id alone; null ids
of documents come first; rows that repeat a ``doc_id`` are kept and follow each
other in an order fixed by their texts; an empty table gives an empty file set;
columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.llm import simple8b
from pactline.llm.common import texts
from pactline.llm.encoder import encoder
from pactline.llm.words import slices

SCHEMA = (
    "shard int, part int, first bigint, size bigint, doc_ids array<bigint>, "
    "ends array<bigint>, offsets array<bigint>, words binary"
)
_DECODED = "shard int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"


def _lists(values: list) -> pa.Array:
    return pa.array(values, pa.list_(pa.int64()))


def _encoder(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, first = TaskContext.get().partitionId(), 0, 0
        coder = encoder(path)
        for batch in batches:
            ids_of = batch.column("doc_id")
            for cut in slices(batch.column("text")):
                flat, counts = coder.encode(cut)
                ends = np.cumsum(counts + 1)
                ids = np.full(int(ends[-1]), end_id, dtype=np.uint32)
                own = np.ones(len(ids), dtype=bool)
                own[ends - 1] = False
                ids[own] = flat
                words, offsets = simple8b.pack(ids)
                docs = ids_of.slice(cut.first, cut.last - cut.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([part], pa.int32()),
                        pa.array([first], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.ListArray.from_arrays([0, len(docs)], docs),
                        _lists([ends]),
                        _lists([offsets]),
                        pa.array([words.astype("<u8").tobytes()], pa.binary()),
                    ],
                    names=["shard", "part", "first", "size", "doc_ids", "ends", "offsets", "words"],
                )
                part, first = part + 1, first + len(ids)

    return encode


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shards: int | None = None
) -> None:
    """Encode every whole text, append ``end_id``, and write the file set to ``path``."""
    count = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    (
        texts(docs)
        .repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_encoder(tokenizer, end_id), SCHEMA)
        .write.parquet(path)
    )


def _read_words(batch: pa.RecordBatch, i: int) -> np.ndarray:
    words = np.frombuffer(batch.column("words")[i].as_py(), dtype="<u8")
    offsets = batch.column("offsets")[i].values.to_numpy()
    return simple8b.unpack(words, offsets, batch.column("size")[i].as_py())


def _decoder(with_ids: bool):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = _read_words(batch, i).astype("<u4")
                ends = batch.column("ends")[i].values.to_numpy()
                begins = np.concatenate([[0], ends[:-1]])
                spans = list(zip(begins.tolist(), ends.tolist(), strict=True))
                shard, first = batch.column("shard")[i].as_py(), batch.column("first")[i].as_py()
                columns = [
                    pa.array(np.full(len(ends), shard, dtype=np.int32)),
                    batch.column("doc_ids")[i].values,
                    pa.array(begins + first),
                    pa.array(ends - begins),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in spans], pa.int64()),
                ]
                names = ["shard", "doc_id", "place", "n_tokens", "ids_crc32"]
                if with_ids:
                    cuts = pa.array(np.append(begins, ends[-1]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(cuts, ids.astype(np.int32)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return decode


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of a file set: where its ids start, how many, their checksum.

    ``start`` counts the ids of all documents before it. Only one sum per shard
    is ordered in one task.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    decoded = files.mapInArrow(
        _decoder(with_ids), _DECODED + (", ids array<int>" if with_ids else "")
    )
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        files.groupBy("shard")
        .agg(F.sum("size").alias("_size"))
        .select("shard", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_base"))
    )
    rows = decoded.join(F.broadcast(bases), "shard")  # one row per shard
    return rows.select(
        "doc_id",
        (F.col("_base") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )
