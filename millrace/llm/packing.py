"""Packing by power-of-two decomposition.

Each document (its ids, then the end id) is cut into pieces whose lengths are
powers of two: as many full pieces of `limit` tokens as fit, then the binary
digits of the rest, longest first. Every piece is a sequence by itself, so no
sequence crosses documents and none needs padding; sequences of one length form
a bucket from which equal-length batches are drawn.

Defined results: a null or empty text is a document of the end id alone, one
piece of length 1; a very long text is encoded whole and cut; there are no ties; repeated rows are packed each by itself; columns beyond
doc_id and text are ignored; an empty table gives no rows. Documents are cut
where they are read: no shuffle, and a task holds one batch of texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .encode import encoder, tokenizer_path

LIMIT = 1024
END_ID = 0
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def piece_lengths(n: int, limit: int = LIMIT) -> list[int]:
    """The lengths into which a document of n tokens is cut; limit is a power of two."""
    full, rest = divmod(n, limit)
    return [limit] * full + [1 << k for k in range(limit.bit_length() - 2, -1, -1) if rest >> k & 1]


def _cutter(path: str, limit: int, end_id: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        made = [0] * limit.bit_length()
        end = end_id.to_bytes(4, "little")
        enc = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.encode_column(batch.column("text")), strict=True):
                ids = ids.tobytes() + end
                total, start = len(ids) // 4, 0
                for length in piece_lengths(total, limit):
                    k = length.bit_length() - 1
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc, start, length, zlib.crc32(piece), total, (k << 58) | (partition << 34) | made[k], 0, piece if with_ids else None))
                    made[k] += 1
                    start += length
            for at in range(0, len(rows), 20_000):
                columns = zip(*rows[at : at + 20_000], strict=True)
                types = [pa.int64()] * 7 + [pa.binary()]
                names = [x.split()[0] for x in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return cut


def pack(docs: DataFrame, path: str | None = None, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece, which is one sequence.

    sequence_id holds the bucket (log2 of the length) in its high bits, then the
    partition, then a running number: sequences of a bucket are neighbours in id
    order. Input partitions of files are the same when a task runs again, so ids are
    too. limit is a power of two up to 2**15 (a bucket number fits in 4 bits).
    """
    common.prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _cutter(path or tokenizer_path(), limit, end_id, with_ids), SCHEMA
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7 over the whole documents table."""
    return pack(common.table(spark, sf_dir, "documents"), with_ids=False).drop("ids")
