"""Token ids in ORC: run-length encoded stripes, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill.llm.common import store
from jobmill.llm.encoder import TOKENIZER, task_encoder
from jobmill.session import shared_dir

END_ID = 2
#: UTF-8 bytes of the texts of one file, about: some 16 million ids and 30 MB on disk.
BYTES_PER_FILE = 48 << 20
#: Ids that a task holds before it gives a batch on; bytes of word ids that it remembers.
IDS_AT_ONCE, REMEMBERED_BYTES = 1 << 20, 128 << 20
ORC = {
    "compression": "zstd",
    "orc.stripe.size": 16 << 20,
    "orc.row.index.stride": 1000,
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": 0.01,
}
# Ascending; Spark puts missing values first.
ORDER = ("doc_id", "hash", "row")
FILE = "doc_id long, part int, inside long, ids array<int>"
LISTED = "part int, doc_id long, inside long, n_tokens long, ids_crc32 long"
ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("inside", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encoded(rows: DataFrame, end_id: int = END_ID, name: str = TOKENIZER) -> DataFrame:
    """Ids of whole documents in the order of the rows, with the count of ids before in the task."""

    def batch(docs: list, parts: list, ids: list[np.ndarray], before: int) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, ids)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids).view("<i4"), pa.int32()))
        columns = [pa.array(docs, pa.int64()), pa.array(parts, pa.int32()), pa.array(before + ends[:-1], pa.int64()), lists]
        return pa.RecordBatch.from_arrays(columns, schema=ARROW)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4")
        with task_encoder(name, REMEMBERED_BYTES) as coder:
            docs, parts, ids, held, before = [], [], [], 0, 0
            for given in batches:
                for doc, part, text in zip(*given.columns, strict=True):
                    own = coder.text(text.as_py() or "")
                    docs.append(doc.as_py())
                    parts.append(part.as_py())
                    ids += [np.concatenate([own, end])]
                    held += len(own) + 1
                    if held >= IDS_AT_ONCE:
                        yield batch(docs, parts, ids, before)
                        docs, parts, ids, held, before = [], [], [], 0, before + held
            if ids:
                yield batch(docs, parts, ids, before)

    return rows.mapInArrow(encode, FILE)


def write(docs: DataFrame, path: str, end_id: int = END_ID, name: str = TOKENIZER, per_file: int = BYTES_PER_FILE) -> None:
    """Write the ids of all documents to ORC files in ascending order of ``doc_id``.

    Texts are dealt by ranges of (doc_id, hash of the text, row) and sorted inside each range,
    so neither repeated nor missing doc_ids meet in one task; then they are encoded in that
    order, straight into the files. Missing doc_ids come first; rows of one doc_id are ordered
    by their texts' hash. Rows equal in id and text are dealt by their place in the input,
    which a table that is read as it is stored keeps when a task runs again. A null text is
    empty: its ids are the end id alone. An empty table gives no rows. Only ``doc_id`` and
    ``text`` are read, so other columns may have any names.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row")
    ).withColumn("hash", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    parts = max(1, -(-total // per_file))
    dealt = rows.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER)
    out = encoded(dealt.select("doc_id", F.spark_partition_id().alias("part"), "text"), end_id, name)
    out.write.options(**ORC).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, part, inside, ids`` of the files; ``inside`` counts the ids before in the file.

    Spark cuts files at stripes, so stripes of one file are read in parallel.
    """
    return spark.read.schema(FILE).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """``doc_id, ids`` of some documents: stripes and row groups whose ranges or Bloom filters
    rule all of them out are not read."""
    return read(spark, path).where(F.col("doc_id").isin(*doc_ids)).select("doc_id", "ids")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files' own ids.

    ``start`` counts the ids before a document: those inside its file and the sums of all
    files before, of which there is one row a file.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=True).astype("<u4", copy=False)
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("doc_id"), batch.column("inside"), pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())],
                names=["part", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )

    rows = store(read(spark, path).select("part", "doc_id", "inside", "ids").mapInArrow(check, LISTED), "listing")
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "part").select("doc_id", (F.col("_base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, per_file: int = BYTES_PER_FILE) -> DataFrame:
    """Write all documents and list what the files hold."""
    spark = docs.sparkSession
    path = shared_dir(spark, "tokens")
    write(docs, path, per_file=per_file)
    return listing(spark, path)
