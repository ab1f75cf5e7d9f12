"""What the text operators share: tables, stages in the shared folder, packed arrays."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: what ``bytes.split()`` and this pattern know.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode without one, a folder below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir") + "/stages"


def remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None:  # the session has ended
        return
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Writes ``frame`` to the shared folder and reads it back; removed when the program ends.

    Cuts lineage: what follows doesn't depend on executors that computed it.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/regraft-{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    atexit.register(remove, spark, path)
    return spark.read.schema(frame.schema).parquet(path)


def release() -> None:
    """Gives memory that is free in this process back to the system, where its C library knows how."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_arrow(frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` whose tasks leave no memory behind: Python workers serve stage after stage, and would keep the most that any took."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            release()

    return frame.mapInArrow(run, schema)


def per_batch(
    frame: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                made = work(batch)
                yield from [made] if isinstance(made, pa.RecordBatch) else made

    return in_arrow(frame, run, schema)


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose ``column`` has about ``size`` bytes at most; a longer value stands alone."""
    lengths = np.array([0 if v is None else len(v) for v in batch.column(column).to_pylist()], np.int64)
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total + n > size and i > start:
            yield start, i
            start, total = i, 0
        total += n
    yield start, len(lengths)


def spread(frame: DataFrame, *keys, times: int = 1) -> DataFrame:
    """Dealt out by keys over the session's shuffle partitions, or ``times`` as many, without coalescing."""
    return frame.repartition(times * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def texts(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), whatever other columns there are."""
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of sorted batches, each as a table."""
    kept: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(k)[row].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for k in keys:
            values = np.asarray(batch.column(k))
            changed[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if start == 0 and kept and key(kept[-1], 0) != key(batch, 0):
                yield pa.Table.from_batches(kept)
                kept = []
            elif start > 0:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(start, end - start))
    if kept:
        yield pa.Table.from_batches(kept)


#: Stands for a null ``doc_id``; the lowest bit of a row's mark tells it from a row that has this id.
NO_ID = -(1 << 63)


def row_key() -> tuple[Column, Column]:
    """``doc_id`` and a mark of ``text``, never null: rows that repeat an id are told apart by their text's hash."""
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    mark = F.when(F.col("doc_id").isNull(), text.bitwiseAND(F.lit(-2).cast("long"))).otherwise(text.bitwiseOR(F.lit(1).cast("long")))
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long")), mark


def given_id(doc: str, mark: str) -> Column:
    """The ``doc_id`` that a row came with."""
    return F.expr(f"CASE WHEN {mark} & 1 = 1 THEN {doc} END")


#: Bits of a set of ids for filtering before a shuffle: 1 MB, whatever the input; full, it lets all rows pass.
ID_BITS = 1 << 23


def id_bits(frame: DataFrame, column: str) -> bytes:
    """Marks the ids of a column; others may share their bits, so an exact join has to follow."""
    place = F.expr(f"(({column} ^ shiftright({column}, 23)) & {ID_BITS - 1}L) + 1")
    parts = (
        frame.where(F.col(column).isNotNull()).select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()
    )
    marked = bytearray(ID_BITS // 8)
    for part, bits in parts:  # counted from 1, 4096 bytes each
        marked[(part - 1) * 4096 : part * 4096] = bytes(bits)
    return bytes(marked)


def id_places(values: np.ndarray) -> np.ndarray:
    return (values ^ (values >> 23)) & (ID_BITS - 1)


def marked_ids(bits: bytes, ids: pa.Array) -> np.ndarray:
    place = id_places(np.asarray(ids.cast(pa.int64()).fill_null(-1)))
    return (np.frombuffer(bits, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def bounded_sample(frame: DataFrame, key: str, size: int, *ties: str) -> DataFrame:
    """The ``size`` rows of smallest hash of ``key``; about twice as many come together to be ordered."""
    total = frame.count()
    if total > 2 * size:
        frame = frame.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * 2 * size / total))
    return frame.orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 30)), key, *ties).limit(size)


def without_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose ``doc_id`` isn't among ``ids``; only those that may be are shuffled."""
    found = stage(ids.select("doc_id").where("doc_id IS NOT NULL").distinct(), "ids")
    bits = documents.sparkSession.sparkContext.broadcast(id_bits(found, "doc_id"))

    def chosen(marked: bool):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(marked_ids(bits.value, batch.column("doc_id")) == marked))

        return in_arrow(documents, run, documents.schema)

    return chosen(False).union(chosen(True).hint("merge").join(found, "doc_id", "left_anti").select(*documents.columns))


def with_key(documents: DataFrame) -> DataFrame:
    doc, mark = row_key()
    return documents.select(*documents.columns, doc.alias("_key_id"), mark.alias("_key_mark"))


def without_rows(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents whose :func:`row_key` isn't among ``rows`` (``doc_id, mark``); only those that may be are shuffled."""
    found = stage(rows.select(F.col("doc_id").alias("_key_id"), F.col("mark").alias("_key_mark")).distinct(), "rows")
    bits = documents.sparkSession.sparkContext.broadcast(id_bits(found, "_key_id"))
    given = with_key(documents)

    def chosen(marked: bool):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(marked_ids(bits.value, batch.column("_key_id")) == marked))

        return in_arrow(given, run, given.schema)

    rest = chosen(True).hint("merge").join(found, ["_key_id", "_key_mark"], "left_anti")
    return chosen(False).select(*documents.columns).union(rest.select(*documents.columns))


def bucket_bits(frame: DataFrame) -> int:
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4, min(16, (partitions - 1).bit_length()))


def split_seed(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and the next 32 bits."""
    return (values >> np.uint64(64 - bits)).astype(np.uint16), (values >> np.uint64(32 - bits)).astype(np.uint32)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in parts of few rows, where Python objects are made of them."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def rows_of(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """Rows of a batch, made into Python objects a few at a time."""
    for part in pieces(iter([batch])):
        yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)
