"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, rerank with the vectors.

A rotation of the principal directions is learnt on at most ``FIT_VECTORS``
vectors so that the signs are balanced bits; every vector gets a code. Codes are
cut into substrings of 16 bits, one table for each. In a table a vector is at
home in the bucket of its substring and visits the smaller buckets one bit away,
so that each pair whose substrings differ in one bit at most meets once in the
table, and is taken up in the first table where it meets. With 4 tables every
pair of up to 7 differing bits meets. Exact copies are one entry. Vectors are
only moved if some code within ``RADIUS`` bits met theirs. Buckets beyond
``BLOCK`` entries are split into blocks and compared block against block.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and stay; vectors of different length never link;
repeated rows of one ``vec_id`` count once, as the smallest of them; a vector
without a ``vec_id`` links with nothing and stays, a row of its own with a null
component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, runs_of, spread, stage
from .components import connected_components, smallest_labels

FIT_VECTORS = 20_000
SUBSTRING = 16
RADIUS = 16
BLOCK = 512


def learn_rotation(sample: np.ndarray, bits: int, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimension, bits) whose signs are the code."""
    mean = sample.mean(0)
    centred = sample - mean
    _, directions = np.linalg.eigh(centred.T @ centred)
    principal = directions[:, ::-1][:, :bits]
    reduced = centred @ principal
    rotation = np.linalg.qr(np.random.default_rng(3).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        signs = np.where(reduced @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ reduced)
        rotation = (left @ right).T
    return mean, principal @ rotation


def bits_of(dimension: int) -> int:
    return min(64, dimension // SUBSTRING * SUBSTRING or dimension)


def codes_of(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bits = (vectors - mean) @ projection >= 0
    weights = np.uint64(1) << np.arange(bits.shape[1], dtype=np.uint64)
    return (bits * weights).sum(1, dtype=np.uint64).view(np.int64)


def usable(vector: list | None) -> np.ndarray | None:
    """As doubles, scaled to greatest component 1 so that no square over- or underflows."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, np.float64)
    top = np.abs(v).max()
    return v / top if np.isfinite(top) and top > 0 else None


def fit_codes(vectors: DataFrame, sample_size: int = FIT_VECTORS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A model for each vector length."""
    models = {}
    for dimension in sorted(r.n for r in vectors.select(F.size("embedding").alias("n")).where("n > 0").distinct().collect()):
        rows = bounded_sample(vectors.where(F.size("embedding") == dimension), "vec_id", sample_size).select("embedding").collect()
        sample = [v / np.linalg.norm(v) for r in rows if (v := usable(r.embedding)) is not None]
        if sample:
            models[dimension] = learn_rotation(np.array(sample), bits_of(dimension))
    return models


def _meetings(entries: DataFrame) -> DataFrame:
    """Entries ``id, dim, code, ...`` dealt to blocks of buckets: ``tab, bucket, low, high, home, block, ...``."""
    own = F.expr(f"shiftrightunsigned(code, tab * {SUBSTRING}) & {(1 << SUBSTRING) - 1}")
    with_tables = entries.withColumn(
        "tab", F.explode(F.sequence(F.lit(0), F.greatest(F.least(F.lit(64), F.col("dim")) / SUBSTRING, F.lit(1)).cast("int") - 1))
    ).withColumn("own", own.cast("int"))
    flips = F.transform(F.sequence(F.lit(0), F.lit(SUBSTRING - 1)), lambda b: F.col("own").bitwiseXOR(F.call_function("shiftleft", F.lit(1), b)))
    buckets = F.concat(F.array("own"), F.filter(flips, lambda x: x < F.col("own")))
    placed = with_tables.withColumn("bucket", F.explode(buckets)).withColumn("home", F.col("bucket") == F.col("own")).drop("own")
    where = ["dim", "tab", "bucket"]
    sizes = (
        placed.groupBy(*where).agg(F.count("*").alias("entries"), F.count_if("home").alias("homes"))
        .where("homes > 0 AND entries > 1")
        .select(*where, F.ceil(F.col("entries") / BLOCK).cast("int").alias("blocks"))
    )
    placed = placed.join(sizes, where).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("low"), F.greatest("block", o).alias("high")))
    return placed.withColumn("pair", F.explode(others)).select("*", "pair.low", "pair.high").drop("pair", "blocks")


_KEYS = ["dim", "tab", "bucket", "low", "high"]


def _met(group: pa.Table, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a group whose pair is taken up here, within ``radius`` bits."""
    codes = np.asarray(group.column("code")).view(np.uint64)
    home, block = np.asarray(group.column("home")), np.asarray(group.column("block"))
    tab, low, high = (group.column(k)[0].as_py() for k in ("tab", "low", "high"))
    left = np.flatnonzero(home | (block == low)) if low == high else np.flatnonzero(block == low)
    right = left if low == high else np.flatnonzero(block == high)
    differ = codes[left][:, None] ^ codes[right][None, :]
    taken = (home[left][:, None] | home[right][None, :]) & (np.bitwise_count(differ) <= radius)
    for t in range(tab):
        part = (differ >> np.uint64(t * SUBSTRING)) & np.uint64((1 << SUBSTRING) - 1)
        taken &= np.bitwise_count(part) > 1
    if low == high:
        taken = np.triu(taken, 1)
    i, j = np.nonzero(taken)
    return left[i], right[j]


def _with_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[np.ndarray] = []
    held = 0
    for group in runs_of(batches, _KEYS):
        if group.num_rows < 2:
            continue
        i, j = _met(group, RADIUS)
        if len(i):
            ids = np.asarray(group.column("id"))
            found.append(np.unique(np.concatenate([ids[i], ids[j]])))
            held += len(found[-1])
        if held > 100_000:
            found, held = [np.unique(np.concatenate(found))], 0
            yield pa.RecordBatch.from_arrays([pa.array(found.pop())], ["id"])
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["id"])


def _linked(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """``a, b, n``: with ``b`` an edge of a forest that connects the linked; without, ``n`` links of ``a``."""
    for group in runs_of(batches, _KEYS):
        if group.num_rows < 2:
            continue
        i, j = _met(group, RADIUS)
        if not len(i):
            continue
        ids, copies = np.asarray(group.column("id")), np.asarray(group.column("copies"))
        vectors = np.array([np.frombuffer(v, np.float64) for v in group.column("vector").to_pylist()])
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        kept = np.zeros(len(i), bool)
        for k in range(0, len(i), 50_000):
            kept[k : k + 50_000] = np.einsum("ij,ij->i", vectors[i[k : k + 50_000]], vectors[j[k : k + 50_000]]) >= least
        i, j = i[kept], j[kept]
        if not len(i):
            continue
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        label = smallest_labels(len(ids), i, j)
        tied, some = np.flatnonzero(label != np.arange(len(ids))), np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[tied], ids[some]])),
                pa.array([*ids[label[tied]].tolist(), *[None] * len(some)], pa.int64()),
                pa.array(np.concatenate([np.zeros(len(tied)), links[some]]).astype(np.int64)),
            ],
            ["a", "b", "n"],
        )


def near_duplicates(vectors: DataFrame, least: float = 0.95, sample_size: int = FIT_VECTORS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector."""
    single = stage(vectors.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    sent = single.sparkSession.sparkContext.broadcast(fit_codes(single, sample_size))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = list(zip(batch.column("vec_id").to_pylist(), map(usable, batch.column("embedding").to_pylist())))
            for dimension, (mean, projection) in sent.value.items():
                own = [(i, v) for i, v in read if v is not None and len(v) == dimension]
                if own:
                    full = np.array([v for _, v in own])
                    codes = codes_of(full / np.linalg.norm(full, axis=1, keepdims=True), mean, projection)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i for i, _ in own], pa.int64()), pa.array([dimension] * len(own), pa.int32()), pa.array(codes),
                            pa.array([hashlib.blake2b(v.tobytes(), digest_size=16).digest() for _, v in own], pa.binary()),
                        ],
                        ["vec_id", "dim", "code", "digest"],
                    )

    coded = stage(single.mapInArrow(encode, "vec_id long, dim int, code long, digest binary"), "codes")
    distinct = stage(
        coded.groupBy("dim", "digest", "code").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "distinct"
    )
    narrow = _meetings(distinct.select("id", "dim", "code"))
    flagged = spread(narrow, *_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(_with_candidates, "id long").distinct()
    wanted = stage(distinct.join(flagged, "id", "left_semi"), "candidates")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [usable(v).tobytes() for v in batch.column("embedding").to_pylist()]
            rest = [batch.column(c) for c in ("id", "dim", "code", "copies")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(packed, pa.binary())], ["id", "dim", "code", "copies", "vector"])

    full = single.withColumnRenamed("vec_id", "id").join(wanted, "id").select("id", "dim", "code", "copies", "embedding")
    entries = stage(full.mapInArrow(pack, "id long, dim int, code long, copies long, vector binary"), "entries")
    met = spread(_meetings(entries), *_KEYS).sortWithinPartitions(*_KEYS)
    links = stage(met.mapInArrow(lambda batches: _linked(batches, least), "a long, b long, n long"), "links")
    component = connected_components(links.where("b IS NOT NULL"))
    degree = links.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    class_of = (
        distinct.join(degree, "id", "left").join(component, F.col("id") == F.col("node"), "left")
        .select("dim", "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    known = coded.join(class_of, ["dim", "digest"]).select("vec_id", "n_links", "component_id")
    result = single.select("vec_id").join(known, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    unnamed = vectors.where("vec_id IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return result.union(unnamed).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
