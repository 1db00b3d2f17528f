"""Centroid clustering in whole numbers by subvector dictionaries.

Vectors are scaled and rounded down to integers, so every sum and distance is exact. A chunk of
vectors is stored once as dictionaries: its dimensions are cut into blocks, each block lists its
distinct subvectors, and a vector is one code for each block. A round computes the squared distances
of every listed subvector to the centroids once and adds them up by code; the sums that move the
centroids are counts of codes times subvectors. No vector is rebuilt and none is shuffled: what a
chunk sends on is one sum for each centroid and dimension, which Spark adds up.

Dictionaries belong to a chunk, so that their size is bounded by its rows whatever the values are.
One for the whole table would have to be joined to all vectors in each round, and distances to a few
centroids cost less than moving them. Neighbouring blocks become one while that leaves fewer than one
subvector for ``SHARED`` rows: repeated vectors end as a single code, and unlike ones as codes of
single dimensions at worst.

Defined cases: vectors that are NULL, of another length or hold a NULL or non-finite component are
left out; components beyond 2**27 in magnitude after scaling count as 2**27, so that each squared
distance fits a long (with up to 128 dimensions); fewer rows than centroids give as many centroids as rows; a NULL
id is the empty text where seeds are chosen; rows that share an id are ordered by their vector there;
repeated rows each count; a sum that does not fit a long is NULL; an empty table gives an empty
result; only the id and the vector column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import stored

DIMENSIONS, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Vectors of a chunk, at least, and rows that a listed subvector must stand for on average to be worth a merge.
CHUNK_ROWS, SHARED = 16_384, 8
LIMIT = 1 << 27


def whole(vector: F.Column, scale: int, limit: int) -> F.Column:
    """Components times ``scale``, rounded down to longs within the limit."""
    edge = F.lit(float(limit))
    return F.transform(vector, lambda c: F.floor(F.greatest(-edge, F.least(
        edge, c.cast("double") * float(scale)))).cast("long"))


def finite(vector: F.Column) -> F.Column:
    """True for a vector without NULL and non-finite components."""
    return F.coalesce(F.forall(vector, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))


def dictionaries(vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(entries, codes) of each block of dimensions from left to right: ``entries[codes]`` are its values."""
    most = max(1, len(vectors) // SHARED)
    blocks = []
    for column in vectors.T:
        entries, codes = np.unique(column, return_inverse=True)
        blocks.append((entries[:, None], codes.astype(np.int64)))
    merged = True
    while merged and len(blocks) > 1:
        merged, wider = False, []
        for at in range(0, len(blocks) - 1, 2):
            (one, first), (two, second) = blocks[at:at + 2]
            pairs, codes = np.unique(first * len(two) + second, return_inverse=True)
            if len(pairs) <= most:
                merged = True
                wider.append((np.hstack([one[pairs // len(two)], two[pairs % len(two)]]), codes))
            else:
                wider += blocks[at:at + 2]
        blocks = wider + (blocks[-1:] if len(blocks) % 2 else [])
    yield from blocks


def _encoded(vectors: DataFrame, dimensions: int) -> DataFrame:
    """Chunks of rows (id, x): ids, and width, entries and codes of each block."""

    def row(ids: list[pa.Array], parts: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        own, blocks = pa.concat_arrays(ids), list(dictionaries(np.concatenate(parts)))

        def one(values: list, of: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(
                pa.array([0, len(values)], pa.int32()), pa.array(values, of),
                type=pa.list_(pa.field("element", of)))

        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own, type=kind),
             one([entries.shape[1] for entries, _ in blocks], pa.int32()),
             one([entries.astype("<i4").tobytes() for entries, _ in blocks], pa.binary()),
             one([codes.astype("<u4" if len(entries) > 65_536 else "<u2").tobytes()
                  for entries, codes in blocks], pa.binary())],
            names=["ids", "widths", "entries", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, rows, kind = [], [], 0, None
        for batch in batches:
            kind = pa.list_(pa.field("element", batch.column("id").type))
            ids.append(batch.column("id"))
            parts.append(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(
                -1, dimensions))
            rows += batch.num_rows
            if rows >= CHUNK_ROWS:
                yield row(ids, parts, kind)
                ids, parts, rows = [], [], 0
        if rows:
            yield row(ids, parts, kind)

    blobs = T.ArrayType(T.BinaryType())
    schema = T.StructType().add("ids", T.ArrayType(vectors.schema["id"].dataType)).add(
        "widths", T.ArrayType(T.IntegerType())).add("entries", blobs).add("codes", blobs)
    return vectors.mapInArrow(run, schema)


class Chunk:
    """The blocks of a chunk's row."""

    def __init__(self, widths: list[int], entries: list[bytes], codes: list[bytes], rows: int):
        self.blocks, first = [], 0
        for width, own, places in zip(widths, entries, codes):
            listed = np.frombuffer(own, "<i4").reshape(-1, width).astype(np.int64)
            at = np.frombuffer(places, "<u2" if len(places) == 2 * rows else "<u4")
            self.blocks.append((slice(first, first + width), listed, at))
            first += width

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to each vector's nearest centroid; the first of ties."""
        total = 0
        for where, listed, at in self.blocks:
            apart = np.zeros((len(listed), len(centroids)), np.int64)
            for column, places in zip(listed.T, centroids[:, where].T):
                apart += (column[:, None] - places) ** 2
            total = total + apart[at]
        cluster = np.argmin(total, axis=1)
        return cluster, total[np.arange(len(cluster)), cluster]

    def sums(self, cluster: np.ndarray, clusters: int) -> np.ndarray:
        """Sum of the vectors of each cluster."""
        parts = []
        for _, listed, at in self.blocks:
            times = np.bincount(cluster * len(listed) + at, minlength=clusters * len(listed))
            parts.append(times.reshape(clusters, -1) @ listed)
        return np.hstack(parts)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Chunk]]:
    for place in range(batch.num_rows):
        ids = batch.column("ids").slice(place, 1).flatten()
        yield ids, Chunk(*(batch.column(name)[place].as_py()
                           for name in ("widths", "entries", "codes")), len(ids))


def _moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; sums of any size stay exact."""
    clusters, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, chunk in _chunks(batch):
                cluster, _ = chunk.nearest(centroids)
                size = np.bincount(cluster, minlength=clusters)
                sums = np.hstack([size[:, None], chunk.sums(cluster, clusters)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(sums.size), pa.int32()), pa.array(sums.reshape(-1))],
                    names=["cell", "value"])

    cells = chunks.mapInArrow(run, "cell int, value long").groupBy("cell").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    total = [0] * (clusters * (dimensions + 1))
    for row in cells.collect():  # one row for each centroid and dimension
        total[row["cell"]] = int(row["value"])
    moved = centroids.copy()
    for k in range(clusters):
        size, *sums = total[k * (dimensions + 1):(k + 1) * (dimensions + 1)]
        if size:
            moved[k] = [value // size for value in sums]
    return moved


def clustered(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    dimensions: int = DIMENSIONS, scale: int = SCALE, clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per vector: id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid``."""
    vector = F.col(vector_col)
    rows = vectors.where((F.size(vector) == dimensions) & finite(vector)).select(
        F.col(id_col).alias("id"), whole(vector, scale, LIMIT).alias("x"))
    name = F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    seeds = rows.select(F.sha2(name.cast("binary"), 256).alias("hash"), "x").orderBy(
        "hash", "x").limit(clusters).collect()
    centroids = np.array([row["x"] for row in seeds], np.int64).reshape(-1, dimensions)
    chunks = stored(_encoded(rows, dimensions))
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(chunks, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, chunk in _chunks(batch):
                cluster, distance = chunk.nearest(centroids)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    names=["id", "cluster", "distance"])

    assigned = stored(chunks.mapInArrow(
        assign, rows.select("id").schema.add("cluster", "integer").add("distance", "long")))
    inertia = {row["cluster"]: int(row["total"]) for row in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def fitting(value: int) -> int | None:
        return value if value < 1 << 63 else None

    # One row for each centroid, of which there are ``clusters``.
    final = vectors.sparkSession.createDataFrame(
        [(k, fitting(inertia.get(k, 0)), fitting(sum(inertia.values())), [int(c) for c in centroid])
         for k, centroid in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(final), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")

