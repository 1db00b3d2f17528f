"""Centroid clustering against plain whole numbers, and on odd vectors."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratalake.llm import centroids
from stratalake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def plainly(rows: list, dimensions: int, scale: int = 64, clusters: int = 16, rounds: int = 3):
    """Rows (id, cluster, distance) and the centroids, with Python's integers."""
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dimensions
            and all(c is not None and math.isfinite(c) for c in v)]
    seeds = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), x)
                   for i, x in kept)
    places = [x for _, x in seeds[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(places))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for k, own in groups.items():
            places[k] = [sum(column) // len(own) for column in zip(*own)]
    return [(i, nearest(x)[1], nearest(x)[0]) for i, x in kept], places


def test_whole_table(spark):
    table = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pydict()
    want, places = plainly(list(zip(table["vec_id"], table["embedding"])), 64)
    rows = QUERIES["op13_centroid_clustering"](spark, SF_DIR).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in rows) == sorted(want)
    inertia = [sum(d for _, k, d in want if k == cluster) for cluster in range(len(places))]
    for r in rows:
        name = ",".join(map(str, places[r.cluster]))
        assert (r.cluster_inertia, r.inertia, r.centroid_sha256) == (
            inertia[r.cluster], sum(inertia), hashlib.sha256(name.encode()).hexdigest())


@pytest.mark.parametrize("spread", [1, 3, 1000])
@pytest.mark.parametrize("rows", [1, 7, 500])
def test_dictionaries_hold_all_values(spread, rows):
    random = np.random.default_rng(rows + spread)
    vectors = random.integers(-spread, spread, (rows, 13))
    vectors[::2] = vectors[0]
    blocks = list(centroids.dictionaries(vectors))
    assert (np.hstack([entries[codes] for entries, codes in blocks]) == vectors).all()
    assert all(len(np.unique(entries, axis=0)) == len(entries) for entries, _ in blocks)
    # Equal vectors end as one code, unlike ones are cut into many blocks.
    assert (len(blocks) == 1) == (rows > 8 and len(np.unique(vectors, axis=0)) <= rows // 8
                                  or rows == 1)


def test_odd_vectors(spark):
    random = np.random.default_rng(3)
    good = [(k, random.normal(size=4).astype(np.float32).tolist()) for k in range(200)]
    ties = [(500 + k, [1.0, 1.0, 1.0, 1.0]) for k in range(40)]
    odd = [(900, None), (901, [1.0]), (902, []), (903, [1.0, None, 1.0, 1.0]),
           (904, [math.nan, 1.0, 1.0, 1.0]), (905, [1.0, -math.inf, 1.0, 1.0])]
    rows = good + good[:20] + ties + odd + [(None, [0.5, 0.5, 0.5, 0.5])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {name: F.lit("clash") for name in ("id", "x", "cluster", "distance", "codes", "hash")})
    want, places = plainly(rows, 4)
    found = centroids.clustered(frame, dimensions=4).collect()
    assert sorted(map(str, ((r.vec_id, r.cluster, r.distance) for r in found))) == sorted(map(str, want))
    assert all(r.centroid == places[r.cluster] for r in found)


def test_chunks_change_nothing(spark, monkeypatch):
    frame = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").repartition(3)
    rows = [centroids.clustered(frame).collect()]
    monkeypatch.setattr(centroids, "CHUNK_ROWS", 1)
    rows.append(centroids.clustered(frame.repartition(20)).collect())
    assert sorted(rows[0]) == sorted(rows[1])


def test_few_or_no_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [9.0, 9.0])], SCHEMA)
    found = centroids.clustered(frame, dimensions=2).collect()
    assert [r.distance for r in found] == [0, 0, 0] and {r.inertia for r in found} == {0}
    assert len({r.cluster for r in found}) == 2
    empty = centroids.clustered(frame.limit(0), dimensions=2)
    assert empty.count() == 0 and empty.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_huge_components_take_the_limit(spark):
    frame = spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])], SCHEMA)
    found = centroids.clustered(frame, dimensions=2, clusters=1, rounds=0).collect()
    assert max(r.distance for r in found) in (centroids.LIMIT ** 2, 4 * centroids.LIMIT ** 2)
