"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, one representative.

Centres are fitted on a bounded sample; every vector then lives in the cell of its nearest centre.
Cells meet in hyperplanes through the origin. If two linked vectors live in different cells, they
lie on either side of the plane between these, and one of them lies no further from it than the sine
of half the linking angle. So each vector is also a guest of all cells whose plane is that near, and
residents of a cell are compared with each other and with its guests. A pair that meets twice counts
in the lower cell. No link is missed or counted twice, however good the cells are; poor cells only
cost time.

Equal vectors are one before they are placed. Residents and guests of a cell are split into blocks,
and each pair of blocks with a resident in it is a task's work. A comparison returns counts and
spanning links, not pairs.

Defined cases: vectors that are NULL, empty, zero or hold a NULL or non-finite number link with
nothing, nor do vectors of different lengths; a row with a NULL id stays alone; repeated rows link
with each other; an empty table gives an empty result; only the id and the vector column are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import sampled, stored
from stratalake.llm.components import components
from stratalake.llm.simhash import spanning

LEAST_COSINE = 0.95
#: Vectors to fit the centres on, at most; vectors a cell is meant to have, and centres at most.
SAMPLE_ROWS, CELL_ROWS, MAX_CELLS = 20_000, 500, 1_024
#: Vectors that are compared with each other in one piece.
BLOCK = 2_048


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision, scaled to length one."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the first rows, which come in an order without meaning."""
    centres = sample[:cells].copy()
    for _ in range(rounds):
        home = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return np.unique(centres, axis=0)


def reached(vectors: np.ndarray, centres: np.ndarray, margin: float) -> np.ndarray:
    """Which cells' planes lie within ``margin`` of each vector; its own cell is one of them."""
    products = vectors @ centres.T
    home = np.argmax(products, axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    behind = products[np.arange(len(vectors)), home][:, None] - products
    return behind <= margin * apart[home] + 1e-9


def _place(
    batch: pa.RecordBatch, centres: dict[int, np.ndarray], margin: float, kind: str
) -> Iterator[pa.RecordBatch]:
    lists = batch.column("vector")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        raw = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(kind)
        raw = raw.reshape(-1, size)
        own = centres.get(size)
        if own is None:
            held = np.ones((len(rows), 1), bool)
            home = np.zeros(len(rows), np.int64)
        else:
            vectors = unit(raw)
            held, home = reached(vectors, own, margin), np.argmax(vectors @ own.T, axis=1)
        held[np.arange(len(rows)), home] = True
        at, cell = np.nonzero(held)
        blobs = [vector.tobytes() for vector in raw]
        lists_of = [np.flatnonzero(one).astype("<i4").tobytes() for one in held]
        guest = cell != home[at]
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * len(at), pa.int32()), pa.array(cell, pa.int32()),
             pa.array(guest), pa.array(home[at], pa.int32()),
             pa.array([None if g else lists_of[i] for i, g in zip(at.tolist(), guest.tolist())],
                      pa.binary()),
             batch.column("key").take(pa.array(rows[at])),
             batch.column("times").take(pa.array(rows[at])),
             pa.array([blobs[i] for i in at.tolist()], pa.binary())],
            names=["size", "cell", "guest", "home", "cells", "key", "times", "vector"])


_FOUND = "a long, b long, n long"


def _compare(key: tuple, rows: pa.Table, least: float, kind: str) -> pa.Table:
    """Rows (a, NULL, links of a found here) and (a, b, 0) for spanning links."""
    size, cell = key[0].as_py(), key[1].as_py()
    vectors = unit(np.frombuffer(b"".join(rows.column("vector").to_pylist()), kind).reshape(
        -1, size))
    keys, times = rows.column("key").to_numpy(), rows.column("times").to_numpy()
    side, home = rows.column("side").to_numpy(), rows.column("home").to_numpy()
    cells = [None if x is None else frozenset(np.frombuffer(x, "<i4").tolist())
             for x in rows.column("cells").to_pylist()]
    same = bool((side == 0).all())
    left = np.arange(len(keys)) if same else np.flatnonzero(side == 1)
    right = np.arange(len(keys)) if same else np.flatnonzero(side == 2)
    count, a, b = np.zeros(len(keys), np.int64), [keys[:0]], [keys[:0]]
    for at in range(0, len(left), 256):
        some = left[at:at + 256]
        x, y = np.nonzero(vectors[some] @ vectors[right].T >= least)
        x, y = some[x], right[y]
        new = x < y if same else np.ones(len(x), bool)
        x, y = x[new], y[new]
        # A resident may be a guest in the other's home, too; the lower cell then has the pair.
        twice = (home[y] < cell).nonzero()[0]
        if len(twice):
            here = np.ones(len(x), bool)
            here[[k for k in twice.tolist() if int(home[y[k]]) in cells[x[k]]]] = False
            x, y = x[here], y[here]
        count += np.bincount(x, times[y], len(keys)).astype(np.int64)
        count += np.bincount(y, times[x], len(keys)).astype(np.int64)
        p, q = spanning(keys[x], keys[y])
        a.append(p)
        b.append(q)
    a, b = spanning(np.concatenate(a), np.concatenate(b))
    held = np.flatnonzero(count)
    return pa.table({
        "a": pa.array(np.concatenate([keys[held], a]), pa.int64()),
        "b": pa.concat_arrays([pa.nulls(len(held), pa.int64()), pa.array(b, pa.int64())]),
        "n": pa.array(np.concatenate([count[held], np.zeros(len(a), np.int64)]), pa.int64())})


def _centres(distinct: DataFrame, sample_rows: int, cell_rows: int, max_cells: int):
    """Centres by vector length, from a sample of at most ``sample_rows`` rows."""
    total = distinct.count()
    sample = sampled(distinct.select("h1", "h2", "vector"), sample_rows, "h1", "h2").collect()
    by_size: dict[int, list] = {}
    for row in sorted(sample, key=lambda row: (row["h1"], row["h2"])):
        by_size.setdefault(len(row["vector"]), []).append(row["vector"])
    cells = min(max_cells, max(1, total // cell_rows))
    return {size: fit_centres(unit(np.array(rows)), min(cells, -(-len(rows) // 16)))
            for size, rows in by_size.items()}


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    least: float = LEAST_COSINE, sample_rows: int = SAMPLE_ROWS, cell_rows: int = CELL_ROWS,
    max_cells: int = MAX_CELLS, block: int = BLOCK,
) -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly), ``component_id`` and ``kept``."""
    if not 0 < least <= 1:
        raise ValueError("the least cosine lies in (0, 1]")
    single = vectors.schema[vector_col].dataType.elementType.typeName() == "float"
    element, kind = ("float", "<f4") if single else ("double", "<f8")
    vector = F.col(vector_col).cast(f"array<{element}>")
    usable = F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0) & F.col(id_col).isNotNull(), F.lit(False))
    rows = vectors.select(
        F.col(id_col).alias("id"), usable.alias("usable"), vector.alias("vector"),
        F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(7), vector).alias("h2"))
    distinct = stored(rows.where("usable").groupBy("h1", "h2").agg(
        F.min("id").alias("key"), F.count("*").alias("times"), F.first("vector").alias("vector")))
    centres = _centres(distinct, sample_rows, cell_rows, max_cells)
    margin = math.sin(math.acos(least) / 2)
    placed = stored(distinct.select("key", "times", "vector").mapInArrow(
        lambda batches: (x for batch in batches if batch.num_rows
                         for x in _place(batch, centres, margin, kind)),
        "size int, cell int, guest boolean, home int, cells binary, key long, times long, "
        "vector binary"))
    sizes = placed.groupBy("size", "cell").agg(
        F.ceil(F.count_if(~F.col("guest")) / block).cast("int").alias("residents"),
        F.ceil(F.count_if("guest") / block).cast("int").alias("guests"))
    part = F.xxhash64("key")
    own = F.when(F.col("guest"), F.col("residents") + F.pmod(part, F.col("guests"))).otherwise(
        F.pmod(part, F.col("residents"))).cast("int")
    # Blocks of residents come first; blocks of guests meet only those.
    last = F.when(F.col("guest"), F.col("residents")).otherwise(
        F.col("residents") + F.col("guests")) - 1
    met = placed.join(sizes, ["size", "cell"]).where("residents > 0").withColumn(
        "own", own).withColumn("with", F.explode(F.sequence(F.lit(0), last)))
    side = F.when(F.col("own") == F.col("with"), 0).when(F.col("own") < F.col("with"), 1)
    found = stored(met.select(
        "size", "cell", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
        "home", "cells", "key", "times", "vector",
        side.otherwise(2).cast("byte").alias("side")).groupBy("size", "cell", "i", "j").applyInArrow(
            lambda key, rows: _compare(key, rows, least, kind), _FOUND))
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    member = components(found.where("b is not null").select("a", "b"))
    named = distinct.select("h1", "h2", "key", "times").join(
        links, F.col("key") == F.col("a"), "left").join(
            member, F.col("key") == F.col("node"), "left").select(
                "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                F.coalesce("component", "key").alias("component_id"))
    judged = rows.select("id", "usable", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return judged.select(
        F.col("id").alias(id_col),
        F.when(F.col("usable"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
