"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products, one vector a group."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import save
from millrace.llm.components import components
from millrace.llm.forest import spanning


@dataclass(frozen=True)
class Cells:
    """``per_cell``: different vectors a cell is meant for, up to ``most`` cells. ``sample``: numbers
    the cells are fitted on, at most. ``deviations``: how far beyond the border of a cell a vector
    may lie and still be compared in it. A pair at the threshold lies ``sqrt(2 - 2 * threshold)``
    apart; across a border only the direction between the two centroids counts. One deviation is
    that distance times the root of the share of the sample's variance that lies in this direction,
    at least that of one of ``dim`` equal ones. Half the distance misses nothing, as one vector of
    a pair is that near to the border, and is the most that is used; two deviations miss few (see
    the tests). ``block``: vectors that are compared at a time."""

    per_cell: int = 256
    most: int = 1024
    sample: int = 2_000_000
    deviations: float = 2.0
    rounds: int = 8
    block: int = 1024
    seed: int = 11


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, whatever their scale."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids of length one; an empty cell takes a random row."""
    dice = np.random.default_rng(seed)
    centres = rows[dice.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(rows[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(rows), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        size = np.sqrt((sums * sums).sum(axis=1))
        empty = size < 1e-12
        sums[empty], size[empty] = rows[dice.choice(len(rows), int(empty.sum()))], 1
        centres = sums / size[:, None]
    return centres


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def reaches(sample: np.ndarray, centres: np.ndarray, threshold: float, deviations: float) -> np.ndarray:
    """For each two cells how far a vector may lie behind their border, times the distance of their centroids."""
    centred = sample - sample.mean(axis=0)
    variance = max(float((centred * centred).sum()), 1e-300)
    along = np.concatenate([centred[i : i + 4096] @ centres.T for i in range(0, len(centred), 4096)])
    both = along.T @ along
    spread = np.diag(both)[:, None] + np.diag(both)[None, :] - 2 * both
    apart = np.maximum(2 - 2 * centres @ centres.T, 0)  # squared
    share = np.maximum(np.maximum(spread, 0) / variance, apart / sample.shape[1])
    return np.sqrt(2 - 2 * threshold) * np.minimum(deviations * np.sqrt(share), np.sqrt(apart) / 2)


def visits(rows: np.ndarray, centres: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Each row's own cell, and all cells whose border it is within reach of, its own among them."""
    near = rows @ centres.T
    own = near.argmax(axis=1)
    behind = near[np.arange(len(rows)), own][:, None] - near
    # The last term keeps cells of equal centroids, and the row's own cell, whatever the rounding.
    within = behind <= reach[own] + 1e-12
    return own, [np.nonzero(w)[0].tolist() for w in within]


def _assign(centres: np.ndarray | None, reach: np.ndarray | None):
    """Rows for every cell a vector is compared in; vectors of another dimension share cell -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                rows = batch.slice(start, 2048)
                sizes = pc.list_value_length(rows.column("vector")).to_numpy(zero_copy_only=False)
                own, lists = np.full(len(sizes), -1), [[-1]] * len(sizes)
                fitting = np.nonzero(sizes == centres.shape[1])[0] if centres is not None else []
                if len(fitting):
                    homes, found = visits(unit(_matrix(rows.column("vector").take(pa.array(fitting)))), centres, reach)
                    own[fitting] = homes
                    for i, cells in zip(fitting, found):
                        lists[i] = cells
                again = np.repeat(np.arange(len(sizes)), [len(c) for c in lists])
                taken = rows.take(pa.array(again))
                columns = {
                    "cell": pa.array([c for cells in lists for c in cells], pa.int32()),
                    "size": pa.array(sizes[again], pa.int32()),
                    "home": pa.array(own[again], pa.int32()),
                    "cells": pa.array([lists[i] for i in again], pa.list_(pa.int32())),
                }
                names = ["label", "node", "copies", "vector"]
                yield pa.RecordBatch.from_arrays([*columns.values(), *(taken.column(n) for n in names)], names=[*columns, *names])

    return run


def _compare(threshold: float, step: int = 256):
    """Links of a pair of blocks: for each vector how many, copies counted, and a tree over what is linked.

    A pair that meets in two cells counts in one: in the lower-numbered of its own cells, or in the
    other if it does not meet there.
    """

    def run(table: pa.Table) -> pa.Table:
        left, right = (table.filter(pc.equal(table["side"], s)) for s in (0, 1))
        alone = not right.num_rows and table["i"][0].as_py() == table["j"][0].as_py()
        right = left if alone else right
        cell = table["cell"][0].as_py()
        a, b = unit(_matrix(left["vector"])) if left.num_rows else None, None
        b = a if alone else unit(_matrix(right["vector"])) if right.num_rows else None
        ids_a, ids_b = left["node"].to_numpy(), right["node"].to_numpy()
        links_a, links_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        edges: list[np.ndarray] = []
        if a is not None and b is not None:
            home_a, home_b = left["home"].to_numpy(), right["home"].to_numpy()
            copies_a, copies_b = left["copies"].to_numpy(), right["copies"].to_numpy()
            cells_a, cells_b = left["cells"].to_pylist(), right["cells"].to_pylist()
            for start in range(0, len(a), step):
                part = a[start : start + step]
                x, y = np.nonzero(part @ b.T >= threshold)
                x = x + start
                if alone:
                    x, y = x[x < y], y[x < y]
                at_home = (home_a[x] == cell) | (home_b[y] == cell)
                x, y = x[at_home], y[at_home]
                edges.append(np.stack([ids_a[x], ids_b[y]]))
                counts = np.ones(len(x), bool)
                for n in np.nonzero(home_a[x] != home_b[y])[0]:
                    i, j = x[n], y[n]
                    other, cells = (home_b[j], cells_a[i]) if home_a[i] == cell else (home_a[i], cells_b[j])
                    counts[n] = cell < other or other not in cells
                x, y = x[counts], y[counts]
                np.add.at(links_a, x, copies_b[y])
                np.add.at(links_b, y, copies_a[x])
        found = np.concatenate(edges, axis=1) if edges else np.empty((2, 0), np.int64)
        tree = spanning(found)
        ids = np.concatenate([ids_a, ids_b])
        links = np.concatenate([links_a, links_b])
        counted = links > 0
        none = pa.nulls(int(counted.sum()), pa.int64())
        return pa.table({
            "node": pa.concat_arrays([pa.array(ids[counted]), pa.array(tree[0])]),
            "other": pa.concat_arrays([none, pa.array(tree[1])]),
            "links": pa.concat_arrays([pa.array(links[counted]), pa.nulls(tree.shape[1], pa.int64())]),
        })

    return run


def near_vectors(
    vectors: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label", spec: Cells = Cells()
) -> DataFrame:
    """Per row ``key``, ``n_links``, ``component_id``, ``kept``: vectors of one label that are at
    least ``threshold`` alike by cosine are linked; the smallest key of what is connected is kept.

    Equal vectors of a label are collapsed first, by a partially aggregated group-by on two 64-bit
    digests, so copies are never compared and count as links of their own. Cells are fitted on a
    bounded sample; every vector then goes to its cell and to those whose border is near. A cell of
    any size is compared in blocks: a group is a pair of blocks, which returns counts and a tree,
    not pairs.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and null labels, have no
    links; vectors of different dimension none with each other. Repeated rows are linked copies. A
    key names one vector: rows that share a key but not their vector share their links. A null key
    counts as the smallest number. Other columns are left out. Empty tables give no rows.
    """
    identity = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    numbers = F.col(vector).cast("array<double>")
    rows = vectors.select(identity.alias("id"), F.col(key).alias("key"), F.col(label).alias("label"), numbers.alias("vector"))
    fits = usable(F.col("vector")) & F.col("label").isNotNull()
    digests = [F.when(fits, F.xxhash64(F.lit(n), F.col("vector"))).alias(f"d{n}") for n in (1, 2)]
    rows = rows.select("id", "key", "label", "vector", *digests)
    groups = rows.where("d1 is not null").groupBy("label", "d1", "d2")
    classes = groups.agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"))
    classes = save(classes, "classes")

    dims = classes.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    centres = reach = None
    if dims:
        share = spec.sample / (dims["n"] * dims["dim"])
        drawn = classes.where((F.size("vector") == dims["dim"]) & (F.pmod("d1", F.lit(1 << 30)) < share * (1 << 30)))
        sample = [r["vector"] for r in drawn.select("vector").collect()]
        if sample:
            k = max(1, min(spec.most, dims["n"] // spec.per_cell, len(sample) // 8))
            drawn = unit(np.array(sample, np.float64))
            centres = spherical_kmeans(drawn, k, spec.rounds, spec.seed)
            reach = reaches(drawn, centres, threshold, spec.deviations)

    ddl = "cell int, size int, home int, cells array<int>, label {}, node long, copies long, vector array<double>"
    kind = classes.schema["label"].dataType.simpleString()
    placed = save(classes.select("label", "node", "copies", "vector").mapInArrow(_assign(centres, reach), ddl.format(kind)), "cells")
    bucket = ["cell", "size", "label"]
    sizes = placed.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / spec.block).cast("int")
    dealt = placed.join(sizes, bucket).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sides = []
    for side, (i, j, holds) in enumerate([("own", "other", "own <= other"), ("other", "own", "other < own")]):
        other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where(holds)
        sides.append(other.select(*bucket, F.col(i).alias("i"), F.col(j).alias("j"), F.lit(side).alias("side"), "home", "cells", "node", "copies", "vector"))
    pairs = sides[0].union(sides[1]).groupBy(*bucket, "i", "j").applyInArrow(_compare(threshold), "node long, other long, links long")
    pairs = save(pairs, "compared")

    links = pairs.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(pairs.where("other is not null"), "node", "other")
    named = classes.join(links, "node", "left").join(joined, "node", "left").select(
        "label", "d1", "d2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("named")
    )
    out = rows.select("id", "key", "label", "d1", "d2").join(save(named, "named"), ["label", "d1", "d2"], "left")
    component = F.coalesce("named", "id")
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (component == F.col("id")).alias("kept"),
    )
