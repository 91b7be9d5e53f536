"""Embedding near-dedup: an epsilon grid order join under a cosine threshold.

Two unit vectors with a cosine of at least t are at most eps = sqrt(2 - 2t) apart. Vectors of a group are
put in the order of their grid cells of side eps on the leading principal dimensions and cut into
intervals of that sequence. Starting with the whole sequence, pairs of intervals are taken apart into
pairs of their eighths, and a pair whose boxes on the principal dimensions are more than eps apart is
dropped with everything below it: a projection never lengthens a distance. The pairs of leaf intervals that
remain are compared exhaustively in double precision, each in a task of its own.

The principal dimensions come from at most ``SAMPLE`` vectors (those with the smallest hashes of their ids);
they decide what is skipped, never what is linked. Equal vectors are compared once and counted. A pair of
leaves gives at most one row per vector, with its links and one link of a spanning forest, so a dense
group does not become all its pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a
null group or id, link with nothing; vectors of different lengths are not comparable; rows with one id are
one node (their links are put together) and each gets its row; an empty table gives no rows.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.components import components
from paceline.llm.tables import stored

# Vectors of a leaf interval, principal dimensions, vectors they are taken from, intervals of one above.
LEAF, DIMENSIONS, SAMPLE, FAN = 1024, 8, 4096, 8
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def principal(sample: list[list[float]]) -> dict[int, np.ndarray]:
    """For each length of vectors: its leading principal dimensions as orthonormal columns."""
    out = {}
    for size in {len(v) for v in sample}:
        rows = unit(np.array([v for v in sample if len(v) == size]))
        _, _, axes = np.linalg.svd(rows - rows.mean(axis=0), full_matrices=False)
        out[size] = axes[:DIMENSIONS].T
    return out


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _project(axes: dict[int, np.ndarray], eps: float):
    """Adds the coordinates on the principal dimensions (zero beyond those there are)."""

    def project(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            place = np.zeros((batch.num_rows, DIMENSIONS))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                basis = axes.get(int(size))
                if basis is not None:
                    place[at, : basis.shape[1]] = unit(_matrix(batch.column("vector").take(pa.array(at)), int(size))) @ basis
            cells = np.floor(place / eps).astype(np.int32)
            lists = lambda m, kind: pa.array(list(m), pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists(place, pa.float64()), lists(cells, pa.int32())], [*batch.schema.names, "place", "cells"])

    return project


def _cut(leaf: int):
    """Sorted rows of a partition to leaf intervals: runs of one group of at most ``leaf`` rows."""

    def flush(rows: list[dict], number: int) -> pa.RecordBatch:
        place = np.array([r["place"] for r in rows])
        vectors = np.array([r["vector"] for r in rows])
        row = {
            "group": rows[0]["group"], "size": rows[0]["size"], "number": number,
            "lo": place.min(axis=0).tolist(), "hi": place.max(axis=0).tolist(),
            "ids": np.array([r["id"] for r in rows], np.int64).tobytes(),
            "copies": np.array([r["copies"] for r in rows], np.int64).tobytes(), "vectors": vectors.tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], LEAVES)

    def cut(batches):
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == leaf or (held[0]["group"], held[0]["size"]) != (row["group"], row["size"])):
                    yield flush(held, number)
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield flush(held, number)

    return cut


LEAVES = pa.schema([
    ("group", pa.int64()), ("size", pa.int32()), ("number", pa.int64()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
    ("ids", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary()),
])
LEAVES_SQL = (
    "group long, size int, number long, lo array<double>, hi array<double>, ids binary, copies binary, vectors binary")


def _summaries(leaves: DataFrame, level: int) -> DataFrame:
    """The intervals of a level: FAN ** level leaves each, with their box and the groups they span."""
    ends = [f(F.col(side)[i]).alias(f"{side}{i}") for side, f in (("lo", F.min), ("hi", F.max)) for i in range(DIMENSIONS)]
    span = F.struct("group", "size")
    return leaves.groupBy(F.floor(F.col("leaf") / FAN**level).alias("at")).agg(
        *ends, F.min(span).alias("from"), F.max(span).alias("to"))


def _near(eps: float):
    """Of two intervals: may they hold vectors of one group no more than eps apart?"""
    gap = F.lit(0.0)
    for i in range(DIMENSIONS):
        apart = F.greatest(F.lit(0.0), F.col(f"b.lo{i}") - F.col(f"a.hi{i}"), F.col(f"a.lo{i}") - F.col(f"b.hi{i}"))
        gap = gap + apart * apart
    return (gap <= eps * eps + SLACK) & (F.col("a.from") <= F.col("b.to")) & (F.col("b.from") <= F.col("a.to"))


def interval_pairs(leaves: DataFrame, count: int, eps: float) -> DataFrame:
    """Pairs (a, b), a <= b, of leaves that may hold links, found from the whole sequence downwards."""
    level = 0
    while FAN**level < count:
        level += 1
    pairs = leaves.sparkSession.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    while level:
        level -= 1
        parts = lambda c: F.explode(F.sequence(F.col(c) * FAN, F.col(c) * FAN + FAN - 1))
        split = pairs.withColumn("i", parts("a")).withColumn("j", parts("b")).filter("i <= j")
        boxes = _summaries(leaves, level)
        pairs = (
            split.join(boxes.alias("a"), F.col("i") == F.col("a.at")).join(boxes.alias("b"), F.col("j") == F.col("b.at"))
            .filter(_near(eps)).select(F.col("i").alias("a"), F.col("j").alias("b"))
        )
        pairs = stored(pairs, "intervals")
    return pairs


def _forest(linked: np.ndarray) -> np.ndarray:
    """For rows and columns of a matrix of links: the smallest number (rows first, then columns) they reach."""
    n, m = linked.shape
    row, column = np.arange(n), np.arange(n, n + m)
    far = n + m
    while True:
        to_row = np.minimum(row, np.where(linked, column[None, :], far).min(axis=1, initial=far))
        to_column = np.minimum(column, np.where(linked, to_row[:, None], far).min(axis=0, initial=far))
        if (to_row == row).all() and (to_column == column).all():
            return np.concatenate([row, column])
        row, column = to_row, to_column


def _compare(threshold: float):
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[np.ndarray] = [np.empty(0, np.int64)] * 3
        if left.num_rows and right.num_rows:
            a, b = left.to_pylist()[0], right.to_pylist()[0]
            if (a["group"], a["size"]) == (b["group"], b["size"]):
                ids = [np.frombuffer(x["ids"], np.int64) for x in (a, b)]
                copies = [np.frombuffer(x["copies"], np.int64) for x in (a, b)]
                units = [unit(np.frombuffer(x["vectors"]).reshape(len(i), -1)) for x, i in zip((a, b), ids)]
                linked = units[0] @ units[1].T >= threshold
                same = a["leaf"] == b["leaf"]
                np.fill_diagonal(linked, linked.diagonal() & (not same))
                links = [(linked * copies[1][None, :]).sum(axis=1), (linked * copies[0][:, None]).sum(axis=0)]
                if same:  # a row and its column are one vector
                    np.fill_diagonal(linked, True)
                root = _forest(linked)
                both = np.concatenate(ids)
                n = len(ids[0]) if same else len(both)
                total = np.concatenate(links)[:n]
                at = np.flatnonzero(total > 0)
                out = [both[:n][at], total[at], both[root[:n]][at]]
        return pa.table({"id": pa.array(out[0], pa.int64()), "links": pa.array(out[1], pa.int64()), "to": pa.array(out[2], pa.int64())})

    return compare


def near_vectors(
    table: DataFrame, threshold: float, id: str = "vec_id", group: str = "label", vector: str = "embedding", leaf: int = LEAF
) -> DataFrame:
    """(id, group, n_links, component_id) for each row: links to other rows of its group with a cosine of at
    least ``threshold`` (above 0), and the smallest id reachable by links."""
    eps = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    wide = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id).alias("id"), F.col(group).cast("long").alias("group"), wide.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = rows.filter("id is not null and group is not null and size(vector) > 0").filter(
        ~bad & F.exists("vector", lambda x: x != 0))
    # One row for each vector of a group, named by the smallest of its ids.
    classes = stored(sound.groupBy("group", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vectors")
    sample = [r[0] for r in classes.orderBy(F.xxhash64("id"), "id").select("vector").limit(SAMPLE).collect()]
    placed = classes.withColumn("size", F.size("vector")).select("id", "group", "size", "copies", "vector").mapInArrow(
        _project(principal(sample), eps),
        "id long, group long, size int, copies long, vector array<double>, place array<double>, cells array<int>")
    ordered = placed.repartitionByRange("group", "size", "cells", "id").sortWithinPartitions("group", "size", "cells", "id")
    cut = stored(ordered.select("id", "group", "size", "copies", "vector", "place").mapInArrow(_cut(leaf), LEAVES_SQL), "leaves")
    # Numbers without gaps: a leaf's own in its partition, after the leaves of the partitions before. The driver
    # holds one count per partition.
    part = F.shiftright("number", 32)
    counts = sorted((r["part"], r["count"]) for r in cut.groupBy(part.alias("part")).count().collect())
    starts = [0, *accumulate(n for _, n in counts)]
    offsets = table.sparkSession.createDataFrame([(p, start) for (p, _), start in zip(counts, starts)], "part long, begin long")
    leaves = stored(
        cut.join(F.broadcast(offsets), part == F.col("part")).withColumn("leaf", F.col("begin") + F.col("number").bitwiseAND(2**32 - 1))
        .drop("number", "part", "begin"), "numbered")
    pairs = interval_pairs(leaves.select("group", "size", "leaf", "lo", "hi"), leaves.count(), eps)
    data = leaves.select("leaf", "group", "size", "ids", "copies", "vectors")
    left = pairs.join(data, F.col("a") == F.col("leaf"))
    again = pairs.select(F.col("a").alias("ra"), F.col("b").alias("rb"))
    right = again.join(data.select(*[F.col(c).alias(c) for c in data.columns]), F.col("rb") == F.col("leaf"))
    found = left.groupBy("a", "b").cogroup(right.groupBy("ra", "rb")).applyInArrow(_compare(threshold), "id long, links long, to long")
    found = stored(found, "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    # Back to all rows of a class.
    told = (
        classes.join(links, "id", "left").join(roots, F.col("id") == F.col("node"), "left")
        .select("group", "vector", F.coalesce("links", F.lit(0)).alias("class_links"), F.col("copies") - 1, F.coalesce("root", "id").alias("root"))
        .toDF("g", "v", "class_links", "others", "root")
    )
    return rows.join(told, (F.col("id").isNotNull()) & (F.col("group") == F.col("g")) & (F.col("vector") == F.col("v")), "left").select(
        "id", "group", (F.coalesce("class_links", F.lit(0)) + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"))
