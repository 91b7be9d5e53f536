"""Merkle manifest of a table: a tree of digests per group, a tree over the groups' roots, and proofs.

H is the lowercase hex SHA-256 of its inputs put together, digests as hex text. Leaves of a group ascend by
the given order; while a level has several nodes, every eight consecutive ones become their H. What is left
is the group's root; the roots, ordered by group (null first, then bytewise), form a tree of the same kind.

Places in a tree come from one sort by range: a row's number within its partition, plus what earlier partitions
hold of its group, of which there is one number per partition and group. A proof is the digests beside the
path of a leaf. Proofs are made for whole partitions of leaves at once (octopus): the leaves of a partition
first tell the coordinates of the fewest nodes that together with them give all paths, these are fetched by
one join, and the partition then derives the nodes its paths share and writes out each leaf's own proof.
A partition holds about ``RUN`` leaves, however large or small groups are.

Defined cases: nulls are fields of their own (``-``); rows alike in group and order are ordered by digest, so
repeated rows are leaves of their own; null groups form one group; null order values come first; an empty
table has no rows and no root. A very long text is hashed in the scan and goes no further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.tables import stored

WIDE = 8  # nodes below one
RUN = 1 << 14  # leaves of a partition
TOP = -1  # the tree over the groups' roots
IN_PART = 33  # bits of monotonically_increasing_id() that number the rows of a partition


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its length in bytes and itself, or ``-``."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _placed(df: DataFrame, group: str, order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``part`` and number ``at`` within it, and per part and group where the group's rows start."""
    parts = -(-df.count() // RUN) or 1
    keys = [group, *order, "_salt"]  # the salt takes rows apart that are alike in all else
    ranged = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    numbered = ranged.drop("_salt").withColumn("at", F.monotonically_increasing_id())
    rows = stored(numbered.withColumn("part", F.shiftright("at", IN_PART)).withColumn("at", F.col("at").bitwiseAND((1 << IN_PART) - 1)), name)
    runs = rows.groupBy("part", group).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows, runs.select("part", group, (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("n"))


def _grown(level: DataFrame, name: str) -> DataFrame:
    """All nodes (tree, level, pos, hash, n) above and with the leaves ``level`` (tree, pos, hash, n)."""
    most = level.agg(F.max("n")).first()[0] or 0
    now = level.select("tree", F.lit(0).alias("level"), "pos", "hash", "n")
    nodes = [now]
    while most > 1:
        children = F.array_sort(F.collect_list(F.struct("pos", "hash")))
        above = now.filter("n > 1").groupBy("tree", F.floor(F.col("pos") / WIDE).cast("long").alias("up")).agg(
            F.sha2(F.array_join(F.transform(children, lambda c: c["hash"]), ""), 256).alias("hash"),
            F.ceil(F.max("n") / WIDE).cast("long").alias("n"), (F.max("level") + 1).alias("level"))
        now = stored(above.select("tree", "level", F.col("up").alias("pos"), "hash", "n"), f"{name}-nodes")
        nodes.append(now)
        most = -(-most // WIDE)
    whole = nodes[0]
    for more in nodes[1:]:
        whole = whole.union(more)
    return whole


@dataclass
class Manifest:
    """``rows``: the input with part, tree, pos, n (leaves of its tree); ``nodes``: tree, level, pos, hash;
    ``roots``: tree, subroot; ``trees``: how many; ``root``: the digest of all, null for an empty table."""

    rows: DataFrame
    nodes: DataFrame
    roots: DataFrame
    trees: int
    root: str | None


OWN = {"part", "at", "tree", "pos", "n", "first", "shift", "level", "hash", "up", "_group", "_part", "_salt", "_all", "proof_sha256", "folded_root", "subroot"}


def manifest(df: DataFrame, group: str, order: Sequence[str], digest: str = "leaf", keep: Sequence[str] = ()) -> Manifest:
    """Trees over the rows of ``df``, which has its leaves' digests in a column; reads ``df`` more than once,
    so it should be stored. Columns other than these and ``keep`` are left out, whatever their names; a column in
    use may not have a name of ``OWN``."""
    names = list(dict.fromkeys([group, *order, digest, *keep]))
    if taken := OWN & {name.lower() for name in names}:
        raise ValueError(f"columns of the manifest's own: {sorted(taken)}")
    df = df.select(*[F.col(f"`{name}`") for name in names])
    rows, runs = _placed(df, group, [*order, digest], "leaves")
    groups = stored(runs.select(group, "n").distinct(), "groups")
    ranked, starts = _placed(groups.withColumn("_all", F.lit(0)), "_all", [group], "trees")
    ranked = ranked.join(starts.drop("n"), ["part", "_all"]).select(F.col(group).alias("_group"), (F.col("at") + F.col("shift")).alias("tree"))
    named = runs.join(ranked, runs[group].eqNullSafe(ranked["_group"])).select(
        F.col("part").alias("_part"), "_group", "tree", "shift", "n")
    of = (rows["part"] == named["_part"]) & rows[group].eqNullSafe(named["_group"])
    rows = stored(rows.join(named, of).withColumn("pos", F.col("at") + F.col("shift")).drop("_part", "_group", "at", "shift"), "placed")
    nodes = _grown(rows.select("tree", "pos", F.col(digest).alias("hash"), "n"), "leaf")
    roots = stored(nodes.filter("n = 1").select("tree", F.col("hash").alias("subroot")), "subroots")
    trees = roots.count()
    top = _grown(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("subroot").alias("hash"), F.lit(trees).cast("long").alias("n")), "top")
    last = top.filter("n = 1").select("hash").first()
    return Manifest(rows, nodes.union(top).drop("n"), roots, trees, last[0] if last else None)


def _climb(tree: np.ndarray, pos: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Level by level, for the nodes that the given ones and their ancestors are: parents (tree, pos), and of
    each parent which children there are and which of them are known."""
    level = 0
    while True:
        open_ = n > 1
        tree, pos, n = tree[open_], pos[open_], n[open_]
        if not len(tree):
            return
        up, at = np.unique(np.stack([tree, pos // WIDE, n]), axis=1, return_inverse=True)
        known = np.zeros((up.shape[1], WIDE), bool)
        known[at.ravel(), pos % WIDE] = True
        there = up[1][:, None] * WIDE + np.arange(WIDE) < up[2][:, None]
        yield level, up[0], up[1], there, known
        tree, pos, n = up[0], up[1], -(-up[2] // WIDE)
        level += 1


def _paths(tree: np.ndarray, pos: np.ndarray, n: np.ndarray, trees: int):
    """Both trees' levels, with the tree of the roots after the groups'."""
    yield from ((False, *x) for x in _climb(tree, pos, n))
    below = np.unique(tree)
    yield from ((True, *x) for x in _climb(np.full(len(below), TOP), below, np.full(len(below), trees)))


def _missing(trees: int):
    """The fewest nodes that a partition's leaves lack, as coordinates."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        out = {"tree": [], "level": [], "pos": []}
        for _, level, up_tree, up, there, known in _paths(*(rows[c].to_numpy() for c in ("tree", "pos", "n")), trees):
            i, child = np.nonzero(there & ~known)
            out["tree"].append(up_tree[i])
            out["pos"].append(up[i] * WIDE + child)
            out["level"].append(np.full(len(i), level, "int32"))
        found = {k: np.concatenate([np.zeros(0, "int32" if k == "level" else "int64"), *v]) for k, v in out.items()}
        return pa.table({"part": np.full(len(found["pos"]), key[0].as_py(), "int64"), **found})

    return run


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _expanded(trees: int, digest: str, other: str):
    """Each leaf's proof and the root it folds to, from the partition's leaves and what was fetched for them."""

    def run(rows: pa.Table, fetched: pa.Table) -> pa.Table:
        tree, pos, n = (rows[c].to_numpy() for c in ("tree", "pos", "n"))
        levels = (fetched["level"].to_numpy() + (fetched["tree"].to_numpy() == TOP) * 64).tolist()
        node = dict(zip(zip(levels, fetched["tree"].to_pylist(), fetched["pos"].to_pylist()), fetched["hash"].to_pylist()))
        leaves = rows[digest].to_pylist()
        node.update(zip(((0, t, p) for t, p in zip(tree.tolist(), pos.tolist())), leaves))
        whole = {}  # per parent, its children's digests in a row
        subroot = {t: node[0, t, 0] for t in tree[n == 1].tolist()}
        for top, level, up_tree, up, there, _ in _paths(tree, pos, n, trees):
            at = level + 64 * top
            if top and not level:
                node.update(((64, TOP, t), h) for t, h in subroot.items())
            for t, u, count in zip(up_tree.tolist(), up.tolist(), there.sum(axis=1).tolist()):
                text = "".join(node[at, t, u * WIDE + i] for i in range(count))
                whole[at, t, u] = text
                node[at + 1, t, u] = _digest(text)
            if not top:
                # Ancestors come after what is below them, so the last one of a tree is its root.
                subroot.update(((t, node[at + 1, t, 0]) for t, u in zip(up_tree.tolist(), up.tolist()) if u == 0))
        proofs, folded = [], []
        for t, p, count, own, tampered in zip(tree.tolist(), pos.tolist(), n.tolist(), leaves, rows[other].to_pylist()):
            beside, h = [], own if tampered is None else tampered
            for at, t, p, count in ((0, t, p, count), (64, TOP, t, trees)):
                while count > 1:
                    text, i = whole[at, t, p // WIDE], p % WIDE * 64
                    before, after = text[:i], text[i + 64 :]
                    beside += [before, after]
                    h = _digest(before + h + after)
                    at, p, count = at + 1, p // WIDE, -(-count // WIDE)
            proofs.append(_digest("".join(beside)))
            folded.append(h)
        return rows.drop_columns(["part", "pos", "n"]).append_column("proof_sha256", pa.array(proofs, pa.string())).append_column(
            "folded_root", pa.array(folded, pa.string()))

    return run


def prove(made: Manifest, rows: DataFrame, digest: str = "leaf", other: str = "tampered") -> DataFrame:
    """Proofs of ``rows`` (all of the manifest's rows, or any of them): their columns without part, pos and n,
    ``proof_sha256``, and ``folded_root``: the root that the leaf's digest, or ``other`` if it is not null,
    gives with the proof."""
    part = F.col("part")
    wanted = rows.select("part", "tree", "pos", "n").groupBy(part).applyInArrow(
        _missing(made.trees), "part long, tree long, level int, pos long")
    fetched = wanted.join(made.nodes, ["tree", "level", "pos"]).select("part", "tree", "level", "pos", "hash")
    names = [f for f in rows.schema.fields if f.name not in ("part", "pos", "n")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names)
    return rows.groupBy(part).cogroup(fetched.groupBy(part)).applyInArrow(
        _expanded(made.trees, digest, other), f"{kinds}, proof_sha256 string, folded_root string")
