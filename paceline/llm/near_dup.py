"""Near-duplicates of texts by a chosen-path set similarity join.

A text is the set of its word shingles. Equal sets count as one from the start. Every set walks down
``trees`` independent trees: on each level it takes the branch of the token that a random order puts
first in the set (its minwise token), so sets with similarity s stay together over d levels with
probability s ** d; there are as many trees as ``RECALL`` needs at the asked similarity. A node is taken apart until it holds at most ``LIMIT`` sets, at most ``LEVELS`` times; then its
sets are compared with each other by sketches, and what looks similar is confirmed on the full sets.

Of the similar pairs first one for each set is confirmed: with the smallest set much like it, or else one most
like it in some node. Confirmed links are put together to components, and then the similar pairs that still
lie in different components are compared on their full sets, all of them, in the task of their node; only links
come out. So a group of copies is not paired, only what hangs loosely on it is. A node that no level takes apart is a group of near-copies: it is cut into blocks that all hold its
first set; afterwards whatever did not end in that set's component meets every block.

Defined cases: null or empty text and text without words have an empty set and link with nothing; texts
shorter than a shingle are one shingle; rows without an id link with nothing and have no component; rows
with one id are one node; ties do not matter, the smallest id names a component; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.components import components
from paceline.llm.tables import stored, text_of

# The levels of each tree; sets of a node that is compared exhaustively.
LEVELS, LIMIT = 6, 64
# The chance that a pair of just the asked similarity meets in a node, even if all nodes go down to the last level.
RECALL = 0.9995
# Coarse sketches agree with an error of about 0.035 (102 bytes at 85 percent) or 0.032 (156 bytes at 80); this much below the threshold a pair is not looked at.
MARGIN = 0.18
# As much agreement above the threshold makes a pair a sure candidate.
SURE = 0.05
# Sets of a block of strays, and of the members it meets.
CELL = 256
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C15


def trees_for(percent: int) -> int:
    """Independent trees that give the recall at the last level."""
    met = min((percent / 100) ** LEVELS, RECALL)
    return math.ceil(math.log(1 - RECALL) / math.log(1 - met))


def _orders(trees: int) -> np.ndarray:
    """Odd multipliers, one for each level of each tree."""
    return _mix(np.arange(1, trees * LEVELS + 1, dtype=np.uint64) * _U(_BASE)) | _U(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of all texts, and how many words each text has."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    word = ~blank
    starts = np.flatnonzero(word & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(word & np.concatenate([blank[1:], [True]])) + 1
    n = len(raw)
    up = np.full(n, _U(_BASE))
    down = np.full(n, _U(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    np.cumprod(up, out=up)
    np.cumprod(down, out=down)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + _U(11)) * up, out=sums[1:])
    hashes = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    borders = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, borders), prepend=0)


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The set of each text, as sorted 64-bit hashes of its shingles."""
    hashes, counts = word_hashes(texts)
    at = 0
    for n in counts.tolist():
        mine = hashes[at : at + n]
        at += n
        size = min(n, words)
        if not n:
            yield np.empty(0, np.uint64)
            continue
        out = np.full(n - size + 1, _U(size))
        for i in range(size):
            out = _mix(out * _U(_BASE) + mine[i : n - size + 1 + i])
        yield np.unique(out)


def _batches(batch: pa.RecordBatch, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about so many bytes of text, or one text: hashing takes some 50 bytes of memory a byte."""
    lengths = np.array(pc.binary_length(batch.column("text"))) + 1
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // most)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def _sign(words: int, trees: int):
    def sign(batches):
        orders = _orders(trees)
        for whole in batches:
            for batch in _batches(whole):
                sets = list(shingle_sets([t.as_buffer().to_pybytes() for t in batch.column("text").cast(pa.binary())], words))
                sizes = np.array([len(s) for s in sets])
                some = np.flatnonzero(sizes)
                tokens = np.zeros((len(sets), len(orders)), np.uint32)
                if len(some):
                    joined = np.concatenate([sets[i] for i in some])
                    begins = np.cumsum(sizes[some]) - sizes[some]
                    for i, order in enumerate(orders):
                        tokens[some, i] = (_mix(np.minimum.reduceat(joined * order, begins)) >> _U(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), pa.array(sizes, pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([t.tobytes() for t in tokens], pa.binary()),
                ], ["id", "n_shingles", "digest", "tokens"])

    return sign


def _set_rows(words: int):
    def rows(batches):
        for whole in batches:
            for batch in _batches(whole):
                sets = shingle_sets([t.as_buffer().to_pybytes() for t in batch.column("text").cast(pa.binary())], words)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])

    return rows


def _runs(batches) -> Iterator[pa.Table]:
    """Tables of whole nodes: rows come sorted by node, a node may lie across batches."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        nodes = table.column("node").to_numpy()
        cut = int(np.searchsorted(nodes, nodes[-1]))
        held = table.slice(cut)
        if cut:
            yield table.slice(0, cut)
    if held is not None and held.num_rows:
        yield held


def _sketches(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(table.num_rows, -1)


def _agreement(sketch: np.ndarray) -> np.ndarray:
    return (sketch[:, None, :] == sketch[None, :, :]).mean(axis=2)


def _forest(threshold: float):
    """Candidate links of each node: every set with the first one surely similar, or else with the most similar.

    A set that is similar to later ones only is linked with itself, to be known as one with similar sets.
    """

    def forest(batches):
        for table in _runs(batches):
            node, ids, sketch = table.column("node").to_numpy(), table.column("id").to_numpy(), _sketches(table)
            begin = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            size = np.diff(np.append(begin, len(node)))
            twos = begin[size == 2]
            pair = (sketch[twos] == sketch[twos + 1]).mean(axis=1)
            near = twos[pair >= threshold - MARGIN]
            low, high = np.minimum(ids[near], ids[near + 1]), np.maximum(ids[near], ids[near + 1])
            a, b, sure_ones = [low], [high], [pair[pair >= threshold - MARGIN] >= threshold + SURE]
            for s, n in zip(begin[size > 2].tolist(), size[size > 2].tolist()):
                order = s + np.argsort(ids[s : s + n], kind="stable")
                like = np.tril(_agreement(sketch[order]), -1)
                sure = like >= threshold + SURE
                best = np.where(sure.any(axis=1), sure.argmax(axis=1), like.argmax(axis=1))
                close = like >= threshold - MARGIN
                at = np.flatnonzero(close.any(axis=1))
                alone = np.flatnonzero(close.any(axis=0) & ~close.any(axis=1))
                a += [ids[order[best[at]]], ids[order[alone]]]
                b += [ids[order[at]], ids[order[alone]]]
                sure_ones += [sure.any(axis=1)[at], np.zeros(len(alone), bool)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, sure_ones)], ["a", "b", "sure"])

    return forest


def _open_pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a node that are not in one component, in pairs; of two sides where there are sides (0 and 1, else 2)."""
    node, root, side = (table.column(c).to_numpy() for c in ("node", "root", "side"))
    begin = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    for s, n in zip(begin.tolist(), np.diff(np.append(begin, len(node))).tolist()):
        r, w = root[s : s + n], side[s : s + n]
        if (r == r[0]).all():
            continue
        x, y = np.nonzero(np.triu(r[:, None] != r[None, :], 1) & ((w[:, None] != w[None, :]) | ((w[:, None] == 2) & (w[None, :] == 2))))
        for p in range(0, len(x), 50_000):
            yield s + x[p : p + 50_000], s + y[p : p + 50_000]


def _loose(threshold: float):
    """Rows of nodes that are similar to one of another component, by coarse sketches."""

    def loose(batches):
        for table in _runs(batches):
            sketch = _sketches(table)
            keep = np.zeros(table.num_rows, bool)
            for x, y in _open_pairs(table):
                like = (sketch[x] == sketch[y]).mean(axis=1) >= threshold - MARGIN
                keep[x[like]] = keep[y[like]] = True
            for batch in table.select(["node", "id", "root", "side"]).filter(pa.array(keep)).to_batches():
                yield batch

    return loose


def common(sets: list[np.ndarray], at_once: int = 500_000) -> np.ndarray:
    """How many elements each two of the sorted sets have in common: the product of their incidence matrix with
    itself, by stretches of the hashes with about ``at_once`` elements, so that long texts fit as well."""
    out = np.zeros((len(sets), len(sets)), np.float32)
    parts = sum(map(len, sets)) // at_once + 1
    edges = [i * ((1 << 64) // parts) for i in range(1, parts)]
    cuts = [[0, *np.searchsorted(x, np.array(edges, np.uint64)), len(x)] for x in sets]
    width = 4096
    for part in range(parts):
        mine = [x[c[part] : c[part + 1]] for x, c in zip(sets, cuts)]
        _, column = np.unique(np.concatenate(mine), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), [len(x) for x in mine])
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [first, first + width])
            piece = np.zeros((len(sets), width), np.float32)
            piece[row[a:b], column[a:b] - first] = 1
            out += piece @ piece.T
    return out


def _exact(percent: int):
    """Links between sets of different components in one node, on the full sets."""

    def exact(batches):
        for table in _runs(batches):
            node, ids = table.column("node").to_numpy(), table.column("id").to_numpy()
            raw = table.column("shingles").to_pylist()
            sizes = np.array([len(v) // 8 for v in raw], np.int64)
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            at, both = -1, None
            for x, y in _open_pairs(table):
                if node[x[0]] != at:
                    at = node[x[0]]
                    start, end = np.searchsorted(node, at, side="left"), np.searchsorted(node, at, side="right")
                    both = common([np.frombuffer(v, np.uint64) for v in raw[start:end]]).astype(np.int64)
                shared = both[x - start, y - start]
                keep = 100 * shared >= percent * (sizes[x] + sizes[y] - shared)
                a.append(ids[x[keep]])
                b.append(ids[y[keep]])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return exact


def _confirmed(percent: int):
    def confirmed(batches):
        for batch in batches:
            sets = [[np.frombuffer(v, np.uint64) for v in batch.column(c).to_pylist()] for c in ("left", "right")]
            both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets)], np.int64)
            total = np.array([len(x) + len(y) for x, y in zip(*sets)], np.int64) - both
            keep = pa.array(100 * both >= percent * total)
            yield batch.select(["a", "b"]).filter(keep)

    return confirmed


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose full sets are similar enough."""
    side = lambda name: sets.select(F.col("id").alias("i"), F.col("shingles").alias(name))
    left = pairs.join(side("left"), F.col("a") == F.col("i")).drop("i")
    both = left.join(side("right"), F.col("b") == F.col("i")).drop("i")
    return stored(both.select("a", "b", "left", "right").mapInArrow(_confirmed(percent), "a long, b long"), "confirmed")


def _prefix(level: int) -> Column:
    return F.xxhash64("tree", F.substring("path", 1, 4 * level))


def nodes(classes: DataFrame, trees: int) -> tuple[DataFrame, DataFrame]:
    """(node, id) of the nodes small enough to compare, and (node, first, parts, id) of those no level took apart."""
    paths = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(t.alias("tree"), F.substring(F.col("tokens"), t * (4 * LEVELS) + 1, F.lit(4 * LEVELS)).alias("path")),
    )
    open_ = classes.select("id", F.explode(paths).alias("p")).select("id", "p.tree", "p.path")
    small = []
    for level in range(1, LEVELS + 1):
        keyed = open_.withColumn("node", _prefix(level))
        sizes = keyed.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 1")
        told = stored(keyed.join(sizes, "node"), f"level{level}")
        small.append(told.filter(F.col("n") <= LIMIT).select("node", "id"))
        open_ = told.filter(F.col("n") > LIMIT).select("id", "tree", "path", "node", "n", "first")
        if open_.isEmpty():
            break
        if level < LEVELS:
            open_ = open_.select("id", "tree", "path")
    whole = small[0]
    for part in small[1:]:
        whole = whole.union(part)
    if "node" not in open_.columns:
        open_ = open_.withColumns({"node": F.lit(0).cast("long"), "n": F.lit(0).cast("long"), "first": F.lit(0).cast("long")})
    parts = F.ceil(F.col("n") / (LIMIT - 1)).cast("int")
    return whole, open_.select("node", "first", parts.alias("parts"), "id")


def _deal(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node")


def near_duplicates(
    docs: DataFrame, words: int = 3, percent: int = 85, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id) for each row: documents are linked if 100 * intersection is at least
    ``percent`` * union of their sets of ``words``-word shingles; a component is named by its smallest id."""
    threshold, trees = percent / 100, trees_for(percent)
    texts = docs.select(F.col(id).cast("long").alias("id"), text_of(text).alias("text"))
    signed = stored(texts.mapInArrow(_sign(words, trees), "id long, n_shingles long, digest binary, tokens binary"), "signed")
    classes = stored(
        signed.filter("n_shingles > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("id"), F.first("tokens").alias("tokens")),
        "classes")
    # One byte of each token.
    low = F.concat(*[F.substring("tokens", 4 * i + 1, 1) for i in range(trees * LEVELS)])
    sketches = stored(classes.select("id", low.alias("sketch")), "sketches")
    small, large = nodes(classes, trees)
    large = stored(large, "large")
    # A block of a large node, with the node's first set in each.
    block = F.pmod(F.xxhash64("node", "id"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    name = lambda *c: F.xxhash64("node", *c)
    firsts = large.select("node", "first", "parts").distinct().withColumn("block", every)
    blocks = large.filter("id <> first").withColumn("block", block).select(name("block").alias("node"), "id").union(
        firsts.select(name("block").alias("node"), F.col("first").alias("id")))
    compared = stored(small.union(blocks), "nodes")
    found = stored(
        _deal(compared.join(sketches, "id").select("node", "id", "sketch"))
        .mapInArrow(_forest(threshold), "a long, b long, sure boolean").distinct(), "candidates")
    # The full sets of all that have a similar one. By the same join at every size: it moves the texts once.
    named = found.select(F.col("a").alias("id")).union(found.select("b")).union(large.select("id")).distinct()
    sets = stored(texts.join(named.hint("merge"), "id", "left_semi").mapInArrow(_set_rows(words), "id long, shingles binary"), "sets")
    tried = stored(
        found.filter("a <> b").groupBy("b").agg(F.min(F.struct(~F.col("sure"), "a")).alias("best")).select("best.a", "b"), "tried")
    links = _links(tried, sets, percent)

    # Similar pairs that the forest left in different components.
    roots = stored(components(links), "roots")
    rooted = lambda df: df.join(roots, F.col("id") == F.col("node_id"), "left").withColumn(
        "root", F.coalesce("root", "id")).drop("node_id")
    roots = roots.withColumnRenamed("node", "node_id")
    inside = rooted(small.join(sketches, "id")).select("node", "id", "root", F.lit(2).alias("side"), "sketch")
    members = stored(rooted(large).join(sketches, "id"), "members")
    first = roots.select(F.col("node_id").alias("first_id"), F.col("root").alias("first_root"))
    strays = members.join(first, F.col("first") == F.col("first_id"), "left").filter(
        F.col("root") != F.coalesce("first_root", "first"))
    whole = members.groupBy("node").agg(F.count("*").alias("all"))
    counts = strays.groupBy("node").agg(F.count("*").alias("strays")).join(whole, "node").select(
        F.col("node").alias("n"), F.ceil(F.col("strays") / CELL).cast("int").alias("stray_parts"), F.ceil(F.col("all") / CELL).cast("int").alias("cells"))
    some = strays.join(counts, F.col("node") == F.col("n")).withColumn("mine", F.pmod(F.xxhash64("id", "node"), F.col("stray_parts")).cast("int"))
    meets = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    one = some.withColumn("block", meets).select(name("mine", "block").alias("node"), "id", "root", F.lit(0).alias("side"), "sketch")
    parts = F.explode(F.sequence(F.lit(0), F.col("stray_parts") - 1))
    cell = F.pmod(F.xxhash64("node", "id"), F.col("cells")).cast("int")
    other = members.join(counts, F.col("node") == F.col("n")).withColumn("block", cell).withColumn("mine", parts).select(
        name("mine", "block").alias("node"), "id", "root", F.lit(1).alias("side"), "sketch")
    loose = stored(_deal(inside.union(one).union(other)).mapInArrow(_loose(threshold), "node long, id long, root long, side int"), "loose")
    with_sets = loose.join(sets, "id").select("node", "id", "root", "side", "shingles")
    more = stored(_deal(with_sets).mapInArrow(_exact(percent), "a long, b long").distinct(), "more")
    roots = components(links.union(more))
    named = classes.join(roots, F.col("id") == F.col("node"), "left").select("digest", F.coalesce("root", "id").alias("component_id"))
    return signed.join(named, "digest", "left").select(
        "id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
