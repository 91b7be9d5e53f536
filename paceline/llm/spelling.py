"""Spelling variants: words one edit apart, found in a trie of letter counts.

A word's vector holds how many code points it has of each of ``GROUPS`` letter groups (a code point's last five
bits). One inserted, deleted or replaced code point changes it by at most one surplus and one deficit. The
trie has a level per group, those with the most spread first; a depth-first search for a word follows its own
count and spends a surplus on the branch below it or a deficit on the branch above. Words at the leaves it
reaches are verified.

The top of the trie deals the work out: nodes with more than ``LIMIT`` words are split level by level, from
counts over all words, and each word visits every top node its budget reaches. A top node's words and
visitors are one task, in blocks of at most ``LIMIT`` words and ``VISITORS`` visitors, so no task grows with the
data. What a task tells about a word is two numbers and a word: near words are counted, never listed. With more
words than ``LIMIT * TOP`` a top node has more words, in more blocks, so that the top itself stays bounded.

Search runs over blocks of states on a stack (``BLOCK`` states each), so its memory is bounded as well.

Defined cases: a null text has no words; a null id counts as an empty one in the deletion rule; rows that repeat
count each time; ties of a form go to the smaller word in code-point order; counts above 255 count as 255, which
never takes two near words apart; an empty table has no words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.tables import stored, text_of

GROUPS = 32
LIMIT = 1 << 15  # words of a block
VISITORS = 1 << 17  # visitors of a block
TOP = 1 << 14  # top nodes are split down to LIMIT words as long as about so many do
STEP = 3  # levels split at a time
BLOCK = 1 << 16  # states of a search at once
WIDTH = 64  # code points up to which words are compared in arrays
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[^A-Za-zÀ-ÿ]+"


def word_counts(docs: DataFrame, chars: int = 5, least: int = 3) -> DataFrame:
    """(word, n): runs of letters, lower-cased in A to Z, in which one of 97 loses a code point (by the crc32 of
    document and run), of at least ``chars`` code points and ``least`` occurrences."""
    run = F.explode(F.split(F.translate(text_of("text"), UPPER, LOWER), BETWEEN)).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run).filter(F.length("run") >= chars)
    hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word")
    found = hashed.select(word).filter(F.length("word") >= chars)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _vectors(words: list[str]) -> np.ndarray:
    """A row of letter-group counts per word."""
    groups = np.frombuffer("".join(words).encode("utf-32-le"), "<u4") & (GROUPS - 1)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(owner * GROUPS + groups, minlength=len(words) * GROUPS)
    return np.minimum(counts, 255).astype("u1").reshape(len(words), GROUPS)


class Trie:
    """Vectors as a trie, of which entry i only reaches down to ``depth[i]``.

    ``keys[l]`` holds, ascending, the nodes below level l as parent * 512 + count; their entries, in the order
    of the trie, are ``start`` to ``end``. A node with one entry has no nodes below it.
    """

    def __init__(self, vectors: np.ndarray, depth: np.ndarray | None = None) -> None:
        self.order = np.lexsort(vectors[:, ::-1].T)
        self.vectors = vectors[self.order].astype("i2")
        self.depth = None if depth is None else depth[self.order]
        rows = len(vectors)
        apart = np.zeros(rows, "i2")  # the level that takes an entry apart from the one before
        if rows > 1:
            differs = self.vectors[1:] != self.vectors[:-1]
            apart[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), GROUPS)
        self.keys, self.start, self.end = [], [], []
        start, end = np.zeros(1, "i8"), np.full(1, rows, "i8")
        for level in range(GROUPS):
            many = np.flatnonzero(end - start > 1)
            if not len(many):
                break
            inside = np.zeros(rows + 1, "i8")
            np.add.at(inside, start[many], 1)
            np.add.at(inside, end[many], -1)
            first = np.flatnonzero((np.cumsum(inside)[:-1] > 0) & (apart <= level))
            # An entry that starts one of the parents starts a node, however early it differs.
            first = np.union1d(first, start[many])
            parent = many[np.searchsorted(start[many], first, side="right") - 1]
            ends = np.append(first[1:], rows)
            end = np.minimum(ends, end[parent])
            start = first
            self.keys.append(parent * 512 + self.vectors[first, level])
            self.start.append(start)
            self.end.append(end)

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of pairs (query, entry) with at most one surplus and one deficit, each pair once."""
        if not len(self.order) or not len(queries):
            return
        queries = queries.astype("i2")
        none = np.zeros(len(queries), bool)
        every = np.arange(len(queries))
        if not self.keys:
            yield from self._pairs(queries, every, np.zeros(len(queries), "i8"), np.full(len(queries), len(self.order), "i8"))
            return
        stack = [(0, q, q * 0, none[q], none[q]) for q in np.array_split(every, -(-len(every) // BLOCK))]
        while stack:
            level, query, node, surplus, deficit = stack.pop()
            own, keys, found = queries[query, level], self.keys[level], []
            for less, may in ((0, None), (1, ~surplus & (own > 0)), (-1, ~deficit)):
                at = slice(None) if may is None else np.flatnonzero(may)
                wanted = node[at] * 512 + own[at] - less
                child = np.searchsorted(keys, wanted)
                hit = np.flatnonzero(keys[np.minimum(child, len(keys) - 1)] == wanted)
                spent = (surplus[at][hit] | (less == 1), deficit[at][hit] | (less == -1))
                found.append((query[at][hit], child[hit], *spent))
            query, node, surplus, deficit = (np.concatenate(x) for x in zip(*found))
            start, end = self.start[level][node], self.end[level][node]
            last = (end - start == 1) | (level + 1 == len(self.keys))
            yield from self._pairs(queries, query[last], start[last], end[last])
            on = np.flatnonzero(~last)
            for part in np.array_split(on, -(-len(on) // BLOCK)) if len(on) else []:
                stack.append((level + 1, query[part], node[part], surplus[part], deficit[part]))

    def _pairs(self, queries: np.ndarray, query: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The entries of leaves, as far as the whole vectors keep the budget."""
        low = 0
        upto = np.cumsum(end - start)
        while low < len(query):
            high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + BLOCK)))
            many = (end - start)[low:high]
            of = np.repeat(query[low:high], many)
            entry = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start[low:high], many)
            more = queries[of] - self.vectors[entry]
            if self.depth is not None:
                more *= np.arange(GROUPS) < self.depth[entry][:, None]
            keep = np.flatnonzero(((more > 0) * more).sum(axis=1) <= 1)
            keep = keep[((more[keep] < 0) * more[keep]).sum(axis=1) >= -1]
            yield of[keep], self.order[entry[keep]]
            low = high


def _one_apart(one: str, other: str) -> bool:
    if abs(len(one) - len(other)) > 1 or one == other:
        return False
    p = next((i for i, (a, b) in enumerate(zip(one, other)) if a != b), min(len(one), len(other)))
    return one[p + (len(one) >= len(other)) :] == other[p + (len(other) >= len(one)) :]


class Words:
    """Words as rows of code points, to be compared many at a time."""

    def __init__(self, words: list[str]) -> None:
        self.words, self.size = words, np.array([len(w) for w in words])
        width = min(int(self.size.max(initial=0)), WIDTH) + 1
        self.rows = np.zeros((len(words), width), "<u4")
        short = [w[: width - 1] for w in words]
        filled = np.arange(width) < np.array([len(w) for w in short])[:, None] if words else np.zeros((0, width), bool)
        self.rows[filled] = np.frombuffer("".join(short).encode("utf-32-le"), "<u4")

    def near(self, mine: np.ndarray, others: Words, theirs: np.ndarray) -> np.ndarray:
        """Which pairs are exactly one edit apart."""
        width = max(self.rows.shape[1], others.rows.shape[1])
        row = lambda of, i: np.pad(of.rows, ((0, 0), (0, width - of.rows.shape[1])))[i] if of.rows.shape[1] < width else of.rows[i]
        a, b = row(self, mine), row(others, theirs)
        longer = self.size[mine] - others.size[theirs]
        a, b = np.where((longer < 0)[:, None], b, a), np.where((longer < 0)[:, None], a, b)
        differ = a != b
        after = np.arange(width - 1) >= differ.argmax(axis=1)[:, None]
        shifted = ((a[:, 1:] != b[:, :-1]) & after).any(axis=1)
        out = np.where(longer == 0, differ.sum(axis=1) == 1, (np.abs(longer) == 1) & ~shifted)
        for i in np.flatnonzero(np.maximum(self.size[mine], others.size[theirs]) > WIDTH):
            out[i] = _one_apart(self.words[mine[i]], others.words[theirs[i]])
        return out


def _spread(words: DataFrame) -> list[int]:
    """The letter groups, those whose counts vary most first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column(0).to_pylist()).astype("i8")
            yield pa.RecordBatch.from_pydict({"g": np.arange(GROUPS), "n": np.full(GROUPS, len(v)), "s": v.sum(axis=0), "q": (v * v).sum(axis=0)})

    sums = words.select("word").mapInArrow(run, "g long, n long, s long, q long").groupBy("g").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    spread = {r.g: r.q * r.n - r.s * r.s for r in sums.collect()}
    return sorted(range(GROUPS), key=lambda g: (-spread.get(g, 0), g))


def _top(vectors: DataFrame, rows: int, limit: int) -> list[bytes]:
    """Top nodes, as the counts on the way to them; none lies below another, and together they hold all words.

    The driver holds the nodes that are split and those next below them: about ``rows / limit`` and their children.
    """
    done, open_, depth = [], [b""], 0
    if rows <= limit:
        return open_
    while open_ and depth < GROUPS:
        deep = min(depth + STEP, GROUPS)
        part = vectors
        if depth:
            split = vectors.sparkSession.createDataFrame([(bytearray(p),) for p in open_], "above binary")
            part = vectors.join(F.broadcast(split), F.expr(f"substring(counts, 1, {depth})") == F.col("above"), "left_semi")
        found = part.groupBy(F.expr(f"substring(counts, 1, {deep})").alias("way")).count().collect()
        held = Counter()
        for r in found:
            for level in range(depth + 1, deep + 1):
                held[bytes(r.way[:level])] += r["count"]
        now = sorted(k for k in held if len(k) == depth + 1)
        while now:
            large = [k for k in now if held[k] > limit and len(k) < deep]
            done += [k for k in now if held[k] <= limit]
            last = [k for k in now if held[k] > limit and len(k) == deep]
            below = set(large)
            now = sorted(k for k in held if k[:-1] in below)
            if last:
                open_ = last
        if not any(held[k] > limit for k in held if len(k) == deep):
            open_ = []
        depth = deep
    return done + open_


def _visits(ways: list[bytes], order: list[int]):
    """Each word with every top node its budget reaches; ``home`` where it lies itself."""
    entries = np.zeros((len(ways), GROUPS), "u1")
    for i, way in enumerate(ways):
        entries[i, : len(way)] = np.frombuffer(way, "u1")
    depth = np.array([len(w) for w in ways])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(entries, depth)
        for batch in batches:
            vectors = _vectors(batch.column(0).to_pylist())[:, order]
            for query, node in trie.search(vectors):
                same = ((vectors[query] == entries[node]) | (np.arange(GROUPS) >= depth[node][:, None])).all(axis=1)
                rows = batch.take(pa.array(query))
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), *rows.columns, pa.array(same)], names=["node", "word", "n", "home"])

    return run


_FOUND = "word string, n long, n_near long, near_n long, near_word string"


def _near_words(order: list[int]):
    """Of one block: per visitor how many words are near, and the one with the largest n."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        member = rows["member"].to_numpy()
        words, n, home = rows["word"].to_pylist(), rows["n"].to_numpy(), rows["home"].to_numpy()
        ours, theirs = np.flatnonzero(~member), np.flatnonzero(member)
        visitors, members = Words([words[i] for i in ours]), Words([words[i] for i in theirs])
        near, best = np.zeros(len(ours), "i8"), np.full(len(ours), -1, "i8")
        # Members by n, those alike in it by word, so that the best of several is the one of the highest place.
        ranked = sorted(range(len(theirs)), key=members.words.__getitem__, reverse=True)
        ranked.sort(key=lambda i: n[theirs[i]])
        place = np.empty(len(theirs), "i8")
        place[ranked] = np.arange(len(theirs))
        if len(ours) and len(theirs):
            for visitor, other in Trie(_vectors(members.words)[:, order]).search(_vectors(visitors.words)[:, order]):
                hit = visitors.near(visitor, members, other)
                near += np.bincount(visitor[hit], minlength=len(ours))
                np.maximum.at(best, visitor[hit], place[other[hit]])
        tell = np.flatnonzero((near > 0) | (home[ours] & (key[2].as_py() == 0)))
        found = [ranked[best[i]] if near[i] else None for i in tell]
        return pa.table({
            "word": pa.array([visitors.words[i] for i in tell], pa.string()), "n": pa.array(n[ours][tell], pa.int64()), "n_near": near[tell],
            "near_n": pa.array([None if i is None else int(n[theirs[i]]) for i in found], pa.int64()),
            "near_word": pa.array([None if i is None else members.words[i] for i in found], pa.string())})

    return run


def near_words(words: DataFrame, limit: int = LIMIT, visitors: int = VISITORS) -> DataFrame:
    """``words`` (word, n; each word once) with n_near and, of the near word with the largest n, near_n and near_word."""
    words = stored(words, "words")
    rows = words.count()
    size = max(limit, -(-rows // TOP))
    order = _spread(words)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column(0).to_pylist())[:, order]
            yield pa.RecordBatch.from_pydict({"counts": pa.array([v.tobytes() for v in vectors], pa.binary())})

    ways = [b""]
    if rows > size:
        ways = _top(stored(words.select("word").mapInArrow(counted, "counts binary"), "counts"), rows, size)
    visits = stored(words.select("word", "n").mapInArrow(_visits(ways, order), "node int, word string, n long, home boolean"), "visits")
    # A row per top node.
    sizes = visits.groupBy("node").agg(
        F.ceil(F.count("*") / visitors).cast("int").alias("chunks"), F.ceil(F.greatest(F.sum(F.col("home").cast("long")), F.lit(1)) / limit).cast("int").alias("blocks"))
    spread = F.xxhash64("word")
    chunk, block = F.pmod(spread, "chunks").cast("int"), F.pmod(F.shiftright(spread, 32), "blocks").cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    visiting = F.transform(each("blocks"), lambda b: F.struct(chunk.alias("chunk"), b.alias("block"), F.lit(False).alias("member")))
    at_home = F.transform(each("chunks"), lambda c: F.struct(c.alias("chunk"), block.alias("block"), F.lit(True).alias("member")))
    dealt = visits.join(F.broadcast(sizes), "node").withColumn(
        "to", F.explode(F.when(F.col("home"), F.concat(visiting, at_home)).otherwise(visiting)))
    found = dealt.select("node", "to.chunk", "to.block", "to.member", "word", "n", "home").groupBy("node", "chunk", "block").applyInArrow(
        _near_words(order), _FOUND)
    best = F.min(F.when(F.col("near_n").isNotNull(), F.struct((-F.col("near_n")).alias("n"), F.col("near_word").alias("word"))))
    summed = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return summed.select("word", "n", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.word").alias("near_word"))


def variants(words: DataFrame, times: int = 2, limit: int = LIMIT, visitors: int = VISITORS) -> DataFrame:
    """``words`` (word, n) with ``form`` (the near word with the largest n, if that is at least ``times`` this one's),
    ``root`` (the last of a word's forms, itself without one), n_near and form_n.

    Along forms n grows at least ``times``-fold, so there are no circles; roots are found by doubling the way.
    """
    fits = F.col("near_n") >= times * F.col("n")
    formed = stored(near_words(words, limit, visitors).select(
        "word", "n", "n_near", F.when(fits, F.col("near_word")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n")), "formed")
    links = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("at"), F.col("root").alias("on"))
        moved = stored(links.join(onward, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "forms")
        links = moved.select("word", "root")
        if not moved.filter("moved").head(1):
            break
    roots = links.withColumnRenamed("word", "at")
    return formed.join(roots, formed["word"] == roots["at"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
