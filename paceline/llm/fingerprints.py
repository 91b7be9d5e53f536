"""Document fingerprints by a randomised edit embedding.

All texts walk with the same coins: at step t the walk writes the character under its pointer and moves on if
the coin of step t and that character says so. Texts that differ by few edits meet again after few steps and
then write the same, so edit distance becomes Hamming distance between what was written. A character is
written with the three before it, which makes chance agreement rare. A walk ends with its text, so all of the
text is written and nothing else. Walks of two texts can stay apart for long after one edit, though rarely;
there are ``WALKS`` of them, with coins of their own.

A fingerprint samples ``SAMPLES`` steps of the walks in turn, eight bits each. Which step sample k looks at is the step
below the walk's length with the least random number of k: walks of nearly the same length look at nearly the
same steps, walks of the same length at exactly the same. The likeness of two fingerprints is the share of
equal samples. A search puts runs of ``ROWS`` samples into bands, joins queries with documents on bands and
verifies what meets: likeness of whole fingerprints, then edit distance if it is asked for.

The walk runs over slices of ``SLICE`` characters and keeps, besides a slice, ``SAMPLES`` numbers. Coins repeat
after ``PERIOD`` steps; walks that are in step stay so.

Defined cases: null is the empty text; the empty text has a fingerprint of zeros, like no other text's; texts
that are equal have equal fingerprints; a table without rows gives none. In ``with_next`` documents follow each
other by id (null first), then by a hash of their text; a repeated row is followed by itself; the last is
followed by the first, a single document by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.tables import fresh, stored, text_of

SAMPLES = 128
WALKS = 2
ROWS = 4  # samples of a band
PERIOD = 256  # coins of a kind of character
KINDS = 64  # of coins: characters alike in six bits of a hash share them
SLICE = 1 << 16
WINDOW = 4
SEED = 12


def _mix(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of each number (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x.astype("u8") + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _kinds() -> np.ndarray:
    """A byte of each code point's hash."""
    return _mix(np.arange(0x110000, dtype="u8") + np.uint64(SEED << 32)).astype("u1")


@lru_cache(WALKS)
def _steps(walk: int) -> list[list]:
    """The walk as an automaton: from step t, ``node[kind]`` is the node of the first step after the character is
    left; ``node[KINDS]`` is t itself, below ``PERIOD``."""
    at, kind = np.meshgrid(np.arange(PERIOD, dtype="u8"), np.arange(KINDS, dtype="u8"), indexing="ij")
    leaves = (_mix(_mix(at) ^ (kind << np.uint64(32)) ^ np.uint64((SEED << 48) + (walk << 40))) & np.uint64(1)).astype(bool)
    after = np.zeros((PERIOD, KINDS), "i8")
    behind = np.zeros(KINDS, "i8")
    for t in range(2 * PERIOD - 1, -1, -1):
        behind = np.where(leaves[t % PERIOD], t + 1, behind)
        if t < PERIOD:
            after[t] = behind % PERIOD
    nodes: list[list] = [[] for _ in range(PERIOD)]
    for t, row in enumerate(after.tolist()):
        nodes[t].extend(nodes[x] for x in row)
        nodes[t].append(t)
    return nodes


@lru_cache(1)
def _records() -> list[tuple[np.ndarray, np.ndarray]]:
    """Per walk, the steps that have the least random number so far of one of its samples, in ascending order, and
    the samples.

    Of n steps with uniform numbers the next to lie below the least one, m, is a geometric wait away.
    """
    at, least, found = np.zeros(SAMPLES, "i8"), np.ones(SAMPLES), []
    sample = np.arange(SAMPLES)

    def uniform(turn: int) -> np.ndarray:
        numbers = _mix(sample.astype("u8") * np.uint64(1009) + np.uint64((SEED << 40) + turn))
        return np.maximum((numbers >> np.uint64(11)) / 2.0**53, 2.0**-53)

    for turn in range(400):
        if turn:
            wait = np.ceil(np.log(uniform(2 * turn)) / np.log1p(-np.minimum(least, 1 - 2.0**-53)))
            at = at + np.clip(wait, 1, 2.0**50).astype("i8")
        least = least * uniform(2 * turn + 1)
        going = at < 2**50
        if not going.any():
            break
        found.append(np.stack([at[going], sample[going]]))
        at = np.where(going, at, 2**51)
    steps, samples = np.concatenate(found, axis=1)
    order = np.lexsort((samples, steps))
    steps, samples = steps[order], samples[order]
    return [(steps[samples % WALKS == w], samples[samples % WALKS == w]) for w in range(WALKS)]


class Walk:
    """The walks over a text that is given piece by piece."""

    def __init__(self) -> None:
        self.nodes, self.steps, self.tail = [_steps(w)[0] for w in range(WALKS)], [0] * WALKS, bytes(WINDOW - 1)
        self.values = np.zeros(SAMPLES, "u1")

    def copy(self) -> Walk:
        other = Walk.__new__(Walk)
        other.nodes, other.steps, other.tail, other.values = self.nodes[:], self.steps[:], self.tail, self.values.copy()
        return other

    def feed(self, text: str) -> Walk:
        for i in range(0, len(text), SLICE):
            self._slice(text[i : i + SLICE])
        return self

    def _slice(self, text: str) -> None:
        kinds = _kinds()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        coins = (kinds % KINDS).tobytes()
        behind = np.frombuffer(self.tail + kinds.tobytes(), "u1")
        for walk, (at, sample) in enumerate(_records()):
            nodes = list(accumulate(coins, getitem, initial=self.nodes[walk]))
            stay = np.diff(np.frombuffer(bytes(map(itemgetter(KINDS), nodes)), "u1")).astype("i8")
            starts = self.steps[walk] + np.concatenate([[0], np.cumsum(np.where(stay == 0, PERIOD, stay))])
            low, high = np.searchsorted(at, starts[[0, -1]])
            seen = np.searchsorted(starts, at[low:high], side="right") - 1
            written = np.zeros(len(seen), "u8")
            for back in range(WINDOW):
                written = written << np.uint64(8) | behind[seen + WINDOW - 1 - back].astype("u8")
            drawn = _mix(written ^ (sample[low:high].astype("u8") << np.uint64(40)))
            # Of several records of a sample the last one counts, as numpy assigns in order.
            self.values[sample[low:high]] = drawn % np.uint64(255) + np.uint64(1)
            self.nodes[walk], self.steps[walk] = nodes[-1], int(starts[-1])
        self.tail = behind[-(WINDOW - 1) :].tobytes()

    def hex(self) -> str:
        return self.values.tobytes().hex()


def fingerprint(text: str) -> str:
    return Walk().feed(text).hex()


def likeness(one: Column, other: Column) -> Column:
    """The share of equal samples of two fingerprints."""
    same = lambda k: (F.substring(one, 2 * k + 1, 2) == F.substring(other, 2 * k + 1, 2)).cast("int")
    return sum((same(k) for k in range(1, SAMPLES)), same(0)) / SAMPLES


def bands(print_: Column) -> Column:
    """Hashes of the fingerprint's bands, each with its place."""
    wide = 2 * ROWS
    return F.array(*[F.xxhash64(F.lit(b), F.substring(print_, wide * b + 1, wide)) for b in range(SAMPLES // ROWS)])


def fingerprints(docs: DataFrame, name: str = "fingerprint", text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint of a text column; a column of that name is replaced."""
    rest = docs.drop(name)
    out = rest.select("*", F.lit("").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = out.names.index(text)
        for batch in batches:
            prints = [fingerprint(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], names=out.names)

    return rest.mapInArrow(run, out)


def search(queries: DataFrame, docs: DataFrame, least: float = 0.5, edits: int | None = None) -> DataFrame:
    """(query_id, doc_id, likeness): documents that share a band with a query and are at least that like it, the
    query's own id left out; with ``edits`` also at most so many edits away (``distance``).

    Both tables have doc_id, text and fingerprint. Equal fingerprints meet once: bands join distinct
    fingerprints, pairs that are left join the documents. Empty texts are like no other, so they take no part.
    """
    def distinct(df: DataFrame, as_: str) -> DataFrame:
        one = df.select(F.col("fingerprint").alias(as_)).filter(F.col(as_) != "00" * SAMPLES).distinct()
        return one.select(as_, F.explode(bands(F.col(as_))).alias("band"))

    met = distinct(queries, "query").join(distinct(docs, "found"), "band").select("query", "found").distinct()
    alike = met.withColumn("likeness", likeness(F.col("query"), F.col("found"))).filter(F.col("likeness") >= least)
    pairs = queries.select(F.col("fingerprint").alias("query"), F.col("doc_id").alias("query_id"), text_of("text").alias("query_text")).join(
        alike, "query").join(docs.select(F.col("fingerprint").alias("found"), "doc_id", text_of("text").alias("text")), "found")
    pairs = pairs.filter("query_id <> doc_id")
    if edits is None:
        return pairs.select("query_id", "doc_id", "likeness")
    far = F.levenshtein("query_text", "text", edits)
    return pairs.withColumn("distance", far).filter("distance >= 0").select("query_id", "doc_id", "likeness", "distance")


class _Seen:
    """A document whose next one is not there yet."""

    def __init__(self, doc_id: int | None, text: str) -> None:
        self.doc_id, self.text = doc_id, text
        self.cut = len(text) // 2
        self.half = Walk().feed(text[: len(text) - self.cut])
        self.whole = self.half.copy().feed(text[len(text) - self.cut :])

    def edited(self, text: str, print_: np.ndarray) -> dict:
        """Given the next document: the last half replaced by its beginning."""
        begin = text[: self.cut]
        walk = self.half.feed(begin)
        edited = self.text[: len(self.text) - self.cut] + begin
        return {
            "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(), "edited_fingerprint": walk.values.tobytes(),
            "near_edited": float(np.mean(walk.values == self.whole.values)), "near_next": float(np.mean(print_ == self.whole.values)),
        }


# Fingerprints as bytes until the end: they are stored once on the way.
_EDITED = "edited_sha256 string, edited_fingerprint binary, near_edited double, near_next double"
_OUT = f"doc_id long, n_chars long, fingerprint binary, {_EDITED}"
_EDGES = f"{_OUT}, part int, first_text string, last_text string"


def _table(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in fields]))


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a partition in their order; the first and the last one keep their text."""
    part, last, first = TaskContext.get().partitionId(), None, None
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            now = _Seen(doc_id, text)
            if last is None:
                first = text
            else:
                out.append(_row(last, part, first) | last.edited(text, now.whole.values))
                first = None
            last = now
        yield _table(out, _EDGES)
    if last is not None:
        yield _table([_row(last, part, first) | {"last_text": last.text}], _EDGES)


def _row(seen: _Seen, part: int, first: str | None) -> dict:
    return {"doc_id": seen.doc_id, "n_chars": len(seen.text), "fingerprint": seen.whole.values.tobytes(), "part": part, "first_text": first}


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last documents of partitions with the first one of the next partition."""
    for batch in batches:
        out = []
        for doc_id, text, after, print_ in zip(*(c.to_pylist() for c in batch.columns)):
            seen = _Seen(doc_id, text)
            out.append({"doc_id": doc_id, "n_chars": len(text), "fingerprint": seen.whole.values.tobytes()}
                       | seen.edited(after, np.frombuffer(print_, "u1")))
        yield _table(out, _OUT)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint, and of the text whose last half is replaced by the beginning of the next
    document: edited_sha256, edited_fingerprint, near_edited; near_next: the likeness to the next document.

    Documents are dealt out by ranges of their order and read in order, one at a time; only the first and the
    last text of each partition go to a second, small step.
    """
    salt = fresh(docs, "salt")
    rows = docs.select("doc_id", text_of("text").alias("text")).withColumn("hash", F.xxhash64("text")).withColumn(salt, F.monotonically_increasing_id())
    keys = ["doc_id", "hash", salt]  # the salt deals out rows that are alike in all else
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    done = stored(ordered.mapInArrow(_follow, _EDGES), "followed")
    # A number per partition.
    parts = sorted(r.part for r in done.filter("first_text is not null").select("part").collect())
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, after int")
    first = done.filter("first_text is not null").select(F.col("part").alias("after"), "first_text", F.col("fingerprint").alias("first_print"))
    last = done.filter("last_text is not null").select("doc_id", "last_text", "part")
    edges = last.join(after, "part").join(first, "after").select("doc_id", "last_text", "first_text", "first_print")
    names = [f.split(" ")[0] for f in _OUT.split(", ")]
    whole = done.filter("last_text is null").select(*names).union(edges.mapInArrow(_across, _OUT).select(*names))
    return whole.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
