"""Byte-level BPE by a global shuffle of distinct words.

Encoding: each task splits its texts into pre-tokens; the place of a pre-token in its text is its place in the
text's list of numbers, which point into the distinct words of the chunk of texts. Words go, once per
chunk, to the task of their bucket, where every distinct word is encoded exactly once, and its ids
return to the chunks that hold it. There the numbers of each text are replaced by ids in order. A word that
is in every text travels once per chunk, so it is no hot key; bucket rows hold a handful of words each.

One shuffle brings words to buckets and the lists to where their chunk will be put together; a second
one brings the ids back. Both are packed and compressed. A task holds one chunk (``CHUNK`` characters,
or one longer text) or the distinct words of one bucket.

Decoding joins the ids with the table of token bytes, which has a fixed size and is sent to all tasks.

Defined cases: null text is empty and has no ids; empty tables give no rows; repeated rows each get
their own result; kept columns of any name and type pass through, others are left out; a null list of ids decodes
to nothing.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from paceline.llm.pretokens import (
    END_POINT,
    code_points,
    distinct_slices,
    gathered,
    packed,
    pretoken_starts,
    unpacked,
)
from paceline.llm.tables import text_of

# Characters of a chunk, and of the batches it is split in; buckets of words in a chunk.
CHUNK, BATCH, BUCKETS = 8_000_000, 500_000, 1024


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Chunk:
    """Texts of a task, split, with their distinct words."""

    def __init__(self):
        self.words: dict[str, int] = {}
        self.lists: list[np.ndarray] = []
        self.rows: list[pa.RecordBatch] = []
        self.size = 0

    def add(self, kept: pa.RecordBatch, texts: list[str]) -> None:
        points = code_points(texts)
        starts = pretoken_starts(points)
        ends = np.append(starts[1:], len(points))
        real = points[starts] != END_POINT
        texts_of = np.cumsum(~real)[real]
        starts, ends = starts[real], ends[real]
        first, which = distinct_slices(points, starts, ends)
        joined = "\0".join(texts)
        words = self.words
        number = np.array(
            [words.setdefault(joined[a:b], len(words)) for a, b in zip(starts[first].tolist(), ends[first].tolist())], np.uint32)
        self.lists.extend(np.split(number[which] if len(which) else np.empty(0, np.uint32),
                                   np.searchsorted(texts_of, np.arange(1, len(texts)))))
        self.rows.append(kept)
        self.size += len(points)

    def out(self, key: int, schema: pa.Schema):
        """Rows of words for the buckets, then a row for each text; frequent words get small numbers."""
        counts = np.bincount(np.concatenate(self.lists), minlength=len(self.words)) if self.lists else np.zeros(0, int)
        rank = np.empty(len(counts), np.uint32)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts), dtype=np.uint32)
        buckets: dict[int, tuple[list, list]] = {}
        for word, number in self.words.items():
            raw = word.encode("utf-8", "surrogatepass")
            names, numbers = buckets.setdefault(zlib.crc32(raw) % BUCKETS, ([], []))
            names.append(raw)
            numbers.append(rank[number])
        payload = [packed(np.array(n), np.array([len(w) for w in ws]), b"".join(ws)) for ws, n in buckets.values()]
        kept = pa.Table.from_batches(self.rows)
        nothing = {f.name: pa.nulls(len(payload), f.type) for f in kept.schema}
        yield self._batch(schema, [-1 - b for b in buckets], key, payload, [None] * len(payload), pa.table(nothing, schema=kept.schema))
        for at in range(0, len(self.lists), 1000):
            lists = [packed(rank[x]) for x in self.lists[at : at + 1000]]
            yield self._batch(schema, [key] * len(lists), key, [None] * len(lists), lists, kept.slice(at, 1000))

    @staticmethod
    def _batch(schema: pa.Schema, keys: list, chunk: int, words: list, lists: list, kept: pa.Table) -> pa.RecordBatch:
        own = [pa.array(keys, pa.int64()), pa.array([chunk] * len(keys), pa.int64()), pa.array(words, pa.binary()), pa.array(lists, pa.binary())]
        return pa.RecordBatch.from_arrays([*own, *[c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in kept.columns]], schema=schema)


def _split(schema: pa.Schema, chunk_size: int):
    def split(batches):
        from pyspark import TaskContext

        key, chunk = TaskContext.get().partitionId() << 24, Chunk()
        for batch in batches:
            kept = batch.select(batch.schema.names[1:])
            texts = batch.column(0)
            lengths = np.array(pc.utf8_length(texts)) + 1
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // BATCH)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if chunk.size and chunk.size + lengths[a:b].sum() > chunk_size:
                    yield from chunk.out(key, schema)
                    key, chunk = key + 1, Chunk()
                chunk.add(kept.slice(a, b - a), texts.slice(a, b - a).to_pylist())
        if chunk.size:
            yield from chunk.out(key, schema)

    return split


def _encode(ranks, pattern: str):
    def encode(batches):
        import tiktoken

        piece = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})._core_bpe.encode_single_piece
        known: dict[bytes, list[int]] = {}
        bucket = None
        for batch in batches:
            chunks, out = [], []
            for key, chunk, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if payload is None:
                    continue
                if key != bucket:  # rows come sorted by key
                    bucket, known = key, {}
                numbers, lengths, raw = unpacked(payload, int, int, bytes)
                ids, ends = [], np.cumsum(lengths).tolist()
                for a, b in zip([0, *ends], ends):
                    word = raw[a:b]
                    got = known.get(word)
                    if got is None:
                        got = known[word] = piece(word)
                    ids.append(got)
                chunks.append(chunk)
                out.append(packed(numbers, np.array([len(i) for i in ids]), np.array([x for i in ids for x in i])))
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(out, pa.binary())], ["chunk", "ids"])

    return encode


def _assemble(schema: pa.Schema):
    def assemble(texts: pa.Table, words: pa.Table) -> pa.Table:
        texts = texts.filter(texts.column("list").is_valid())
        if not texts.num_rows:
            return schema.empty_table()
        parts = [unpacked(v, int, int, int) for v in words.column("ids").to_pylist()]
        if parts:
            number, length, flat = (np.concatenate([p[i] for p in parts]) for i in range(3))
        else:
            number, length, flat = (np.empty(0, np.uint32),) * 3
        begins = np.cumsum(length, dtype=np.int64) - length
        size = np.zeros(len(number) + 1, np.int64)
        size[1:][number] = length
        offsets = np.cumsum(size)
        order = np.empty(len(number), np.int64)
        order[number] = begins
        flat = gathered(flat, np.append(begins, len(flat)), np.argsort(number, kind="stable"))
        ids = [gathered(flat, offsets, unpacked(v, int)[0].astype(np.int64)).astype("<u4").tobytes() for v in texts.column("list").to_pylist()]
        kept = [texts.column(name) for name in schema.names[:-1]]
        return pa.Table.from_arrays([*kept, pa.array(ids, pa.binary())], schema=schema)

    return assemble


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",),
    ids: str = "ids", chunk: int = CHUNK,
) -> DataFrame:
    """``keep`` and ``ids``: the ids of each text as little-endian unsigned 32-bit numbers.

    ``docs`` should be a stored table: words are numbered in the order of its rows, so a task that is run again
    must read the same rows. The one ``pattern`` there is stands written out in ``pretokens``; another is an error.
    """
    if pattern != PATTERN:
        raise ValueError("only public_tokenizers.PATTERN is split by")
    spark = docs.sparkSession
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(text_of(text).alias("t"), *[F.col(k).alias(n) for k, n in zip(keep, names)])
    kept = [T.StructField(f.name, f.dataType) for f in rows.schema.fields[1:]]
    own = [T.StructField("key", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("words", T.BinaryType()),
           T.StructField("list", T.BinaryType())]
    split = T.StructType([*own, *kept])
    out = T.StructType([*kept, T.StructField("ids", T.BinaryType())])
    table = spark.sparkContext.broadcast(ranks)
    # Both uses read the same shuffle: its lists are at home already, its words go on.
    dealt = rows.mapInArrow(_split(to_arrow_schema(split), chunk), split).repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(_encode(table, pattern), "chunk long, ids binary")
    whole = dealt.groupBy("key").cogroup(found.groupBy("chunk")).applyInArrow(_assemble(to_arrow_schema(out)), out)
    return whole.select(*[F.col(n).alias(k) for n, k in zip(names, keep)], F.col("ids").alias(ids))


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for; a column of the name ``decoded`` is replaced."""
    df = df.drop(decoded)
    tokens = sorted(ranks, key=ranks.get)
    size = max(ranks.values(), default=-1) + 1
    lengths = np.zeros(size + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank + 1] = len(token)
    table = df.sparkSession.sparkContext.broadcast((np.cumsum(lengths), b"".join(tokens)))
    schema = T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())])
    place = df.columns.index(ids)

    def join(batches):
        offsets, raw = table.value
        flat = np.frombuffer(raw, np.uint8)
        for batch in batches:
            found = [gathered(flat, offsets, np.frombuffer(v or b"", "<u4").astype(np.int64)).tobytes() for v in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, decoded])

    return df.mapInArrow(join, schema)
