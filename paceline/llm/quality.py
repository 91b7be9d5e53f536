"""Quality of texts by a convolutional network over bytes, in numpy.

A text's bytes are covered from end to end by chunks of ``CHUNK`` bytes, each overlapping the next by half.
Learned filters of ``WIDTH`` bytes run over a chunk, the largest answer of each is kept (so a chunk is told by
what occurs in it, and by what never does), and a small dense layer makes a probability of it. The
text's probability is the mean over its chunks, whatever its length.

A filter is a table of weights per byte and place, so running it is looking up and adding; places are
taken in twos, by tables over pairs of bytes. Training is gradient descent (Adam) written out: through the maximum
only the place that won learns. It sees at most ``SAMPLE`` labelled texts of each class, the ones with the smallest
hashes of their ids, each whole, in windows of ``CHUNK`` bytes end to end; that is all the driver ever holds.
Windows of a text share the weight of that text.

Defined cases: a null text is empty, an empty text is one chunk of nothing and gets the score of that; with
labels of one class only, the score is that class's share by add-one counting; null ids are scored and never
learned from; several labels of one id count as the highest; rows that repeat are scored each, and of texts that share an id
the smallest is learned from; an empty table has no scores; extra columns pass untouched, but for one with the
name of the score, which is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from paceline.llm.tables import text_of

CHUNK, WIDTH, FILTERS, HIDDEN = 512, 4, 20, 16
SAMPLE = 1500
EPOCHS, BATCH, RATE = 3, 64, 0.01
# Few windows are gone over more often, until there were this many steps.
STEPS = 800
THRESHOLD = 0.7
# Positions whose answers are held at once.
SLICE = 200_000


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    inner: np.ndarray  # (FILTERS + 1) x HIDDEN, the last row for how full a chunk is
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.inner, self.inner_bias, self.outer, self.outer_bias]

    def head(self, peaks: np.ndarray, full: np.ndarray):
        seen = np.concatenate([np.maximum(peaks + self.bias, 0), full[:, None]], axis=1)
        hidden = np.tanh(seen @ self.inner + self.inner_bias)
        logit = hidden @ self.outer + self.outer_bias[0]
        return seen, hidden, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def train(windows: Sequence[bytes], labels: Sequence[int], seed: int = 0, shares: Sequence[float] | None = None) -> Network:
    """A network that tells windows, of at most ``CHUNK`` bytes, of label 1 from those of label 0; ``shares`` are
    the windows' weights."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.1, (WIDTH, 256, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, (FILTERS + 1, HIDDEN)),
        np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1),
    )
    raw = np.zeros((len(windows), CHUNK + WIDTH - 1), np.uint8)
    for i, w in enumerate(windows):
        raw[i, : len(w)] = np.frombuffer(w, np.uint8)
    full = np.array([len(w) / CHUNK for w in windows])
    target = np.array(labels, np.float64)
    # Both classes weigh the same.
    weight = np.ones(len(windows)) if shares is None else np.array(shares, np.float64)
    weight = weight / max(weight.mean(), 1e-9)
    share = max((target * weight).mean(), 1e-9)
    weight = weight * np.where(target == 1, 0.5 / share, 0.5 / max(1 - share, 1e-9))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    step = 0
    epochs = max(EPOCHS, -(-STEPS // max(1, -(-len(windows) // BATCH))))
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        rate = RATE * (1 - epoch / epochs) + RATE / 10
        for at in range(0, len(order), BATCH):
            mine = order[at : at + BATCH]
            x = raw[mine]
            table = net.filters.astype(np.float32)
            answers = sum(table[k][x[:, k : k + CHUNK]] for k in range(WIDTH))
            winner = answers.argmax(axis=1)
            peaks = np.take_along_axis(answers, winner[:, None, :], 1)[:, 0].astype(np.float64)
            seen, hidden, p = net.head(peaks, full[mine])
            slope = (p - target[mine]) * weight[mine] / len(mine)
            to_hidden = slope[:, None] * net.outer * (1 - hidden**2)
            to_peaks = (to_hidden @ net.inner.T)[:, :-1] * (peaks + net.bias > 0)
            to_filters = np.zeros_like(net.filters)
            row, which = np.arange(len(mine))[:, None], np.arange(FILTERS)[None, :]
            for k in range(WIDTH):
                np.add.at(to_filters[k], (x[row, winner + k], which), to_peaks)
            slopes = [to_filters, to_peaks.sum(0), seen.T @ to_hidden, to_hidden.sum(0), hidden.T @ slope, slope.sum(keepdims=True)]
            step += 1
            for part, g, (m, v) in zip(net.parts(), slopes, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def with_short(windows: Sequence[bytes], labels: Sequence[int], seed: int = 0) -> tuple[list[bytes], list[int]]:
    """The windows, and of each a short cut of 12 to 160 bytes: short texts are to be judged as well."""
    rng = np.random.default_rng(seed)
    sizes = np.exp(rng.uniform(np.log(12), np.log(160), len(windows))).astype(int)
    cuts = []
    for w, size in zip(windows, sizes.tolist()):
        at = int(rng.integers(0, max(1, len(w) - size + 1)))
        cuts.append(w[at : at + size])
    return [*windows, *cuts], [*labels, *labels]


def pair_tables(net: Network) -> list[np.ndarray]:
    """For each two neighbouring places of a filter: the sum of its weights by pair of bytes."""
    return [
        (net.filters[k][:, None, :] + net.filters[k + 1][None, :, :]).reshape(65536, -1).astype(np.float32) for k in range(0, WIDTH, 2)
    ]


def score_texts(net: Network, tables: list[np.ndarray], texts: Sequence[bytes]) -> np.ndarray:
    """The probability of label 1 for each whole text."""
    half = CHUNK // 2
    lengths = np.array([len(t) for t in texts], np.int64)
    if not len(lengths):
        return np.empty(0)
    gap = b"\0" * WIDTH
    raw = np.frombuffer(gap.join(texts) + gap + gap, np.uint8)
    begin = np.cumsum(lengths + WIDTH) - (lengths + WIDTH)
    blocks = np.maximum(1, -(-lengths // half))
    of = np.repeat(np.arange(len(lengths)), blocks)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = begin[of] + inside * half
    ends = np.minimum(starts + half, begin[of] + np.maximum(lengths[of], 1))
    peaks = np.empty((len(of), FILTERS), np.float32)
    pairs = raw[:-1].astype(np.uint16) << 8 | raw[1:]
    at = 0
    while at < len(of):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, side="right")))
        a, b = starts[at], ends[to - 1]
        answers = tables[0][pairs[a:b]]
        for k, table in enumerate(tables[1:], 1):
            answers += table[pairs[a + 2 * k : b + 2 * k]]
        # The bytes between two texts belong to no block: reduce over blocks and gaps, keep the blocks.
        edges = np.stack([starts[at:to], ends[at:to]], axis=1).ravel() - a
        keep = np.flatnonzero(np.diff(np.append(edges, b - a)) > 0)
        peaks[at + keep[keep % 2 == 0] // 2] = np.maximum.reduceat(answers, edges[keep], axis=0)[keep % 2 == 0]
        at = to
    # A chunk is a block and the next one; a text of one block is one chunk.
    first = np.flatnonzero((inside + 1 < blocks[of]) | (blocks[of] == 1))
    second = np.where(blocks[of[first]] == 1, first, first + 1)
    size = (ends - starts)[first] + np.where(second > first, (ends - starts)[second], 0)
    size = np.where(lengths[of[first]] == 0, 0, size)
    _, _, p = net.head(np.maximum(peaks[first], peaks[second]).astype(np.float64), size / CHUNK)
    return np.bincount(of[first], p, len(lengths)) / np.bincount(of[first], minlength=len(lengths))


def held_out(id: Column) -> Column:
    """Is a row kept for testing: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE):
    """A network from at most ``sample`` labelled texts of each class, or the share of label 1 if there is one class."""
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(F.col(id)))
        .groupBy(F.col(id).alias("_id")).agg(F.max(label).alias("_label"))
    )
    chosen = [known.filter(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(sample) for c in (0, 1)]
    # At most 2 * sample short rows.
    texts = docs.select(F.col(id).alias("_doc"), text_of(text).alias("_text"))
    some = texts.join(F.broadcast(chosen[0].union(chosen[1])), F.col("_doc") == F.col("_id"))
    rows = sorted(tuple(r) for r in some.groupBy("_id", "_label").agg(F.min("_text")).collect())
    marks = [r[1] for r in rows]
    if len(set(marks)) < 2:
        return (sum(marks) + 1) / (len(marks) + 2)
    windows, of = [], []
    for i, row in enumerate(rows):
        whole = row[2].encode()
        cut = [whole[at : at + CHUNK] for at in range(0, max(len(whole), 1), CHUNK)]
        windows += cut
        of += [i] * len(cut)
    counts = np.bincount(of)
    # A short cut of one window of each text, with the weight of a whole text.
    first = np.cumsum(counts) - counts
    picked = [windows[at + zlib.crc32(str(row[0]).encode()) % n] for at, n, row in zip(first.tolist(), counts.tolist(), rows)]
    cuts = with_short(picked, marks)[0][len(picked) :]
    return train([*windows, *cuts], [*(marks[i] for i in of), *marks], shares=[*(1 / counts[of]), *np.ones(len(cuts))])


def score(docs: DataFrame, model: Network | float, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text."""
    docs = docs.drop(name)
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    arrow = to_arrow_schema(schema)
    place = docs.columns.index(text)

    def run(batches):
        net = shared.value
        tables = pair_tables(net)
        for batch in batches:
            column = batch.column(place).cast(pa.binary()).fill_null(b"")
            scores: list[np.ndarray] = []
            lengths = np.array(pc.binary_length(column)) + WIDTH
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // 4_000_000)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                scores.append(score_texts(net, tables, column.slice(a, b - a).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores))], schema=arrow)

    return docs.mapInArrow(run, schema)
