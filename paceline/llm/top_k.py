"""Exact top-k search by inner product, term at a time.

Queries and candidates are sparse rows: an id and postings (term, weight). Both sides are cut into
blocks of bounded size by a hash of the id, and every block of queries meets every block of
candidates in a task of its own. There the candidates' postings are grouped by term; a query row scatters
its weight times the postings of each of its terms into a dense array of scores, one per
candidate; a partition of that array selects the block's best, and the best of all blocks are merged per query.

Every pair of a query and a candidate is scored: the set of queries is stated, and this is what
exhaustive search means. Memory is that of one block of each side, whatever the input.

Defined cases: of repeated query ids the smallest row counts; repeated candidates are candidates each; rows
without an id or postings take no part; a candidate without a term in common scores 0 and counts; ties go
to the smaller id; weights are whole numbers in doubles and scores are exact, cut to the range of long; no
queries or no candidates give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a block: some megabytes at a few hundred terms a row.
QUERY_ROWS, CANDIDATE_ROWS = 8192, 8192
# Cells of scores held at once.
SCORES = 1 << 20


def postings(weights: Column) -> Column:
    """A dense array of doubles as postings of the terms that are not zero."""
    pairs = F.transform(weights, lambda w, i: F.struct(i.cast("int").alias("term"), w.alias("weight")))
    return F.filter(pairs, lambda p: p["weight"] != 0)


def _by_row(table: pa.Table):
    """Ids, and for all postings their row, term and weight."""
    lists = table.column("postings").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten()
    counts = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(counts)), counts)
    return (table.column("id").to_numpy(), row, flat.field("term").to_numpy(zero_copy_only=False),
            flat.field("weight").to_numpy(zero_copy_only=False))


def _by_term(row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    order = np.argsort(term, kind="stable")
    terms, starts = np.unique(term[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    return {int(t): (row[order[a:b]], weight[order[a:b]]) for t, a, b in zip(terms, starts, ends)}


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores first, then smaller ids."""
    if len(scores) > k:
        if scores.dtype == object:
            least = sorted(scores, reverse=True)[k - 1]
        else:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return np.array(sorted(at.tolist(), key=lambda i: (-scores[i], ids[i]))[:k], dtype=int)


def score_block(k: int):
    def score(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if queries.num_rows and candidates.num_rows:
            q_id, q_row, q_term, q_weight = _by_row(queries)
            c_id, c_row, c_term, c_weight = _by_row(candidates)
            top = lambda w: float(np.abs(w).max(initial=0))
            longest = max(np.bincount(q_row).max(initial=0), 1)
            kind = np.int64 if top(q_weight) * top(c_weight) * longest < 2.0**62 else object
            exact = (lambda w: w.astype(np.int64)) if kind is np.int64 else (lambda w: np.array([int(x) for x in w], object))
            index = _by_term(c_row, c_term, exact(c_weight))
            q_weight = exact(q_weight)
            step = max(1, SCORES // len(c_id))
            for first in range(0, len(q_id), step):
                here = (q_row >= first) & (q_row < first + step)
                scores = np.zeros((min(step, len(q_id) - first), len(c_id)), kind)
                for term, (rows, weights) in _by_term(q_row[here] - first, q_term[here], q_weight[here]).items():
                    if term in index:
                        to, values = index[term]
                        if len(to) == len(c_id):
                            scores[rows] += weights[:, None] * values[None, :]
                        else:
                            scores[rows[:, None], to[None, :]] += weights[:, None] * values[None, :]
                for i, row in enumerate(scores):
                    others = np.flatnonzero(c_id != q_id[first + i])
                    best = others[_best(row[others], c_id[others], k)]
                    out[0].extend([int(q_id[first + i])] * len(best))
                    out[1].extend(c_id[best].tolist())
                    out[2].extend(max(-(2**63), min(2**63 - 1, int(x))) for x in row[best])
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("query_id", "id", "score"), out)})

    return score


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS
) -> DataFrame:
    """(query_id, rank, id, score): the k best candidates of each query, other than itself.

    Both inputs have ``id`` (long) and ``postings`` (array of struct of term int, weight double).
    """
    usable = "id is not null and postings is not null"
    asked = queries.filter(usable).groupBy("id").agg(F.min("postings").alias("postings"))
    there = candidates.filter(usable).select("id", "postings")
    many = queries.filter(usable).select(F.count("*")).first()[0], there.select(F.count("*")).first()[0]
    cuts = [max(1, -(-n // rows)) for n, rows in zip(many, (query_rows, candidate_rows))]
    block = lambda n: F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = asked.select("id", "postings", block(cuts[0]).alias("qb"), every(cuts[1]).alias("cb"))
    right = there.select("id", "postings", every(cuts[0]).alias("qb"), block(cuts[1]).alias("cb"))
    best = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(
        score_block(k), "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
