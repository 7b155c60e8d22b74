"""Operator 7: nearest neighbours by a block matrix join in int8.

A vector is stored as round(x / s) in int8 with its own step s, and the norm
of what rounding lost. A tile (see ``_tiles``) multiplies the int8 matrices;
the product times both steps is within ``|q'| e_c + e_q |c'| + e_q e_c`` of
the true inner product (q', c' the rounded vectors, e the lost norms). The
k-th largest lower bound, or the k-th exact score so far, is a floor for the
result: pairs whose upper bound reaches it are recomputed in double precision
from the original vectors, dimension by dimension, and pushed on the query's
heap of k. No true neighbour can be lost, so the recall is 1.

Defined cases: vectors that are null, zero, or hold a null, NaN or infinite
component take no part, nor do null ids; vectors of different lengths are
compared as if padded with zeros; rows that repeat id and vector count once;
different vectors of one id are all candidates and, together, one query; a
query's candidates never include its own id; ties go to the smaller id; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import _tiles
from casebook.llm._common import table

_PAIRS = 1 << 18  # survivors recomputed at once


class Quantised:
    """int8 form of vectors: values, step, norm of the rounded, lost norm."""

    def __init__(self, m: np.ndarray):
        top = np.abs(m).max(axis=1, initial=0)
        self.step = np.maximum(top / 127, 1e-300)
        self.q8 = np.rint(m / self.step[:, None]).astype(np.int8)
        # the product of int8 rows is exact in float32 up to 1040 dimensions
        self.wide = self.q8.astype(np.float32 if m.shape[1] <= 1040 else np.float64)
        rounded = self.q8 * self.step[:, None]
        self.norm = np.linalg.norm(rounded, axis=1)
        self.lost = np.linalg.norm(m - rounded, axis=1)


class Int8Tile:
    """Queries of one tile and a heap of their best k candidates so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]  # (score, -id)
        self.form = Quantised(queries)

    def add(self, ids: np.ndarray, cands: np.ndarray) -> None:
        width = max(self.queries.shape[1], cands.shape[1])
        if self.queries.shape[1] < width:
            self.queries = _tiles.widen(self.queries, width)
            self.form = Quantised(self.queries)
        cands = _tiles.widen(cands, width)
        a, b = self.form, Quantised(cands)
        with np.errstate(over="ignore", invalid="ignore"):
            near = (a.wide @ b.wide.T).astype(np.float64) * a.step[:, None] * b.step
            slack = (np.outer(a.norm, b.lost) + np.outer(a.lost, b.norm) + np.outer(a.lost, b.lost)) * (1 + 1e-6)
            slack += 1e-12 * (a.norm + a.lost)[:, None] * (b.norm + b.lost)
            other = self.ids[:, None] != ids
            floor = np.array([h[0][0] if len(h) == self.k else -np.inf for h in self.heaps])
            if len(ids) > self.k + 1:
                low = np.where(other, near - slack, -np.inf)
                floor = np.fmax(floor, np.partition(low, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
            q, c = np.nonzero(other & ~(near + slack < floor[:, None]))
        for at in range(0, len(q), _PAIRS):
            self._push(q[at:at + _PAIRS], c[at:at + _PAIRS], ids, cands)

    def _push(self, q: np.ndarray, c: np.ndarray, ids: np.ndarray, cands: np.ndarray) -> None:
        score = np.zeros(len(q))
        for d in range(cands.shape[1]):  # one order of summation for all
            score += self.queries[q, d] * cands[c, d]
        push, swap, k, heaps = heapq.heappush, heapq.heappushpop, self.k, self.heaps
        for i, s, v in zip(q.tolist(), score.tolist(), ids[c].tolist()):
            h = heaps[i]
            if len(h) < k:
                push(h, (s, -v))
            elif (s, -v) > h[0]:
                swap(h, (s, -v))

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = [(i, -v, s) for i, h in enumerate(self.heaps) for s, v in h]
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, c, s = zip(*rows)
        return np.array(q), np.array(c, dtype=np.int64), np.array(s)


def usable_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part, v as doubles."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def nearest(df: DataFrame, k: int = 20, query_every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            **blocks) -> DataFrame:
    """query_id, rank, vec_id, score (double) of each query's k nearest."""
    return _tiles.search(usable_vectors(df, id_col, vec_col), Int8Tile, k, query_every, "double", **blocks)


def op7_ann_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
with v as (
  select distinct vec_id, cast(embedding as double[]) as v
  from embeddings
  where embedding is not null and vec_id is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""
