"""Operator 2: exact top-k inner products by columnar branch and bound.

Vectors are integers, floor(scale * x). A tile (see ``_tiles``) keeps its
candidates in vertical layout, one array per block of dimensions, heaviest
dimensions first. Scores are accumulated block by block; after each block a
pair survives only if its score so far plus the most that the remaining mass
of both vectors can add (Cauchy-Schwarz) reaches the query's k-th best score.
Survivors are compacted to a list of pairs as soon as they are few. The bound
is never below the true score, and pairs that tie with the k-th best survive,
so the result is exact.

Defined cases: vectors that are null or hold a null, NaN or infinite component
take no part, nor do null ids; vectors of different lengths are compared as if
padded with zeros; rows that repeat id and vector count once; different
vectors of one id are all candidates and, together, one query; a query's
candidates never include its own id; components beyond the 64-bit range
saturate and sums of products beyond it wrap around; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import _tiles
from casebook.llm._common import table

_DENSE = 0.1   # share of a tile's pairs below which survivors are listed
_SEED = 256    # candidates scored in full to begin with
_EXACT = float(1 << 53)


class BoundTile:
    """Queries of one tile and their best k candidates so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.q, self.c, self.s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _keep(self, q: np.ndarray, c: np.ndarray, s: np.ndarray) -> None:
        self.q, self.c, self.s = _tiles.merge_best(np.concatenate([self.q, q]), np.concatenate([self.c, c]),
                                                   np.concatenate([self.s, s.astype(np.int64)]), self.k)

    def _full(self, ids: np.ndarray, cands: np.ndarray) -> None:
        score = self.queries @ cands.T
        q, c = np.nonzero(self.ids[:, None] != ids)
        self._keep(q, ids[c], score[q, c])

    def _wrapped(self, ids: np.ndarray, cands: np.ndarray) -> None:
        """Components too large for exact double sums: 64-bit integers."""
        to_long = lambda m: np.where(m >= 2.0 ** 63, np.iinfo(np.int64).max, np.clip(m, -2.0 ** 63, 2.0 ** 62 * 1.99)).astype(np.int64)
        score = to_long(self.queries) @ to_long(cands).T
        q, c = np.nonzero(self.ids[:, None] != ids)
        self._keep(q, ids[c], score[q, c])

    def add(self, ids: np.ndarray, cands: np.ndarray) -> None:
        width = max(self.queries.shape[1], cands.shape[1])
        self.queries, cands = _tiles.widen(self.queries, width), _tiles.widen(cands, width)
        if np.abs(self.queries).max(initial=0) * np.abs(cands).max(initial=0) * max(width, 1) >= _EXACT:
            self._wrapped(ids, cands)
            return
        if len(self.q) < len(self.ids) * self.k:  # not every query has k yet
            self._full(ids[:_SEED], cands[:_SEED])
            ids, cands = ids[_SEED:], cands[_SEED:]
        if not len(ids) or not width:
            if len(ids):
                self._full(ids, cands)
            return
        least = _tiles.kth_best(self.q, self.s, len(self.ids), self.k)
        least = np.where(np.abs(least) >= _EXACT, least - np.abs(least) * 1e-15, least)  # rounded as a double
        order = np.argsort(-(cands ** 2).sum(axis=0), kind="stable")
        step = max(8, -(-width // 6))
        dims = [order[a:a + step] for a in range(0, width, step)]
        q_cols = [np.ascontiguousarray(self.queries[:, d]) for d in dims]
        c_cols = [np.ascontiguousarray(cands[:, d]) for d in dims]
        # mass of the dimensions after each block
        def rest(cols):
            mass = np.array([(m ** 2).sum(axis=1) for m in cols])
            return np.sqrt(mass[::-1].cumsum(axis=0)[::-1][1:]) * (1 + 1e-9)
        q_rest, c_rest = rest(q_cols), rest(c_cols)
        score = np.zeros((len(self.ids), len(ids)))
        alive = self.ids[:, None] != ids
        pairs = None
        for i, (a, b) in enumerate(zip(q_cols, c_cols)):
            last = i == len(dims) - 1
            if pairs is None:
                score += a @ b.T
                bound = score if last else score + q_rest[i][:, None] * c_rest[i]
                alive &= bound >= least[:, None]
                if last or np.count_nonzero(alive) < _DENSE * alive.size:
                    q, c = np.nonzero(alive)
                    pairs = (q, c, score[q, c])
            else:
                q, c, s = pairs
                s = s + np.einsum("ij,ij->i", a[q], b[c])
                bound = s if last else s + q_rest[i][q] * c_rest[i][c]
                on = bound >= least[q]
                pairs = (q[on], c[on], s[on])
        q, c, s = pairs
        self._keep(q, ids[c], s)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.q, self.c, self.s


def integer_vectors(df: DataFrame, scale: float = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part; v: floor(scale * x) as double."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    return df.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def top_k(df: DataFrame, k: int = 20, scale: float = 64, query_every: int = 20, id_col: str = "vec_id",
          vec_col: str = "embedding", **blocks) -> DataFrame:
    """query_id, rank, vec_id, score (long) of each query's k best."""
    return _tiles.search(integer_vectors(df, scale, id_col, vec_col), BoundTile, k, query_every, "bigint", **blocks)


def op2_topk_columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
with v as (
  select distinct vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings
  where embedding is not null and vec_id is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum([x[1] * x[2] for x in list_zip(q.v, c.v)]) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""
