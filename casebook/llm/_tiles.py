"""All-against-queries searches in blocks, shared by operators 2 and 7.

Queries (rows whose id is divisible by ``query_every``) are dealt by hash into
query blocks, candidates into candidate groups. A tile is one query block
against one candidate group. A tile's rows arrive sorted, queries first: the
queries stay in memory, the candidates stream past them in batches. Each tile
returns its own best k of each query; a window over those few rows merges
them. Nothing is broadcast and no tile grows with the data.

What is sent is n * q * (1 / block + 1 / group) rows for n candidates and q
queries. A block is as large as 64 MB of queries allow (2048 to 32768 rows), a
group has 131072 rows: at 100 million vectors of 64 dimensions and a query in
every 20, the table is sent 153 times and the queries 763 times. Smaller tables
are dealt into up to 32 groups all the same, for the sake of parallel tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm._common import written

_ROWS = 2048  # queries and candidates of one matrix
_RESIDENT = 1 << 26  # bytes of a block's queries


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as float64, short rows padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def widen(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.hstack([m, np.zeros((len(m), width - m.shape[1]))])


def merge_best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (query index, id, score), each query's k highest scores, ties
    to the smaller id."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    first = np.searchsorted(q, q, side="left")
    keep = np.arange(len(q)) - first < k
    return q[keep], ids[keep], score[keep]


def kth_best(q: np.ndarray, score: np.ndarray, n: int, k: int) -> np.ndarray:
    """Each query's k-th score of rows as merge_best returns them, else -inf."""
    out = np.full(n, -np.inf)
    counts = np.bincount(q, minlength=n)
    ends = np.cumsum(counts)
    full = counts >= k
    out[full] = score[ends[full] - 1]
    return out


class Block:
    """A query block as tiles of at most ``_ROWS`` queries each, so that the
    matrices of a step stay small however many queries there are."""

    def __init__(self, tile: Callable, ids: np.ndarray, m: np.ndarray, k: int):
        self.tiles = [(at, tile(ids[at:at + _ROWS], m[at:at + _ROWS], k)) for at in range(0, len(ids), _ROWS)]

    def add(self, ids: np.ndarray, m: np.ndarray) -> None:
        for _, t in self.tiles:
            t.add(ids, m)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [(q + at, c, s) for at, t in self.tiles for q, c, s in [t.best()]]
        return tuple(np.concatenate(x) for x in zip(*found))


def search(vectors: DataFrame, tile: Callable, k: int, query_every: int, score_type: str,
           query_block: int | None = None, group: int = 1 << 17) -> DataFrame:
    """query_id, rank, vec_id, score from ``vectors`` (vec_id, v).

    ``tile(ids, matrix)`` makes a state with ``add(ids, matrix)`` for a batch
    of candidates and ``best()`` -> (query index, id, score)."""
    vectors = written(vectors.dropDuplicates(["vec_id", "v"]), "vectors")
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n = shape["n"]
    query_block = query_block or min(max(_RESIDENT // (8 * max(shape["width"] or 1, 1)), _ROWS), 1 << 15)
    group = min(group, max(4096, -(-n // 32)))
    blocks = max(1, -(-n // (query_every * query_block)))
    groups = max(1, -(-n // group))
    h = F.xxhash64("vec_id", "v")
    queries = (vectors.where(F.col("vec_id") % query_every == 0)
               .select(F.pmod(h, F.lit(blocks)).cast("int").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
                       F.lit(0).alias("kind"), "vec_id", "v"))
    others = vectors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.pmod(h, F.lit(groups)).cast("int").alias("g"),
                            F.lit(1).alias("kind"), "vec_id", "v")
    dealt = queries.union(others).repartition("b", "g").sortWithinPartitions("b", "g", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, parts, state = None, [], [], None

        def finish() -> Iterator[pa.RecordBatch]:
            if state is not None:
                q, c, s = state.best()
                qid = np.concatenate(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid[q], pa.int64()), pa.array(c, pa.int64()),
                     pa.array(s.astype(np.int64) if score_type == "bigint" else s)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            b, g, kind = (batch.column(i).to_numpy() for i in range(3))
            cut = np.flatnonzero((np.diff(b) != 0) | (np.diff(g) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if lo == hi:
                    continue
                if (b[lo], g[lo]) != now:
                    yield from finish()
                    now, ids, parts, state = (b[lo], g[lo]), [], [], None
                some = batch.slice(lo, hi - lo)
                vec_id, m = some.column(3).to_numpy(), matrix(some.column(4))
                if kind[lo] == 0:
                    ids.append(vec_id)
                    parts.append(m)
                    continue
                if not parts:
                    continue  # a block without queries
                if state is None:
                    width = max(p.shape[1] for p in parts)
                    state = Block(tile, np.concatenate(ids), np.vstack([widen(p, width) for p in parts]), k)
                for at in range(0, len(m), _ROWS):
                    state.add(vec_id[at:at + _ROWS], m[at:at + _ROWS])
        yield from finish()

    found = dealt.mapInArrow(run, f"query_id bigint, vec_id bigint, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
