"""Both block searches against SQL on the table and brute force on edge rows."""

import math
import random

import duckdb
import numpy as np
import pytest

from casebook.llm import ann_blocks, topk_columnar
from tests.llm.helpers import SF, clash


@pytest.mark.parametrize("module,query", [(topk_columnar, topk_columnar.op2_topk_columnar), (ann_blocks, ann_blocks.op7_ann_blocks)])
def test_equals_the_sql(spark, module, query):
    got = query(spark, SF).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(module.ORACLE_SQL).df().sort_values(["query_id", "rank"]).reset_index(drop=True)
    assert len(got) == len(want) and (got == want[got.columns]).all().all()


def _rows():
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(12)]) for i in range(300)]
    rows += [(300 + i, [0.25] * 12) for i in range(60)]                    # ties
    rows += [(400, None), (401, [None] * 12), (402, [float("nan")] * 12), (403, [float("inf")] * 12), (None, [1.0] * 12)]
    rows += [(404, [0.0] * 12), (405, [-0.0] * 12), (420, [0.0] * 12), (406, []), (407, [1.0] * 3), (440, [0.5] * 20)]
    return rows + [rows[0], rows[0], (20, [0.9] * 12), (460, [1e-30] * 12), (480, [1e12] * 12), (481, [-3e12] * 12)]


def _brute(rows, transform, skip_zero, k=20):
    seen = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or (skip_zero and not any(v)):
            continue
        seen[(i, tuple(transform(x) for x in v))] = None
    out = []
    best = {}
    for q, a in seen:
        if q % 20 == 0:
            for c, b in seen:
                if c != q:
                    s = 0 if not skip_zero else 0.0
                    for x, y in zip(a, b):
                        s += x * y
                    best.setdefault(q, []).append((-s, c))
    for q, found in best.items():
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [{}, {"query_block": 4, "group": 37}])
def test_edge_rows(spark, blocks):
    rows = _rows()
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted(map(tuple, topk_columnar.top_k(df, **blocks).collect()))
    assert got == _brute(rows, lambda x: math.floor(64 * x), False)
    got = sorted(map(tuple, ann_blocks.nearest(df, **blocks).collect()))
    assert got == _brute(rows, float, True)
    assert topk_columnar.top_k(df.limit(0)).count() == 0 and ann_blocks.nearest(df.limit(0)).count() == 0


def test_bound_tile_prunes_and_stays_exact():
    r = np.random.default_rng(0)
    q, c = np.floor(64 * r.normal(0, 0.2, (50, 64))), np.floor(64 * r.normal(0, 0.2, (6000, 64)))
    c[:, 16:] *= 0.1
    c = np.floor(c)
    tile = topk_columnar.BoundTile(np.arange(50), q, 20)
    for at in range(0, 6000, 2048):
        tile.add(np.arange(100 + at, 100 + min(at + 2048, 6000)), c[at:at + 2048])
    qi, ids, s = tile.best()
    full = q @ c.T
    for i in range(50):
        order = np.lexsort((np.arange(6000), -full[i]))[:20]
        assert ids[qi == i].tolist() == (order + 100).tolist() and s[qi == i].tolist() == full[i][order].tolist()


@pytest.mark.parametrize("kind", ["bound", "int8"])
def test_block_of_several_tiles(monkeypatch, kind):
    """A query block larger than one matrix gives what single tiles give."""
    import numpy as np
    from casebook.llm import _tiles
    from casebook.llm.ann_blocks import Int8Tile
    from casebook.llm.topk_columnar import BoundTile
    monkeypatch.setattr(_tiles, "_ROWS", 7)
    rnd = np.random.default_rng(4)
    q, c = np.floor(rnd.normal(0, 20, (30, 6))), np.floor(rnd.normal(0, 20, (200, 6)))
    qid, cid = np.arange(1000, 1030), np.arange(200)
    block = _tiles.Block({"bound": BoundTile, "int8": Int8Tile}[kind], qid, q, 5)
    for at in range(0, 200, 50):
        block.add(cid[at:at + 50], c[at:at + 50])
    got = {}
    for i, v, s in zip(*block.best()):
        got.setdefault(int(i), []).append((float(s), -int(v)))
    for i in range(30):
        want = sorted(((float(s), -int(v)) for v, s in zip(cid, c @ q[i])), reverse=True)[:5]
        assert sorted(got[i], reverse=True) == want
