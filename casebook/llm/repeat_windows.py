"""Operator 10: removal of repeated byte strings (see the README for why this
is not done by external induced suffix sorting).

A byte is removed if it is covered by a ``length``-byte string that also
starts anywhere else in the table. So the question is, for every window of
``length`` bytes, whether its content occurs twice. It is answered in two
levels, without sorting all windows:

1. Every window names its anchor: of the ``gram``-byte strings inside it, the
   one with the smallest hash (the leftmost, in a tie). The anchor depends on
   the window's content only, so equal windows have equal anchors at equal
   places. Neighbouring windows mostly share the anchor; such a run of windows
   is one row: the gram's hash, a hash of all bytes of the run, and its place.
   Rows are folded within a task, then dealt by the gram's hash. A gram that
   occurs once has no repeated window. If all runs of a gram are equal, all
   their windows are repeated; so are those of equal runs of other grams.
2. What remains are runs that share a gram but not all their bytes: the edges
   of repeated passages. Each different run lists its windows, and the windows
   are counted by hash.

Hashes are polynomial, from running sums modulo 2^64. Equality is decided on
128 bits in step 1 (gram and run) and 96 bits in step 2.

No task holds more than a chunk of text and a few arrays of its length; long
texts are cut into overlapping pieces. Nothing is collected on the driver.

Defined cases: a null text is the empty text; a text shorter than ``length``
loses nothing; rows are told apart by id and 64-bit text hash, so rows that repeat an
id are judged each by its text, and rows that repeat id and text are copies of
each other; a null id is an id; an empty table gives an empty result; no other
column is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm._common import table

_CHUNK = 1 << 20     # bytes worked on at once
_PIECE = 1 << 19     # windows of a long text taken at once
_POS_BITS = 22       # places within a chunk and its last piece
_MIX = np.uint64(0xD6E8FEB86659FD93)
_U = np.uint64


class Rolling:
    """Position-independent polynomial hashes of substrings of a byte array."""

    def __init__(self, seed: int):
        self.base = int(np.random.default_rng(seed).integers(1 << 62, 1 << 63)) | 5
        self.values = np.random.default_rng(seed + 1).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.up) < n:
            def powers(b: int) -> np.ndarray:
                p = np.full(max(n, 1 << 16), b, dtype=np.uint64)
                p[0] = 1
                return np.cumprod(p, dtype=np.uint64)
            self.up, self.down = powers(self.base), powers(pow(self.base, -1, 1 << 64))
        out = np.zeros(n, np.uint64)
        np.cumsum(self.values[data] * self.up[:n - 1], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start, end) -> np.ndarray:
        """Hashes of data[start:end]."""
        return (sums[end] - sums[start]) * self.down[start]


_FIRST, _SECOND = Rolling(11), Rolling(29)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * _MIX
    return h ^ (h >> _U(32))


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset, bytes) of the pieces with a window, in chunks."""
    chunk, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t) - length + 1, _PIECE):
            piece = t[at:at + _PIECE + length - 1] if len(t) > _PIECE else t
            chunk.append((i, at, piece))
            size += len(piece)
            if size >= _CHUNK:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def runs(chunk: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each run of windows with one anchor: the text's number, the first
    window's place in the text, the number of windows, gram hash, run hash."""
    data = np.frombuffer(b"".join(p for _, _, p in chunk), dtype=np.uint8)
    size = np.array([len(p) for _, _, p in chunk])
    begin = np.cumsum(size) - size
    one = _FIRST.sums(data)
    grams = (one[gram:] - one[:-gram]) * _FIRST.down[:len(one) - gram]
    # smallest hash among the ``width`` grams of each window, from running
    # minima to the right and to the left within blocks of that width
    width = length - gram + 1
    mask = _U((1 << _POS_BITS) - 1)
    key = (_mix(grams) & ~mask) | np.arange(len(grams), dtype=np.uint64)
    rows = -(-len(key) // width)
    padded = np.full(rows * width, np.uint64(2 ** 64 - 1))
    padded[:len(key)] = key
    block = padded.reshape(rows, width)
    right = np.minimum.accumulate(block, axis=1).ravel()
    left = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    anchor = (np.minimum(left[:windows], right[width - 1:width - 1 + windows]) & mask).astype(np.int64)
    # a run ends where the anchor changes and where the piece's windows end
    edge = np.zeros(windows + 1, bool)
    edge[0] = True
    edge[1:windows] = anchor[1:] != anchor[:-1]
    last = begin + size - length + 1  # end of the piece's windows
    edge[begin[begin <= windows]] = True
    edge[last[last <= windows]] = True
    start = np.flatnonzero(edge[:windows])
    end = np.concatenate([start[1:], [windows]])
    piece = np.searchsorted(begin, start, side="right") - 1
    inside = start < last[piece]  # not across two texts
    start, end, piece = start[inside], end[inside], piece[inside]
    a, count = anchor[start], end - start
    second = _SECOND.sums(data)
    whole = _SECOND.of(second, start, end + length - 1)
    whole = _mix(whole + (a - start).astype(np.uint64) * _U(0x9E3779B97F4A7C15) + count.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
    text = np.array([i for i, _, _ in chunk])[piece]
    offset = np.array([o for _, o, _ in chunk])[piece]
    return text, start - begin[piece] + offset, count, grams[a].view(np.int64), whole.view(np.int64)


def _blobs(column: pa.Array) -> list[bytes]:
    return [x.as_py() or b"" for x in column]


def _run_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, run, doc, th, pos, more): pos is place << 16 | windows - 1 of a
    run, more the other runs of equal hashes in the same chunk."""
    kind = docs.schema["doc"].dataType.simpleString()
    most = 1 << 16

    def run(batches):
        for b in batches:
            texts = _blobs(b.column("t"))
            doc, th = b.column("doc"), b.column("th").to_numpy()
            for chunk in _pieces(texts, length):
                text, start, count, g, w = runs(chunk, length, gram)
                pos = start << 16 | (count - 1)
                order = np.lexsort((w, g))
                text, pos, g, w = text[order], pos[order], g[order], w[order]
                first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])]))
                extra = np.ones(len(g), bool)
                extra[first] = False
                ends = np.append(first[1:], len(g)) - first - 1
                offsets = np.concatenate([[0], np.cumsum(ends)])
                more = pa.StructArray.from_arrays([doc.take(pa.array(text[extra])), pa.array(th[text[extra]], pa.int64()), pa.array(pos[extra])],
                                                  names=["doc", "th", "pos"])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), more)
                for at in range(0, len(first), most):
                    f = first[at:at + most]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[f]), pa.array(w[f]), doc.take(pa.array(text[f])), pa.array(th[text[f]], pa.int64()), pa.array(pos[f]),
                         lists.slice(at, len(f))], names=["gram", "run", "doc", "th", "pos", "more"])

    assert length - gram < 1 << 16
    return docs.mapInArrow(run, f"gram bigint, run bigint, doc {kind}, th bigint, pos bigint, more array<struct<doc:{kind},th:bigint,pos:bigint>>")


def _window_rows(docs: DataFrame, length: int) -> DataFrame:
    """(h, c, doc, th, s, want) of each window of the runs listed in column
    ``listed`` (array of pos, want)."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for i, t in enumerate(b.column("t")):
                raw = t.as_py() or b""
                doc, th = b.column("doc").slice(i, 1), b.column("th").slice(i, 1)
                listed = sorted((x["pos"] >> 16, (x["pos"] & 0xFFFF) + 1, x["want"]) for x in b.column("listed")[i].as_py())
                for s, n, want in listed:
                    data = np.frombuffer(raw, dtype=np.uint8, count=n + length - 1, offset=s)
                    at = np.arange(n)
                    h = _SECOND.of(_SECOND.sums(data), at, at + length)
                    c = (_FIRST.of(_FIRST.sums(data), at, at + length) >> _U(32)).astype(np.uint32).view(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(c), doc.take(pa.array(np.zeros(n, np.int64))),
                         th.take(pa.array(np.zeros(n, np.int64))), pa.array(at + s), pa.array(np.full(n, want))],
                        names=["h", "c", "doc", "th", "s", "want"])

    def batched(batches):
        waiting, rows = [], 0
        for b in run(batches):
            waiting.append(b)
            rows += b.num_rows
            if rows >= 1 << 15:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting, rows = [], 0
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return docs.mapInArrow(batched, f"h bigint, c int, doc {kind}, th bigint, s bigint, want boolean")


def _rows(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("th"), text.cast("binary").alias("t"))


def repeated_starts(df: DataFrame, length: int = 400, gram: int = 224, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc, th, starts): per row with a repeated window, the runs of starts
    of repeated windows (array of place << 16 | windows - 1, each place once,
    however many copies of the row there are)."""
    docs = _rows(df, text_col, id_col)
    same_run, same_gram = Window.partitionBy("gram", "run"), Window.partitionBy("gram")
    c = (_run_rows(docs.where(F.length("t") >= length), length, gram).repartition("gram")
         .withColumn("n_run", F.sum(1 + F.size("more")).over(same_run))
         .withColumn("is_first", F.row_number().over(same_run.orderBy("doc", "th", "pos")) == 1)
         .withColumn("n_gram", F.sum(1 + F.size("more")).over(same_gram))
         .withColumn("mixed", F.min("run").over(same_gram) != F.max("run").over(same_gram))
         .where("n_gram > 1"))
    whole = c.where("n_run > 1").select(F.explode(F.concat(F.array(F.struct("doc", "th", "pos")), "more")).alias("x")).select("x.*")
    listed = (c.where("mixed and is_first")
              .groupBy("doc", "th").agg(F.collect_list(F.struct("pos", (F.col("n_run") == 1).alias("want"))).alias("listed"))
              .select(F.col("doc").alias("d"), F.col("th").alias("h"), "listed"))
    texts = docs.join(listed, F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")))
    texts = texts.select("doc", "th", "t", "listed").dropDuplicates(["doc", "th"])  # a run of copies is not wanted, so one copy's windows do
    windows = _window_rows(texts, length).repartition("h")
    parts = (windows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("h", "c"))).where("n > 1 and want")
             .select("doc", "th", F.shiftleft("s", 16).alias("pos")))
    return whole.union(parts).groupBy("doc", "th").agg(F.collect_set("pos").alias("starts"))


def removed_spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [begin, end) of removed bytes."""
    starts = np.sort(starts)
    begin, end = starts >> 16, (starts >> 16) + (starts & 0xFFFF) + length
    end = np.maximum.accumulate(end)
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def remove_repeats(df: DataFrame, length: int = 400, gram: int = 224, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left) and
    spans (array of begin, end of the removed bytes)."""
    found = repeated_starts(df, length, gram, text_col, id_col).select(F.col("doc").alias("d"), F.col("th").alias("h"), "starts")
    docs = _rows(df, text_col, id_col).join(found, F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")), "left")
    kind = df.select(id_col).schema[0].dataType.simpleString()
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for b in batches:
            size, removed, kept, spans = [], [], [], []
            for t, s in zip(b.column("t"), b.column("starts")):
                raw = t.as_py() or b""
                size.append(len(raw))
                if not s.is_valid:
                    removed.append(0), kept.append(raw), spans.append([])
                    continue
                begin, end = removed_spans(s.values.to_numpy(), length)
                removed.append(int((end - begin).sum()))
                keep = zip([0, *end.tolist()], [*begin.tolist(), len(raw)])
                kept.append(b"".join(raw[x:y] for x, y in keep))
                spans.append([{"begin": x, "end": y} for x, y in zip(begin.tolist(), end.tolist())])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(s) for s in spans], pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(spans, pa.list_(span))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])

    return docs.select("doc", "t", "starts").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, spans array<struct<begin:bigint,end:bigint>>")


def op10_repeat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                      (F.col("n_removed") > 0).cast("int").alias("has_repeats"))
