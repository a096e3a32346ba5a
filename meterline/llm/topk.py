"""Exact top-k by inner product with multi-resolution segment statistics.

Components are taken as floor(256 * x). A vector is cut into 1, 4, 16 and then 32 segments; each resolution keeps means
and deviations. The squared distance of two segments is at least m * ((mean difference)^2 + (deviation difference)^2);
the same statistics give an upper bound of the inner product, which orders by distance once the lengths are known.

Rows are put in order of their coarse statistics and cut into cells of bounded size, each with the box that its statistics
fill. Queries first visit their own cell, where like rows lie; that fixes a k-th score. Blocks of neighbouring queries then
visit the other cells, but only cells whose box can hold a row that reaches the least of these scores. In a visit
bounds are taken coarse to fine against each query's own k-th score; survivors are scored exactly in integers. No task
holds more than one block and one cell at a time.

Defined results: vectors that are null or hold null or non-finite components take no part; vectors of different
dimension don't meet; a vector of no dimension scores 0; a query is never its own candidate, a repeated row is; ties go
to the smaller id, null ids last; a score beyond 64 bits is cut to the nearest long; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.csv import number_rows
from .common import written

K = 5
SCALE = 256.0
SEGMENTS = (1, 4, 16, 32)
#: Segments whose statistics order the rows and make the boxes of cells.
COARSE = 16
CELL_ROWS = 2048
#: Rows with the nearest coarse means that are scored to raise a query's k-th score before the finest bounds; more than K.
PROBES = 64
#: Summaries of cells that meet a block's summary together, on average.
_SLOT_CELLS = 256
_NO_ID, _NO_SCORE = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def whole_vectors(table: DataFrame, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, v, key, is_query, row): usable vectors with their number; v holds floor(SCALE * x) as 64-bit floats, key the
    signs of the coarse means, by which like vectors come close in order."""
    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, asked, vector in zip(batch["id"].to_pylist(), batch["is_query"].to_pylist(), batch["v"].to_pylist(), strict=True):
                if vector is None or any(x is None for x in vector):
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(np.array(vector, float) * SCALE)
                if np.isfinite(x).all():
                    means = [p.sum() > 0 for p in np.array_split(x, COARSE)]
                    out.append((own, len(x), x.tobytes(), sum(int(m) << (COARSE - 1 - k) for k, m in enumerate(means)), asked))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.bool_()))],
                                             names=["id", "dim", "v", "key", "is_query"])

    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v")).withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    return written(rows.mapInArrow(scaled, "id bigint, dim int, v binary, key int, is_query boolean").withColumn("row", F.monotonically_increasing_id()), "vectors")


#: One row per stack of vectors: its number, dimension, the vectors' ids, numbers, cells, marks, k-th scores, and the box
#: of their coarse statistics with the least of the scores.
_STACK = "stack bigint, dim int, ids binary, rows binary, cells binary, marks binary, scores binary, vectors binary, low binary, high binary, least bigint"


def _stacked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows (id, dim, v, row, cell, mark, score) in stacks of up to CELL_ROWS neighbours in ``order``, of one dimension each. Their
    number follows from the rows alone: places in the order are counted over all partitions."""
    def stack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        v = np.frombuffer(b"".join(part["v"]), float).reshape(len(part), part["dim"].iloc[0])
        stats = segment_statistics(v, COARSE)
        longs = lambda c: part[c].to_numpy(np.int64).tobytes()
        return pd.DataFrame({"stack": [part["place"].iloc[0]], "dim": [part["dim"].iloc[0]], "ids": [longs("id")], "rows": [longs("row")], "cells": [longs("cell")],
                             "marks": [part["mark"].to_numpy(bool).tobytes()], "scores": [longs("score")], "vectors": [v.tobytes()],
                             "low": [stats.min(axis=0).tobytes()], "high": [stats.max(axis=0).tobytes()], "least": [part["score"].min()]})

    whole = [F.coalesce(c, F.lit(none)).alias(c) for c, none in (("id", _NO_ID), ("cell", 0), ("score", _NO_SCORE))]
    placed = number_rows(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("dim", "v", "row", "mark", *whole), "place")
    return placed.withColumn("number", F.floor((F.col("place") - 1) / CELL_ROWS)).groupBy("number", "dim").applyInPandas(stack, _STACK)


class _Stack:
    """The arrays of a row of _STACK."""

    def __init__(self, dim: int, ids: bytes, rows: bytes, cells: bytes, marks: bytes, scores: bytes, vectors: bytes):
        self.ids, self.rows, self.cells, self.scores = (np.frombuffer(x, np.int64) for x in (ids, rows, cells, scores))
        self.marks, self.vectors = np.frombuffer(marks, bool), np.frombuffer(vectors, float).reshape(len(self.ids), dim)


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows of root-of-length times mean, and times deviation, of each segment; their inner products bound those of
    the vectors."""
    parts = [p for p in np.array_split(x, min(segments, max(1, x.shape[1])), axis=1) if p.shape[1]]
    if not parts:
        return np.zeros((len(x), 1))
    return np.concatenate([np.stack([np.sqrt(p.shape[1]) * p.mean(axis=1), np.sqrt(p.shape[1]) * p.std(axis=1)], 1) for p in parts], axis=1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of one row with rows; whole numbers in 64-bit floats stay exact below 2^53."""
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if top * top * max(1, len(a)) < 2**53:
        return (b @ a).astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    own = [int(x) for x in a]
    return np.array([min(high, max(low, sum(x * int(y) for x, y in zip(own, row, strict=True)))) for row in b], np.int64)


def reachable(bound: np.ndarray, score: np.ndarray, scale: float) -> np.ndarray:
    """Where an upper bound reaches a score, with room for rounding of terms that add up to ``scale``; a bound that isn't a
    number rules nothing out."""
    return ~(bound + 1e-9 * (1 + scale) < score)


def survivors(queries: np.ndarray, vectors: np.ndarray, allowed: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Which rows can still be among the k best of each query [queries, rows], by bounds from coarse to fine. ``scores`` holds each
    query's k-th score so far, and is raised where rows with near means give a higher one."""
    if k > PROBES:
        raise ValueError(f"k is at most {PROBES}")
    alive = allowed.copy()
    with np.errstate(over="ignore", invalid="ignore"):
        scale = np.linalg.norm(queries, axis=1).max(initial=0.0) * np.linalg.norm(vectors, axis=1).max(initial=0.0)
        for segments in SEGMENTS:
            columns = np.flatnonzero(alive.any(axis=0))
            own, stats = segment_statistics(queries, segments), segment_statistics(vectors[columns], segments)
            bound = own @ stats.T
            alive[:, columns] &= reachable(bound, scores[:, None], scale)
            if segments == COARSE:
                likely = own[:, ::2] @ stats[:, ::2].T  # by the means alone, which is no bound but nearer to the score
                for j in np.flatnonzero(alive.sum(axis=1) > 2 * PROBES).tolist():
                    left = np.flatnonzero(alive[j, columns])
                    probe = columns[left[np.argpartition(-np.nan_to_num(likely[j, left]), PROBES)[:PROBES]]]
                    scores[j] = max(scores[j], int(np.partition(_exact(queries[j], vectors[probe]), -k)[-k]))
    return alive


def best_of(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, allowed: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and scores of up to k best rows of each query, best first, as far as they reach its ``scores``."""
    given = scores.copy()
    alive = survivors(queries, vectors, allowed, scores.copy(), k)
    out = []
    for j in range(len(queries)):
        left = np.flatnonzero(alive[j])
        found = _exact(queries[j], vectors[left])
        left, found = left[found >= given[j]], found[found >= given[j]]
        best = np.lexsort((rows[left], ids[left], ~found))[:k]
        out.append((left[best], found[best]))
    return out


_FOUND = "query_id bigint, query_row bigint, id bigint, row bigint, score bigint"


def top_k(table: DataFrame, is_query: Column, id_col: str, vec_col: str, k: int = K) -> DataFrame:
    """(query_id, query_row, rank, id, score): for each row that ``is_query`` (over column ``id``) marks."""
    nothing = F.lit(None).cast("bigint")
    rows = whole_vectors(table, is_query, id_col, vec_col).withColumns({"cell": nothing, "mark": F.col("is_query"), "score": nothing})
    cells = written(_stacked(rows, ["dim", "key", "row"]), "topk-cells")
    parts = ["dim", "ids", "rows", "cells", "marks", "scores", "vectors"]

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best of each query in its own cell, and its vector with the k-th score."""
        for batch in batches:
            for n in range(batch.num_rows):
                cell, own = batch["stack"][n].as_py(), _Stack(*(batch[c][n].as_py() for c in parts))
                asked = np.flatnonzero(own.marks)
                if not len(asked):
                    continue
                allowed = np.ones((len(asked), len(own.ids)), bool)
                allowed[np.arange(len(asked)), asked] = False
                found = best_of(own.vectors[asked], own.vectors, own.ids, own.rows, allowed, np.full(len(asked), _NO_SCORE), k)
                yield pa.RecordBatch.from_pydict({
                    "id": [int(own.ids[j]) for j in asked], "dim": pa.array([own.vectors.shape[1]] * len(asked), pa.int32()), "v": [own.vectors[j].tobytes() for j in asked],
                    "row": [int(own.rows[j]) for j in asked], "cell": pa.array([cell] * len(asked), pa.int64()), "mark": [True] * len(asked),
                    "score": pa.array([int(s[k - 1]) if len(s) == k else None for _, s in found], pa.int64()),
                    "best": pa.array([[{"id": int(own.ids[p]), "row": int(own.rows[p]), "score": int(x)} for p, x in zip(*f, strict=True)] for f in found],
                                     pa.list_(pa.struct([("id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])))})

    kind = "id bigint, dim int, v binary, row bigint, cell bigint, mark boolean, score bigint, best array<struct<id:bigint,row:bigint,score:bigint>>"
    queries = written(cells.mapInArrow(at_home, kind), "topk-queries")
    blocks = written(_stacked(queries, ["dim", "cell", "row"]), "topk-blocks")
    slots = max(1, -(-cells.count() // _SLOT_CELLS))
    asked = blocks.select("dim", F.col("stack").alias("block"), F.col("low").alias("q_low"), F.col("high").alias("q_high"), "least", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    boxes = cells.select("dim", F.pmod(F.xxhash64("stack"), F.lit(slots)).cast("int").alias("slot"), F.col("stack").alias("cell"), "low", "high")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a block and a cell whose boxes leave room for the block's least k-th score."""
        for batch in batches:
            keep = []
            for n in range(batch.num_rows):
                q_low, q_high, low, high = (np.frombuffer(batch[c][n].as_py(), float) for c in ("q_low", "q_high", "low", "high"))
                with np.errstate(over="ignore", invalid="ignore"):
                    corners = np.array([q_low * low, q_low * high, q_high * low, q_high * high])
                    keep.append(bool(reachable(corners.max(axis=0).sum(), batch["least"][n].as_py(), np.abs(corners).max(axis=0).sum())))
            yield batch.select(["block", "cell"]).filter(pa.array(keep, pa.bool_()))

    pairs = asked.join(boxes, ["slot", "dim"]).select("block", "cell", "q_low", "q_high", "low", "high", "least").mapInArrow(near, "block bigint, cell bigint")
    block = blocks.select(F.col("stack").alias("block"), *[F.col(c).alias(f"q_{c}") for c in parts])
    visits = pairs.join(block, "block").join(cells.select(F.col("stack").alias("cell"), *parts), "cell")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                asked, own = (_Stack(*(batch[mark + c][n].as_py() for c in parts)) for mark in ("q_", ""))
                away = np.flatnonzero(asked.cells != batch["cell"][n].as_py())  # the others were at home here
                allowed = np.ones((len(away), len(own.ids)), bool)
                found = best_of(asked.vectors[away], own.vectors, own.ids, own.rows, allowed, asked.scores[away], k)
                out = [(asked.ids[j], asked.rows[j], own.ids[p], own.rows[p], x) for j, f in zip(away, found, strict=True) for p, x in zip(*f, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(5)], names=[c.split()[0] for c in _FOUND.split(", ")])

    at_first = queries.select(F.col("id").alias("query_id"), F.col("row").alias("query_row"), F.inline("best"))
    found = visits.mapInArrow(visit, _FOUND).unionByName(at_first)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "id", "row")  # k rows of each cell at most
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select(known("query_id").alias("query_id"), "query_row", "rank", known("id").alias("id"), "score"))
