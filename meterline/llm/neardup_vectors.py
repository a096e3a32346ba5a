"""Near-duplicate vectors by sorted projection passes, completed by an exact comparison of tiles.

Each pass gives every vector a key of random-hyperplane bits; vectors are ordered by (pass, label, key) and each is
compared with the next WINDOW in that order. Pairs of one label whose cosine in double precision reaches the
threshold are links; links of all passes are united. Equal vectors are one node from the start, so a group of copies
costs one comparison. The order is cut into ranges by Spark; the rows at both ends of each range are kept and compared
once more across the cut. No task holds more than a range's window.

A pass misses pairs: by its window in a cluster of many different vectors, elsewhere by chance. So the order of one pass
is cut into tiles of bounded bytes, and each two tiles of a label and dimension are compared in full, unless the angle
between their centres is larger than both radii and the threshold's angle together; vectors too far from the other
tile's centre are left out in the same way. A pair of tiles gives link counts and one tree for each connected part,
never its links one by one. Links, counts and components are those of all pairs. Where the bound prunes nothing (vectors spread
evenly in many dimensions) this step's work grows with the square of a label's different vectors.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without a label, link
with nothing and are their own component; vectors of different dimension don't link; rows with the same id are
separate rows that share an id; a row with a null id has its group's component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

THRESHOLD = 0.98
PASSES = 20
BITS = 62
WINDOW = 96
#: Vectors of one tile; a pair of tiles is one task's work.
TILE_BYTES = 1 << 20
#: Rows compared at once inside a pair of tiles.
_STRIP = 512
#: Added to angles before a bound is trusted, against rounding.
_SLACK = 1e-6


def planes(dim: int, number: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng([seed, dim, number]).standard_normal((dim, BITS))


def _usable(vector: list | None) -> bool:
    if vector is None or not len(vector) or any(x is None for x in vector):
        return False
    x = np.array(vector, float)
    return bool(np.isfinite(x).all() and x.any())


def _packed(x: np.ndarray) -> bytes:
    """The components without loss: as 32-bit floats if all of them are such numbers, else as 64-bit ones."""
    with np.errstate(over="ignore"):
        small = x.astype(np.float32)
    return b"f" + small.tobytes() if (small.astype(float) == x).all() else b"d" + x.tobytes()


def _values(v: bytes) -> np.ndarray:
    return np.frombuffer(v, np.float32 if v[:1] == b"f" else float, offset=1).astype(float)


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """v: the packed vector, null if it can't link."""
    for batch in batches:
        v = [_packed(np.array(x, float)) if lab is not None and _usable(x) else None for x, lab in zip(batch["v"].to_pylist(), batch["label"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], pa.array(v, pa.binary())], names=["id", "label", "v"])


def _units(vectors: list[bytes]) -> list[np.ndarray]:
    out = []
    for v in vectors:
        x = _values(v)
        x = x / np.abs(x).max()  # so that squares neither overflow nor vanish
        out.append(x / np.sqrt(x @ x))
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        units = _units(batch["v"].to_pylist())
        for number in range(PASSES):
            keys = [int(((u @ planes_of(len(u), number)) > 0) @ weights) for u in units]
            yield pa.RecordBatch.from_arrays([pa.array([number] * len(keys), pa.int32()), batch["label"], pa.array(map(len, units), pa.int32()), pa.array(keys, pa.int64()), batch["node"], batch["v"]],
                                             names=["pass", "label", "dim", "key", "node", "v"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dimension and the key of pass 0."""
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        units = _units(batch["v"].to_pylist())
        keys = [int(((u @ planes_of(len(u), 0)) > 0) @ weights) for u in units]
        yield pa.RecordBatch.from_arrays([batch["label"], pa.array(map(len, units), pa.int32()), pa.array(keys, pa.int64()), batch["node"], batch["copies"], batch["v"]],
                                         names=["label", "dim", "key", "node", "copies", "v"])


_planes: dict[tuple[int, int], np.ndarray] = {}


def planes_of(dim: int, number: int) -> np.ndarray:
    if (dim, number) not in _planes:
        _planes[dim, number] = planes(dim, number)
    return _planes[dim, number]


def _compare(group: list[tuple], nodes: list[int], units: list[np.ndarray], first_new: int, out: list) -> None:
    """Links of rows from ``first_new`` on with the WINDOW rows before each, in the same (pass, label, dimension)."""
    start = 0
    while start < len(nodes):
        end = start
        while end < len(nodes) and group[end] == group[start]:
            end += 1
        if end > first_new and end - start > 1:
            x, n = np.stack(units[start:end]), np.array(nodes[start:end])
            for lag in range(1, min(WINDOW, end - start - 1) + 1):
                close = np.flatnonzero((x[lag:] * x[:-lag]).sum(axis=1) >= THRESHOLD)
                close = close[close + lag + start >= first_new]
                out += zip(n[close].tolist(), n[close + lag].tolist(), strict=True)
        start = end


_PAIRS = "kind string, a bigint, b bigint, part int, pos int, pass int, label bigint, v binary"


def _sweep(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside one range, and its first and last WINDOW rows."""
    kept: tuple[list, list, list, list] = ([], [], [], [])  # group, node, unit, raw of the last rows
    seen = 0

    def edge(kind: str, rows: list[tuple]) -> list[tuple]:
        return [(kind, node, None, part, pos, g[0], g[1], v) for pos, (g, node, v) in enumerate(rows)]

    for batch in batches:
        passes, labels, nodes, raw = (batch[c].to_pylist() for c in ("pass", "label", "node", "v"))
        units = _units(raw)
        group = list(zip(passes, labels, map(len, units), strict=True))
        out: list = []
        old = len(kept[0])
        everything = (kept[0] + group, kept[1] + nodes, kept[2] + units, kept[3] + raw)
        _compare(*everything[:3], old, out)
        rows = [("link", a, b, None, None, None, None, None) for a, b in out]
        if seen < WINDOW:
            first = list(zip(group, nodes, raw, strict=True))[:WINDOW - seen]
            rows += [("first", node, None, part, seen + k, g[0], g[1], v) for k, (g, node, v) in enumerate(first)]
        seen += len(nodes)
        kept = tuple(x[-WINDOW:] for x in everything)
        yield _batch(rows)
    yield _batch(edge("last", list(zip(kept[0], kept[1], kept[3], strict=True))))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[x.split()[0] for x in _PAIRS.split(", ")])


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) of the linked pairs found among ``nodes`` (node, label, v), a < b."""
    keyed = nodes.mapInArrow(_keyed, "pass int, label bigint, dim int, key bigint, node bigint, v binary")
    ordered = keyed.repartitionByRange("pass", "label", "dim", "key").sortWithinPartitions("pass", "label", "dim", "key", "node")

    def sweep(batches):
        from pyspark import TaskContext
        return _sweep(TaskContext.get().partitionId(), batches)

    swept = written(ordered.mapInArrow(sweep, _PAIRS), "projection-passes")

    def across(edge: pd.DataFrame) -> pd.DataFrame:
        edge = edge.sort_values(["side", "pos"])
        units = _units(edge["v"].tolist())
        group = [(int(p), int(x), len(u)) for p, x, u in zip(edge["pass"], edge["label"], units, strict=True)]
        out: list = []
        before = int((edge["side"] == 0).sum())
        # only pairs over the cut: a row before it and one after it, at most WINDOW apart
        _compare(group, edge["a"].tolist(), units, before, out)
        return pd.DataFrame(out, columns=["a", "b"])

    cuts = swept.where("kind <> 'link'").select("a", "pos", "pass", "label", "v", F.when(F.col("kind") == "last", 0).otherwise(1).alias("side"),
                                                F.when(F.col("kind") == "last", F.col("part") + 1).otherwise(F.col("part")).alias("cut"))
    over = cuts.groupBy("cut").applyInPandas(across, "a bigint, b bigint")
    found = swept.where("kind = 'link'").select("a", "b").union(over)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


_TILE = "tile bigint, label bigint, dim int, nodes binary, copies binary, vectors binary, centre array<double>, radius double"


def _tiles(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles of one range: neighbours in its order, of one label and dimension."""
    group, held, made = None, [], 0

    def tile() -> pa.RecordBatch:
        x = np.stack(_units([v for _, _, v in held]))
        centre = x.mean(axis=0)
        centre = centre / np.linalg.norm(centre) if np.linalg.norm(centre) > 1e-9 else x[0]
        row = [(part << 33) + made, *group, np.array([n for n, _, _ in held], np.int64).tobytes(), np.array([c for _, c, _ in held], np.int64).tobytes(),
               _packed(np.stack([_values(v) for _, _, v in held])), centre.tolist(), float(_angle(x @ centre).max())]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in _TILE.split(", ")])

    for batch in batches:
        for label, dim, node, copies, v in zip(*(batch[c].to_pylist() for c in ("label", "dim", "node", "copies", "v")), strict=True):
            if held and (group != (label, dim) or (len(held) + 1) * len(v) > TILE_BYTES):
                yield tile()
                held, made = [], made + 1
            group = (label, dim)
            held.append((node, copies, v))
    if held:
        yield tile()


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of x and y are linked. 32-bit products decide where their error can't matter, 64-bit ones elsewhere."""
    error = (x.shape[1] + 8) * 2.0 ** -23
    x32, y32, out = x.astype(np.float32), y.astype(np.float32), np.zeros((len(x), len(y)), bool)
    for k in range(0, len(x), _STRIP):
        cosine = x32[k:k + _STRIP] @ y32.T
        out[k:k + _STRIP] = cosine >= THRESHOLD + error
        i, j = np.nonzero((cosine >= THRESHOLD - error) & ~out[k:k + _STRIP])
        for n in range(0, len(i), 1 << 14):
            a, b = i[n:n + (1 << 14)] + k, j[n:n + (1 << 14)]
            out[a, b] = (x[a] * y[b]).sum(axis=1) >= THRESHOLD
    return out


def _trees(linked: np.ndarray, nodes: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
    """(node, root) that tie the connected parts of a table of links together."""
    out, left, free = [], linked.any(axis=1), np.ones(linked.shape[1], bool)
    for root in np.flatnonzero(left):
        new = np.array([root]) if left[root] else np.array([], int)
        left[root] = False
        while len(new):
            columns = np.flatnonzero(linked[new].any(axis=0) & free)
            free[columns] = False
            out += [(n, int(nodes[root])) for n in [*nodes[new].tolist(), *others[columns].tolist()]]
            new = np.flatnonzero(linked[:, columns].any(axis=1) & left)
            left[new] = False
    return [(n, r) for n, r in out if n != r]


def _tile_pair(pair: pd.DataFrame) -> pd.DataFrame:
    """Of two tiles, or one and itself: (node, linked copies) and (node, root) of what is connected."""
    rows = []
    for _, t in pair.sort_values("tile").iterrows():
        raw = _values(t["vectors"]).reshape(-1, t["dim"])
        x = raw / np.abs(raw).max(axis=1, keepdims=True)
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        rows.append((x, np.frombuffer(t["nodes"], np.int64), np.frombuffer(t["copies"], np.int64), np.array(t["centre"]), t["radius"]))
    one, two = rows[0], rows[-1]
    reach = np.arccos(THRESHOLD) + _SLACK
    keep = [np.flatnonzero(_angle(a[0] @ b[3]) <= b[4] + reach) for a, b in ((one, two), (two, one))]
    (x, nodes, copies), (y, others, other_copies) = ([c[k] for c in t[:3]] for t, k in zip((one, two), keep, strict=True))
    linked = _linked(x, y)
    if len(rows) == 1:
        np.fill_diagonal(linked, False)
    i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    linked, nodes, others = linked[np.ix_(i, j)], nodes[i], others[j]
    counted = [*zip(nodes.tolist(), (linked @ other_copies[j]).tolist())]
    if len(rows) == 2:
        counted += zip(others.tolist(), (copies[i] @ linked).tolist())
    found = [(n, None, c) for n, c in counted] + [(n, r, None) for n, r in _trees(linked, nodes, others)]
    return pd.DataFrame({c: pd.array([f[k] for f in found], "Int64") for k, c in enumerate(("node", "root", "others"))})


def exact_links(nodes: DataFrame) -> DataFrame:
    """From all pairs of ``nodes`` (node, label, copies, v): rows (node, others) with link counts to be summed, and rows
    (node, root) that are connected."""
    placed = nodes.select("node", "label", "copies", "v").mapInArrow(_placed, "label bigint, dim int, key bigint, node bigint, copies bigint, v binary")
    ordered = placed.repartitionByRange("label", "dim", "key").sortWithinPartitions("label", "dim", "key", "node")

    def cut(batches):
        from pyspark import TaskContext
        return _tiles(TaskContext.get().partitionId(), batches)

    tiles = written(ordered.mapInArrow(cut, _TILE), "vector-tiles")
    balls = tiles.select("label", "dim", F.col("tile").alias("a"), F.col("centre").alias("ca"), F.col("radius").alias("ra"))
    cosine = F.aggregate(F.zip_with("ca", "cb", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    apart = F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))
    near = (balls.join(balls.toDF("label", "dim", "b", "cb", "rb"), ["label", "dim"])
            .where((F.col("a") <= F.col("b")) & (apart <= F.col("ra") + F.col("rb") + float(np.arccos(THRESHOLD)) + _SLACK)).select("a", "b"))
    sides = written(near, "tile-pairs").select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    compared = sides.join(tiles, "tile").groupBy("a", "b").applyInPandas(_tile_pair, "node bigint, root bigint, others bigint")
    return written(compared, "tile-links")


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``table``."""
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vec_col).alias("v"))
    rows = written(rows.mapInArrow(_prepared, "id bigint, label bigint, v binary"), "vectors")
    able = rows.where("v is not null")
    # equal vectors of a label are one node, numbered as written
    nodes = written(able.groupBy("label", "v").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
                    .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    pairs = written(links(nodes.select("node", "label", "v")), "vector-links")
    exact = exact_links(nodes)
    degree = exact.where("root is null").groupBy("node").agg(F.sum("others").alias("others"))
    reach = written(components(pairs.union(exact.where("root is not null").select("node", "root"))), "vector-components")
    known = (nodes.join(degree, "node", "left").join(reach, "node", "left")
             .select("label", "v", "first_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("root")))
    first = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = known.join(first, "root").select("label", "v", "n_links", "component_id")
    linked = able.join(found, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("v is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
