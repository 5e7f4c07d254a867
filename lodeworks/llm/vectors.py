"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors within a distance epsilon are linked.  Vectors are sorted by their
grid cells on the leading principal dimensions and cut into intervals of the
order; pairs of intervals whose boxes are further apart than epsilon are never
compared, and the others are joined recursively, halves against halves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import connected_components, join_members
from .storage import drop, stash
from .textio import flat

#: Leading principal dimensions that make the grid.
GRID_DIMS = 6
#: Vectors of an interval, and of the smallest interval that is still halved.
BLOCK = 1024
LEAF = 128
#: Intervals of a group, and bytes of their vectors: a task joins two groups.
GROUP = 16
GROUP_BYTES = 32 << 20


def matrices(col) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as one matrix) for each length in an Arrow column of
    doubles as bytes."""
    data, offsets = flat(col)
    size = np.diff(offsets) // 8
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        if len(rows) == len(size):
            yield rows, data.view(np.float64).reshape(len(rows), d)
        else:
            yield rows, data[(offsets[rows][:, None] + np.arange(8 * d)).ravel()].view(np.float64).reshape(len(rows), d)


def keyed(rows: DataFrame) -> DataFrame:
    """(vec_id, label, key, v) of (vec_id, label, v): the vector as bytes, and a
    key of label and vector (128 bits of SHA-256), both null where the label is
    null, or the vector is null, empty, zero or holds what is no finite number."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            label, col = batch.column(1), batch.column(2)
            size = pc.fill_null(pc.list_value_length(col), 0).to_numpy().astype(np.int64)
            # a null vector may have places in the buffer, so only its own values are taken
            values = col.flatten()
            x = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no -0.0
            ends = np.cumsum(size)
            starts = ends - size
            count = lambda good: np.concatenate([[0], np.cumsum(good)])
            finite, other = count(np.isfinite(x)), count(x != 0)
            fit = (finite[ends] - finite[starts] == size) & (other[ends] > other[starts]) & ~np.asarray(label.is_null().to_numpy(zero_copy_only=False))
            raw, names = x.tobytes(), label.to_pylist()
            vectors = [raw[8 * i : 8 * j] if ok else None for i, j, ok in zip(starts.tolist(), ends.tolist(), fit.tolist())]
            keys = [None if v is None else hashlib.sha256(f"{n}|".encode() + v).digest()[:16] for n, v in zip(names, vectors)]
            yield pa.RecordBatch.from_arrays([batch.column(0), label, pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], ["vec_id", "label", "key", "v"])

    return rows.select("vec_id", "label", "v").mapInArrow(run, "vec_id long, label long, key binary, v binary")


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow."""
    v = raw.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, dims: int) -> dict[int, np.ndarray]:
    """The leading principal axes of the unit vectors, per dimension of space.

    Every task sends one matrix of second moments per dimension; they are
    summed in a few tasks, so the driver gets d x d numbers from each of 16.
    """

    def moments(batches: Iterable) -> Iterator:
        import pyarrow as pa

        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, m in matrices(batch.column(0)):
                m = unit(m)
                totals[m.shape[1]] = totals.get(m.shape[1], 0) + m.T @ m
        part = TaskContext.get().partitionId()
        for d, moment in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([part % 16], pa.int32()), pa.array([moment.tobytes()], pa.binary())], ["d", "slot", "m"])

    def add(pdf):
        import pandas as pd

        total = sum(np.frombuffer(m, np.float64) for m in pdf["m"])
        return pd.DataFrame({"d": [pdf["d"].iloc[0]], "m": [total.tobytes()]})

    got = vectors.select("v").mapInArrow(moments, "d int, slot int, m binary").groupBy("d", "slot").applyInPandas(add, "d int, m binary").collect()
    sums: dict[int, np.ndarray] = {}
    for r in got:
        sums[r["d"]] = sums.get(r["d"], 0) + np.frombuffer(r["m"], np.float64).reshape(r["d"], r["d"])
    return {d: np.linalg.eigh(m)[1][:, ::-1][:, : min(dims, d)] for d, m in sums.items()}


def box_gap(lo1: np.ndarray, hi1: np.ndarray, lo2: np.ndarray, hi2: np.ndarray) -> float:
    """The squared distance between two boxes."""
    gap = np.maximum(0.0, np.maximum(lo1 - hi2, lo2 - hi1))
    return float((gap * gap).sum())


def join_intervals(a: np.ndarray, pa_: np.ndarray, b: np.ndarray, pb: np.ndarray, least: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of a, rows of b) of all pairs of cosine ``least`` or more.

    ``a`` and ``b`` are unit vectors in grid order and ``pa_``, ``pb`` their
    principal coordinates.  If ``same``, both are one interval and each pair
    is given once, smaller row first.
    """
    limit = 2.0 - 2.0 * least + 1e-9
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i, j, k, n = stack.pop()
        if i == j or k == n or (same and n <= i):
            continue
        if box_gap(pa_[i:j].min(0), pa_[i:j].max(0), pb[k:n].min(0), pb[k:n].max(0)) > limit:
            continue
        if max(j - i, n - k) <= LEAF:
            x, y = np.nonzero(a[i:j] @ b[k:n].T >= least)
            x, y = x + i, y + k
            keep = x < y if same else slice(None)
            yield x[keep], y[keep]
            continue
        halves = lambda lo, hi: [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)] if hi - lo > LEAF else [(lo, hi)]
        stack += [(p, q, r, s) for p, q in halves(i, j) for r, s in halves(k, n) if not (same and s <= p)]


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Each node's smallest node reachable by the links (x, y)."""
    root = np.arange(n)
    while len(x):
        old = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if (root == old).all():
            break
    return root


def _blocks(vectors: DataFrame, axes: dict[int, np.ndarray], eps: float, tasks: int) -> DataFrame:
    """Intervals of the grid order: (block, label, d, n, lo, hi, ids, weights,
    vecs), the vectors scaled to length one."""

    def cells(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            d, grid = np.zeros(n, np.int32), np.zeros((n, GRID_DIMS), np.int32)
            for rows, m in matrices(batch.column(2)):
                cell = np.floor(unit(m) @ axes[m.shape[1]] / eps).astype(np.int32)
                d[rows], grid[rows, : cell.shape[1]] = m.shape[1], cell
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * GRID_DIMS), pa.array(grid.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d), lists, batch.column(2), batch.column(3)], ["key", "label", "d", "cell", "v", "weight"])

    placed = vectors.select("key", "label", "v", "weight").mapInArrow(cells, "key binary, label long, d int, cell array<int>, v binary, weight long")
    placed = placed.repartitionByRange(tasks, "label", "d", "cell", "key").sortWithinPartitions("label", "d", "cell", "key")

    def cut(batches: Iterable) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("d", pa.int32()), ("n", pa.int32()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
                            ("ids", pa.list_(pa.binary())), ("weights", pa.list_(pa.int64())), ("vecs", pa.binary())])
        part, seq = TaskContext.get().partitionId(), 0
        held: list = []  # parts (keys, weights, vectors) of one label and length
        at = None

        def block():
            nonlocal seq, held
            vecs = unit(np.concatenate([m for _, _, m in held]))
            proj = vecs @ axes[vecs.shape[1]]
            row = {"block": (part << 32) + seq, "label": at[0], "d": at[1], "n": len(vecs), "lo": proj.min(0).tolist(), "hi": proj.max(0).tolist(),
                   "ids": [k for ks, _, _ in held for k in ks], "weights": np.concatenate([w for _, w, _ in held]), "vecs": vecs.tobytes()}
            seq, held = seq + 1, []
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            label, d, weight = (batch.column(i).to_numpy() for i in (1, 2, 5))
            data, offsets = flat(batch.column(4))
            edges = [0, *(np.flatnonzero((label[1:] != label[:-1]) | (d[1:] != d[:-1])) + 1).tolist(), len(label)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                here = (int(label[lo]), int(d[lo]))
                if held and here != at:
                    yield block()
                at = here
                while lo < hi:
                    n = min(hi - lo, BLOCK - sum(len(ks) for ks, _, _ in held))
                    m = data[offsets[lo] : offsets[lo + n]].copy().view(np.float64).reshape(n, here[1])
                    held.append((batch.column(0).slice(lo, n).to_pylist(), weight[lo : lo + n].copy(), m))
                    lo += n
                    if sum(len(ks) for ks, _, _ in held) >= BLOCK:
                        yield block()
        if held:
            yield block()

    return placed.mapInArrow(cut, "block long, label long, d int, n int, lo array<double>, hi array<double>, ids array<binary>, weights array<long>, vecs binary")


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs (a, b), a <= b, of intervals whose boxes may be within eps, each with
    the groups (ga, gb) that its ends are in.

    Intervals meet by an equi-join on label and the cells that their boxes cover
    on the first two principal dimensions, one cell wider on one side.  A group
    are neighbouring intervals of a label, as many as a task holds.
    """
    place = F.row_number().over(Window.partitionBy("label", "d").orderBy("block")) - 1  # one row an interval
    group = F.greatest(F.lit(1), F.least(F.lit(GROUP), F.floor(F.lit(GROUP_BYTES) / (F.col("d") * 8 * BLOCK))))
    meta = blocks.select("block", "label", "d", "lo", "hi").withColumn("g", F.floor(place / group).cast("int"))

    def cells(df: DataFrame, wider: int) -> DataFrame:
        for i in (0, 1):
            # vectors of one component have no second dimension
            low, high = (F.coalesce(F.floor(F.get(c, F.lit(i)) / eps), F.lit(0)) for c in ("lo", "hi"))
            df = df.withColumn(f"c{i}", F.explode(F.sequence(low - wider, high + wider)))
        return df

    l, r = cells(meta, 0).alias("l"), cells(meta, 1).alias("r")  # noqa: E741
    gap = F.aggregate(F.zip_with(F.zip_with("l.lo", "r.hi", lambda x, y: x - y), F.zip_with("r.lo", "l.hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))),
                      F.lit(0.0), lambda acc, x: acc + x * x)
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("label", "d", "c0", "c1")]
    met = l.join(r, same[0] & same[1] & same[2] & same[3] & (F.col("l.block") <= F.col("r.block"))).where(gap <= eps * eps + 1e-9)
    return met.select("l.label", "l.d", F.col("l.g").alias("ga"), F.col("r.g").alias("gb"), F.col("l.block").alias("a"), F.col("r.block").alias("b")).distinct()


def _links(blocks: DataFrame, pairs: DataFrame, axes: dict[int, np.ndarray], least: float) -> DataFrame:
    """(key, links, root) of the nodes that link, from every pair of groups of
    intervals: each interval goes once to each group that it meets."""
    task = ["label", "d", "ga", "gb"]
    need = pairs.select(*task, F.col("a").alias("block")).unionByName(pairs.select(*task, F.col("b").alias("block"))).distinct()
    bodies = need.join(blocks.select("block", "ids", "weights", "vecs"), "block")
    none = F.lit(None)
    both = bodies.select(*task, "block", none.cast("long").alias("b"), "ids", "weights", "vecs").unionByName(
        pairs.select(*task, F.col("a").alias("block"), "b", none.cast("array<binary>").alias("ids"), none.cast("array<long>").alias("weights"), none.cast("binary").alias("vecs")))

    def run(group):
        import pyarrow as pa

        d = group["d"][0].as_py()
        first, second = group["block"].to_numpy(), group["b"].to_pylist()
        ids, weights, vecs, base = [], [], {}, {}
        for i, (block, partner) in enumerate(zip(first.tolist(), second)):
            if partner is None:
                base[block] = len(ids)
                ids += group["ids"][i].as_py()
                weights.append(np.asarray(group["weights"][i].as_py(), np.int64))
                v = np.frombuffer(group["vecs"][i].as_py(), np.float64).reshape(-1, d)
                vecs[block] = v, v @ axes[d]
        weight, links, tree_x, tree_y = np.concatenate(weights), np.zeros(len(ids), np.int64), [], []
        for a, b in zip(first.tolist(), second):
            if b is None:
                continue
            for x, y in join_intervals(*vecs[a], *vecs[b], least, a == b):
                x, y = x + base[a], y + base[b]
                np.add.at(links, x, weight[y])
                np.add.at(links, y, weight[x])
                # a leaf's links are kept as a spanning forest only
                nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
                root = forest(len(nodes), at[: len(x)], at[len(x) :])
                got = np.flatnonzero(root != np.arange(len(nodes)))
                tree_x.append(nodes[got])
                tree_y.append(nodes[root[got]])
        root = forest(len(ids), np.concatenate(tree_x), np.concatenate(tree_y)) if tree_x else np.arange(len(ids))
        at = np.flatnonzero(links).tolist()
        return pa.table({"key": pa.array([ids[i] for i in at], pa.binary()), "links": pa.array(links[at], pa.int64()), "root": pa.array([ids[root[i]] for i in at], pa.binary())})

    return both.groupBy(*task).applyInArrow(run, "key binary, links long, root binary")


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table``.

    Rows link if their labels are equal, their vectors have equal numbers of
    components, and their cosine, in double precision, is ``least`` or more.
    A row with a null label, or a vector that is null, empty, zero or holds a
    null or a component that is not finite, links with nothing.  Rows with
    equal vectors and labels are one node of the join, so a vector that a third
    of all rows repeat costs no more than one; each such row counts the others
    as links, a row that repeats a vec_id too.  ``component_id`` is the least
    vec_id reachable (null only if all are null); ``kept`` holds if it is the
    row's own.  Empty tables give empty results; other columns are not read.
    """
    eps = float(np.sqrt(2.0 - 2.0 * least))
    rows = keyed(table.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")))
    nodes = stash(rows.where("key IS NOT NULL").groupBy("key").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("weight"), F.min("vec_id").alias("least")), "nodes")
    axes = principal_axes(nodes, GRID_DIMS)
    tasks = max(1, min(10_000, -(-nodes.count() // (4 * BLOCK))))
    blocks = stash(_blocks(nodes, axes, eps, tasks), "blocks")
    pairs = stash(_block_pairs(blocks, eps), "block-pairs")
    found = stash(_links(blocks, pairs, axes, least), "links")
    drop(blocks, pairs)
    roots = connected_components(found.where("key != root"), "key", "root")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    state = nodes.select("key", "weight", "least").join(links, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
    state = state.withColumn("root", F.coalesce("root", "key"))
    state = stash(state, "members")
    ids = state.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("nodes"))
    state = stash(join_members(state, ids, "nodes").select("key", "component", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")), "state")
    drop(nodes, found)
    out = rows.select("vec_id", "key").join(state, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
