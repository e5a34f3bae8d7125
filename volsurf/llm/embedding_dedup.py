"""Near-duplicate vectors by an epsilon grid order join.

Vectors are scaled to length 1 and turned onto the principal axes of the whole
table.  Cosine >= t means a distance of at most epsilon = sqrt(2 - 2t).  A grid
of that cell width on the leading axes gives the epsilon grid order: vectors
are sorted by their cells, axis by axis, and cut into sequence intervals of at
most INTERVAL rows and INTERVAL_BYTES.  Two intervals are joined recursively:
as long as both hold more than LEAF rows they are halved, and a pair of parts is
dropped as soon as the distance between their bounding boxes on the leading
axes, with the norms of what the other axes hold, proves every pair of rows too
distant.  What is left is compared exactly, in double precision, on the
original values.  Vectors of different dimensions never link; each dimension
has an order of its own (that of DIMENSIONS dimensions, the most common ones,
on principal axes, of others on the axes as they are).

Scale: equal vectors collapse to one row first.  An interval has one fixed
size however large the table, and is the unit of shipping.  Interval pairs come
from an equi-join: as intervals are sorted by cells, two can only reach each
other if they share a cell of the first axis or have neighbouring ones; pairs
whose boxes are too far apart are dropped before a vector is shipped.  Per
interval pair each vector gets the number of its links and the pair a spanning
forest of them, so dense groups yield rows in proportion to their size, not its
square.  Of the data only the covariance matrices reach the driver.  On
vectors without leading axes (nearly isotropic ones) boxes prune next to
nothing, and the join is quadratic in distinct vectors.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing.  A null id takes part with its vector but names
no component.  Repeated rows are vectors of their own and link with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize
from .components import connected_components
from .simhash import _forest

COSINE, AXES, DIMENSIONS = 0.95, 12, 4
INTERVAL, INTERVAL_BYTES, LEAF, SALTS = 8192, 8 << 20, 256, 16
_SLACK = 1e-9


def _valid(vector):
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # squares of extreme values would overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _moments(vectors: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, sum and sum of outer products of unit vectors, over all rows; one small row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            u = _unit(_matrix(batch.column("vector")))
            n, s, q = n + len(u), s + u.sum(axis=0), q + u.T @ u
        flat = np.concatenate([[n], s, q.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["k", "x"])

    total = vectors.select("vector").mapInArrow(run, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).orderBy("k").toPandas()["x"].to_numpy()
    return int(total[0]), total[1 : 1 + dim], total[1 + dim :].reshape(dim, dim)


class Order:
    """The turn onto principal axes, and the grid order's sort key; without moments the axes stay as they are."""

    def __init__(self, dim: int, epsilon: float, moments: tuple[int, np.ndarray, np.ndarray] | None = None, axes: int = AXES):
        self.axes, self.epsilon = min(axes, dim), epsilon
        self.mean, self.turn = np.zeros(dim), None
        if moments is not None:
            n, total, outer = moments
            self.mean = total / max(n, 1)
            self.turn = np.linalg.eigh(outer / max(n, 1) - np.outer(self.mean, self.mean))[1][:, ::-1]

    def project(self, unit: np.ndarray) -> np.ndarray:
        """Leading coordinates, then the norm of the rest: distances between these never exceed the real ones."""
        all_axes = (unit - self.mean) @ self.turn if self.turn is not None else unit
        rest = np.linalg.norm(all_axes[:, self.axes :], axis=1)
        return np.hstack([all_axes[:, : self.axes], rest[:, None]])

    def keys(self, low: np.ndarray) -> list[bytes]:
        cells = np.floor(low[:, : self.axes] / self.epsilon).astype(np.int64) + 128
        return [bytes(row) for row in np.clip(cells, 0, 255).astype(np.uint8)]


class Orders:
    """The order of each dimension."""

    def __init__(self, known: dict[int, Order], epsilon: float):
        self.known, self.epsilon = known, epsilon

    def of(self, dim: int) -> Order:
        return self.known.get(dim) or Order(dim, self.epsilon)


def _boxes(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return low.min(axis=0), low.max(axis=0)


def _apart(a: tuple, b: tuple, epsilon: float) -> bool:
    gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(gap @ gap) > epsilon * epsilon + _SLACK


def _leaves(la: np.ndarray, lb: np.ndarray, same: bool, epsilon: float) -> Iterator[tuple[slice, slice]]:
    """Pairs of row ranges that may hold links."""
    stack = [(0, len(la), 0, len(lb))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        if same and b1 <= a0:
            continue  # its mirror image is met elsewhere
        if _apart(_boxes(la[a0:a1]), _boxes(lb[b0:b1]), epsilon):
            continue
        big_a, big_b = a1 - a0 > LEAF, b1 - b0 > LEAF
        if not (big_a or big_b):
            yield slice(a0, a1), slice(b0, b1)
            continue
        parts_a = [(a0, (a0 + a1) // 2), ((a0 + a1) // 2, a1)] if big_a else [(a0, a1)]
        parts_b = [(b0, (b0 + b1) // 2), ((b0 + b1) // 2, b1)] if big_b else [(b0, b1)]
        stack += [(*p, *q) for p in parts_a for q in parts_b]


def _join(orders: Orders, cosine: float):
    """For pairs of intervals: rows (u, u, n) - vectors behind the links of u - and forest links (u, v, 0)."""

    def pair(dim: int, same: bool, sides: list[tuple[np.ndarray, np.ndarray, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = orders.of(dim)
        keys, copies = [s[0] for s in sides], [s[1] for s in sides]
        unit = [_unit(_unpacked(s[2], len(s[0]))) for s in sides]
        low = [order.project(u) for u in unit]
        counts = [np.zeros(len(x), np.int64) for x in keys]
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for ra, rb in _leaves(*low, same, order.epsilon):
            hit = unit[0][ra] @ unit[1][rb].T >= cosine
            if same:
                hit &= np.arange(ra.start, ra.stop)[:, None] < np.arange(rb.start, rb.stop)[None, :]
            if hit.any():
                counts[0][ra] += hit @ copies[1][rb]
                counts[1][rb] += copies[0][ra] @ hit
                i, j = np.array(_forest(hit, same and ra == rb)).T
                us.append(keys[0][ra][i])
                vs.append(keys[1][rb][j])
        seen = [np.nonzero(c)[0] for c in counts]
        node = np.concatenate([e[s] for e, s in zip(keys, seen, strict=True)])
        n = np.concatenate([c[s] for c, s in zip(counts, seen, strict=True)])
        u, v = np.concatenate(us), np.concatenate(vs)
        return np.concatenate([node, u]), np.concatenate([node, v]), np.concatenate([n, np.zeros(len(u), np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                sides = [(np.frombuffer(row[f"{s}_nodes"], np.int64), np.frombuffer(row[f"{s}_copies"], np.int64), row[f"{s}_vectors"]) for s in "ab"]
                u, v, n = pair(row["d"], row["a"] == row["b"], sides)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(n)], ["u", "v", "n"])

    return run


def _packed(x: np.ndarray) -> bytes:
    """Single precision where that is exact, which a marker byte tells."""
    with np.errstate(over="ignore"):
        narrow = x.astype(np.float32)
    return b"f" + narrow.tobytes() if (narrow == x).all() else b"d" + x.tobytes()


def _unpacked(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, data[:1].decode(), offset=1).reshape(rows, -1).astype(float)


_INTERVAL_DDL = "interval long, d int, low array<double>, high array<double>, first int, last int, nodes binary, copies binary, vectors binary"


def intervals(vectors: DataFrame, orders: Orders) -> DataFrame:
    """The grid order of (node, copies, d, vector), cut into intervals; first and last are cells of the first axis."""
    names = [f.split()[0] for f in _INTERVAL_DDL.split(", ")]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("d").to_numpy()
            cells: list = [None] * len(dims)
            for d in np.unique(dims).tolist():
                own = np.nonzero(dims == d)[0]
                order = orders.of(d)
                low = order.project(_unit(_matrix(batch.column("vector").take(pa.array(own)))))
                for k, c in zip(own.tolist(), order.keys(low), strict=True):
                    cells[k] = c
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.binary())], [*batch.schema.names, "cell"])

    ordered = vectors.select("node", "copies", "d", "vector").mapInArrow(keyed, "node long, copies long, d int, vector array<double>, cell binary")
    n = max(1, -(-vectors.count() // INTERVAL))
    # the node makes sort keys distinct, so that a crowded cell can be cut
    ordered = ordered.repartitionByRange(n, "d", "cell", "node").sortWithinPartitions("d", "cell", "node")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        k = TaskContext.get().partitionId() << 32
        dim, held, rows = None, [], 0

        def interval() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            x = _matrix(table.column("vector").combine_chunks())
            low = orders.of(dim).project(_unit(x))
            box, cells = _boxes(low), [c.as_py()[0] for c in (table.column("cell")[0], table.column("cell")[-1])]
            packed = [table.column(c).to_numpy().astype(np.int64).tobytes() for c in ("node", "copies")]
            row = dict(zip(names, [k, dim, *(b.tolist() for b in box), *cells, *packed, _packed(x)], strict=True))
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.int32(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in zip(names, kinds, strict=True)], names)

        for batch in batches:
            dims, at = batch.column("d").to_numpy(), 0
            while at < len(dims):
                if dim != dims[at] and rows:
                    yield interval()
                    k, held, rows = k + 1, [], 0
                dim = int(dims[at])
                size = max(1, min(INTERVAL, INTERVAL_BYTES // (8 * dim)))
                end = min(int(np.searchsorted(dims, dim, side="right")), at + size - rows)
                held.append(batch.slice(at, end - at))
                rows, at = rows + end - at, end
                if rows == size:
                    yield interval()
                    k, held, rows = k + 1, [], 0
        if rows:
            yield interval()

    return ordered.mapInArrow(cut, _INTERVAL_DDL)


def _interval_pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(a, b, d): interval pairs whose boxes are near enough, each once."""
    box = blocks.select("interval", "d", "low", "high", "first", "last")
    # a crowded cell of the first axis is dealt over SALTS keys
    a = box.select(F.col("interval").alias("a"), "d", F.col("low").alias("a_low"), F.col("high").alias("a_high"), F.pmod(F.xxhash64("interval"), F.lit(SALTS)).alias("salt"), F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    b = box.select(F.col("interval").alias("b"), "d", F.col("low").alias("b_low"), F.col("high").alias("b_high"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"), "first", "last")
    b = b.select("b", "d", "b_low", "b_high", "salt", F.explode(F.sequence("first", "last")).alias("cell"))
    both = a.join(b, ["d", "salt", "cell"]).filter("a <= b")
    gaps = F.zip_with(F.zip_with("a_low", "b_high", lambda x, y: x - y), F.zip_with("b_low", "a_high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= epsilon * epsilon + _SLACK
    return both.filter(near).select("a", "b", "d").distinct()


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of the table."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    # equal vectors have equal digests; -0.0 counts as 0.0
    digest = F.sha2(F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string"))), 256)
    keyed = materialize(rows.select("vec_id", "vector", F.when(_valid(F.col("vector")), digest).alias("digest")), "vectors")
    sound = keyed.filter("digest is not null")
    distinct = sound.groupBy("digest").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
    distinct = distinct.withColumns({"node": F.xxhash64("digest"), "d": F.size("vector")})
    distinct = materialize(distinct, "distinct")
    epsilon = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    common = [r["d"] for r in distinct.groupBy("d").count().orderBy(F.desc("count"), "d").limit(DIMENSIONS).collect()]
    orders = Orders({d: Order(d, epsilon, _moments(distinct.filter(F.col("d") == d), d)) for d in common}, epsilon)
    blocks = materialize(intervals(distinct, orders), "intervals")
    pairs = materialize(_interval_pairs(blocks, epsilon), "interval_pairs")
    payload = lambda s: blocks.select(F.col("interval").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in ("nodes", "copies", "vectors")))
    shipped = pairs.join(payload("a"), "a").join(payload("b"), "b")
    found = materialize(shipped.mapInArrow(_join(orders, cosine), "u long, v long, n long"), "found")
    counts = found.filter("n > 0").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected_components(found.filter("n = 0").select("u", "v")).withColumnRenamed("node", "member")
    named = distinct.join(counts, "node", "left").join(roots, F.col("node") == F.col("member"), "left")
    named = materialize(named.select("digest", "least_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "named")
    least = materialize(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
    by_digest = materialize(named.join(least, "root").select("digest", "n_links", "component_id"), "by_digest")
    discard(distinct, blocks, pairs, found, named, least)
    linked = keyed.select("vec_id", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return linked.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
