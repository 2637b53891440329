"""Exact neighbor queries, neighbor graphs and graph clustering on a metric index of balls.

Centres, spread out by farthest-first choice from a bounded sample, cut the points into balls: each point belongs to its nearest
centre. A ball keeps its number of points and its radius, so the triangle inequality tells which balls can hold a point within
r of a query: those whose centre is no farther than r plus their radius. Neighboring balls are packed into units of at most
``block`` points (a larger ball is several units). Queries travel in the same units: a query is sent once to each unit with a ball
that it may need, and one task compares the queries of a unit with the points of a unit, a few balls at a time. So rows are copied
once a unit, not once a ball, and no task holds more than two units and ``CELLS`` distances. Balls whose distances to the
centre exclude a query are left out, one matrix product per run gives squared distances that only select candidates (widened by
more than their rounding error), and the candidates' distances are computed exactly by differences.

k nearest neighbors: a first join inside each point's own unit gives its k best so far; the k-th distance, or a bound from the
balls' sizes where it is smaller, is the radius of the second join. Both keep k rows a point and unit. Clusterings never write
pairs: units return counts, forests of their own components, and one link for each component that a border point touches.

The work follows the data: points with structure meet few balls, and exact neighbors of points without any need all of them.
Connected components come from ``plans.components``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from colonnade.plans import components
from colonnade.plans.components import least_reachable
from colonnade.session import materialize

BALL_ROWS = 512  # points of a ball, about
MOST_BALLS = 1024
SAMPLE = 8192  # points among which centres are chosen
UNIT_ROWS = (2048, 16384)  # least and most points that one task compares with as many queries
CELL_ROWS = 16384  # the most points of a unit, also where ``UNIT_ROWS`` asks for more
UNITS = 12  # units at least, where there are points enough
RUN_ROWS = 2048  # points that are compared at once, about
SENT_ROWS = 4096  # rows of a batch of sent queries
CELLS = 1 << 19  # distances that are held at once
PAIRS = 1 << 22  # pairs that a task may return


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows of a list column of one length, as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(len(column), len(flat) // len(column) if len(column) else 0)


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows, each the farthest from those before it (fewer if rows repeat)."""
    picked = [0]
    near = ((x - x[0]) ** 2).sum(1)
    while len(picked) < min(n, len(x)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[picked[-1]]) ** 2).sum(1))
    return x[picked]


def from_centres(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of rows to all centres, by differences."""
    out = np.empty((len(x), len(centres)))
    for at in range(0, len(x), 1024):
        part = x[at:at + 1024]
        for c, centre in enumerate(centres):
            out[at:at + 1024, c] = np.sqrt(((part - centre) ** 2).sum(1))
    return out


def along(centres: np.ndarray) -> np.ndarray:
    """The centres in an order in which each is followed by the nearest of those left."""
    left, order, at = np.ones(len(centres), bool), [], 0
    while len(order) < len(centres):
        order.append(at)
        left[at] = False
        at = int(np.where(left, ((centres - centres[at]) ** 2).sum(1), np.inf).argmin())
    return centres[order]


def exact_distances(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for at in range(0, len(i), 1 << 15):
        out[at:at + (1 << 15)] = np.sqrt(((q[i[at:at + (1 << 15)]] - x[j[at:at + (1 << 15)]]) ** 2).sum(1))
    return out


def candidates(q: np.ndarray, x: np.ndarray, reach: np.ndarray, k: int | None = None):
    """(query, row, distance) with distance <= reach, in runs of queries; with ``k`` at least the k nearest of them, ties
    included. One matrix product a run selects, differences decide."""
    square_q, square_x = (q * q).sum(1), (x * x).sum(1)
    step = max(1, CELLS // max(len(x), 1))
    for at in range(0, len(q), step):
        part, own = q[at:at + step], reach[at:at + step]
        slack = 1e-9 * (square_q[at:at + step] + square_x.max(initial=0)) + 1e-12
        d2 = square_q[at:at + step, None] + square_x[None, :] - 2 * part @ x.T
        limit = own * own
        hit = d2 <= (limit + 2 * slack)[:, None]
        if k is not None and k < len(x):
            busy = np.flatnonzero(np.count_nonzero(hit, axis=1) > 4 * k)
            if len(busy):
                some = d2[busy]
                hit[busy] = some <= (np.minimum(limit[busy], np.partition(some, k - 1, axis=1)[:, k - 1]) + 2 * slack[busy])[:, None]
        i, j = np.nonzero(hit)
        dist = exact_distances(part, x, i, j)
        keep = dist <= own[i]
        yield i[keep] + at, j[keep], dist[keep]


def runs(a: pa.Table, p: pa.Table, centres: np.ndarray, reach: np.ndarray):
    """(queries, rows of p, their vectors) for runs of balls of ``p``, with the queries of ``a`` that may hold one of a run's points within
    ``reach``, which may shrink between the runs."""
    order = np.argsort(p.column("_ball").to_numpy(), kind="stable")
    ball, far, v = p.column("_ball").to_numpy()[order], p.column("_far").to_numpy()[order], matrix(p.column("_v"))
    start = np.flatnonzero(np.append(True, ball[1:] != ball[:-1])[:len(ball)])
    d = from_centres(matrix(a.column("vi")), centres[ball[start]])
    low, high = np.minimum.reduceat(far, start), np.maximum.reduceat(far, start)
    wide = 1e-9 * (1 + far.max() + d.max(initial=0))
    end, at = np.append(start[1:], len(ball)), 0
    while at < len(start):
        to = at + 1
        while to < len(start) and end[to] - start[at] <= RUN_ROWS:
            to += 1
        gap = np.maximum(d[:, at:to] - high[at:to], low[at:to] - d[:, at:to]).min(1)
        asks = np.flatnonzero(gap <= reach + wide)
        if len(asks):
            for row in range(start[at], end[to - 1], RUN_ROWS):
                rows = order[row:min(row + RUN_ROWS, end[to - 1])]
                yield asks, rows, v[rows]
        at = to


class Space:
    """Points (id, vector) in balls. ``points`` has _id, _v, _ball and _far (distance from the centre); ids are unique."""

    def __init__(self, df: DataFrame, id_col: str, vec_col: str, balls: int | None = None, block: int | None = None, group: int | None = None):
        self.spark = df.sparkSession
        rows = df.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_v")).where(F.col("_v").isNotNull())
        some = rows.orderBy(F.xxhash64("_id", F.lit(7)), "_id").limit(SAMPLE).toArrow()
        self.n = rows.count()
        self.block = block or min(max(math.ceil(self.n / UNITS), UNIT_ROWS[0]), UNIT_ROWS[1], CELL_ROWS)
        self.group = group or self.block
        wanted = balls or min(MOST_BALLS, math.ceil(self.n / BALL_ROWS))
        self.centres = along(farthest_first(matrix(some.column("_v")), wanted)) if some.num_rows else np.zeros((0, 0))
        self.id_type = rows.schema["_id"].dataType
        self.kind = self.id_type.simpleString()
        self.points = materialize(self._assigned(rows), "balls")
        self.sizes, self.radius = self._extent(self.points)
        self.units = self._packed(self.sizes, self.block)

    def _assigned(self, rows: DataFrame) -> DataFrame:
        """_id and _v with the nearest ball and the distance of its centre."""
        centres = self.centres

        def assign(batches):
            for b in batches:
                if b.num_rows:
                    d = from_centres(matrix(b.column("_v")), centres)
                    yield pa.record_batch([b.column("_id"), b.column("_v"), pa.array(d.argmin(1).astype(np.int32)), pa.array(d.min(1))], ["_id", "_v", "_ball", "_far"])

        return rows.select("_id", "_v").mapInArrow(assign, f"_id {self.kind}, _v array<double>, _ball int, _far double")

    def _extent(self, points: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        sizes, radius = np.zeros(len(self.centres), np.int64), np.zeros(len(self.centres))
        for r in points.groupBy("_ball").agg(F.count(F.lit(1)).alias("n"), F.max("_far").alias("r")).collect():  # at most MOST_BALLS rows
            sizes[r["_ball"]], radius[r["_ball"]] = r["n"], r["r"]
        return sizes, radius

    @staticmethod
    def _packed(sizes: np.ndarray, block: int) -> list[tuple[int, int, int]]:
        """(ball, first unit, units): consecutive balls share a unit of at most ``block`` rows, a larger ball has several units."""
        out, unit, held = [], 0, 0
        for ball, n in enumerate(sizes.tolist()):
            if held and held + n > block:
                unit, held = unit + 1, 0
            many = max(1, math.ceil(n / block))
            out.append((ball, unit, many))
            unit, held = (unit + many, 0) if many > 1 else (unit, held + n)
        return out

    def _placed(self, rows: DataFrame, units: list[tuple[int, int, int]], ball: str, key: str, name: str) -> DataFrame:
        """``rows`` with the number of their unit."""
        table = F.broadcast(self.spark.createDataFrame(units or [(-1, 0, 1)], f"`{ball}` int, _first int, _many int"))
        at = F.col("_first") + F.pmod(F.xxhash64(key, F.lit(5)), F.col("_many")).cast("int")
        return rows.join(table, ball).withColumn(name, at).drop("_first", "_many")

    def _may(self, vi: np.ndarray, reach: np.ndarray, sizes: np.ndarray, radius: np.ndarray, k: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which balls may hold a point within reach, the reach and the distances of the centres. With ``k``, reach shrinks to a
        distance within which the balls' sizes promise k points."""
        d = from_centres(vi, self.centres)
        if k is not None and sizes.sum() >= k:
            outer = d + radius
            order = np.argsort(outer, 1)
            enough = np.argmax(np.cumsum(sizes[order], 1) >= k, 1)
            bound = np.take_along_axis(outer, np.take_along_axis(order, enough[:, None], 1), 1)[:, 0] * (1 + 1e-9)
            reach = np.minimum(reach, bound)
        return (d - radius[None, :] <= reach[:, None] * (1 + 1e-9) + 1e-12) & (sizes > 0)[None, :], reach, d

    def _sending(self, asks: DataFrame, pick, schema: str) -> DataFrame:
        """``pick(vectors, reach, batch)`` names (row, target, reach, distance); its rows go out in batches of bounded size."""

        def run(batches):
            for b in batches:
                for at in range(0, b.num_rows, 1024):
                    part = b.slice(at, 1024)
                    i, target, reach, d = pick(matrix(part.column("vi")), part.column("reach").to_numpy(), part)
                    for to in range(0, len(i), SENT_ROWS):
                        rows = i[to:to + SENT_ROWS]
                        take = pa.array(rows)
                        kept = [pa.array(reach[rows]) if c == "reach" else part.column(c).take(take) for c in part.schema.names]
                        more = [pa.array(target[to:to + SENT_ROWS].astype(np.int32))] + ([] if d is None else [pa.array(d[to:to + SENT_ROWS])])
                        yield pa.record_batch([*kept, *more], [*part.schema.names, *schema])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asks.schema.fields)
        return asks.mapInArrow(run, fields + "".join(f", {n} {t}" for n, t in schema.items()))

    def addressed(self, asks: DataFrame, sizes: np.ndarray, radius: np.ndarray) -> DataFrame:
        """``asks`` (i, vi, reach, ..) once for every ball that may hold a point within reach."""

        def pick(vi, reach, _):
            may, reach, d = self_may(vi, reach)
            i, ball = np.nonzero(may)
            return i, ball, reach, d[i, ball]

        self_may = self._picker(sizes, radius)
        return self._sending(asks, pick, {"ball": "int", "far": "double"})

    def _picker(self, sizes: np.ndarray, radius: np.ndarray, k: int | None = None):
        """``_may`` as a function that tasks can hold."""
        bare = Space.__new__(Space)
        bare.centres = self.centres
        return lambda vi, reach: bare._may(vi, reach, sizes, radius, k)

    def sent(self, asks: DataFrame, sizes: np.ndarray, radius: np.ndarray, k: int | None = None, asked: np.ndarray | None = None) -> tuple[DataFrame, DataFrame]:
        """``asks`` (i, vi, reach, ball, ..; ball is the nearest) once for every unit (columns grp, unit) that may hold a point within
        reach, and the (grp, unit) that occur. With ``k`` a query's own unit is left out. ``asked``: queries by ball, if not the points."""
        firsts, many = (np.array([u[c] for u in self.units]) for c in (1, 2))
        n_units = int((firsts + many).max(initial=0))
        may_of = self._picker(sizes, radius, k)

        def units_of(vi, reach, part):
            may, reach, _ = may_of(vi, reach)
            to = np.zeros((len(vi), n_units), bool)
            for ball in np.flatnonzero(may.any(0)):
                to[:, firsts[ball]:firsts[ball] + many[ball]] |= may[:, ball, None]
            if k is not None:
                to[np.arange(len(vi)), part.column("grp").to_numpy()] = False
            return to, reach

        def pick(vi, reach, part):
            to, reach = units_of(vi, reach, part)
            i, unit = np.nonzero(to)
            return i, unit, reach, None

        def pairs(batches):
            for b in batches:
                for at in range(0, b.num_rows, 1024):
                    part = b.slice(at, 1024)
                    i, unit = np.nonzero(units_of(matrix(part.column("vi")), part.column("reach").to_numpy(), part)[0])
                    seen = np.unique(part.column("grp").to_numpy()[i].astype(np.int64) * n_units + unit)
                    yield pa.record_batch([pa.array((seen // n_units).astype(np.int32)), pa.array((seen % n_units).astype(np.int32))], ["grp", "unit"])

        groups = self.units if asked is None else self._packed(asked, self.block)
        asks = self._placed(asks, groups, "ball", "i", "grp")
        used = materialize(asks.select("vi", "reach", "grp").mapInArrow(pairs, "grp int, unit int").distinct(), "unit-pairs")
        return self._sending(asks, pick, {"unit": "int"}), used

    def meet(self, sent: tuple[DataFrame, DataFrame], points: DataFrame, compare, schema: str, parts: int = 1) -> DataFrame:
        """``compare(asks, points)`` on Arrow tables for the queries of every unit and the points of every unit that they are sent to,
        about ``block`` rows each; ``parts`` cuts both finer."""
        asks, used = sent
        keys = ["grp", "unit", "part", "slice"]
        cuts = max(parts, math.ceil(self.block / self.group))
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        mine = lambda c, seed, n: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(n)).cast("int")
        left = asks.withColumn("part", mine("i", 3, cuts)).withColumn("slice", each(parts))
        right = self._placed(points, self.units, "_ball", "_id", "unit").join(F.broadcast(used), "unit").withColumn(
            "slice", mine("_id", 11, parts)).withColumn("part", each(cuts))
        empty = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in self.spark.createDataFrame([], schema).schema.fields]).empty_table()

        def run(a: pa.Table, p: pa.Table) -> pa.Table:
            return compare(a, p).cast(empty.schema) if a.num_rows and p.num_rows else empty

        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)

    def asks(self, reach: float, *more) -> DataFrame:
        """All points as queries."""
        return self.points.select(F.col("_id").alias("i"), F.col("_v").alias("vi"), F.lit(float(reach)).alias("reach"), F.col("_ball").alias("ball"), *more)

    def within(self, queries: DataFrame, r: float, strict: bool = False) -> DataFrame:
        """All (i, j, dist) with dist <= r (< r when strict), i from ``queries`` (columns _id, _v), j from all points, i == j
        included."""
        centres = self.centres

        def compare(a, p):
            ids, own, q = p.column("_id").combine_chunks(), a.column("i").combine_chunks(), matrix(a.column("vi"))
            reach, out = a.column("reach").to_numpy(), [pa.table([own[:0], ids[:0], pa.array([], pa.float64())], ["i", "j", "dist"])]
            for asks, rows, v in runs(a, p, centres, reach):
                for i, j, dist in candidates(q[asks], v, reach[asks]):
                    keep = dist < r if strict else np.ones(len(dist), bool)
                    out.append(pa.table([own.take(pa.array(asks[i[keep]])), ids.take(pa.array(rows[j[keep]])), pa.array(dist[keep])], ["i", "j", "dist"]))
            return pa.concat_tables(out)

        near = self._assigned(queries)
        asked, _ = self._extent(near)
        asks = near.select(F.col("_id").alias("i"), F.col("_v").alias("vi"), F.lit(float(r)).alias("reach"), F.col("_ball").alias("ball"))
        return self.meet(self.sent(asks, self.sizes, self.radius, asked=asked), self.points, compare, f"i {self.kind}, j {self.kind}, dist double",
                         math.ceil(self.block / math.sqrt(PAIRS)))

    def knn(self, k: int, max_reach: float = math.inf) -> DataFrame:
        """Exact k nearest neighbors (self included) no farther than ``max_reach``: (i, j, dist, rank), ties by the smaller id."""
        schema, centres = f"i {self.kind}, j {self.kind}, dist double", self.centres

        def compare(a, p):
            ids, own, q = p.column("_id").combine_chunks(), a.column("i").combine_chunks(), matrix(a.column("vi"))
            by_id, reach = pc.rank(ids, tiebreaker="first").to_numpy(), a.column("reach").to_numpy().copy()
            found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]

            def first(i, j, dist):
                """The k nearest of each query, sorted, and the k-th distances of those that have so many."""
                order = np.lexsort((by_id[j], dist, i))
                i, j, dist = i[order], j[order], dist[order]
                begin = np.flatnonzero(np.append(True, i[1:] != i[:-1])[:len(i)])
                rank = np.arange(len(i)) - np.repeat(begin, np.diff(np.append(begin, len(i))))
                last = rank == k - 1
                reach[i[last]] = np.minimum(reach[i[last]], dist[last])
                return i[rank < k], j[rank < k], dist[rank < k]

            for asks, rows, v in runs(a, p, centres, reach):
                for i, j, dist in candidates(q[asks], v, reach[asks], k):
                    for held, new in zip(found, first(asks[i], rows[j], dist)):
                        held.append(new)
            i, j, dist = first(*map(np.concatenate, found))
            return pa.table([own.take(pa.array(i)), ids.take(pa.array(j)), pa.array(dist)], ["i", "j", "dist"])

        best = Window.partitionBy("i").orderBy("dist", "j")
        ids = sorted({unit + x for _, unit, many in self.units for x in range(many)})
        home = self._placed(self.asks(max_reach), self.units, "ball", "i", "grp").withColumn("unit", F.col("grp"))
        own = self.spark.createDataFrame([(u, u) for u in ids] or [(-1, -1)], "grp int, unit int")
        near = materialize(self.meet((home, own), self.points, compare, schema), "own-unit")
        if len(ids) > 1:
            kth = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("i", F.col("dist").alias("kth"))
            more = self.asks(max_reach).drop("reach").join(kth, "i", "left").select(
                "i", "vi", F.least(F.coalesce("kth", F.lit(math.inf)), F.lit(float(max_reach))).alias("reach"), "ball")
            sent = self.sent(materialize(more, "asks"), self.sizes, self.radius, k)
            near = near.unionByName(self.meet(sent, self.points, compare, schema))
        return materialize(near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "knn")


def knn_graph(space: Space, k: int) -> DataFrame:
    """Symmetrized connectivity graph 0.5 (A + A'), A[i, j] = 1 when j is
    among the k nearest neighbors of i (self included): (src, dst, weight)."""
    a = space.knn(k).select(F.col("i").alias("src"), F.col("j").alias("dst"))
    both = a.select("src", "dst", F.lit(0.5).alias("w")).unionByName(
        a.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0.5).alias("w")))
    return both.groupBy("src", "dst").agg(F.sum("w").alias("weight"))


def core_distance(space: Space, min_samples: int, max_eps: float = math.inf) -> DataFrame:
    """Distance to the min_samples-th neighbor (self counted); infinite when
    it lies beyond ``max_eps``."""
    kth = space.knn(min_samples, max_eps).where(F.col("rank") == min_samples)
    return space.points.select(F.col("_id").alias("id")).join(
        kth.select(F.col("i").alias("id"), F.col("dist").alias("core_distance")), "id", "left") \
        .fillna(math.inf, subset=["core_distance"])


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component = smallest id in the component); ``edges`` (src, dst) are undirected, ids without an edge are
    their own component.  Rounds grow with the logarithm of the longest path and end when nothing changes."""
    cc = components.connected_components(edges, "src", "dst")
    return vertices.select("id").join(cc.withColumnRenamed("vertex", "id"), "id", "left") \
        .select("id", F.coalesce("component", "id").alias("component"))


def neighbor_counts(space: Space, r: float) -> DataFrame:
    """(i, n): how many points lie within r of each point, itself included.  Units return one row a query."""
    centres = space.centres

    def compare(a, p):
        n, q, reach = np.zeros(a.num_rows, np.int64), matrix(a.column("vi")), a.column("reach").to_numpy()
        for asks, _, v in runs(a, p, centres, reach):
            for i, _, _ in candidates(q[asks], v, reach[asks]):
                n[asks] += np.bincount(i, minlength=len(asks))
        return pa.table([a.column("i"), pa.array(n)], ["i", "n"])

    met = space.meet(space.sent(space.asks(r), space.sizes, space.radius), space.points, compare, f"i {space.kind}, n long")
    return met.groupBy("i").agg(F.sum("n").alias("n"))


def links(space: Space, points: DataFrame, r: float, strict: bool = False) -> DataFrame:
    """(src, dst, inner) that connect what lies within r of each other.  ``points`` has the columns of ``Space.points`` and
    _core.  Core points within r of each other end in one component of the ``inner`` links; a point that is not core has
    a link (not inner) to one core point of each component that it touches in a unit.  Units return at most one link a
    point and component, never their pairs."""
    core = materialize(points.where("_core").drop("_core"), "cores")
    sizes, radius = space._extent(core)
    centres = space.centres

    def compare(a, p):
        ids, own = p.column("_id").combine_chunks(), a.column("i").combine_chunks()
        is_core = a.column("core").to_numpy(zero_copy_only=False).astype(bool)
        m, n = p.num_rows, p.num_rows + a.num_rows
        label, touch = np.arange(n), [np.zeros((2, 0), np.int64)]
        q, reach = matrix(a.column("vi")), a.column("reach").to_numpy()
        for asks, rows, v in runs(a, p, centres, reach):
            for i, j, dist in candidates(q[asks], v, reach[asks]):
                near = dist < r if strict else np.ones(len(dist), bool)
                i, j = asks[i[near]], rows[j[near]]
                if not len(i):
                    continue
                inner = is_core[i]
                if inner.any():
                    label = least_reachable(np.concatenate([np.arange(n), i[inner] + m]), np.concatenate([label, j[inner]]), n)
                if not inner.all():
                    touch.append(np.unique(np.stack([i[~inner], label[j[~inner]]]), axis=1))
        q = np.flatnonzero(label[m:] < m)  # core queries with a point in reach
        rows = np.flatnonzero(label[:m] < np.arange(m))
        t = np.concatenate(touch, 1)
        t = np.unique(np.stack([t[0], label[t[1]]]), axis=1)
        src = pa.concat_arrays([own.take(pa.array(q)), ids.take(pa.array(rows)), own.take(pa.array(t[0]))])
        dst = ids.take(pa.array(np.concatenate([label[m:][q], label[:m][rows], t[1]])))
        return pa.table([src, dst, pa.array(np.arange(len(src)) < len(q) + len(rows))], ["src", "dst", "inner"])

    asks = points.select(F.col("_id").alias("i"), F.col("_v").alias("vi"), F.lit(float(r)).alias("reach"), F.col("_ball").alias("ball"), F.col("_core").alias("core"))
    met = space.meet(space.sent(asks, sizes, radius), core, compare, f"src {space.kind}, dst {space.kind}, inner boolean")
    return materialize(met, "links")


def single_link(space: Space, distance_threshold: float) -> DataFrame:
    """Single-linkage clusters cut at a distance: connected components of
    the graph of pairs closer than the threshold.  (id, cluster)."""
    found = links(space, space.points.withColumn("_core", F.lit(True)), distance_threshold, strict=True)
    cc = connected_components(space.points.select(F.col("_id").alias("id")), found.select("src", "dst"))
    return cc.withColumnRenamed("component", "cluster")


def density_clusters(space: Space, eps: float, min_samples: int) -> DataFrame:
    """Density clusters at ``eps``: core points have at least min_samples
    points (self included) within eps; clusters are the connected
    components of core points; a border point joins the smallest cluster
    label among its core neighbors; the rest is noise (-1)."""
    counts = neighbor_counts(space, eps).withColumnRenamed("i", "_id")
    points = materialize(space.points.join(counts, "_id").withColumn("_core", F.col("n") >= min_samples).drop("n"), "core-flags")
    found = links(space, points, eps)
    core = points.where("_core").select(F.col("_id").alias("id"))
    cc = materialize(connected_components(core, found.where("inner").select("src", "dst")), "core-components")
    border = found.where("not inner").join(cc.select(F.col("id").alias("dst"), "component"), "dst").groupBy("src").agg(F.min("component").alias("b"))
    pts = space.points.select(F.col("_id").alias("id"))
    return pts.join(cc, "id", "left").join(border.withColumnRenamed("src", "id"), "id", "left") \
        .select("id", F.coalesce("component", "b", F.lit(-1)).alias("cluster"))
