"""Centroid clustering in exact integers, with ball trees that hand whole balls to a centroid.

Vectors are turned into integers once and dealt into trees: every task builds
trees of a few thousand of the vectors that it reads, nothing is shuffled, and
the trees are written down as rows of a table. A node of a tree is a ball; it has
its members' number and integer sum, their mean as its centre, and the distance
of the farthest one as its radius. In each round a task walks its trees from
their roots with the centroids that can still be nearest: by the triangle
inequality a centroid goes if it is farther from the centre than the nearest
one by more than twice the radius. A ball for which one centroid is left goes to
it whole, by its count and sum; other balls are opened, down to leaves, whose
vectors are compared in exact integers. What leaves a task is a count and a sum
for each centroid.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.plans.scratch import Scratch

#: Integers of a larger size could not be squared and summed in 64 bits over the components.
LARGEST = 1 << 27
#: Up to this size of all integers a product of matrices of doubles is exact; beyond it integers are multiplied.
EXACT = 1 << 22
TREE_ROWS, LEAF = 4096, 32
TREE = "ids array<bigint>, points binary, sums binary, counts binary, radius binary, starts binary, children binary"


class Tree:
    """A ball tree over rows of integers. Node 0 is the root; a node holds the rows from ``starts`` on, ``counts`` of them; ``children`` is its first child's number (the other one follows), 0 for a leaf."""

    def __init__(self, points, sums, counts, radius, starts, children):
        self.points, self.sums, self.counts, self.radius, self.starts, self.children = points, sums, counts, radius, starts, children

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF) -> tuple[Tree, np.ndarray]:
        """(tree, the order into which it puts the rows). A ball is halved across the line between two far members; equal members are not."""
        order = np.arange(len(points))
        values = points.astype(np.float64)
        starts, counts, children, radius, sums = [0], [len(points)], [0], [], []
        at = 0
        while at < len(starts):
            rows = slice(starts[at], starts[at] + counts[at])
            held = values[order[rows]]
            sums.append(points[order[rows]].sum(0, dtype=np.int64))
            centre = sums[-1] / counts[at]
            far = ((held - centre) ** 2).sum(1)
            # a little more than the distance, so that rounding leaves no member outside
            radius.append(float(np.sqrt(far.max()) * (1 + 1e-9) + 1e-9))
            if counts[at] > leaf and far.max() > 0:
                one = held[far.argmax()]
                other = held[((held - one) ** 2).sum(1).argmax()]
                half = counts[at] // 2
                order[rows] = order[rows][np.argpartition(held @ (other - one), half)]
                children[at] = len(starts)
                starts += [starts[at], starts[at] + half]
                counts += [half, counts[at] - half]
                children += [0, 0]
            at += 1
        tree = cls(points[order], np.array(sums), np.array(counts), np.array(radius), np.array(starts), np.array(children))
        return tree, order

    def row(self, ids: list) -> tuple:
        return (ids, self.points.astype("<i4").tobytes(), self.sums.astype("<i8").tobytes(), self.counts.astype("<i8").tobytes(), self.radius.astype("<f8").tobytes(), self.starts.astype("<i8").tobytes(), self.children.astype("<i8").tobytes())

    @classmethod
    def read(cls, row: dict, dims: int) -> Tree:
        def array(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(row[name], dtype=kind)

        return cls(array("points", "<i4").reshape(-1, dims), array("sums", "<i8").reshape(-1, dims), array("counts", "<i8"), array("radius", "<f8"), array("starts", "<i8"), array("children", "<i8"))

    def walk(self, centroids: np.ndarray):
        """(balls, their centroids, rows of opened leaves, their centroids): every row is in one ball or one leaf.

        Of centroids at the same distance the smaller number counts: a ball goes
        whole only if all others are farther from every member.
        """
        c = centroids.astype(np.float64)
        c2 = (c * c).sum(1)
        nodes, may = np.zeros(1, dtype=np.int64), np.ones((1, len(c)), dtype=bool)
        balls, owners, leaves, allowed = [], [], [], []
        while len(nodes):
            x = self.sums[nodes] / self.counts[nodes][:, None]
            x2 = (x * x).sum(1)
            # squares cancel: what rounding leaves of a distance is within this slack
            slack = 1e-6 * (1 + np.sqrt(x2) + np.sqrt(c2.max()))
            away = np.sqrt(np.maximum(0, x2[:, None] - 2 * (x @ c.T) + c2))
            away[~may] = np.inf
            may = away <= (away.min(1) + 2 * self.radius[nodes] + slack)[:, None]
            settled = may.sum(1) == 1
            balls.append(nodes[settled])
            owners.append(may[settled].argmax(1))
            end = ~settled & (self.children[nodes] == 0)
            leaves.append(nodes[end])
            allowed.append(may[end])
            opened = ~settled & ~end
            first, may = self.children[nodes[opened]], np.concatenate([may[opened], may[opened]])
            nodes = np.concatenate([first, first + 1])
        leaves, allowed = np.concatenate(leaves), np.concatenate(allowed)
        rows = self.rows_of(leaves)
        return np.concatenate(balls), np.concatenate(owners), rows, nearest(self.points[rows], centroids, np.repeat(allowed, self.counts[leaves], axis=0))

    def rows_of(self, nodes: np.ndarray) -> np.ndarray:
        sizes = self.counts[nodes]
        return np.repeat(self.starts[nodes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())

    def gather(self, centroids: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
        """Add the tree's rows to their centroids' counts and sums."""
        balls, owners, rows, labels = self.walk(centroids)
        np.add.at(counts, owners, self.counts[balls])
        np.add.at(sums, owners, self.sums[balls])
        np.add.at(counts, labels, 1)
        np.add.at(sums, labels, self.points[rows])

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of every row."""
        balls, owners, rows, labels = self.walk(centroids)
        out = np.empty(len(self.points), dtype=np.int64)
        out[rows] = labels
        out[self.rows_of(balls)] = np.repeat(owners, self.counts[balls])
        apart = self.points - centroids[out]
        return out, (apart * apart).sum(1)


def nearest(points: np.ndarray, centroids: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """The nearest allowed centroid of every point, in exact arithmetic; of equally near ones the smaller number."""
    exact = np.float64 if max(abs(points).max(initial=0), abs(centroids).max(initial=0)) <= EXACT else np.int64
    c = centroids.astype(exact)
    apart = (c * c).sum(1) - 2 * (points.astype(exact) @ c.T)  # the points' own squares change no order
    apart[~allowed] = np.inf if exact is np.float64 else np.iinfo(np.int64).max
    return apart.argmin(1)


def usable(vectors: DataFrame, vector: str, dims: int, scale: int) -> DataFrame:
    """The rows whose vector has so many components, all of them finite and, times scale, no larger than LARGEST."""
    whole = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) <= LARGEST // scale, F.lit(False)))
    return vectors.where((F.size(vector) == dims) & whole)


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(values.astype(np.float64) * scale).astype(np.int64)


def plant(vectors: DataFrame, id: str, vector: str, dims: int, scale: int, tree_rows: int = TREE_ROWS, leaf: int = LEAF) -> DataFrame:
    """One row a tree: every task's rows, so many to a tree at most."""

    def run(batches):
        ids, held, n = [], [], 0

        def tree():
            built, order = Tree.build(np.concatenate(held), leaf)
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, built.row([ids[i] for i in order]), strict=True))], schema)

        for batch in batches:
            values = integers(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
            keys = batch.column("id").to_pylist()
            at = 0
            while at < len(keys):
                take = min(tree_rows - n, len(keys) - at)
                ids += keys[at : at + take]
                held.append(values[at : at + take])
                n, at = n + take, at + take
                if n == tree_rows:
                    yield tree()
                    ids, held, n = [], [], 0
        if n:
            yield tree()

    binary = ("points", "sums", "counts", "radius", "starts", "children")
    schema = pa.schema([("ids", pa.list_(pa.int64())), *[(x, pa.binary()) for x in binary]])
    return vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, TREE)


def first_centroids(vectors: DataFrame, id: str, vector: str, k: int, salt: str, scale: int) -> np.ndarray:
    """The k vectors whose ids, behind the salt, have the least SHA-256, in that order; equal ids by vector, rows without an id last."""
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(id).cast("string")), 256)
    rows = vectors.select(mark.alias("mark"), F.col(vector).cast("array<double>").alias("v")).orderBy(F.asc_nulls_last("mark"), "v").limit(k).collect()
    return integers(np.array([r.v for r in rows]), scale) if rows else np.empty((0, 0), dtype=np.int64)


def moved(trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of their vectors' mean; those without vectors stay."""
    k, dims = centroids.shape

    def run(batches):
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                Tree.read(row, dims).gather(centroids, counts, sums)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(counts[full]), pa.array(sums[full].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = trees.drop("ids").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(20,0)")) for i in range(dims)]).alias("sums")).collect()
    out = centroids.copy()
    for r in totals:
        out[r.cluster] = [int(x) // r.n for x in r.sums]
    return out


def cluster(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, salt: str = "2", tree_rows: int = TREE_ROWS, leaf: int = LEAF
) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every usable vector, the final centroids): so many rounds of k-means, and a last assignment.

    Components become floor(scale * x). Vectors of another length, or with
    components that are null, not finite or beyond LARGEST / scale (their
    distances do not fit 64 bits), do not take part. Rows that repeat an id
    count each; rows without an id are clustered, and start a centroid last. With
    fewer vectors than k there are as many centroids; without any the result is
    empty. The driver holds k centroids and gets a count and a sum for each.
    """
    ready = usable(vectors, vector, dims, scale)
    scratch = Scratch(vectors.sparkSession, "balltree")
    centroids = first_centroids(ready, id, vector, k, salt, scale)
    trees = scratch.keep(plant(ready, id, vector, dims, scale, tree_rows, leaf) if len(centroids) else plant(ready, id, vector, dims, scale).limit(0))
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(trees, centroids)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                label, distance = Tree.read(row, dims).assign(centroids)
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(label.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    assigned = scratch.keep(trees.mapInArrow(run, "id bigint, cluster int, distance bigint"))
    scratch.drop(trees)
    return assigned.withColumnRenamed("id", id), centroids


def query(embeddings: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector. Sums that do not fit a long are null."""
    assigned, centroids = cluster(embeddings)
    by = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    marks = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str):
        return F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), F.col("cluster")) if values else F.lit(None).cast(kind)

    def fits(n: int) -> int | None:
        return n if n < 1 << 63 else None

    return assigned.select(
        "vec_id", "cluster", "distance", of_cluster([fits(by.get(i, 0)) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(fits(sum(by.values()))).cast("long").alias("inertia"), of_cluster(marks, "string").alias("centroid_sha256"),
    )


def oracle(dims: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, salt: str = "2") -> str:
    """The same by comparing every vector with every centroid."""

    def assign(centroids: str) -> str:
        return f"""SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
            SELECT row, cluster, list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d FROM kept, {centroids}) GROUP BY row"""

    ctes = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x::DOUBLE) <= {LARGEST // scale})) = {dims})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id) NULLS LAST, v) - 1 AS cluster, v AS c FROM kept QUALIFY cluster < {k})",
    ]
    for i in range(rounds):
        ctes.append(f"a{i} AS MATERIALIZED ({assign(f'c{i}')})")
        floors = "list((s - ((s % n) + n) % n) // n ORDER BY j)"
        ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN (SELECT cluster, {floors} AS m FROM (
            SELECT cluster, j, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range({dims})) AS j FROM a{i} JOIN kept USING (row)) GROUP BY ALL) GROUP BY cluster) USING (cluster))""")
    ctes.append(f"a AS MATERIALIZED ({assign(f'c{rounds}')})")
    return f"""WITH {', '.join(ctes)}
    SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a JOIN kept USING (row) JOIN c{rounds} USING (cluster)"""
