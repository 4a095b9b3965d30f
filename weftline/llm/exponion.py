"""Centroid clustering over whole numbers by exponion search: exact Lloyd rounds that look at few centroids.

A vector keeps an upper bound of the distance to its centroid and a lower bound of the distance to all others; both move with
the centroids. Where the bounds can't tell, it scans only the centroids inside a ball around its own one: of radius twice
the upper bound plus the distance from that centroid to the nearest other. Each centroid has the others in order of distance,
so a ball is a prefix of that list. The radius is inclusive and bounds decide only if strictly less, so ties are seen, and go
to the smaller number.

Vectors are packed in blocks and written once, bucketed by block, to the shared folder; bounds are a second, small table in the
same buckets, written anew each round. So a round joins both without a shuffle, and only bounds are written. Moved vectors
change their centroids' sums; sums of a round come together as one row for each centroid and dimension.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import cut_lineage, ensure_checkpoint_dir
from weftline.llm.vectors import matrix

#: Vectors in a block; the largest whole number of a component (beyond it, squared distances would pass 64 bits).
BLOCK, LARGEST = 1024, 1 << 27
#: Sums of doubles up to this are exact whole numbers.
EXACT = 1 << 53
#: Centroids at most: the table of their distances goes to all tasks.
MOST_CENTROIDS = 4096
#: Components at most, so that squared distances fit in 64 bits.
MOST_DIMS = 127

STATE = "block long, cluster array<int>, upper array<double>, lower array<double>, k array<int>, n array<long>, sums array<long>, looked long"


def whole(vector: Column, scale: int) -> Column:
    """Components as whole numbers floor(scale * x), by doubles; beyond ``LARGEST`` they are taken as that."""
    limit = F.lit(float(LARGEST))
    return F.transform(vector.cast("array<double>"), lambda x: F.greatest(F.least(F.floor(F.greatest(F.least(x * scale, limit), -limit)), F.lit(LARGEST)), F.lit(-LARGEST)).cast("long"))


def kept(vectors: DataFrame, vector: str, dims: int) -> DataFrame:
    """Rows whose vector has ``dims`` components, none of them null or not finite."""
    x = F.col(vector).cast("array<double>")
    ok = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where(F.coalesce(ok, F.lit(False)))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x (int64) from all rows of c."""
    if 4 * x.shape[1] * int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))) ** 2 <= EXACT:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(axis=1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(axis=1)[None, :]).astype(np.int64)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]


def up(x: np.ndarray) -> np.ndarray:
    """Not less than the true value, whatever was lost in a few operations of doubles."""
    return x * (1 + 1e-12) + 1e-9


def down(x: np.ndarray) -> np.ndarray:
    return x * (1 - 1e-12) - 1e-9


class Balls:
    """Centroids with the others of each in order of distance."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        self.centroids = centroids
        apart = np.sqrt(squared(centroids, centroids).astype(np.float64))
        np.fill_diagonal(apart, 0.0)
        self.order = np.argsort(apart, axis=1, kind="stable").astype(np.int32)
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        np.fill_diagonal(apart, np.inf)
        self.nearest = apart.min(axis=1)
        if before is not None:
            self.moved = up(np.sqrt(((centroids - before) ** 2).sum(axis=1).astype(np.float64)))
            most = np.sort(self.moved)[::-1]
            top = int(np.argmax(self.moved))
            #: How far any other centroid than this one has moved at most.
            self.others = np.where(np.arange(len(centroids)) == top, most[1] if len(most) > 1 else 0.0, most[0])

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(cluster, upper, lower, distances looked at) by looking at all centroids."""
        d = squared(x, self.centroids)
        own = d.argmin(axis=1)
        least = np.take_along_axis(d, own[:, None], axis=1)[:, 0]
        rest = d.astype(np.float64)
        rest[np.arange(len(x)), own] = np.inf
        return own.astype(np.int32), up(np.sqrt(least)), down(np.sqrt(rest.min(axis=1))), d.size

    def again(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The same from the last round's, after the centroids have moved."""
        cluster, upper, lower = cluster.copy(), up(upper + self.moved[cluster]), down(lower - self.others[cluster])
        sure = np.maximum(lower, down(self.nearest[cluster] / 2))
        doubt = np.flatnonzero(~(upper < sure))
        looked = len(doubt)
        if looked:
            near = (x[doubt] - self.centroids[cluster[doubt]]).astype(np.int64)
            upper[doubt] = up(np.sqrt((near * near).sum(axis=1).astype(np.float64)))
            doubt = doubt[~(upper[doubt] < sure[doubt])]
        radius = up(2 * upper[doubt] + self.nearest[cluster[doubt]])
        for a in np.unique(cluster[doubt]).tolist():
            mine = np.flatnonzero(cluster[doubt] == a)
            inside = np.searchsorted(self.apart[a], radius[mine], side="right")
            # Balls of like size together: each scans the next power of two of the list, so twice its ball at most.
            size = np.minimum(1 << np.ceil(np.log2(np.maximum(inside, 2))).astype(np.int64), len(self.centroids))
            for m in np.unique(size).tolist():
                rows = doubt[mine[size == m]]
                some = np.sort(self.order[a, :m])  # by number, so that the first of equal distances is the smaller
                d = squared(x[rows], self.centroids[some])
                looked += d.size
                own = d.argmin(axis=1)
                upper[rows] = up(np.sqrt(np.take_along_axis(d, own[:, None], axis=1)[:, 0].astype(np.float64)))
                rest = d.astype(np.float64)
                rest[np.arange(len(rows)), own] = np.inf
                # Whatever is outside the ball is further than the second nearest inside.
                lower[rows] = down(np.sqrt(rest.min(axis=1)))
                cluster[rows] = some[own]
        return cluster, upper, lower, looked


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else np.zeros(0), kind))


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """(id, v) to (block, ids, flat): ``BLOCK`` vectors at most in a row, one behind the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                ids, flat = part.column("id").to_pylist(), matrix(part.column("v"), np.int64).ravel()
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), _lists([flat], pa.int64())], names=["block", "ids", "flat"])
                number += 1

    return rows.mapInArrow(run, "block long, ids array<long>, flat array<long>")


def assigned(met: DataFrame, centroids: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """Blocks (with the last round's state, if there was one) to the next state, and by how much sums change."""
    dims, count = centroids.shape[1], len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = Balls(centroids, before)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: np.asarray(batch.column(n)[i].values) for n in batch.schema.names if n not in ("block", "ids")}
                x = row["flat"].reshape(-1, dims)
                if before is None:
                    own, upper, lower, looked = balls.first(x)
                    changed = np.arange(len(x))
                else:
                    own, upper, lower, looked = balls.again(x, row["cluster"], row["upper"], row["lower"])
                    changed = np.flatnonzero(own != row["cluster"])
                n, sums = np.zeros(count, np.int64), np.zeros((count, dims), np.int64)
                np.add.at(n, own[changed], 1)
                np.add.at(sums, own[changed], x[changed])
                touched = set(own[changed].tolist())
                if before is not None:
                    np.subtract.at(n, row["cluster"][changed], 1)
                    np.subtract.at(sums, row["cluster"][changed], x[changed])
                    touched |= set(row["cluster"][changed].tolist())
                k = np.array(sorted(touched), np.int32)
                lists = [_lists([own], pa.int32()), _lists([upper], pa.float64()), _lists([lower], pa.float64()), _lists([k], pa.int32()), _lists([n[k]], pa.int64()), _lists([sums[k].ravel()], pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), *lists, pa.array([looked], pa.int64())], names=["block", "cluster", "upper", "lower", "k", "n", "sums", "looked"])

    return met.mapInArrow(run, STATE)


def changes(state: DataFrame, dims: int) -> tuple[dict[int, int], dict[int, list[int]]]:
    """By how many vectors, and by which sums, each centroid changes: a number for each centroid and dimension."""
    each = state.select(F.explode(F.arrays_zip("k", "n", F.sequence(F.lit(0), F.greatest(F.size("k") - 1, F.lit(0))).alias("at"))).alias("e"), "sums").where("e.k is not null")
    cut = each.select("e.k", "e.n", F.slice("sums", F.col("e.at") * dims + 1, dims).alias("sums"))
    counts = {r["k"]: r["n"] for r in cut.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    sums: dict[int, list[int]] = {k: [0] * dims for k in counts}
    for r in cut.select("k", F.posexplode("sums").alias("d", "x")).groupBy("k", "d").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        sums[r["k"]][r["d"]] = int(r["x"])
    return counts, sums


class _Tables:
    """Tables bucketed by block in a folder of their own under the shared one; gone when done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.name = spark, f"exponion_{uuid.uuid4().hex}"
        self.folder = f"{ensure_checkpoint_dir(spark)}/{self.name}"
        self.buckets = max(1, min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def write(self, df: DataFrame, suffix: str) -> DataFrame:
        table = f"{self.name}_{suffix}"
        df.write.bucketBy(self.buckets, "block").sortBy("block").option("path", f"{self.folder}/{suffix}").format("parquet").saveAsTable(table)
        return self.spark.table(table)

    def drop(self, suffix: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{suffix}")
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{suffix}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, dims: int = 64, seed: int = 3, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector.

    Kept are vectors of ``dims`` components, none null or not finite. The first centroids are the ``k`` of least SHA-256 of
    ``seed:id`` (nothing for a null id; of repeated ids those of least vector first, and fewer if there are fewer vectors); equal
    centroids are allowed, the smaller number has all their vectors. A centroid becomes the floor of its vectors' mean;
    one without vectors stays. Repeated rows stay and count each. Components beyond 2**27 / ``scale`` are taken as that.
    Other columns are left out, an empty table gives no rows.
    """
    if not 1 <= k <= MOST_CENTROIDS or not 1 <= dims <= MOST_DIMS:
        raise ValueError(f"needs 1 to {MOST_CENTROIDS} centroids and 1 to {MOST_DIMS} components")
    spark = vectors.sparkSession
    rows = kept(vectors, vector, dims).select(F.col(id_col).cast("long").alias("id"), whole(F.col(vector), scale).alias("v"))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    drawn = rows.orderBy(hashed, "v").limit(k).select("v").collect()
    schema = f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not drawn:
        return spark.createDataFrame([], schema)
    centroids, before = np.array([r["v"] for r in drawn], np.int64), None
    counts, sums = np.zeros(len(centroids), np.int64), [[0] * dims for _ in centroids]
    tables = _Tables(spark)
    data = tables.write(blocks(rows, dims).repartition(tables.buckets, "block"), "vectors")
    state = None
    for r in range(rounds + 1):
        met = data.select("block", "flat") if state is None else data.select("block", "flat").join(state.select("block", "cluster", "upper", "lower"), "block")
        state = tables.write(assigned(met, centroids, before), f"state{r}")
        if r:
            tables.drop(f"state{r - 1}")
        if r == rounds:
            break
        more, by = changes(state, dims)
        for c in more:
            counts[c] += more[c]
            sums[c] = [x + y for x, y in zip(sums[c], by[c], strict=True)]
        before, centroids = centroids, centroids.copy()
        for c in np.flatnonzero(counts).tolist():
            centroids[c] = [x // int(counts[c]) for x in sums[c]]
    last = centroids

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.asarray(batch.column("cluster")[i].values)
                apart = np.asarray(batch.column("flat")[i].values).reshape(-1, dims) - last[own]
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(own, pa.int32()), pa.array((apart * apart).sum(axis=1), pa.int64())], names=["id", "cluster", "distance"])

    found = cut_lineage(data.join(state.select("block", "cluster"), "block").mapInArrow(measured, "id long, cluster int, distance long"))
    tables.drop("vectors")
    tables.drop(f"state{rounds}")
    inertia = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [(c, inertia.get(c, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(last.tolist())]
    known = spark.createDataFrame(digests, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 8, rounds: int = 10, scale: int = 1024, dims: int = 64, seed: int = 3) -> str:
    """The same in DuckDB SQL, all distances of all rounds written out."""
    apart = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {k}) t)"]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, k := k)) AS best FROM (SELECT row, vec_id, v, k, CAST({apart} AS BIGINT) AS d FROM kept, c{r}) t GROUP BY row)")
        if r < rounds:
            total = "CAST(sum(x) AS HUGEINT)"
            floor = f"CAST(({total} - ((({total} % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT)"
            steps.append(f"""m{r} AS (SELECT k, list(x ORDER BY i) AS c FROM (SELECT k, i, {floor} AS x FROM (SELECT best.k AS k, unnest(v) AS x, unnest(range(1, {dims} + 1)) AS i FROM a{r}) t GROUP BY k, i) u GROUP BY k)""")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT p.k, coalesce(m.c, p.c) AS c FROM c{r} p LEFT JOIN m{r} m ON p.k = m.k)")
    return "WITH " + ",\n".join(steps) + f"""
        SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} f ON f.k = best.k"""
