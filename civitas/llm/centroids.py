"""Centroid clustering in exact integers, with block-norm screening.

Every vector is stored once with the norms of its segments. By the inequality of Cauchy and Schwarz
in each segment, |v - c|^2 >= |v|^2 + |c|^2 - 2 * sum of |v_s| |c_s|: a bound from the compressed
vectors (segment norms) alone. Centroids are tried in the order of their bounds, and only those whose
bound does not exceed the best distance so far get an exact integer distance.

A round is one pass over the stored vectors: a task adds up its vectors by centroid and hands on as
many sums as there are components, whatever it has read; the sums of all tasks are added by Spark, and
the driver divides k times `width` of them. Centroids ride in the closure (k vectors). Nothing else is
kept between rounds, so a lost executor costs its tasks only.

Defined cases. Vectors that are null, of another width, or with a null or non-finite component take no
part and get no row. Repeated rows count each. A null vec_id takes part, is never among the starting
centroids while others are left, and is returned as null. Rows of equal hash start in the order of
their ids, then vectors. With fewer vectors than k there are as many centroids; an empty table gives no
rows. Sums are exact for any double; a distance or sum that no long holds is returned as null. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from civitas.llm.common import column, removed, scratch, small_batches, stored
from civitas.llm.vectors import EXACT, kept, matrix, whole

RESULT = "vec_id long, cluster int, distance long, checked int"
#: Bits of the digits in which sums of very large components travel.
DIGIT = 40


def segment_norms(x: np.ndarray, segments: int) -> np.ndarray:
    """Norms of each row's segments."""
    return np.sqrt(np.add.reduceat(x * x, np.arange(0, x.shape[1], -(-x.shape[1] // segments)), axis=1))


def nearest(x: np.ndarray, square: np.ndarray, norms: np.ndarray, centroids: list[list[int]], segments: int):
    """The nearest centroid of every row, its squared distance, and how many exact distances were made.

    Distances below 2**53 are exact in doubles; a row that meets a larger one, unscreened, is settled
    in Python's integers. Bounds are lowered by far more than their rounding.
    """
    n, k = len(x), len(centroids)
    c = np.array(centroids, np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        c_square = (c * c).sum(axis=1)
        bound = square[:, None] + c_square
        bound = bound - 2 * (norms @ segment_norms(c, segments).T) - 1e-9 * bound - 1
        far = ~((np.sqrt(square)[:, None] + np.sqrt(c_square)) ** 2 < EXACT / 2)
        order = np.argsort(bound, axis=1, kind="stable")
        best, pick = np.full(n, np.inf), np.full(n, k)
        checked, large = np.zeros(n, np.int64), np.zeros(n, bool)
        for j in range(k):
            one = order[:, j]
            rows = np.nonzero(~(bound[np.arange(n), one] > best))[0]
            if len(rows) == 0:
                break
            at = one[rows]
            difference = x[rows] - c[at]
            distance = np.einsum("ij,ij->i", difference, difference)
            checked[rows] += 1
            large[rows] |= far[rows, at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (at < pick[rows]))
            best[rows[better]], pick[rows[better]] = distance[better], at[better]
    exact = {}
    for i in np.nonzero(large)[0]:
        row = whole(x[i])
        exact[int(i)], pick[i] = min((sum((a - b) ** 2 for a, b in zip(row, c, strict=True)), j) for j, c in enumerate(centroids))
        checked[i] = k
    return pick, best, exact, checked


def _arrays(batch):
    return matrix(column(batch, "x")), column(batch, "square").to_numpy(), matrix(column(batch, "norms"))


def _compressed(segments: int):
    """Vectors with their squared norms and the norms of segments."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(column(batch, "x"))
            with np.errstate(over="ignore"):
                norms, square = segment_norms(x, segments), (x * x).sum(axis=1)
            listed = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), listed(x), pa.array(square), listed(norms)], ["vec_id", "x", "square", "norms"])

    return run


def _sums(centroids: list[list[int]], segments: int):
    """Per task: sums of components (part -1: rows) by centroid, in digits of DIGIT bits for what is too large."""

    def run(batches):
        import pyarrow as pa

        k, width = len(centroids), len(centroids[0])
        totals, counts, digits = np.zeros((k, width), np.int64), np.zeros(k, np.int64), {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, square, norms = _arrays(batch)
            pick, _, exact, _ = nearest(x, square, norms, centroids, segments)
            counts += np.bincount(pick, minlength=k)
            small = square < EXACT / 2
            for j in range(k):
                totals[j] += x[(pick == j) & small].sum(axis=0).astype(np.int64)
            for i in np.nonzero(~small)[0]:
                for part, v in enumerate(whole(x[i])):
                    sign, v, digit = (1, v, 0) if v >= 0 else (-1, -v, 0)
                    while v:
                        key = (int(pick[i]), part, digit)
                        digits[key] = digits.get(key, 0) + sign * (v & (1 << DIGIT) - 1)
                        v, digit = v >> DIGIT, digit + 1
        rows = [(j, part, 0, int(totals[j, part])) for j in range(k) if counts[j] for part in range(width)]
        rows += [(j, -1, 0, int(counts[j])) for j in range(k) if counts[j]] + [(*key, v) for key, v in digits.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["cluster", "part", "digit", "total"])

    return run


def _assigned(centroids: list[list[int]], segments: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            pick, best, exact, checked = nearest(*_arrays(batch), centroids, segments)
            distance = [exact.get(i, d) for i, d in enumerate(best)]
            distance = [int(d) if d < 1 << 63 else None for d in distance] if exact else best.astype(np.int64)
            yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), pa.array(pick, pa.int32()), pa.array(distance, pa.int64()), pa.array(checked, pa.int32())], ["vec_id", "cluster", "distance", "checked"])

    return run


def moved(points: DataFrame, centroids: list[list[int]], segments: int) -> list[list[int]]:
    """Every centroid replaced by the floor of the mean of its vectors; those without vectors stay."""
    sums = points.mapInArrow(_sums(centroids, segments), "cluster int, part int, digit int, total long")
    found = sums.groupBy("cluster", "part", "digit").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total: dict[tuple[int, int], int] = {}
    for r in found:
        total[r.cluster, r.part] = total.get((r.cluster, r.part), 0) + (int(r.total) << DIGIT * r.digit)
    return [[total.get((j, i), 0) // total[j, -1] for i in range(len(c))] if (j, -1) in total else c for j, c in enumerate(centroids)]


def cluster(spark: SparkSession, embeddings: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, salt: str = "3", segments: int = 16, vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, and checked: the exact distances of the last pass."""
    small_batches(spark)
    folder = scratch(spark)
    rows = kept(embeddings.where(F.size(vector) == width), scale, vector, F.col("vec_id").cast("long").alias("vec_id"))
    points = stored(spark, rows.mapInArrow(_compressed(segments), "vec_id long, x array<double>, square double, norms array<double>"), folder, "points")
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = points.orderBy(name.asc_nulls_last(), "vec_id", "x").select("x").limit(k).collect()
    centroids = [whole(r.x) for r in first]
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, checked int")
    for _ in range(rounds):
        centroids = moved(points, centroids, segments)
    assigned = stored(spark, points.mapInArrow(_assigned(centroids, segments), RESULT), folder, "assigned")
    removed(spark, folder, "points")
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), (F.count("distance") == F.count(F.lit(1))).alias("known")).collect()
    sums = {r.cluster: int(r.s) if r.known else None for r in per}
    held = lambda v: v if v is not None and v < 1 << 63 else None
    inertia = held(sum(sums.values())) if None not in sums.values() else None
    told = [(j, held(s), inertia, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for j, s in sums.items()]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "checked")


def oracle_sql(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, salt: str = "3") -> str:
    """The same rows in SQL, round by round."""
    steps = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x FROM embeddings "
        f"WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda e: isfinite(e))) = {width})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id)) - 1 AS j, x AS c FROM v ORDER BY j LIMIT {k})",
    ]
    for r in range(rounds + 1):
        d = f"list_sum(list_transform(range(1, {width + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(x) AS x, min({d} * {k} + j)::BIGINT AS m FROM v, c{r} GROUP BY vec_id)")
        if r < rounds:
            mean = "(s - ((s % n) + n) % n) // n"
            steps.append(
                f"c{r + 1} AS MATERIALIZED (SELECT o.j, coalesce(w.c, o.c) AS c FROM c{r} o LEFT JOIN (SELECT j, list({mean} ORDER BY i)::BIGINT[] AS c FROM "
                f"(SELECT m % {k} AS j, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, range(1, {width + 1}) t(i) GROUP BY 1, 2) GROUP BY j) w ON o.j = w.j)"
            )
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT vec_id, (m % {k})::INT AS cluster, m // {k} AS distance, sum(m // {k}) OVER (PARTITION BY m % {k})::BIGINT AS cluster_inertia, "
        f"sum(m // {k}) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON j = m % {k}"
    )
