"""Hard-negative mining by a pivot table, in exact integers.

Vectors get one more component, sqrt(M^2 - |v|^2) with M the largest norm, and queries a zero there:
then |q - v|^2 = |q|^2 + M^2 - 2 * (inner product), so that large scores are small distances. The pivot
table keeps every row's distances to `PIVOTS` pivots; by the triangle inequality
|d(q,p) - d(v,p)| <= d(q,v) <= d(q,p) + d(v,p) they bracket every score. Rows whose bracket cannot reach
what an anchor asks for are left; the survivors' scores are made exactly.

Two searches of all anchors against all rows follow each other: the first for positives (the best rows
of the anchor's label), the second for negatives (the best rows of other labels whose score lies in the
window of each positive). Rows lie in the order of their nearest pivot and packed in blocks, so that a
block's smallest and largest pivot distances bracket all its rows at once. Blocks of anchors go to every
tile, a set of some blocks of rows, and meet them there: rows are shuffled once, anchors once a tile, and
a task keeps the best rows of each anchor as it goes. What leaves a task is the best few rows an anchor
and tile; a window ranks them.

Pivots are the farthest-first rows of `SAMPLE` rows with the smallest hashes: bounded parameters that
change the pace alone. Every row is in the table; nothing is approximate.

Defined cases. Rows with a null label, a null vector or a null or non-finite component take no part. A
row with a null id takes part as a candidate, never as an anchor, and ranks after all ids of its score;
repeated rows are rows of their own (each may be the other's positive). Vectors of different widths
are filled up with zeros. Anchors without positives, and positives without negatives, give no rows.
Scores are exact up to 2**55; beyond, they count as that. Empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from civitas.llm.common import column, removed, scratch, small_batches, stored
from civitas.llm.vectors import kept, matrix, whole

PIVOTS = 16
#: Most positives of an anchor, each with its window of scores.
SLOTS = 5
SAMPLE = 1024
#: Rows and components of a block, blocks of a tile.
ROWS, ANCHORS, VALUES, TILE = 4096, 256, 1 << 18, 16
#: Scores below this bound are exact in doubles, also with a row's place in a block beside it in a long.
EXACT = 2.0**50
MOST = 1 << 55
NONE = np.int64(-1 << 62)
#: Blocks of anchors whose best rows a task remembers.
REMEMBERED = 64
POINT = "uid long, vec_id long, label long, x array<double>, cell int, reach double, distances array<double>"
BLOCK = "block long, n int, width int, uids binary, ids binary, named binary, labels binary, vectors binary, distances binary"
HITS = "uid long, slot int, score long, hit_id long, hit_uid long"


def _own(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


# The pivot table


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows, each as far as possible from those before it; the first is the first row."""
    chosen, gap = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(n, len(sample)):
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(np.argmax(gap)))
    return sample[chosen]


def _filled(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def pivot_distances(x: np.ndarray, pivots: np.ndarray, largest: float, query: bool) -> np.ndarray:
    """Distances of augmented rows (or of queries) to augmented pivots; largest is M^2."""
    width = max(x.shape[1], pivots.shape[1])
    x, p = _filled(x, width), _filled(pivots, width)
    square, p_square = (x * x).sum(axis=1), (p * p).sum(axis=1)
    more = 0 if query else np.sqrt(np.maximum(largest - square, 0))[:, None] * np.sqrt(np.maximum(largest - p_square, 0))
    own = square if query else np.full(len(x), largest)
    return np.sqrt(np.maximum(own[:, None] + largest - 2 * (x @ p.T + more), 0))


def _placed(pivots: np.ndarray, largest: float):
    """Rows with their pivot distances, nearest pivot and distance to it."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                d = pivot_distances(matrix(column(batch, "x")), pivots, largest, False)
            cell = np.argmin(d, axis=1)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * d.shape[1], pa.int32()), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in ("uid", "vec_id", "label", "x")), pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell]), listed], ["uid", "vec_id", "label", "x", "cell", "reach", "distances"]
            )

    return run


def _packed(rows: int, more: tuple[str, ...] = (), query: tuple | None = None):
    """Rows in blocks of at most `rows` rows and VALUES components (one row, if it alone has more).

    Within a block rows are in the order of ids. Queries get the pivot distances of queries.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number, waiting, n = TaskContext.get().partitionId() << 32, [], 0

        def block(table):
            nonlocal number
            number += 1
            ids = column(table, "vec_id")
            named, values = ~ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
            uids = column(table, "uid").to_numpy()
            order = np.lexsort((uids, values, ~named))
            x = matrix(column(table, "x"))[order]
            with np.errstate(over="ignore", invalid="ignore"):
                d = pivot_distances(x, *query, True) if query else matrix(column(table, "distances"))[order]
            extra = [column(table, c).flatten().to_numpy().reshape(-1, SLOTS)[order] for c in more]
            values = (number, len(order), x.shape[1], uids[order], values[order], named[order], column(table, "label").to_numpy()[order], x, d, *extra)
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * (6 + len(more))]
            return pa.RecordBatch.from_arrays([pa.array([_own(v) if isinstance(v, np.ndarray) else v], k) for v, k in zip(values, kinds, strict=True)], [f.split()[0] for f in BLOCK.split(", ")] + list(more))

        def flushed():
            nonlocal waiting, n
            table = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting, n = [], 0
            return block(table)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                widest = max(1, int(np.diff(column(batch, "x").offsets.to_numpy()).max()))
                most = max(1, min(rows, VALUES // widest))
                if n >= most:
                    yield flushed()
                part = batch.slice(at, most - n)
                waiting.append(part)
                at, n = at + part.num_rows, n + part.num_rows
        if n:
            yield flushed()

    return run


# The search


class _Block:
    """One packed block as arrays; `prefix` tells the side of a pair."""

    def __init__(self, row: dict, prefix: str):
        of = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        self.n, self.key = row[prefix + "n"], row[prefix + "block"]
        self.uids, self.ids, self.named, self.labels = of("uids", np.int64), of("ids", np.int64), of("named", bool), of("labels", np.int64)
        self.x, self.d = of("vectors", np.float64).reshape(self.n, -1), of("distances", np.float64).reshape(self.n, -1)
        with np.errstate(over="ignore"):
            self.square = (self.x * self.x).sum(axis=1)


def brackets(q: _Block, v: _Block, rows: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of q's anchors with v's rows, widened by more than their rounding."""
    low, high = np.zeros((q.n, len(rows))), np.full((q.n, len(rows)), np.inf)
    for p in range(q.d.shape[1]):
        a, b = q.d[:, p, None], v.d[None, rows, p]
        np.maximum(low, np.abs(a - b), out=low)
        np.minimum(high, a + b, out=high)
    whole = (q.square + largest)[:, None]
    slack = 1e-9 * whole + 1
    return (whole - high * high) / 2 - slack, (whole - low * low) / 2 + slack


def block_bracket(q: _Block, v: _Block, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """The same for each of q's anchors and all of v's rows at once, from the block's pivot intervals."""
    least, most = v.d.min(axis=0), v.d.max(axis=0)
    low = np.maximum(np.maximum(least - q.d, q.d - most), 0).max(axis=1)
    high = (q.d + most).min(axis=1)
    whole = q.square + largest
    slack = 1e-9 * whole + 1
    return (whole - high * high) / 2 - slack, (whole - low * low) / 2 + slack


def scores(q: _Block, v: _Block, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; those that doubles may not hold are made in Python's integers."""
    width = max(q.x.shape[1], v.x.shape[1])
    a, b = _filled(q.x, width), _filled(v.x[rows], width)
    far = ~(np.sqrt(q.square)[:, None] * np.sqrt(v.square[rows]) < EXACT)
    if not far.any():
        return (a @ b.T).astype(np.int64)
    out = np.where(far, 0, np.einsum("ik,jk->ij", np.where(np.abs(a) < EXACT, a, 0), np.where(np.abs(b) < EXACT, b, 0)))
    out = np.where(np.abs(out) < 2 * EXACT, out, 0).astype(np.int64)
    for i, j in zip(*np.nonzero(far), strict=True):
        out[i, j] = max(-MOST, min(MOST, sum(s * t for s, t in zip(whole(a[i]), whole(b[j]), strict=True))))
    return out


class _Best:
    """The best `k` rows found so far for every anchor of a block and each of its slots."""

    def __init__(self, q: _Block, slots: int, k: int):
        self.q, self.k = q, k
        shape = (q.n, slots, k)
        self.score, self.id, self.unnamed, self.uid = np.full(shape, NONE), np.zeros(shape, np.int64), np.ones(shape, bool), np.zeros(shape, np.int64)

    def floor(self) -> np.ndarray:
        """The score below which a row is of no use, by anchor and slot."""
        return self.score[:, :, -1]

    def take(self, slot: int, found: np.ndarray, v: _Block, rows: np.ndarray) -> None:
        """Take the best of found[anchor, row]; NONE marks what does not count."""
        k = min(self.k, found.shape[1])
        # Rows are in the order of ids: among equal scores the first k of them.
        if found.shape[1] > k:
            if (np.abs(found[found != NONE]) < EXACT).all():
                placed = np.where(found == NONE, NONE, found * ROWS + (ROWS - 1 - np.arange(found.shape[1])))
                top = np.argpartition(placed, found.shape[1] - k, axis=1)[:, -k:]
            else:
                top = np.argsort(-found, axis=1, kind="stable")[:, :k]
        else:
            top = np.broadcast_to(np.arange(k), (len(found), k))
        at = rows[top]
        merged = lambda own, new: np.concatenate([own[:, slot], new], axis=1)
        score, ids, unnamed, uid = merged(self.score, np.take_along_axis(found, top, 1)), merged(self.id, v.ids[at]), merged(self.unnamed, ~v.named[at]), merged(self.uid, v.uids[at])
        order = np.lexsort((uid, ids, unnamed, -score), axis=1)[:, : self.k]
        for own, new in ((self.score, score), (self.id, ids), (self.unnamed, unnamed), (self.uid, uid)):
            own[:, slot] = np.take_along_axis(new, order, 1)

    def rows(self):
        import pyarrow as pa

        anchor, slot, _ = at = np.nonzero(self.score != NONE)
        arrays = [pa.array(self.q.uids[anchor]), pa.array(slot, pa.int32()), pa.array(self.score[at]), pa.array(self.id[at], mask=self.unnamed[at]), pa.array(self.uid[at])]
        return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in HITS.split(", ")])


def _searched(largest: float, k: int, windows: bool):
    """Pairs of blocks: the best rows of each anchor and slot.

    Without windows: one slot, other rows of the anchor's label. With windows: rows of other labels,
    a slot for each window of scores that the anchor brings.
    """

    def run(batches):
        remembered: dict[int, tuple] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names) if name.startswith("v_")}
                key = column(batch, "q_block")[i].as_py()
                if key not in remembered:
                    if len(remembered) == REMEMBERED:
                        yield from (best.rows() for best, *_ in remembered.values())
                        remembered = {}
                    q = _Block({name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names) if name.startswith("q_")}, "q_")
                    bounds = [np.frombuffer(column(batch, f"q_{c}")[i].as_py(), np.int64).reshape(q.n, SLOTS) for c in ("least", "most")] if windows else None
                    remembered[key] = (_Best(q, SLOTS if windows else 1, k), q, bounds)
                with np.errstate(over="ignore", invalid="ignore"):
                    _step(*remembered[key], _Block(row, "v_"), largest)
        yield from (best.rows() for best, *_ in remembered.values())

    return run


def _step(best: _Best, q: _Block, bounds, v: _Block, largest: float) -> None:
    """Search one block: by its bracket as a whole, then by the brackets of its rows, then exactly."""
    floor = best.floor()
    if bounds is None:
        least, most = floor[:, 0].astype(np.float64), np.full(q.n, np.inf)
    else:
        # An empty window is one that no score meets.
        empty = bounds[0] > bounds[1]
        least = np.where(empty, np.inf, np.maximum(bounds[0], floor)).min(axis=1)
        most = np.where(empty, -np.inf, bounds[1]).max(axis=1)
    low, high = block_bracket(q, v, largest)
    wanted = ~(high < least) & ~(low > most)
    if not wanted.any():
        return
    # In slices, so that the arrays of a step stay small whatever a block holds.
    for at in range(0, v.n, ROWS):
        rows = np.arange(at, min(v.n, at + ROWS))
        low, high = brackets(q, v, rows, largest)
        label = q.labels[:, None] == v.labels[rows]
        live = wanted[:, None] & ~(high < least[:, None]) & ~(low > most[:, None]) & (label if bounds is None else ~label)
        if bounds is None:
            live &= q.uids[:, None] != v.uids[rows]
        alive = np.nonzero(live.any(axis=0))[0]
        if len(alive) == 0:
            continue
        exact, live = scores(q, v, rows[alive]), live[:, alive]
        if bounds is None:
            best.take(0, np.where(live, exact, NONE), v, rows[alive])
            continue
        for slot in range(bounds[0].shape[1]):
            fits = live & (exact >= bounds[0][:, slot, None]) & (exact <= bounds[1][:, slot, None])
            some = np.nonzero(fits.any(axis=0))[0]
            if len(some):
                best.take(slot, np.where(fits[:, some], exact[:, some], NONE), v, rows[alive][some])


def _pairs(anchors: DataFrame, rows: DataFrame, tiles: int) -> DataFrame:
    """Every block of anchors beside every block of rows: anchors go to all tiles, rows to one."""
    q = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), *(F.col(c).alias(f"q_{c}") for c in anchors.columns))
    v = rows.select(F.pmod(F.xxhash64("block"), F.lit(tiles)).cast("int").alias("tile"), *(F.col(c).alias(f"v_{c}") for c in rows.columns))
    return q.join(v, "tile").drop("tile")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """The first k hits of each anchor and slot."""
    order = Window.partitionBy("uid", "slot").orderBy(F.col("score").desc(), F.col("hit_id").asc_nulls_last(), "hit_uid")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(spark: SparkSession, embeddings: DataFrame, every: int = 100, relabel: int = 7, labels: int = 10, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by `every`; a negative's score lies between `least` and
    `most` hundredths of the positive's. positives is SLOTS at most.
    """
    if not 1 <= positives <= SLOTS:
        raise ValueError(f"positives: 1 to {SLOTS}")
    small_batches(spark)
    folder = scratch(spark)
    label = F.when(F.col("vec_id") % relabel == 0, (F.col("label").cast("long") + 1) % labels).otherwise(F.col("label").cast("long"))
    rows = kept(embeddings.where("label is not null"), scale, "embedding", F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"))
    square = F.aggregate("x", F.lit(0.0), lambda s, e: s + e * e)
    largest = rows.agg(F.max(square)).first()[0]
    if largest is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    # The norms of numpy may differ by rounding.
    largest = float(largest) * (1 + 1e-12)
    sample = rows.orderBy(F.xxhash64("vec_id", "x"), "vec_id", "x").select("x").limit(SAMPLE).collect()
    wide = max(len(r.x) for r in sample)
    with np.errstate(over="ignore", invalid="ignore"):
        pivots = farthest_first(np.array([[*r.x, *[0.0] * (wide - len(r.x))] for r in sample]).reshape(len(sample), wide), PIVOTS)
    points = rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", "x").mapInArrow(_placed(pivots, largest), POINT)
    points = stored(spark, points.orderBy("cell", "reach", "uid"), folder, "points")
    blocks = stored(spark, points.mapInArrow(_packed(ROWS), BLOCK), folder, "blocks")
    count = blocks.count()
    if count == 0:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    tiles = max(-(-count // TILE), min(count, spark.sparkContext.defaultParallelism))
    anchors = points.where(F.col("vec_id") % every == 0)
    packed = stored(spark, anchors.mapInArrow(_packed(ANCHORS, query=(pivots, largest)), BLOCK), folder, "anchors")
    hits = _pairs(packed, blocks, tiles).mapInArrow(_searched(largest, positives, False), HITS)
    hits = _ranked(hits, positives).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "hit_id"))).alias("found"))
    hundredths = lambda i, n: F.try_element_at("found", i)["score"].cast("decimal(20,0)") * n / 100
    each = lambda f, n, none: F.transform(F.sequence(F.lit(1), F.lit(SLOTS)), lambda i: F.coalesce(f(hundredths(i, n)).cast("long"), F.lit(none)))
    windows = hits.select("uid", "found", each(F.ceil, least, 1).alias("least"), each(F.floor, most, 0).alias("most"))
    asking = stored(spark, anchors.join(windows, "uid").sortWithinPartitions("cell", "reach", "uid"), folder, "asking")
    packed = stored(spark, asking.mapInArrow(_packed(ANCHORS, ("least", "most"), (pivots, largest)), f"{BLOCK}, least binary, most binary"), folder, "windows")
    hits = _pairs(packed, blocks, tiles).mapInArrow(_searched(largest, negatives, True), HITS)
    hits = stored(spark, _ranked(hits, negatives), folder, "negatives")
    removed(spark, folder, "points", "blocks", "anchors", "windows")
    pairs = asking.select("uid", F.col("vec_id").alias("anchor_id"), F.posexplode("found").alias("slot", "positive"))
    out = pairs.join(hits, ["uid", "slot"])
    return out.select("anchor_id", F.col("positive.hit_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("hit_id").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"))


ORACLE_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: isfinite(e))) = len(embedding)),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""
