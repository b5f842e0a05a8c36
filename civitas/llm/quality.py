"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors of its words and of the n-grams of 3 to 5
characters of its words (with the white space at either end), both hashed to a fixed
number of rows. A softmax over the average gives the classes. Vectors and output are
trained in numpy by stochastic gradient descent, one document a step.

Only the sample used for training is bounded (`SAMPLE` labelled documents of together
about `SAMPLE_BYTES`, taken by hash order of the id, whole texts). Every document is scored whole. As the output is
linear in the average, scoring adds up one number per feature: the difference of its
two class scores.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civitas.llm.common import BREAK, PART, column, parts, prefix_hash, small_batches, span_hash, texts, trimmed

#: Labelled documents used for training at most, and their bytes (the last taken may go beyond).
SAMPLE = 2000
SAMPLE_BYTES = 12 << 20
BITS = 16
ROWS = 1 << BITS
WIDTH = 16
GRAMS = (3, 4, 5)
THRESHOLD = 0.3


def characters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and their texts' bounds as code points and theirs."""
    if data.size == 0 or data.max() < 128:
        return data, bounds
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4"), starts[bounds]


def _features(data: np.ndarray, bounds: np.ndarray):
    """Yields (row numbers, documents' indexes) of every feature of the texts."""
    data, bounds = characters(data, bounds)
    n = len(bounds) - 1
    size = np.diff(bounds)
    doc = np.repeat(np.arange(n), size + 1)
    padded = np.full(len(data) + n + 1, 32, data.dtype)
    padded[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), size)] = data
    doc = np.append(doc, max(0, n - 1))
    breaks = BREAK[np.minimum(padded, 255)]
    padded[breaks] = 32
    seen = np.cumsum(breaks, dtype=np.int32)
    value = padded.astype(np.uint32)
    rolled = value.copy()
    for k in range(1, max(GRAMS)):
        rolled = rolled[:-1] * np.uint32(16777619) + value[k:]
        if k + 1 in GRAMS and len(rolled):
            inner = seen[k - 1 : len(padded) - 1][: len(rolled)] == seen[: len(rolled)]
            at = np.flatnonzero(inner)
            yield ((rolled[at] * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64), doc[at]
    starts = np.flatnonzero(breaks[:-1] & ~breaks[1:]) + 1
    ends = np.flatnonzero(~breaks[:-1] & breaks[1:]) + 1
    if len(starts):
        hashes = span_hash(prefix_hash(padded), starts, ends)
        yield (hashes >> np.uint64(64 - BITS)).astype(np.int64) + ROWS, doc[starts]


def _segments(part):
    """The texts of a batch piece; one that is far longer than PART in parts cut at white space."""
    data, bounds = texts(column(part, "text"))
    n = len(bounds) - 1
    if len(data) <= 2 * PART:
        yield data, bounds, np.arange(n)
        return
    at = 0
    while at < len(data):
        to = min(at + PART, len(data))
        while to < len(data) and not BREAK[data[to]]:
            to += 1
        yield data[at:to], np.array([0, to - at]), np.array([n - 1])
        at = to


@dataclass
class Model:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def differences(self) -> tuple[np.ndarray, float]:
        """For each feature and the bias, the score of class 1 less that of class 0."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 4, rate: float = 0.5, seed: int = 7) -> Model:
    """examples: (label 0 or 1, distinct features, how often each occurs)."""
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-1 / WIDTH, 1 / WIDTH, (2 * ROWS, WIDTH)).astype(np.float32), np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32))
    if not examples:
        return model
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            label, features, counts = examples[i]
            now = rate * (1 - done / steps)
            done += 1
            if len(features) == 0:
                continue
            weight = (counts / counts.sum()).astype(np.float32)
            own = model.vectors[features]
            hidden = weight @ own
            score = hidden @ model.output + model.bias
            p = np.exp(score - score.max())
            p /= p.sum()
            p[label] -= 1
            back = model.output @ p
            model.output -= now * np.outer(hidden, p)
            model.bias -= np.float32(0.05) * now * p
            # each occurrence moves its vector, as if features were drawn one by one
            model.vectors[features] = own - np.minimum(counts, 20)[:, None].astype(np.float32) * np.float32(now / 20) * back
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on at most `sample` labelled documents outside the held-out fold."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    few = usable.groupBy("doc_id").agg(F.max("quality").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` rows (more where ids repeat) of an id and a size go to the driver, to end the sample by bytes
    sizes = docs.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id", "label").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    taken = [r for r, before in zip(sizes, itertools.accumulate((r["size"] for r in sizes), initial=0)) if before < SAMPLE_BYTES]  # noqa: B905
    few = spark.createDataFrame([(r["doc_id"], r["label"]) for r in taken], few.schema)

    def extract(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                rows = [f for data, bounds, _ in _segments(batch.slice(i, 1)) for f, _ in _features(data, bounds)]
                features, counts = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_counts=True)
                yield pa.record_batch(
                    [column(batch, "label").slice(i, 1).cast(pa.int32()), pa.array([features.astype(np.int32).tobytes()], pa.binary()), pa.array([np.minimum(counts, 65535).astype(np.uint16).tobytes()], pa.binary())],
                    ["label", "features", "counts"],
                )

    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("label", "text").mapInArrow(extract, "label int, features binary, counts binary").collect()
    examples = [(int(r[0] > 0), np.frombuffer(r[1], np.int32), np.frombuffer(r[2], np.uint16)) for r in rows]
    return train(sorted(examples, key=lambda e: (e[0], len(e[1]), e[1].tobytes())))


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The documents with two more columns, score (0 to 1) and predicted (1 where score >= threshold).

    A null or empty text has no feature and gets what the bias alone gives. Without any
    label every score is 0.5. Only the text enters a score. All columns and rows of
    `docs` are kept, repeated ones too; columns of it that have one of `names` are
    replaced. An empty table gives no row.
    """
    small_batches(spark)
    differences, bias = fit(spark, docs, labels, sample).differences()
    model = spark.sparkContext.broadcast(differences)
    docs = docs.drop(*names)

    def predict(batches):
        import pyarrow as pa

        weights = model.value
        for batch in batches:
            for part in parts(batch):
                n = part.num_rows
                total, count = np.zeros(n), np.zeros(n)
                for data, bounds, index in _segments(part):
                    for features, doc in _features(data, bounds):
                        total += np.bincount(index[doc], weights[features], n)
                        count += np.bincount(index[doc], minlength=n)
                value = 1 / (1 + np.exp(-(total / np.maximum(count, 1) + bias)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(value), pa.array((value >= threshold).astype(np.int32))], [*part.schema.names, *names]
                )
        trimmed()

    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])
    return docs.mapInArrow(predict, schema)
