"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read the bytes of a window, one in each direction; a softmax
over both states labels every position. A document's probabilities are the mean over
all positions of all its windows that hold letters. The network is trained in numpy by
backpropagation through time (Adam steps) on windows of labelled documents.

Texts are cut into windows of `WINDOW` bytes, each read from a zero state, so any number
of windows of any documents runs side by side and a long text needs no more memory than
a short one. Only the training set is bounded (`PER_LANGUAGE` documents a language and
`TAKEN` windows of each); every byte of every text is labelled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from civitas.llm.common import column, parts, scratch, stored, texts

WINDOW = 128
HIDDEN = 8
#: Documents of each language, and windows of each document, that training uses at most.
PER_LANGUAGE = 150
TAKEN = 4
#: Windows that run side by side.
LANES = 1024
SALTS = 64
#: Training documents that are broadcast at most, so that only chosen texts move; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


@dataclass
class Network:
    """Weights of one direction are [0], of the other [1]; gates are laid out as (update, reset, candidate)."""

    languages: list[str]
    inputs: np.ndarray
    inner: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    moments: dict = field(default_factory=dict, repr=False)

    @classmethod
    def new(cls, languages: list[str], seed: int = 5, hidden: int = HIDDEN) -> Network:
        rng = np.random.default_rng(seed)
        f = np.float32
        return cls(
            languages,
            rng.normal(0, 0.4, (2, 256, 3 * hidden)).astype(f),
            rng.normal(0, 0.3, (2, hidden, 3 * hidden)).astype(f),
            rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(f),
            np.zeros(len(languages), f),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.inner, self.output, self.bias]


def _halved(net: Network) -> tuple[np.ndarray, np.ndarray]:
    """Weights with the gates' rows halved: sigmoid(x) = tanh(x / 2) / 2 + 1 / 2."""
    h = net.inner.shape[1]
    scale = np.concatenate([np.full(2 * h, 0.5, np.float32), np.ones(h, np.float32)])
    return net.inputs * scale, net.inner * scale


def states(net: Network, data: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """data: bytes (steps, lanes). The states (steps, lanes, 2 * hidden) of both directions."""
    inputs, inner = _halved(net)
    steps, lanes = data.shape
    h = inner.shape[1]
    out = np.empty((steps, lanes, 2 * h), np.float32)
    state = np.zeros((2, lanes, h), np.float32)
    x, g = np.empty((2, lanes, 3 * h), np.float32), np.empty((2, lanes, 3 * h), np.float32)
    if keep is not None:
        keep["steps"] = []
    for t in range(steps):
        np.take(inputs[0], data[t], axis=0, out=x[0], mode="clip")
        np.take(inputs[1], data[steps - 1 - t], axis=0, out=x[1], mode="clip")
        np.matmul(state, inner, out=g)
        gates = x[..., : 2 * h] + g[..., : 2 * h]
        np.tanh(gates, out=gates)
        gates *= np.float32(0.5)
        gates += np.float32(0.5)
        candidate = gates[..., h:] * g[..., 2 * h :]
        candidate += x[..., 2 * h :]
        np.tanh(candidate, out=candidate)
        if keep is not None:
            keep["steps"].append((state.copy(), gates, g[..., 2 * h :].copy(), candidate.copy()))
        state -= candidate
        state *= gates[..., :h]
        state += candidate
        out[t, :, :h] = state[0]
        out[steps - 1 - t, :, h:] = state[1]
    return out


def probabilities(net: Network, data: np.ndarray) -> np.ndarray:
    """(steps, lanes, languages): the label probabilities of every position."""
    score = states(net, data) @ net.output
    score += net.bias
    score -= score.max(axis=2, keepdims=True)
    np.exp(score, out=score)
    score /= score.sum(axis=2, keepdims=True)
    return score


def gradients(net: Network, data: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients of the mean cross-entropy of all positions, by backpropagation through time.

    weight: (steps, lanes), 0 for padding.
    """
    keep: dict = {}
    hidden = states(net, data, keep)
    steps, lanes = data.shape
    h = net.inner.shape[1]
    score = hidden @ net.output + net.bias
    score -= score.max(axis=2, keepdims=True)
    p = np.exp(score)
    p /= p.sum(axis=2, keepdims=True)
    lane = np.arange(lanes)
    total = max(1.0, float(weight.sum()))
    loss = -(np.log(np.maximum(p[:, lane, label], 1e-12)) * weight).sum() / total
    p[:, lane, label] -= 1
    p *= (weight / total)[..., None]
    d_out = np.einsum("tlh,tlk->hk", hidden, p, optimize=True)
    d_bias = p.sum(axis=(0, 1))
    d_hidden = p @ net.output.T
    d_in, d_inner = np.zeros_like(net.inputs), np.zeros_like(net.inner)
    carry = np.zeros((2, lanes, h), np.float32)
    for t in range(steps - 1, -1, -1):
        before, gates, raw, candidate = keep["steps"][t]
        z, r = gates[..., :h], gates[..., h:]
        carry = carry + np.stack([d_hidden[t, :, :h], d_hidden[steps - 1 - t, :, h:]])
        dz = carry * (before - candidate) * z * (1 - z)
        dc = carry * (1 - z) * (1 - candidate * candidate)
        dr = dc * raw * r * (1 - r)
        back = np.concatenate([dz, dr, dc * r], axis=2)
        d_inner += before.transpose(0, 2, 1) @ back
        carry = carry * z + back @ net.inner.transpose(0, 2, 1)
        into = np.concatenate([dz, dr, dc], axis=2)
        for k, row in ((0, data[t]), (1, data[steps - 1 - t])):
            order = np.argsort(row, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], row[order][1:] != row[order][:-1]]))
            d_in[k, row[order][cuts]] += np.add.reduceat(into[k][order], cuts, axis=0)
    return float(loss), [d_in, d_inner, d_out.astype(np.float32), d_bias.astype(np.float32)]


def train(windows: list[tuple[bytes, str]], rounds: int = 160, batch: int = 128, rate: float = 0.02, seed: int = 5) -> Network | None:
    """windows: (bytes, language). None without any."""
    if not windows:
        return None
    languages = sorted({w[1] for w in windows})
    net, rng = Network.new(languages, seed), np.random.default_rng(seed)
    by = [[w for w, k in windows if k == x] for x in languages]
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    for turn in range(1, rounds + 1):
        label = rng.integers(0, len(languages), batch)
        data, weight = np.full((WINDOW, batch), 32, np.uint8), np.zeros((WINDOW, batch), np.float32)
        for i, k in enumerate(label):
            own = np.frombuffer(by[k][rng.integers(0, len(by[k]))], np.uint8)
            data[: len(own), i], weight[: len(own), i] = own, 1
        _, grads = gradients(net, data, label, weight)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        now = rate * min(1.0, 2 * (1 - turn / (rounds + 1)))
        for w, g, m, v in zip(net.weights, grads, first, second, strict=True):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= (now * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def training_windows(spark: SparkSession, docs: DataFrame) -> list[tuple[bytes, str]]:
    """Windows of at most PER_LANGUAGE documents a language outside the held-out fold.

    Documents are taken by hash order of the id, first within salted parts of a language,
    then among these, so that no language meets in one task.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("order"))
    for key in (["lang", F.pmod("order", F.lit(SALTS))], ["lang"]):
        ids = ids.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("order", "doc_id"))).where(F.col("rank") <= PER_LANGUAGE).drop("rank")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                data = column(batch, "text")[i].as_py().encode()
                n = -(-len(data) // WINDOW)
                some = [data[k * WINDOW : (k + 1) * WINDOW] for k in {j * n // TAKEN for j in range(TAKEN)} if k < n]
                yield pa.record_batch([pa.array(some, pa.binary()), pa.array([column(batch, "lang")[i].as_py()] * len(some), pa.string())], ["bytes", "lang"])

    ids = stored(spark, ids.select("doc_id", "lang"), scratch(spark), "chosen")
    chosen = rows.select("doc_id", "text").join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "doc_id")
    return sorted((bytes(r[0]), r[1]) for r in chosen.select("text", "lang").mapInArrow(cut, "bytes binary, lang string").collect())


def label(net: Network | None, data: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language and its pooled probability for each text; `und` and 0 where `letters` is false."""
    n = len(bounds) - 1
    names, scores = ["und"] * n, np.zeros(n)
    if net is None or not n:
        return names, scores
    size = np.where(letters, np.diff(bounds), 0)
    per = -(-size // WINDOW)
    doc = np.repeat(np.arange(n), per)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = bounds[:-1][doc] + within * WINDOW
    held = np.minimum(WINDOW, bounds[1:][doc] - start)
    pooled = np.zeros((n, len(net.languages)))
    order = np.argsort(held, kind="stable")
    padded = np.concatenate([data, np.full(WINDOW, 32, np.uint8)])
    for at in range(0, len(doc), LANES):
        own = order[at : at + LANES]
        steps = int(held[own].max())
        index = start[own][None, :] + np.arange(steps)[:, None]
        rows = padded[index]
        inside = np.arange(steps)[:, None] < held[own][None, :]
        rows[~inside] = 32
        p = probabilities(net, rows)
        p *= inside[..., None]
        summed = p.sum(axis=0, dtype=np.float64)
        for k in range(pooled.shape[1]):
            pooled[:, k] += np.bincount(doc[own], summed[:, k], n)
    best = pooled.argmax(axis=1)
    for i in np.flatnonzero(letters & (size > 0)):
        names[i] = net.languages[best[i]]
        scores[i] = min(1.0, pooled[i, best[i]] / size[i])
    return names, scores


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from text and lang of the documents outside the held-out fold; predicts from
    the text alone. A null text, or one without a letter, is `und` with score 0, and so
    is every text where nothing could be learned. Of equally likely languages the first
    by name is taken. Repeated rows are returned as often; other columns are ignored;
    an empty table gives no row.
    """
    net = train(training_windows(spark, docs))
    shared = spark.sparkContext.broadcast(net)
    kind = dict(docs.dtypes)["doc_id"]
    latin = np.zeros(256, bool)
    latin[[*range(65, 91), *range(97, 123)]] = True

    def predict(batches):
        import pyarrow as pa

        for batch in batches:
            for part in parts(batch):
                held = column(part, "text")
                data, bounds = texts(held)
                counted = np.concatenate([[0], np.cumsum(latin[data])])
                letters = counted[bounds[1:]] > counted[bounds[:-1]]
                for i in np.flatnonzero(~letters & (np.diff(bounds) > 0)):
                    letters[i] = any(c.isalpha() for c in held[int(i)].as_py())
                names, scores = label(shared.value, data, bounds, letters)
                yield pa.record_batch([column(part, "doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    out = docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
