"""Sequence packing by non-negative least squares over length combinations.

1. Every text is tokenised once; ids go to a table in the shared folder. The distinct words
   of a batch are looked up among those that the worker remembers, or given to the tokenizer.
2. A document is cut into full windows and a tail. The histogram of tail lengths
   (at most as many rows as a window has tokens) goes to the driver.
3. Lengths are grouped into classes of `UNIT` tokens. Combinations of up to three
   classes that fill a window are enumerated; non-negative least squares gives how
   often each should be used to meet the histogram; the counts are rounded down and
   limited by what is there.
4. What remains is packed greedily: laid end to end and cut where a sequence is full.
5. A piece's place follows from its length and its rank among pieces of that length.
   Ranks of a frequent length are counted within hashed buckets and shifted by the
   buckets before, so that it never meets in one task.

The plan's size depends on the window alone, not on the number of documents.
"""

from __future__ import annotations

import array
import itertools
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from civitas.llm.common import BATCH, column, parts, scratch, small_batches, stored, trimmed

WINDOW = 2048
UNIT = 16
#: Pieces of one length in a bucket of ranks, about.
BUCKET = 1_000
#: Pieces in a generation that a worker remembers, all of fewer than `LONG` characters; of whole runs a quarter.
REMEMBERED = 400_000
LONG = 64


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Remembered(dict):
    """Values by key, made where they are missing.

    Beyond `most` keys a new generation begins. The one before is kept, and what is asked
    for again moves on from it, so that frequent keys stay and memory is bounded.
    """

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(key) < LONG:
            if len(self) >= self.most:
                # a copy, as callers hold a method of this object
                self.before = self.copy()
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Token ids of whole texts, the same as the tokenizer gives, with words remembered.

    White space ends every token of these vocabularies, so a text's ids are those of
    its runs of other characters. Texts of printable characters up to U+017F are made
    lower-case as a whole and parted before a mark that follows a letter or digit, where
    the splitter parts them, too, so that words meet without their marks. Their pieces are
    given to the tokenizer's model; runs with other characters go through all of it.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = np.dtype("<u4" if self.wide else "<u2")
        self.code = "I" if self.wide else "H"
        self.pieces, self.runs = Remembered(self.piece, REMEMBERED), Remembered(self.run, REMEMBERED // 4)
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.simple = re.compile(r"[\x20\x09-\x0D!-~¡-¬®-įı-ſ]*\Z").match
        self.marks = re.compile(r"[.,;:!?](?<=[^\W_].)").sub
        self.several = re.compile(r"[!-/:-@\[-`{-~¡-©«-±´¶-¸»¿×÷][.,;:!?]").search
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        self.shown = {b: b if b in plain else next(spare) for b in range(256)}
        self.splits = re.compile(r"[\x20\x09-\x0D]+").split
        self.odd = re.compile("[\x1c-\x1f]").search

    def packed(self, ids) -> bytes:
        return array.array(self.code, ids).tobytes()

    def piece(self, run: str) -> bytes:
        """A lower-case run of simple characters, or a piece of one."""
        if not run.isalpha() and (pieces := self.split(run)) != [run]:
            return b"".join(map(self.pieces.__getitem__, pieces))
        shown = run if run.isascii() else run.encode().decode("latin-1").translate(self.shown)
        return self.packed([t.id for t in self.model.tokenize(shown)])

    def run(self, run: str) -> bytes:
        if "<|" not in run and self.simple(run):
            return self.pieces[run.lower()]
        return self.packed(self.tokenizer.encode(run, add_special_tokens=False).ids)

    def parted(self, text: str) -> str:
        """The text with a space before each mark that follows a letter or digit; other spaces may be doubled."""
        if self.several(text):
            return self.marks(r" \g<0>", text)
        for mark in ".,;:!?":
            text = text.replace(mark, " " + mark)
        return text

    def __call__(self, text: str) -> bytes:
        if "<|" not in text and self.simple(text):
            return b"".join(map(self.pieces.__getitem__, self.parted(text.lower()).split()))
        # str.split takes the four separators for white space, the vocabulary does not
        runs = filter(None, self.splits(text)) if self.odd(text) else text.split()
        return b"".join(map(self.runs.__getitem__, runs))

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; a word of several simple texts is looked up once."""
        import pyarrow as pa
        import pyarrow.compute as pc

        simple = [len(x) <= BATCH and "<|" not in x and self.simple(x) is not None for x in texts]
        words = pc.ascii_split_whitespace(pa.array([self.parted(x.lower()) for x, own in zip(texts, simple, strict=True) if own], pa.string()))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        ids = pa.array([self.pieces[x] for x in distinct], pa.binary()).take(coded.indices)
        joined = iter(pc.binary_join(pa.ListArray.from_arrays(words.offsets, ids), b"").to_pylist())
        return [next(joined) if own else self(x) for x, own in zip(texts, simple, strict=True)]


_encoders: dict[str, Encoder] = {}


def tokens(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, 2 bytes each where the vocabulary allows, else 4)."""
    doc_type = dict(docs.dtypes)["doc_id"]

    def encode(batches):
        import pyarrow as pa

        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        last = encoder.packed([end_id])
        for batch in batches:
            for part in parts(batch, BATCH):
                ids = [x + last for x in encoder.many([x or "" for x in column(part, "text").to_pylist()])]
                sizes = pa.array([len(x) // encoder.kind.itemsize for x in ids], pa.int64())
                yield pa.record_batch([column(part, "doc_id"), sizes, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])
        trimmed()

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {doc_type}, n_tokens long, ids binary")


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by an active set that grows one column at a time."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    for _ in range(3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        if gain.max() <= tolerance * max(1.0, np.abs(b).max()):
            break
        active[np.argmax(gain)] = True
        while True:
            cols = np.flatnonzero(active)
            own = a[:, cols]
            z = np.linalg.solve(own.T @ own + 1e-9 * np.eye(len(cols)), own.T @ b)
            if z.min(initial=1.0) > 0:
                break
            low = z <= 0
            have = x[cols]
            step = (have[low] / np.maximum(have[low] - z[low], 1e-300)).min()
            have = have + step * (z - have)
            x[:] = 0
            x[cols] = np.maximum(have, 0)
            gone = cols[(x[cols] <= 1e-12 * max(1.0, x.max())) & low]
            if len(gone) == 0:
                gone = cols[low][:1]
            active[gone] = False
            x[gone] = 0
        x[:] = 0
        x[cols] = z
    return x


@dataclass
class Plan:
    """Where the g-th shortest tail goes. before[l]: tails shorter than l."""

    window: int
    before: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    first: np.ndarray
    earlier: np.ndarray
    full: int
    laid_from: int
    rest_from: np.ndarray
    laid: np.ndarray

    def length(self, g: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.before, g, side="right") - 1

    def place(self, length: np.ndarray, rank: np.ndarray):
        """Rows (index of the piece, start within it, length, sequence, offset)."""
        index = np.arange(len(length))
        whole = length == self.window
        g = self.before[np.minimum(length, self.window - 1)] + rank
        slot = np.searchsorted(self.lo, g, side="right") - 1
        slotted = ~whole & (slot >= 0)
        slotted[slotted] = g[slotted] < self.hi[slot[slotted]]
        s = slot[slotted]
        n = g[slotted] - self.lo[s]
        offset = np.zeros(len(s), np.int64)
        for k in range(self.earlier.shape[1] if len(s) else 0):
            other = self.earlier[s, k]
            there = other >= 0
            offset[there] += self.length(other[there] + n[there])
        rest = ~whole & ~slotted
        at = self.laid[length[rest]] + (g[rest] - self.rest_from[length[rest]]) * length[rest]
        head = np.minimum(length[rest], self.window - at % self.window)
        tail = length[rest] - head
        more = tail > 0
        zero = np.zeros(len(index), np.int64)
        parts = [
            (index[whole], zero[whole], length[whole], rank[whole], zero[whole]),
            (index[slotted], zero[slotted], length[slotted], self.first[s] + n, offset),
            (index[rest], zero[rest], head, self.laid_from + at // self.window, at % self.window),
            (index[rest][more], head[more], tail[more], self.laid_from + at[more] // self.window + 1, zero[: more.sum()]),
        ]
        return [np.concatenate(x) for x in zip(*parts, strict=True)]


def plan(counts: dict[int, int], window: int = WINDOW, unit: int = UNIT) -> Plan:
    """counts: pieces of each length from 1 to window."""
    hist = np.zeros(window, np.int64)
    for length, n in counts.items():
        if length < window:
            hist[length] = n
    before = np.concatenate([[0], np.cumsum(hist)])[: window + 1]
    top = -(-window // unit)
    of = -(-np.arange(window) // unit)
    have = np.bincount(of, hist, top + 1).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(have)])
    combos = [
        c
        for depth in (1, 2, 3)
        for c in itertools.combinations_with_replacement(range(1, top + 1), depth)
        if top - 1 <= sum(c) <= top and all(have[k] for k in c)
    ]
    slots, used, sequence = [], np.zeros(top + 1, np.int64), int(counts.get(window, 0))
    if combos:
        a = np.zeros((top + 1, len(combos)))
        for j, c in enumerate(combos):
            np.add.at(a[:, j], list(c), 1)
        x = nnls(a, have.astype(float))
        for j in np.argsort(-x, kind="stable"):
            n = int(min(np.floor(x[j] + 1e-6), min((have[k] - used[k]) // combos[j].count(k) for k in combos[j])))
            if n <= 0:
                continue
            earlier: list[int] = []
            for k in combos[j]:
                lo = int(start[k] + used[k])
                slots.append((lo, lo + n, sequence, (earlier + [-1, -1])[:2]))
                earlier.append(lo)
                used[k] += n
            sequence += n
    slots.sort()
    rest_from = np.maximum(before[:-1], (start[:-1] + used)[of])
    rest = np.maximum(before[1:] - rest_from, 0)
    laid = np.concatenate([[0], np.cumsum(rest * np.arange(window))])
    return Plan(
        window, before, *(np.array([s[k] for s in slots], np.int64) for k in range(3)),
        np.array([s[3] for s in slots], np.int64).reshape(-1, 2), int(counts.get(window, 0)), sequence, rest_from, laid,
    )


def pack(spark: SparkSession, docs: DataFrame, path: str | None = None, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text (null: empty) and `end_id`; each id
    lies in exactly one piece. Sequences are numbered from 0 without gaps; offsets run
    from 0 without gaps. `ids` are little-endian unsigned 32-bit. Rows that repeat a
    doc_id are packed as documents of their own; other columns are ignored; an empty
    table gives no row. Only the last sequence and combinations of lengths that fill a
    window up to two classes fall short of the window.
    """
    path = path or vocabulary()
    folder = scratch(spark)
    small_batches(spark)
    encoded = tokens(docs, path, end_id).withColumn("uid", F.monotonically_increasing_id())
    encoded.write.option("compression", "zstd").parquet(f"{folder}/tokens")
    encoded = spark.read.schema(encoded.schema).parquet(f"{folder}/tokens")

    full = F.floor(F.col("n_tokens") / window).cast("long")
    cut = F.transform(
        F.sequence(F.lit(0), F.ceil(F.col("n_tokens") / window).cast("long") - 1),
        lambda k: F.struct((k * window).alias("start"), F.when(k < full, F.lit(window)).otherwise(F.col("n_tokens") % window).cast("long").alias("length")),
    )
    pieces = encoded.select("uid", F.inline(cut))
    counts = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count(F.lit(1))).collect()}
    whole = plan(counts, window)
    # a row for each length, at most as many as a window has tokens
    buckets = spark.createDataFrame([(k, -(-n // BUCKET)) for k, n in counts.items()], "length long, buckets long")
    pieces = pieces.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64("uid"), F.col("buckets")).cast("int")).drop("buckets")
    local = Window.partitionBy("length", "bucket").orderBy("uid", "start")
    pieces = stored(spark, pieces.withColumn("local", F.row_number().over(local) - 1), folder, "pieces")
    sizes = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stored(spark, sizes.withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0))), folder, "shifts")

    def placed(batches):
        import pyarrow as pa

        for batch in batches:
            uid, start, length, rank = (column(batch, c).to_numpy(zero_copy_only=False) for c in ("uid", "start", "length", "rank"))
            index, at, size, sequence, offset = whole.place(length, rank)
            yield pa.record_batch([pa.array(x.astype(np.int64)) for x in (uid[index], start[index] + at, size, sequence, offset)], ["uid", "start", "length", "sequence_id", "offset"])

    ranked = pieces.join(shifts.drop("n"), ["length", "bucket"]).select("uid", "start", "length", (F.col("local") + F.col("shift")).alias("rank"))
    places = ranked.mapInArrow(placed, "uid long, start long, length long, sequence_id long, offset long")
    lists = places.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    out = encoded.join(lists, "uid").select("doc_id", "n_tokens", "ids", "pieces")
    width = 4 if _wide(path) else 2

    def sliced(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows: list[tuple] = []
                index: list[int] = []
                for i, (n, ids, some) in enumerate(zip(*(column(part, c).to_pylist() for c in ("n_tokens", "ids", "pieces")), strict=True)):
                    wide = ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    for p in some:
                        own = wide[4 * p["start"] : 4 * (p["start"] + p["length"])]
                        rows.append((p["start"], p["length"], own, zlib.crc32(own), n, p["sequence_id"], p["offset"]))
                        index.append(i)
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)]
                yield pa.record_batch([column(part, "doc_id").take(pa.array(index, pa.int64())), *arrays], ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = dict(docs.dtypes)["doc_id"]
    return out.mapInArrow(sliced, f"doc_id {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _wide(path: str) -> bool:
    return (_encoders.get(path) or _encoders.setdefault(path, Encoder(path))).wide
