r"""N-gram Jaccard join: a size-aware heavy-light set-similarity self-join.

A document's set holds its distinct shingles of five words. Equal sets form a class
from the start (its id is a 64-bit hash of the set), so copies are never paired.

Light sets (up to a boundary of size) are joined by enumerated subsets: for every
partner size two sets must share a subset of a fixed size, so each lists its subsets
of that size as keys, and equal keys make candidates. Heavy sets are joined by scanning
inverted lists: shingles are ordered from rare to frequent by a sketch of counts over
the whole corpus, and only the first ones of each set, enough to meet every possible
partner, are listed. The boundary is where the estimated cost of both is least.

1. Classes that share a key, or many listed shingles with the head of a list, are put
   in one cluster. Clusters only say which sets lie together; they decide no link.
2. Within a cluster all sets are compared, exactly, in blocks of bounded size: counts of
   common shingles are products of 0/1 matrices. A cluster of several blocks is compared
   block by block in different tasks. What leaves a task is one number for each set and
   the edges of a spanning forest, never the pairs.
3. Candidates of different clusters are pairs of classes that share a listed shingle and
   pass bounds on sizes and on how many listed shingles they share; these pairs are
   compared one by one.

No list, bucket or partner is capped. Postings travel as packed blocks, one row for many
of them. The work within a cluster grows with the square of its different texts, as the
number of links does; rows and bytes exchanged grow with its blocks. One shingle's list
(18 bytes a class that has it among its rarest shingles) is gathered in one task.
"""

from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civitas.llm.common import BREAK, LOWER, PART, column, mixed, parts, prefix_hash, removed, scratch, small_batches, span_hash, stored, texts, trimmed
from civitas.llm.graph import components

WORDS = 5
#: Similarity as a fraction: NUM / DEN.
NUM, DEN = 4, 5
#: Cells of the count sketch; its size is fixed, whatever the corpus.
CELLS = 1 << 21
CHUNK = 1 << 14
#: What comparing through one posting costs, in subsets enumerated.
POSTING_COST = 16
#: The largest size the boundary may take.
LIGHT_MOST = 24
#: Listed shingles that a class has in common with a list's head where both go to one cluster: of the shorter prefix p
#: at least LEAST * p, and at least SHARE * p but for a deviation of SPREAD * sqrt(p), as links of long sets must share more.
LEAST, SHARE, SPREAD = 0.1, 0.3, 1.5
#: Shingles, and sets, of a block.
BLOCK_SHINGLES, BLOCK_SETS = 200_000, 500
#: Columns of a 0/1 matrix at once.
COLUMNS = 1024
#: Postings that a group gathers, about, and those that a task holds before it sends them.
GATHERED, HELD = 250_000, 400_000
#: Classes that a task remembers to leave out their copies.
REMEMBERED = 1 << 17


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and for each its document's index; words never cross documents."""
    low, breaks = LOWER[data], BREAK[data]
    first = ~breaks
    first[1:] &= breaks[:-1]
    last = ~breaks
    last[:-1] &= breaks[1:]
    some = bounds[:-1] < bounds[1:]
    heads, tails = bounds[:-1][some], bounds[1:][some] - 1
    first[heads] = ~breaks[heads]
    last[tails] = ~breaks[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hash(prefix_hash(low), starts, ends), np.searchsorted(bounds, starts, side="right") - 1


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, with one very long text taken in parts that end at white space."""
    if len(data) <= 2 * PART:
        return _words(data, bounds)
    hashes, docs, at = [], [], 0
    while at < len(data):
        to = min(at + PART, len(data))
        while to < len(data) and not BREAK[data[to - 1]] and to not in bounds:
            to += 1
        h, d = _words(data[at:to], np.clip(bounds, at, to) - at)
        hashes.append(h)
        docs.append(d)
        at = to
    return np.concatenate(hashes), np.concatenate(docs)


def shingles(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """For each text its shingles' 64-bit hashes, sorted and distinct."""
    hashes, docs = words(data, bounds)
    n = len(bounds) - 1
    at = np.searchsorted(docs, np.arange(n + 1))
    k, factor = WORDS, np.uint64(0x9FB21C651E98DF25)
    rolled = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for i in range(k if len(rolled) else 0):
        rolled *= factor
        rolled += hashes[i : len(hashes) - k + 1 + i]
    rolled = mixed(rolled)
    out = []
    for i in range(n):
        a, b = at[i], at[i + 1]
        if b - a >= k:
            own = np.sort(rolled[a : b - k + 1])
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            out.append(own[keep])
        elif b > a:
            value = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for h in hashes[a:b]:
                    value = value * factor + h
            out.append(mixed(np.array([value ^ np.uint64(0xA5A5A5A5)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_id(own: np.ndarray) -> int:
    """A 64-bit hash of a set, the same for equal sets."""
    a = np.bitwise_xor.reduce(mixed(own ^ np.uint64(0x51ED270B)), initial=np.uint64(0), keepdims=True)
    b = np.add.reduce(mixed(own + np.uint64(0x2545F491)), dtype=np.uint64, keepdims=True)
    return int(mixed(b + a * np.uint64(2654435769) + np.uint64(len(own))).view(np.int64)[0])


def _described(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, n, cid) and, with a chunk number, a task's packed counts of the sketch (n: the task)."""
    kind = dict(docs.dtypes)["doc_id"]

    def describe(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        counts, id_type = np.zeros(CELLS, np.uint32), None
        cells: list[np.ndarray] = []

        def add():
            if cells:
                np.add(counts, np.bincount(np.concatenate(cells), minlength=CELLS), out=counts, casting="unsafe")
                cells.clear()

        names = ["doc_id", "n", "cid", "chunk", "cells"]
        for batch in batches:
            id_type = column(batch, "doc_id").type
            for part in parts(batch):
                sets = shingles(*texts(column(part, "text")))
                n = len(sets)
                if n:
                    cells.append((np.concatenate(sets) & np.uint64(CELLS - 1)).astype(np.int32))
                if sum(map(len, cells)) >= CELLS:
                    add()
                yield pa.record_batch(
                    [column(part, "doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array([class_id(x) for x in sets], pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names
                )
        add()
        if id_type is not None:
            n = CELLS // CHUNK
            packed = [zlib.compress(x.astype(np.uint64).tobytes(), 1) for x in counts.reshape(n, CHUNK)]
            yield pa.record_batch([pa.nulls(n, id_type), pa.array([TaskContext.get().partitionId()] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(packed, pa.binary())], names)
        del counts
        trimmed()

    return docs.select("doc_id", "text").mapInArrow(describe, f"doc_id {kind}, n long, cid long, chunk int, cells binary")


def _sketch(described: DataFrame) -> np.ndarray:
    """Frequency classes (logarithms of counts) of all cells; a fixed 4 MB, whatever the corpus.

    Tasks' counts are added up by groups of tasks first.
    """

    def add(table):
        import pyarrow as pa

        total = np.zeros(CHUNK, np.uint64)
        for x in table.column("cells"):
            total += np.frombuffer(zlib.decompress(x.as_py()), np.uint64)
        return pa.table({"chunk": table.column("chunk")[:1], "cells": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    cells = described.where("chunk IS NOT NULL").select("chunk", F.floor(F.col("n") / 64).alias("tasks"), "cells")
    cells = cells.groupBy("chunk", "tasks").applyInArrow(add, "chunk int, cells binary")
    out = np.zeros((CELLS // CHUNK, CHUNK), np.uint16)
    for chunk, packed in cells.groupBy("chunk").applyInArrow(add, "chunk int, cells binary").collect():
        out[chunk] = np.minimum(65535, np.log2(np.frombuffer(zlib.decompress(packed), np.uint64).astype(np.float64) + 1) * 1600)
    return out.reshape(-1)


def least_overlap(a: int, b: int) -> int:
    """The fewest common shingles that link sets of these sizes."""
    return -(-NUM * (a + b) // (NUM + DEN))


def partners(size: int) -> range:
    return range(-(-NUM * size // DEN), DEN * size // NUM + 1)


def boundary(sizes: dict[int, int]) -> int:
    """The size up to which sets are light: the least estimated cost over the sizes given."""
    best = cost = sum(n * (s - -(-NUM * s // DEN) + 1) * POSTING_COST for s, n in sizes.items())
    at = 0
    for s in range(1, LIGHT_MOST + 1):
        n = sizes.get(s, 0)
        cost += n * (sum(math.comb(s, min(s, least_overlap(s, p))) for p in partners(s)) - (s - -(-NUM * s // DEN) + 1) * POSTING_COST)
        if cost <= best:
            best, at = cost, s
    return at


#: 48 bits of a shingle's hash, and the class that lists it.
POSTING = np.dtype([("low", "<u4"), ("high", "<u2"), ("cid", "<i8"), ("size", "<u4")])


def _postings(docs: DataFrame, sketch, light: int, blocks: int) -> DataFrame:
    """Packed blocks of postings (part, postings), and light keys (key, cid, size)."""

    def emit(batches):
        import pyarrow as pa

        frequency = sketch.value
        names = ["part", "postings", "key", "cid", "size"]
        seen: set[int] = set()
        held: list[np.ndarray] = []
        keys: list[tuple[int, int, int]] = []

        def flush():
            if held:
                own = np.concatenate(held)
                to = ((own["low"].astype(np.int64) << 16 | own["high"]) % blocks).astype(np.int32)
                order = np.argsort(to, kind="stable")
                own, to = own[order], to[order]
                first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
                n = len(first)
                lists = [x.tobytes() for x in np.split(own, first[1:])]
                yield pa.record_batch([pa.array(to[first]), pa.array(lists, pa.binary()), *(pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int32()))], names)
            if keys:
                n = len(keys)
                yield pa.record_batch([pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *(pa.array(x, t) for x, t in zip(zip(*keys, strict=True), (pa.int64(), pa.int64(), pa.int32()), strict=True))], names)
            held.clear(), keys.clear()

        pending = 0
        for batch in batches:
            for part in parts(batch):
                for own in shingles(*texts(column(part, "text"))):
                    size = len(own)
                    if not size or (cid := class_id(own)) in seen:
                        continue
                    if len(seen) < REMEMBERED:
                        seen.add(cid)
                    if size <= light:
                        keys.extend((k, cid, size) for k in light_keys(own))
                    if DEN * size >= NUM * (light + 1):
                        tokens = (frequency[(own & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(48)) | (own >> np.uint64(16))
                        n = prefix(size)
                        if n < size:
                            tokens = np.partition(tokens, n - 1)[:n]
                        block = np.zeros(n, POSTING)
                        block["low"], block["high"], block["cid"], block["size"] = tokens & np.uint64(0xFFFFFFFF), (tokens >> np.uint64(32)) & np.uint64(0xFFFF), cid, size
                        held.append(block)
                        pending += n
                    if pending >= HELD or len(keys) >= HELD // 8:
                        yield from flush()
                        pending = 0
        yield from flush()
        trimmed()

    return docs.select("text").mapInArrow(emit, "part int, postings binary, key long, cid long, size int")


def prefix(size: int) -> int:
    """How many shingles of a set of this size are listed."""
    return size - -(-NUM * size // DEN) + 1


def light_keys(own: np.ndarray) -> list[int]:
    """A key for each partner size and subset of the size both must share."""
    size, out = len(own), []
    for other in partners(size):
        k = least_overlap(size, other)
        if k > min(size, other):
            continue
        pick = np.array(list(itertools.combinations(range(size), k)))
        low, high = min(size, other), max(size, other)
        with np.errstate(over="ignore"):
            value = np.full(len(pick), np.uint64(low * 1000 + high))
            for c in range(k):
                value = mixed(value * np.uint64(0x9FB21C651E98DF25) + own[pick[:, c]])
        # the lowest bit tells whether the two sizes differ
        value = (value & ~np.uint64(1)) | np.uint64(low != high)
        out.extend(value.view(np.int64).tolist())
    return out


def _lists(blocks: DataFrame) -> DataFrame:
    """Inverted lists of three members at least (token, cid, size), and pairs (token null; cid, size, other, other_size, two).

    A list of two is but a pair, marked as `two`; of longer ones every member is paired with two heads.
    """

    def gather(table):
        import pyarrow as pa

        own = np.concatenate([np.frombuffer(p.as_py(), POSTING) for p in table.column("postings")])
        token, cid, size = own["low"].astype(np.int64) << 16 | own["high"], own["cid"], own["size"].astype(np.int32)
        # members are in the order of their mixed ids, so that lists of the same members have the same heads
        order = np.lexsort((mixed(cid.view(np.uint64)), token))
        token, cid, size = token[order], cid[order], size[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])])
        token, cid, size = token[new], cid[new], size[new]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        n = np.diff(np.concatenate([first, [len(token)]]))
        place, many = np.arange(len(token)), np.repeat(n, n)
        heads = [np.repeat(x, n) for x in (first, first + n - 1)]
        ends = [(many > 1) & (place != heads[0]), (many > 2) & (place != heads[0]) & (place != heads[1])]
        a, b = np.concatenate([place[x] for x in ends]), np.concatenate([h[x] for h, x in zip(heads, ends, strict=True)])
        swap = cid[a] > cid[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        long = many > 2
        pad = lambda x, kind, before=0, after=0: pa.concat_arrays([pa.nulls(before, kind), pa.array(x, kind), pa.nulls(after, kind)])
        k, m = len(a), int(long.sum())
        return pa.table({
            "token": pad(token[long], pa.int64(), before=k), "cid": pa.array(np.concatenate([cid[a], cid[long]])), "size": pa.array(np.concatenate([size[a], size[long]])),
            "other": pad(cid[b], pa.int64(), after=m), "other_size": pad(size[b], pa.int32(), after=m), "two": pad(many[a] == 2, pa.bool_(), after=m),
        })

    return blocks.select("part", "postings").groupBy("part").applyInArrow(gather, "token long, cid long, size int, other long, other_size int, two boolean")


def _picked(docs: DataFrame, marks, paired) -> DataFrame:
    """(cid, task, paired, own): sets of marked classes, about once a task; paired: those also marked there."""

    def pick(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        there, there_too, task = marks.value, paired.value, TaskContext.get().partitionId()
        seen: set[int] = set()
        for batch in batches:
            for part in parts(batch):
                cids, sets, two = [], [], []
                for own in shingles(*texts(column(part, "text"))):
                    if len(own) and (cid := class_id(own)) not in seen and there.may_hold(cid):
                        if len(seen) < REMEMBERED:
                            seen.add(cid)
                        cids.append(cid)
                        two.append(there_too.may_hold(cid))
                        sets.append(own.tobytes())
                if cids:
                    yield pa.record_batch([pa.array(cids, pa.int64()), pa.array([task] * len(cids), pa.int32()), pa.array(two), pa.array(sets, pa.binary())], ["cid", "task", "paired", "own"])
        trimmed()

    return docs.select("text").mapInArrow(pick, "cid long, task int, paired boolean, own binary")


class Marks:
    """A fixed-size set of marks over mixed ids: false positives, no false negatives."""

    BITS = 1 << 25

    def __init__(self):
        self.bytes = np.zeros(self.BITS // 8, np.uint8)

    @staticmethod
    def place(cid):
        """The same as a column expression (below) and here: the low bits of the id, itself a hash."""
        return cid & (Marks.BITS - 1)

    def may_hold(self, cid: int) -> bool:
        p = self.place(cid)
        return bool(self.bytes[p >> 3] >> (p & 7) & 1)

    @classmethod
    def of(cls, wanted: DataFrame) -> Marks:
        place = F.col("cid").bitwiseAND(F.lit(cls.BITS - 1)) + 1
        maps = wanted.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
        out = cls()
        for bucket, bitmap in maps.collect():
            out.bytes[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bitmap, np.uint8)
        return out


def _sets(own: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all shingles, whose they are, sizes)."""
    size = np.array([len(x) for x in own])
    return np.concatenate(own), np.repeat(np.arange(len(own)), size), size


def overlaps(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """How many shingles each set of a has in common with each set of b (without b: of a)."""
    token, owner, size = _sets(a if b is None else a + b)
    n = len(a)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    count = np.diff(np.concatenate([first, [len(token)]]))
    if b is None:
        wanted = count > 1
        every = count == n  # in each set: no column of its own
    else:
        low, high = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
        wanted = (low < n) & (high >= n)
        every = count == len(size)
    out = np.full((n, n if b is None else len(b)), np.float32((every & wanted).sum()), np.float32)
    wanted &= ~every
    keep = np.repeat(wanted, count)
    owner, at = owner[keep], np.repeat(np.arange(wanted.sum()), count[wanted])
    for lo in range(0, int(wanted.sum()), COLUMNS):
        i, j = np.searchsorted(at, (lo, lo + COLUMNS))
        x = np.zeros((len(size), COLUMNS), np.float32)
        x[owner[i:j], at[i:j] - lo] = 1
        out += x[:n] @ (x if b is None else x[n:]).T
    return out


def linked(common: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    return (NUM + DEN) * common.astype(np.int64) >= NUM * (size_a[:, None] + size_b[None, :])


def _labels(link: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the smallest row reachable."""
    label = np.arange(len(link), dtype=np.int32)
    while True:
        least = np.minimum(label, np.where(link, label[None, :], np.int32(len(link))).min(1, initial=len(link)))
        least = np.minimum(least, least[least])
        if np.array_equal(least, label):
            return label
        label = least


def _block(rows) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(sets, ids, weights) of a block's rows (cid, weight, own), each class once."""
    once = {r[0]: r for r in rows}
    return [np.frombuffer(r[2], np.uint64) for r in once.values()], np.array([r[0] for r in once.values()], np.int64), np.array([r[1] for r in once.values()], np.int64)


def _runs(batches, keys: list[str], columns: list[str]):
    """(key, rows) for each run of equal keys in sorted batches."""
    last, held = None, []
    for batch in batches:
        rows = zip(*(column(batch, c).to_pylist() for c in keys), strict=True), zip(*(column(batch, c).to_pylist() for c in columns), strict=True)
        for key, row in zip(*rows, strict=True):
            if key != last and held:
                yield last, held
                held = []
            last = key
            held.append(row)
    if held:
        yield last, held


WITHIN = "cid long, links long, u long, v long, cluster long, block int, blocks int, packed binary"


def _found(cids, links, edges, packed=()):
    """A record batch of WITHIN: links of classes, edges, and packed blocks."""
    import pyarrow as pa

    n, m, k = len(cids), len(edges), len(packed)
    u, v = zip(*edges, strict=True) if m else ((), ())
    pad = lambda before, values, after, kind: pa.concat_arrays([pa.nulls(before, kind), pa.array(values, kind), pa.nulls(after, kind)])
    some = [pad(0, cids, m + k, pa.int64()), pad(0, links, m + k, pa.int64()), pad(n, u, k, pa.int64()), pad(n, v, k, pa.int64())]
    rest = [pad(n + m, [p[i] for p in packed], 0, kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary()))]
    return pa.record_batch([*some, *rest], [c.split()[0] for c in WITHIN.split(", ")])


def _within(placed: DataFrame) -> DataFrame:
    """Links within blocks, from rows (cluster, block, blocks, cid, weight, own); a block of several comes out packed."""

    def compare(batches):
        cids, links, edges, packed = [], [], [], []
        for (cluster, block, blocks), rows in _runs(batches, ["cluster", "block", "blocks"], ["cid", "weight", "own"]):
            own, cid, weight = _block(rows)
            size = np.array([len(x) for x in own])
            if len(own) > 1:
                link = linked(overlaps(own), size, size)
                np.fill_diagonal(link, False)
                label = _labels(link)
                cids.extend(cid.tolist())
                links.extend((link @ weight.astype(np.float64)).astype(np.int64).tolist())
                edges.extend((int(cid[i]), int(cid[label[i]])) for i in np.flatnonzero(label != np.arange(len(label))))
            if blocks > 1:
                packed.append((cluster, block, blocks, b"".join([np.int64([len(own)]).tobytes(), cid.tobytes(), weight.tobytes(), size.astype(np.int64).tobytes(), *(x.tobytes() for x in own)])))
            if len(cids) + len(edges) > 20_000 or packed:
                yield _found(cids, links, edges, packed)
                cids, links, edges, packed = [], [], [], []
        yield _found(cids, links, edges, packed)
        trimmed()

    return placed.mapInArrow(compare, WITHIN)


def _unpacked(packed: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    n = int(np.frombuffer(packed, np.int64, 1)[0])
    cid, weight, size = (np.frombuffer(packed, np.int64, n, 8 + 8 * n * k) for k in range(3))
    token = np.frombuffer(packed, np.uint64, -1, 8 + 24 * n)
    return np.split(token, np.cumsum(size)[:-1]), cid, weight


def _across(blocks: DataFrame) -> DataFrame:
    """Links between blocks of one cluster, from packed blocks (cluster, block, blocks, packed)."""

    def compare(batches):
        for _, rows in _runs(batches, ["cluster", "lo", "hi"], ["packed"]):
            if len(rows) < 2:  # no class fell into the other block
                continue
            (a, cid_a, weight_a), (b, cid_b, weight_b) = (_unpacked(r[0]) for r in rows)
            link = linked(overlaps(a, b), np.array([len(x) for x in a]), np.array([len(x) for x in b]))
            n = len(a)
            both = np.zeros((n + len(b),) * 2, bool)
            both[:n, n:], both[n:, :n] = link, link.T
            label, cid = _labels(both), np.concatenate([cid_a, cid_b])
            edges = [(int(cid[i]), int(cid[label[i]])) for i in np.flatnonzero(label != np.arange(len(label)))]
            links = [link @ weight_b.astype(np.float64), weight_a.astype(np.float64) @ link]
            yield _found(cid.tolist(), np.concatenate(links).astype(np.int64).tolist(), edges)
        trimmed()

    other = F.explode(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("block"))).alias("other")
    pairs = blocks.select("cluster", "block", "packed", other).select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "packed")
    key = ["cluster", "lo", "hi"]
    return pairs.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, WITHIN)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, task_a, b, task_b) that are links, as (u, v)."""

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(column(batch, "own_a"), column(batch, "own_b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                common = int((q[at] == p).sum())
                keep.append(DEN * common >= NUM * (len(p) + len(q) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.record_batch([column(batch, "a").filter(keep), column(batch, "b").filter(keep)], ["u", "v"])
        trimmed()

    side = lambda x: sets.select(F.col("cid").alias(x), F.col("task").alias(f"task_{x}"), F.col("own").alias(f"own_{x}"))
    return pairs.join(side("a"), ["a", "task_a"]).join(side("b"), ["b", "task_b"]).select("a", "b", "own_a", "own_b").mapInArrow(compare, "u long, v long")


def similar_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, class_id, n_links.

    component_id is the smallest doc_id reachable by links of similarity NUM / DEN or
    more (itself included); documents with equal sets are linked; n_links counts the
    other rows a row is linked with. A text of one to four words has one shingle, the
    whole sequence; one without words (null and empty too) has none, is linked with
    nothing and is its own component. Rows that repeat a doc_id and text agree in all
    columns and count as links of each other; a null doc_id is the least, so a component
    that has one has a null component_id. Other columns are ignored; an empty table
    gives no row.
    """
    folder = scratch(spark)
    small_batches(spark)
    described = stored(spark, _described(docs), folder, "described")
    rows = described.where("chunk IS NULL").select("doc_id", "n", "cid")
    sizes = {r[0]: r[1] for r in rows.where(F.col("n").between(1, DEN * LIGHT_MOST)).groupBy("n").agg(F.count(F.lit(1))).collect()}
    light = boundary(sizes)
    postings = rows.agg(F.sum(F.floor(F.col("n") / DEN) + 1)).first()[0] or 0
    sketch = spark.sparkContext.broadcast(_sketch(described))
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), postings // GATHERED)

    packed = stored(spark, _postings(docs, sketch, light, blocks), folder, "postings")
    lists = stored(spark, _lists(packed.where("part IS NOT NULL")), folder, "lists")
    shared = stored(spark, _shared(lists), folder, "shared")
    clusters = stored(spark, _clusters(spark, packed, shared, folder), folder, "clusters")
    removed(spark, folder, "postings")
    pairs = stored(spark, _candidates(lists, shared, clusters, light), folder, "pairs")
    removed(spark, folder, "lists")

    paired = pairs.select(F.explode(F.array("a", "b")).alias("cid"))
    marks = [spark.sparkContext.broadcast(Marks.of(x)) for x in (clusters.select("cid").union(paired), paired)]
    sets = stored(spark, _picked(docs, *marks), folder, "sets")
    # of a set's copies in several tasks one counts, so that sets need no exchange to become distinct
    owners = stored(spark, sets.groupBy("cid").agg(F.min("task").alias("task")), folder, "owners")
    classes = stored(spark, rows.where("n > 0").groupBy("cid").agg(F.first("n").alias("size"), F.count(F.lit(1)).alias("weight")), folder, "classes")

    members = stored(spark, clusters.join(classes, "cid").join(owners, "cid"), folder, "members")
    blocks = F.greatest(F.ceil(F.sum("size") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).cast("int")
    large = members.groupBy("cluster").agg(blocks.alias("blocks")).where("blocks > 1")
    placed = members.join(large, "cluster", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.select("cid", "task", "cluster", "weight", "blocks", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int").alias("block"))
    # a merge join at every size: what is broadcast where the corpus is small must not be counted on where it is large
    placed = sets.select("cid", "task", "own").hint("merge").join(placed, ["cid", "task"]).select("cluster", "block", "blocks", "cid", "weight", "own")
    within = stored(spark, _within(placed.repartition("cluster", "block").sortWithinPartitions("cluster", "block")), folder, "within")
    blocks = within.where("packed IS NOT NULL").select("cluster", "block", "blocks", "packed")
    if blocks.take(1):
        within = within.drop("packed").unionByName(stored(spark, _across(blocks).drop("packed"), folder, "across"))
    links = within.where("u IS NOT NULL").select("u", "v")
    counts = within.where("cid IS NOT NULL").select("cid", "links")
    if pairs.take(1):
        owner = lambda x: owners.select(F.col("cid").alias(x), F.col("task").alias(f"task_{x}"))
        routed = pairs.join(owner("a"), "a").join(owner("b"), "b")
        found = stored(spark, _verified(routed, sets.where("paired")), folder, "found")
        links = links.unionByName(found)
        both = found.union(found.select("v", "u")).join(classes.select(F.col("cid").alias("v"), F.col("weight").alias("links")), "v")
        counts = counts.unionByName(both.select(F.col("u").alias("cid"), "links"))
    counts = stored(spark, counts.groupBy("cid").agg(F.sum("links").alias("links")), folder, "counts")
    removed(spark, folder, "sets")
    roots = components(spark, links, folder, "all").withColumnRenamed("node", "cid")
    about = classes.select("cid", "weight").join(counts, "cid", "left").join(roots, "cid", "left")
    about = about.select("cid", F.coalesce("root", "cid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    found = stored(spark, rows.where("n > 0").join(stored(spark, about, folder, "about"), "cid"), folder, "rows")
    least = stored(spark, found.groupBy("root").agg(F.min(F.struct("doc_id")).alias("least")), folder, "least")
    out = found.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), F.col("least.doc_id").alias("component_id"), F.col("cid").alias("class_id"), "n_links")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("cid").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def _prefix(size: Column) -> Column:
    return size - F.ceil(NUM * size / DEN) + 1


def _shared(lists: DataFrame) -> DataFrame:
    """Pairs of classes with how many listed shingles they share as members and heads (k), and how many in lists of two (k_two)."""
    pairs = lists.where("token IS NULL").groupBy("cid", "size", "other", "other_size")
    return pairs.agg(F.count(F.lit(1)).alias("k"), F.count_if("two").alias("k_two"))


def _clusters(spark: SparkSession, packed: DataFrame, shared: DataFrame, folder: str) -> DataFrame:
    """(cid, cluster): classes that share a light key, or many listed shingles with the head of their lists."""
    keys = packed.where("key IS NOT NULL").select("key", "cid", "size", (F.col("key").bitwiseAND(F.lit(1)) == 0).alias("even")).distinct()
    # a key stands for a pair of sizes; where these differ, both must be there
    heads = keys.groupBy("key").agg(F.min("cid").alias("v"), F.count(F.lit(1)).alias("m"), (F.min("size") < F.max("size")).alias("two"), F.max("even").alias("even"))
    heads = heads.where("m > 1 AND (even OR two)").select("key", "v")
    light = keys.join(heads, "key").where("cid <> v").select(F.col("cid").alias("u"), "v")
    listed = F.least(_prefix(F.col("size")), _prefix(F.col("other_size")))
    heavy = shared.where((F.col("k") >= LEAST * listed) & (F.col("k") >= SHARE * listed - SPREAD * F.sqrt(listed))).select(F.col("cid").alias("u"), F.col("other").alias("v"))
    edges = stored(spark, light.unionByName(heavy), folder, "edges")
    return components(spark, edges, folder, "near").select(F.col("node").alias("cid"), F.col("root").alias("cluster"))


def _candidates(lists: DataFrame, shared: DataFrame, clusters: DataFrame, light: int) -> DataFrame:
    """Pairs (a, b) of classes of different clusters that may be links: they share listed shingles, and bounds leave it open."""
    def named(rows: DataFrame, cid: str, cluster: str) -> DataFrame:
        own = clusters.select(F.col("cid").alias(cid), F.col("cluster").alias(cluster))
        return rows.join(own, cid, "left").withColumn(cluster, F.coalesce(cluster, cid))

    long = named(lists.where("token IS NOT NULL").select("token", "cid", "size"), "cid", "cluster")
    spread = long.groupBy("token").agg(F.min("cluster").alias("x"), F.max("cluster").alias("y")).where("x <> y").select("token")
    long = long.join(spread, "token", "left_semi")
    side = lambda x: long.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("cid", "cluster", "size")))
    size = (F.col("size_a"), F.col("size_b"))
    fits = (DEN * F.least(*size) >= NUM * F.greatest(*size)) & (F.greatest(*size) > light)
    both = side("a").join(side("b"), "token").where((F.col("cluster_a") < F.col("cluster_b")) & fits)
    # the smaller id first, as in the pairs of lists of two
    turned = F.col("cid_a") > F.col("cid_b")
    ordered = lambda x, y: [F.when(turned, F.col(f"{c}_{y}")).otherwise(F.col(f"{c}_{x}")).alias(f"{c}_{x}") for c in ("cid", "size")]
    both = both.select(*ordered("a", "b"), *ordered("b", "a"), F.lit(1).cast("long").alias("k"))
    two = shared.where("k_two > 0").select(F.col("cid").alias("cid_a"), F.col("size").alias("size_a"), F.col("other").alias("cid_b"), F.col("other_size").alias("size_b"), F.col("k_two").alias("k")).where(fits)
    two = named(named(two, "cid_a", "cluster_a"), "cid_b", "cluster_b").where("cluster_a <> cluster_b").select(*both.columns)
    # shingles beyond the listed ones of the set whose list ends first, and those listed by both, are all that two sets can share
    rest = lambda c: c - _prefix(c)
    enough = (F.col("k") + 1 + F.greatest(rest(size[0]), rest(size[1]))) * (NUM + DEN) >= NUM * (size[0] + size[1])
    both = both.unionByName(two).groupBy("cid_a", "cid_b", "size_a", "size_b").agg(F.sum("k").alias("k"))
    return both.where(enough).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"))
