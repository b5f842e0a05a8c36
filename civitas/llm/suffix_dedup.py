"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort.

Which suffixes are sorted: those at anchors. The anchor of a string of `LENGTH` bytes is
the leftmost of its `LENGTH // 2`-byte substrings of least hash; equal strings have it at
the same place, so two strings can only be equal if their anchors' substrings are. Only
anchors whose hash occurs more than once go on; hashes merely rule others out, and all
that is removed was compared byte by byte.

1. Anchors are hashed, packed in blocks and met by hash; those that repeat are candidates.
   Repeats within a task are found there, and one of them is sent.
2. Every task cuts its candidates' contexts (bytes after and before the anchor) from the
   texts, keeps one entry for each distinct context, sorts them, and emits them
   front-coded, by ranges of the suffix. Which places an entry stands for stays behind.
3. Each range merges its runs with a loser tree. Strings carry the length of the prefix
   they share with the last output, so known prefixes are never compared again.
4. Neighbours that share enough form a group. Where in its context an entry is repeated
   follows from the common prefixes and the common suffixes before the anchor, by
   counting equal classes for each split of the length: linear in the group, no pairs.
5. The findings return to the places, and documents are cut.

Identical contexts of any number of documents meet as one entry a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from civitas.llm.common import PART, column, mixed, parts, powers, prefix_hash, scratch, small_batches, stored, texts, trimmed

LENGTH = 400
#: Anchors, and contexts, that a task holds before it sends them.
HELD_ANCHORS = 400_000
HELD_CONTEXTS = 40_000
#: Anchors that meet in one group, about; a text has one in `LENGTH // 4` bytes.
GROUP = 100_000
#: Low bits of a hash that give way to the place in a chunk: the same for all chunks, so that ties fall alike.
PLACE_BITS = (4 * PART).bit_length()
ANCHOR = np.dtype([("hash", "<u8"), ("uid", "<i8"), ("at", "<u4"), ("start", "<i8")])
ENTRY = np.dtype([("shared", "<u2"), ("rest", "<u2"), ("shared_back", "<u2"), ("rest_back", "<u2"), ("many", "?")])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes of their substrings) of all anchors of the texts, in order."""
    k = length // 2
    width = length - k + 1
    n = len(data) - k + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prefix = prefix_hash(data)
    hashes = prefix[k:] - prefix[:-k]
    hashes *= powers(len(prefix), inverse=True)[:n]
    hashes = mixed(hashes)
    bits = PLACE_BITS
    assert n < 1 << bits
    key = (hashes >> np.uint64(bits)) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    rows = -(-n // width)
    full = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = key
    full = full.reshape(rows, width)
    ahead = np.minimum.accumulate(full, axis=1).reshape(-1)
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    room = np.diff(bounds) >= length
    marks = np.zeros(len(data) + 2, np.int32)
    np.add.at(marks, bounds[:-1][room], 1)
    np.add.at(marks, bounds[1:][room] - length + 1, -1)
    valid = np.cumsum(marks[: len(least)]) > 0
    places = (least[valid] & np.uint64((1 << bits) - 1)).astype(np.int64)
    places = places[np.concatenate([[True], places[1:] != places[:-1]])] if len(places) else places
    return places, hashes[places]


def _spans(batch, length: int):
    """(data, bounds, row of each text, offset within it): pieces of about PART bytes, long texts overlapping."""
    for part, row in _rows(batch):
        data, bounds = texts(column(part, "text"))
        if len(data) <= 2 * PART:
            yield data, bounds, row + np.arange(part.num_rows), np.zeros(part.num_rows, np.int64)
            continue
        for at in range(0, len(data), PART):
            own = data[at : at + PART + length - 1]
            yield own, np.array([0, len(own)]), np.array([row + part.num_rows - 1]), np.array([at])


def _rows(batch):
    row = 0
    for part in parts(batch):
        yield part, row
        row += part.num_rows


def _first(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The seven bytes from each place as a number, in the order of the bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.int64)
    out = np.zeros(len(at), np.int64)
    for k in range(7):
        out = (out << 8) | padded[at + k]
    return out


def _anchored(docs: DataFrame, blocks: int, length: int) -> DataFrame:
    """Packed anchors (part, packed), and candidates known at once (uid, places, starts)."""

    def emit(batches):
        import pyarrow as pa

        names = ["part", "packed", "uid", "places", "starts"]
        held: list[np.ndarray] = []

        def flush():
            own = np.concatenate(held)
            held.clear()
            own = own[np.lexsort((own["at"], own["uid"], own["hash"]))]
            new = np.concatenate([[True], (own["hash"][1:] != own["hash"][:-1])])
            again = ~new
            again[:-1] |= ~new[1:]
            yield _candidates(own[again])
            # one of a hash is sent, marked by a doubled row where there are more
            sent = own[new | np.concatenate([[False], new[:-1] & again[1:] & ~new[1:]])]
            to = (sent["hash"] % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            sent, to = sent[order], to[order]
            cuts = np.flatnonzero(np.diff(to)) + 1
            packed = [x.tobytes() for x in np.split(sent, cuts)]
            n = len(packed)
            yield pa.record_batch([pa.array(to[np.concatenate([[0], cuts])].astype(np.int32)), pa.array(packed, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))], names)

        size = 0
        for batch in batches:
            uid = column(batch, "uid").to_numpy(zero_copy_only=False)
            for data, bounds, rows, offset in _spans(batch, length):
                at, hashes = anchors(data, bounds, length)
                if not len(at):
                    continue
                doc = np.searchsorted(bounds, at, side="right") - 1
                block = np.zeros(len(at), ANCHOR)
                block["hash"], block["uid"], block["at"], block["start"] = hashes, uid[rows[doc]], at - bounds[doc] + offset[doc], _first(data, at)
                held.append(block)
                size += len(at)
                if size >= HELD_ANCHORS:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()
        trimmed()

    return docs.select("uid", "text").mapInArrow(emit, "part int, packed binary, uid long, places array<int>, starts array<long>")


def _candidates(own: np.ndarray):
    import pyarrow as pa

    own = own[np.lexsort((own["at"], own["uid"]))]
    new = np.concatenate([[True], own["uid"][1:] != own["uid"][:-1]]) if len(own) else np.zeros(0, bool)
    offsets = pa.array(np.concatenate([np.flatnonzero(new), [len(own)]]).astype(np.int32))
    n = int(new.sum())
    return pa.record_batch(
        [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(own["uid"][new]), pa.ListArray.from_arrays(offsets, pa.array(own["at"].astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(own["start"]))],
        ["part", "packed", "uid", "places", "starts"],
    )


def _met(anchored: DataFrame) -> DataFrame:
    """Candidates found by meeting packed anchors of the same hash."""

    def meet(table):
        import pyarrow as pa

        own = np.concatenate([np.frombuffer(x.as_py(), ANCHOR) for x in table.column("packed")])
        _, inverse, n = np.unique(own["hash"], return_inverse=True, return_counts=True)
        return pa.Table.from_batches([_candidates(own[n[inverse] > 1])]).select(["uid", "places", "starts"])

    return anchored.where("part IS NOT NULL").select("part", "packed").groupBy("part").applyInArrow(meet, "uid long, places array<int>, starts array<long>")


def shared_bytes(a: bytes, b: bytes, start: int = 0) -> int:
    """How long a prefix two strings share, given that they share `start` bytes."""
    n = min(len(a), len(b)) - start
    if n <= 0:
        return min(len(a), len(b))
    differ = int.from_bytes(a[start : start + n], "big") ^ int.from_bytes(b[start : start + n], "big")
    return start + n - (differ.bit_length() + 7) // 8


def front_coded(entries: list[tuple[bytes, bytes, bool]]) -> bytes:
    """Pack sorted entries (suffix, reversed bytes before, many): shared lengths and what is new."""
    table, rest = np.zeros(len(entries), ENTRY), []
    last, last_back = b"", b""
    for i, (after, before, many) in enumerate(entries):
        shared, back = shared_bytes(last, after), shared_bytes(last_back, before)
        table[i] = (shared, len(after) - shared, back, len(before) - back, many)
        rest += [after[shared:], before[back:]]
        last, last_back = after, before
    return len(entries).to_bytes(4, "little") + table.tobytes() + b"".join(rest)


def decoded(block: bytes) -> list[tuple[int, bytes, bytes, bool]]:
    """(shared with the one before, suffix, reversed bytes before, many)."""
    n = int.from_bytes(block[:4], "little")
    table = np.frombuffer(block, ENTRY, n, 4).tolist()
    at, out, last, last_back = 4 + n * ENTRY.itemsize, [], b"", b""
    for shared, rest, back, rest_back, many in table:
        last = last[:shared] + block[at : at + rest]
        at += rest
        last_back = last_back[:back] + block[at : at + rest_back]
        at += rest_back
        out.append((shared, last, last_back, many))
    return out


def merged(runs: list[list[tuple[int, bytes]]]):
    """Merge sorted runs of (shared with the one before in the run, string).

    Yields (run, index, shared with the last output). A loser tree: each waiting string
    knows the prefix it shares with the last output. Of two, the one that shares more is
    the smaller; only on equal lengths are bytes compared, from that length on.
    """
    n = 1
    while n < len(runs):
        n *= 2
    at = [0] * n
    string: list[bytes | None] = [r[0][1] if r else None for r in runs] + [None] * (n - len(runs))
    shared = [0] * n
    loser = [0] * n

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = string[a], string[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        s = shared_bytes(x, y, shared[a])
        a_first = len(x) <= len(y) if s == min(len(x), len(y)) else x[s] < y[s]
        if a_first:
            shared[b] = s
            return a, b
        shared[a] = s
        return b, a

    winners = [0] * n + list(range(n))
    for node in range(n - 1, 0, -1):
        winners[node], loser[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    while string[best] is not None:
        yield best, at[best], shared[best]
        run = runs[best]
        at[best] += 1
        if at[best] < len(run):
            shared[best], string[best] = run[at[best]]
        else:
            string[best] = None
        node = (best + n) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


def repeated(after: list[bytes], before: list[bytes], many: np.ndarray, shared: np.ndarray, length: int):
    """For sorted entries of whole groups: rows (entry, lo, hi), such that the strings of `length`
    bytes that start lo to hi bytes before the anchor stand elsewhere too.

    shared: prefix in common with the entry before.
    """
    n = len(after)
    size, size_back = np.array([len(x) for x in after]), np.array([len(x) for x in before])
    order = sorted(range(n), key=before.__getitem__)
    back = np.zeros(n, np.int64)
    for i in range(1, n):
        back[i] = shared_bytes(before[order[i - 1]], before[order[i]])
    order = np.array(order)
    found = np.zeros((n, length - length // 2 + 1), bool)
    weight = 1 + many.astype(np.int64)
    place = np.empty(n, np.int64)
    kept: tuple = ()
    for j in range(found.shape[1]):
        ahead = np.cumsum(shared < length - j)
        place[order] = np.cumsum(back < j)
        fits = (size >= length - j) & (size_back >= j)
        now = (ahead[-1], place.max(), ahead.tobytes(), place.tobytes())
        if now != kept:
            _, inverse = np.unique(ahead * (n + 1) + place, return_inverse=True)
            kept = now
        total = np.bincount(inverse, weight * fits)
        found[:, j] = fits & (total[inverse] > 1)
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    entry, lo = np.nonzero(edge == 1)
    _, hi = np.nonzero(edge == -1)
    return entry, lo, hi - 1


def _runs(texts_with: DataFrame, splits: list[int], length: int) -> DataFrame:
    """Front-coded blocks (part, run, first, block) and what entries stand for (run, entry, uid, at)."""
    k, width = length - length // 2, length

    def emit(batches):
        import bisect

        import pyarrow as pa
        from pyspark import TaskContext

        names = ["part", "run", "first", "block", "entry", "uid", "at"]
        task, runs = TaskContext.get().partitionId(), 0
        held: dict[tuple[bytes, bytes], list[tuple[int, int]]] = {}
        count = 0

        def flush():
            nonlocal runs, count
            run = (task << 24) | runs
            runs, count = runs + 1, 0
            order = sorted(held)
            entries = [(a, b, len(held[a, b]) > 1) for a, b in order]
            to = [bisect.bisect_right(splits, int.from_bytes(a[:7], "big")) for a, _ in order]
            cuts = [0] + [i for i in range(1, len(to)) if to[i] != to[i - 1]] + [len(to)]
            n = len(cuts) - 1
            yield pa.record_batch(
                [pa.array([to[c] for c in cuts[:-1]], pa.int32()), pa.array([run] * n, pa.int64()), pa.array(cuts[:-1], pa.int32()), pa.array([front_coded(entries[cuts[i] : cuts[i + 1]]) for i in range(n)], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())], names
            )
            members = [(i, *m) for i, c in enumerate(order) for m in held[c]]
            held.clear()
            n = len(members)
            entry, uid, at = zip(*members, strict=True)
            yield pa.record_batch([pa.nulls(n, pa.int32()), pa.array([run] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(entry, pa.int32()), pa.array(uid, pa.int64()), pa.array(at, pa.int32())], names)

        for batch in batches:
            uids, places = column(batch, "uid").to_pylist(), column(batch, "places")
            for i, text in enumerate(column(batch, "text")):
                data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                for p in places[i].values.to_numpy().tolist():
                    context = (bytes(data[p : p + width]), bytes(data[max(0, p - k) : p])[::-1])
                    held.setdefault(context, []).append((uids[i], p))
                    count += 1
                if len(held) >= HELD_CONTEXTS or count >= 10 * HELD_CONTEXTS:
                    yield from flush()
        if held:
            yield from flush()
        trimmed()

    return texts_with.select("uid", "text", "places").mapInArrow(emit, "part int, run long, first int, block binary, entry int, uid long, at int")


def _found(runs: DataFrame, length: int) -> DataFrame:
    """(run, entry, lo, hi): where entries are repeated, from merging each range's runs."""

    def merge(table):
        import pyarrow as pa

        run_ids, firsts = table.column("run").to_pylist(), table.column("first").to_pylist()
        blocks = [decoded(x.as_py()) for x in table.column("block")]
        out: list[list[np.ndarray]] = []
        held: list[tuple[int, int]] = []
        common: list[int] = []
        starts = 0

        def close():
            if len(held) > 1 or (held and blocks[held[0][0]][held[0][1]][3]):
                own = [blocks[b][i] for b, i in held]
                entry, lo, hi = repeated([x[1] for x in own], [x[2] for x in own], np.array([x[3] for x in own]), np.array(common), length)
                if len(entry):
                    ids = np.array([(run_ids[b], firsts[b] + i) for b, i in held], np.int64)[entry]
                    out.append([ids[:, 0], ids[:, 1], lo, hi])
            held.clear(), common.clear()

        for b, i, shared in merged([[x[:2] for x in block] for block in blocks]):
            if held and shared < length // 2:
                # groups are resolved many at once; lone entries are dropped before
                if starts == len(held) - 1 and not blocks[held[-1][0]][held[-1][1]][3]:
                    held.pop(), common.pop()
                if len(held) >= 4000:
                    close()
                starts = len(held)
                shared = 0
            elif not held:
                shared = starts = 0
            held.append((b, i))
            common.append(shared)
        if held and starts == len(held) - 1 and not blocks[held[-1][0]][held[-1][1]][3]:
            held.pop(), common.pop()
        close()
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table({k: pa.array(v.astype(t)) for k, v, t in zip(("run", "entry", "lo", "hi"), columns, (np.int64, np.int32, np.int32, np.int32), strict=True)})

    return runs.where("part IS NOT NULL").select("part", "run", "first", "block").groupBy("part").applyInArrow(merge, "run long, entry int, lo int, hi int")


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, texts_too: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with texts_too kept (binary).

    Every byte covered by a string of `length` bytes that also starts anywhere else, in
    the same document or another, is removed; strings are judged on the input. A null
    text counts as empty; texts shorter than `length` lose nothing. Rows that repeat a
    doc_id are documents of their own (and so repeat each other); a table with such rows
    or null ids is first written to the shared folder with row numbers. Other columns
    are ignored; an empty table gives no row.
    """
    folder = scratch(spark)
    small_batches(spark)
    kind = dict(docs.dtypes)["doc_id"]
    docs = docs.select("doc_id", "text")
    plain = kind in ("bigint", "int", "smallint", "tinyint") and not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").take(1)
    docs = docs.withColumn("uid", F.col("doc_id").cast("long")) if plain else stored(spark, docs.withColumn("uid", F.monotonically_increasing_id()), folder, "numbered")

    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * n_bytes // (length * GROUP))
    anchored = stored(spark, _anchored(docs, blocks, length), folder, "anchored")
    known = anchored.where("part IS NULL").select("uid", "places", "starts")
    candidates = stored(spark, known.unionByName(_met(anchored)), folder, "candidates")
    cuts = candidates.select(F.explode("starts").alias("s")).agg(F.percentile_approx("s", [i / blocks for i in range(1, blocks)], 10000)).first()[0] or []
    lists = candidates.groupBy("uid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
    runs = stored(spark, _runs(docs.join(lists, "uid"), sorted(set(cuts)), length), folder, "runs")
    found = stored(spark, _found(runs, length), folder, "found")
    members = runs.where("entry IS NOT NULL").select("run", "entry", "uid", "at")
    spans = members.join(found, ["run", "entry"]).select("uid", F.struct((F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + length).alias("end")).alias("s"))
    spans = spans.groupBy("uid").agg(F.sort_array(F.collect_set("s")).alias("spans"))

    def cut(batches):
        import pyarrow as pa

        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if texts_too else 5]
        for batch in batches:
            for part in parts(batch):
                rows = []
                for text, own in zip(column(part, "text"), column(part, "spans"), strict=True):
                    data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                    kept, pieces, upto, removed, runs_ = [], own.as_py() or [], 0, 0, 0
                    i = 0
                    while i < len(pieces):
                        start, end = pieces[i]["start"], pieces[i]["end"]
                        i += 1
                        while i < len(pieces) and pieces[i]["start"] <= end:
                            end = max(end, pieces[i]["end"])
                            i += 1
                        kept.append(data[upto:start])
                        removed, runs_, upto = removed + end - start, runs_ + 1, end
                    kept = b"".join([*kept, data[upto:]])
                    rows.append((len(data), removed, runs_, hashlib.sha256(kept).hexdigest(), *([kept] if texts_too else [])))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.record_batch([column(part, "doc_id"), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds))], names)  # noqa: B905
        trimmed()

    joined = docs.join(stored(spark, spans, folder, "spans"), "uid", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts_too)
