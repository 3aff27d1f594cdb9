"""Item-item co-occurrence and co-visitation (M6-M8).

The user x item count matrix is the long table ``(uid, item_id, n)``; the
Gram matrix ``G = X^T X`` is

    G[i, j] = sum_u n_ui * n_uj

Its pairs are quadratic in a user's items, so they are not shuffled as rows.
A user's items are packed once (``_packed``: offsets from the smallest id in as
few bytes as they need) and every item of the user is sent that list, or what
follows it in the list where only the upper triangle is wanted ("stripes"). Rows are
dealt by item, a task adds up the pairs of its items and has them whole, so a top-k
needs no further exchange. Memory follows the pairs a task holds at a time (``PAIRS``) and
the distinct pairs of one item. Scores of users (M8) travel the same way: each
recent like brings the packed list of its item's neighbours to the user.

Skew: lists of hot users are cut into up to ``max_salt`` chunks and
the pairs of chunks are dealt anew before they are spread over items, so a user
holding a third of the data is processed by many tasks, not one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.operators.interactions import pair_counts
from tandem.operators.topk import recent_per_user, top_n_per_group, top_score_per_user
from tandem.session import ship_package
from tandem.sources.io import materialise

PAIRS = 1 << 22  # pairs a task adds up at a time
AT_ONCE = 1 << 20  # pairs unpacked at a time
PASS_PAIRS = 1 << 31  # pairs of a share of the users: their lists take a few GB of shuffle files
OUT_ROWS = 1 << 17  # rows of an Arrow batch that leaves a task
LISTS = ("key long, chunk int, chunks int, size long, ids array<long>, ns array<long>, "
         "base long, width int, packed binary, nwidth int, npacked binary")


def _bytes_of(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _width(most: int) -> int:
    return max(1, (most.bit_length() + 7) // 8)


def _packed(heavy_items: float, max_salt: int):
    """Rows (key, entries: list of (id, n)) -> the sorted lists in chunks, as ``LISTS``."""
    fields = pa.schema([("key", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("size", pa.int64()),
                        ("ids", pa.list_(pa.int64())), ("ns", pa.list_(pa.int64())), ("base", pa.int64()),
                        ("width", pa.int32()), ("packed", pa.binary()), ("nwidth", pa.int32()), ("npacked", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            lists = batch.column("entries")
            flat = lists.flatten()
            every_id = flat.field("id").to_numpy(zero_copy_only=False)
            every_n = flat.field("n").to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            start = 0
            for key, end in zip(batch.column("key").to_pylist(), ends.tolist(), strict=True):
                order = start + np.argsort(every_id[start:end], kind="stable")
                ids, ns, size = every_id[order], every_n[order], end - start
                start = end
                chunks = min(max_salt, math.ceil(size / heavy_items)) if size > heavy_items else 1
                for c in range(chunks):
                    at = slice(size * c // chunks, size * (c + 1) // chunks)
                    i, n = ids[at], ns[at]
                    offsets = i.view(np.uint64) - i[:1].view(np.uint64)  # wraps around as the reader's sum does
                    width, nwidth = _width(int(offsets[-1])), _width(int(n.max())) if n.max() > 1 or n.min() < 1 else 0
                    out.append({"key": key, "chunk": c, "chunks": chunks, "size": size, "ids": i, "ns": n if nwidth else None,
                                "base": int(i[0]), "width": width, "packed": _bytes_of(offsets, width),
                                "nwidth": nwidth, "npacked": _bytes_of(n, nwidth) if nwidth else None})
                    held += len(i)
                if held > OUT_ROWS:
                    yield pa.RecordBatch.from_pylist(out, schema=fields)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=fields)
    return run


def _numbers(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed lists, and how many each list has."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return wide.reshape(-1).view("<u8").view(np.int64), np.diff(ends) // width


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, w) of a batch of stripes (i, n, base, width, packed, nwidth, npacked), some rows at a time."""
    widths, nwidths = (batch.column(c).to_numpy() for c in ("width", "nwidth"))
    for kind in np.unique(widths * 16 + nwidths):
        width, nwidth = int(kind) // 16, int(kind) % 16
        of_kind = batch.filter(pa.array((widths == width) & (nwidths == nwidth)))
        ends = np.cumsum(pc.binary_length(of_kind.column("packed")).to_numpy()) // width
        lo = 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + AT_ONCE, side="right")))
            rows, lo = of_kind.slice(lo, hi - lo), hi
            j, held = _numbers(rows.column("packed"), width)
            j = j + np.repeat(rows.column("base").to_numpy(), held)
            w = np.repeat(rows.column("n").to_numpy(), held)
            if nwidth:
                w = w * _numbers(rows.column("npacked"), nwidth)[0]
            yield np.repeat(rows.column("i").to_numpy(), held), j, w


def _added(i: np.ndarray, j: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (i, j) in order with the sums of w."""
    if not len(i):
        return i, j, w
    low_i, low_j = int(i.min()), int(j.min())
    span = int(j.max()) - low_j + 1
    if (int(i.max()) - low_i + 1) * span < 1 << 62:
        key = (i - low_i) * span + (j - low_j)
        if (w == 1).all():
            key.sort()
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            key, total = key[first], np.diff(np.append(first, len(w)))
        else:
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            key, total = key[first], np.add.reduceat(w[order], first)
        a, b = np.divmod(key, span)
        return a + low_i, b + low_j, total
    order = np.lexsort((j, i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
    return i[first], j[first], np.add.reduceat(w[order], first)


def _largest(i: np.ndarray, j: np.ndarray, w: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` largest w of each i (ties: smaller j) of pairs in order."""
    order = np.lexsort((-w, i))  # keeps the order of j
    i = i[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i, side="left") < most
    return i[keep], j[order][keep], w[order][keep]


def _summed(keep: str, most: int | None, names: list[str], pairs: int):
    """Stripes of a task -> (i, j, w) with w added up; ``keep``: j ``above`` i, ``other`` than i, or ``all``."""
    fields = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size, room = 0, pairs
        for batch in batches:
            for i, j, w in _unpacked(batch):
                if keep != "all":
                    ok = j > i if keep == "above" else j != i
                    i, j, w = i[ok], j[ok], w[ok]
                held.append((i, j, w))
                size += len(i)
                if size > room:
                    held = [_added(*map(np.concatenate, zip(*held, strict=True)))]
                    size = len(held[0][0])
                    room = size + max(size, pairs)
        if not held:
            return
        i, j, w = _added(*map(np.concatenate, zip(*held, strict=True)))
        held.clear()
        if most is not None:
            i, j, w = _largest(i, j, w, most)
        for lo in range(0, len(i), OUT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + OUT_ROWS]) for x in (i, j, w)], schema=fields)
    return run


def _lists(rows: DataFrame, key: str, item: str, n: str, heavy_items: float = math.inf, max_salt: int = 1) -> DataFrame:
    """Rows (key, item, n) as packed lists, written once. Rows without a key or an item take no part."""
    ship_package(rows.sparkSession)
    entry = F.struct(F.col(item).cast("long").alias("id"), F.col(n).cast("long").alias("n"))
    lists = (rows.where(F.col(key).isNotNull() & F.col(item).isNotNull()).groupBy(F.col(key).cast("long").alias("key"))
             .agg(F.collect_list(entry).alias("entries")))
    return materialise(lists.mapInArrow(_packed(heavy_items, max_salt), LISTS))


STRIPE = ["i", "n", "base", "width", "packed", "nwidth", "npacked"]


def _pairs(counts: DataFrame, upper: bool, most: int | None, heavy_items: int, max_salt: int, pairs: int = PAIRS) -> DataFrame:
    """(item_i, item_j, w) from a ``(uid, item_id, n)`` table, ``item_i < item_j`` or both ways."""
    lists = _lists(counts, "uid", "item_id", "n", heavy_items if max_salt > 1 else math.inf, max_salt)
    # a list has one chunk or, with a hot user, meets the others of the user
    total = lists.where("chunk = 0").agg(F.sum((F.col("size") * F.col("size")).cast("double"))).first()[0] or 0.0
    tasks = max(1, math.ceil(total / (2 if upper else 1) / pairs))
    right = ["base", "width", "packed", "nwidth", "npacked"]
    light = lists.where("chunks = 1").select("ids", "ns", *right, F.lit(True).alias("own"))
    hot = lists.where("chunks > 1")
    a = hot.select("key", F.col("chunk").alias("a"), "ids", "ns")
    b = hot.select("key", F.col("chunk").alias("b"), *right)
    met = a.join(b, "key").where("a <= b") if upper else a.join(b, "key")
    met = met.repartition("key", "a", "b").select("ids", "ns", *right, (F.col("a") == F.col("b")).alias("own"))
    rows = light.unionByName(met).select("ns", *right, "own", F.posexplode("ids").alias("pos", "i"))
    n = F.coalesce(F.get("ns", "pos"), F.lit(1).cast("long")).alias("n")
    if upper:  # what follows in the own list; a later chunk has only larger items
        skip = F.when(F.col("own"), F.col("pos") + 1).otherwise(0)
        rows = rows.select("i", n, "base", "width", F.substring("packed", skip * F.col("width") + 1, F.octet_length("packed"))
                           .alias("packed"), "nwidth", F.substring("npacked", skip * F.col("nwidth") + 1, F.octet_length("npacked"))
                           .alias("npacked"))
        rows = rows.where(F.octet_length("packed") > 0)
    else:
        rows = rows.select("i", n, *right)
    return rows.repartition(tasks, "i").mapInArrow(_summed("above" if upper else "other", most, ["item_i", "item_j", "w"], pairs),
                                                   "item_i long, item_j long, w long")


def upper_pairs(counts: DataFrame, heavy_items: int = 2000, max_salt: int = 64) -> DataFrame:
    """(item_i < item_j, w) from a ``(uid, item_id, n)`` table.

    ``heavy_items``/``max_salt`` control the hot-user split: a user with more than ``heavy_items`` items is cut into at
    most ``max_salt`` chunks; ``max_salt=1`` turns it off."""
    return _pairs(counts, True, None, heavy_items, max_salt)


def mirror(pairs: DataFrame) -> DataFrame:
    """(i, j, w) -> (i, j, w) and (j, i, w) in one pass (no self-union, so
    the pair aggregation is computed once)."""
    both = F.array(F.struct(F.col("item_i").alias("a"), F.col("item_j").alias("b")),
                   F.struct(F.col("item_j").alias("a"), F.col("item_i").alias("b")))
    return (pairs.select(F.explode(both).alias("_p"), "w")
            .select(F.col("_p.a").alias("item_i"), F.col("_p.b").alias("item_j"), "w"))


def cooccurrence(likes: DataFrame, counts: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """M6: symmetric co-occurrence ``(item_i, item_j, w)``, diagonal excluded.

    ``most``: what follows asks only for the ``most`` largest ``w`` per ``item_i`` (``sparsify``); others do not leave
    the task that has all pairs of the item."""
    # dealt by user, the likes are counted and listed without a second exchange
    counts = counts if counts is not None else pair_counts(likes.select("uid", "item_id").repartition("uid"))
    return mirror(upper_pairs(counts)) if most is None else _pairs(counts, False, most, 2000, 64)


def sparsify(pairs: DataFrame, top_k: int) -> DataFrame:
    """M7: keep the ``top_k`` largest ``w`` per ``item_i`` (ties: smaller item_j)."""
    return top_n_per_group(pairs, "item_i", [F.desc("w"), F.asc("item_j")], top_k)


def neighbour_lists(similarity: DataFrame) -> DataFrame:
    """S packed, one list an item; written, as scoring reads it more than once."""
    return materialise(_lists(similarity, "item_i", "item_j", "w"))


def in_passes(users: DataFrame, passes: int, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``build`` for a share of the rows of ``users`` (by ``uid``) after the other. With more than one, each share's result is written
    and its shuffle files are gone before the next one begins, so disk holds those of one share."""
    if passes <= 1:
        return build(users)
    share = F.pmod(F.xxhash64(F.lit("pass"), F.col("uid")), F.lit(passes))
    parts = [materialise(build(users.where(share == p))) for p in range(passes)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def covisitation_scores(history: DataFrame, similarity: DataFrame, users: DataFrame | None,
                        history_depth: int, num_candidates: int, near: DataFrame | None = None,
                        pass_pairs: int = PASS_PAIRS) -> DataFrame:
    """M8: score(u, j) = sum over the user's ``history_depth`` newest likes
    (repeats count) of ``S[item, j]``; top ``num_candidates`` per user.

    S has at most ``top_k`` rows per item, packed as one list (``near``, if they are at hand). Each recent like
    takes the list of its item to the user's task, which adds up and ranks: the
    (uid, item) rows before the sum never are rows of a shuffle. Rows without a
    uid take no part. Users come in shares of about ``pass_pairs`` pairs.
    """
    h = history if users is None else history.join(users, "uid", "left_semi")
    recent = materialise(recent_per_user(h, history_depth).select(F.col("uid").cast("long").alias("uid"), "item_id")
                         .where("uid is not null"))
    near = neighbour_lists(similarity) if near is None else near
    longest = near.agg(F.max("size")).first()[0] or 0
    total = recent.count() * longest
    passes = max(1, math.ceil(total / pass_pairs))
    tasks = max(1, math.ceil(total / passes / PAIRS))

    def scored(some: DataFrame) -> DataFrame:
        rows = (some.select("uid", F.col("item_id").cast("long").alias("key")).join(near, "key")
                .select(F.col("uid").alias("i"), F.lit(1).cast("long").alias("n"), "base", "width", "packed", "nwidth", "npacked"))
        rows = (rows.repartition(tasks, "i")
                .mapInArrow(_summed("all", num_candidates, ["uid", "item_id", "w"], PAIRS), "uid long, item_id long, w long")
                .select("uid", "item_id", F.col("w").cast("double").alias("score")))
        return top_score_per_user(rows, num_candidates)

    return in_passes(recent, passes, scored)
