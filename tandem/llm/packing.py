"""Mixture-controlled packing of documents into token sequences.

Deficit round-robin over source queues: every window of ``window`` sequences credits each queue with its share of
the window, a queue is served as many whole ids as its credit holds, and what is left over (its deficit, always under
one id) is carried to the next window. Carried over windows, credits are a running total, so the ids that queue ``q``
has been served up to any window have a closed form (``Schedule.served``). Every partition therefore takes up the
deficits exactly where the windows before it left them, without a pass over them, and every document finds its
places alone.

An empty queue's share goes to the queues that still have ids, in proportion. The last, partial sequence is cut into
sequences of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import NO_ID, null_ids, prepare, slices, small, written
from tandem.llm.tokens import encoder, file

LENGTH = 1024
WINDOW = 64
UNIT = 1 << 16  # shares are whole multiples of 1 / UNIT
OWN_QUEUE = 0.001  # a source with less of all ids shares the queue REST, so at most 1001 queues exist
REST = ""

IDS = "part int, queue string, before long, doc_id long, n long, ids binary, bits int"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "queue string")


class Schedule:
    """How many ids each queue has been served after any number of served ids."""

    def __init__(self, totals: list[int], shares: list[float]):
        """totals: ids in each queue. shares: target proportions; a queue with ids and no share gets the least one."""
        self.totals = np.array(totals, np.int64)
        shares_ = np.maximum(np.array(shares, np.float64), 0)
        if len(shares_) and not shares_.sum():
            shares_ = shares_ + 1
        scaled = shares_ / shares_.sum() * UNIT if len(shares_) else shares_
        self.weight = np.maximum(np.rint(scaled).astype(np.int64), 1)
        self.unit = int(self.weight.sum())
        # the credit clock at which a queue runs empty
        self.empty = -(-self.totals * self.unit // self.weight)
        self.n = int(self.totals.sum())

    def _at(self, clock: np.ndarray) -> np.ndarray:
        t = np.minimum(clock[:, None], self.empty[None, :])
        return np.minimum(self.weight[None, :] * t // self.unit, self.totals[None, :])

    def served(self, given: np.ndarray) -> np.ndarray:
        """Ids served of each queue (columns) once ``given`` (rows) ids have been served in all."""
        given = np.minimum(np.asarray(given, np.int64), self.n)
        low, high = np.zeros_like(given), np.full_like(given, int(self.empty.max(initial=0)))
        while (low < high).any():  # the last clock tick that serves no more than given
            mid = (low + high + 1) // 2
            fits = self._at(mid).sum(axis=1) <= given
            low, high = np.where(fits, mid, low), np.where(fits, high, mid - 1)
        now, after = self._at(low), self._at(low + 1)
        left = given - now.sum(axis=1)  # within a tick, queues are visited in order, one id each
        gains = after - now
        turn = np.cumsum(gains, axis=1)
        return now + np.where(turn <= left[:, None], gains, np.maximum(0, gains - (turn - left[:, None])))


def tail_lengths(rest: int) -> list[int]:
    """The last ids as power-of-two sequences, longest first.

    >>> tail_lengths(13)
    [8, 4, 1]
    """
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _queue_ids(path: str, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        seen: dict[str, int] = {}
        for pdf in slices(batches, "text", 4 << 20):
            ids = [x + end for x in enc.encode(pdf["text"].tolist())]
            n = [len(x) // enc.dtype.itemsize for x in ids]
            before = []
            for s, k in zip(pdf["queue"], n, strict=True):
                before.append(seen.get(s, 0))
                seen[s] = before[-1] + k
            yield pd.DataFrame({"part": part, "queue": pdf["queue"], "before": before, "doc_id": pdf["doc_id"],
                                "n": n, "ids": ids, "bits": enc.dtype.itemsize * 8})
    return run


def _pieces(queues: list[str], schedule: Schedule, length: int, window: int, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {q: k for k, q in enumerate(queues)}
        size = length * window
        full = schedule.n // length
        tail = tail_lengths(schedule.n - full * length)
        # ends of the sequences that follow the full ones
        tail_ends = full * length + np.cumsum([0, *tail])
        for pdf in slices(batches, "ids"):
            q = pdf["queue"].map(place).to_numpy()
            x = (pdf["base"] + pdf["before"]).to_numpy(np.int64)
            n = pdf["n"].to_numpy(np.int64)
            found = []
            for k in np.unique(q):
                rows = np.flatnonzero(q == k)
                for r in rows:
                    found.append((r, k, int(x[r]), int(x[r] + n[r])))
            first, last = _windows(schedule, found, size)
            wins = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)]))
            edges = np.unique(np.concatenate([wins, wins + 1]))
            served = schedule.served(edges * size)
            row_of = {int(w): i for i, w in enumerate(edges)}
            out = []
            for (r, k, begin, end), a, b in zip(found, first, last, strict=True):
                ids = np.frombuffer(pdf["ids"].iloc[r], f"<u{pdf['bits'].iloc[r] // 8}").astype("<u4")
                for w in range(int(a), int(b) + 1):
                    lo, hi = served[row_of[w]], served[row_of[w + 1]]
                    c, d = max(begin, int(lo[k])), min(end, int(hi[k]))
                    if c >= d:
                        continue
                    at = w * size + int((hi[:k] - lo[:k]).sum()) + c - int(lo[k])
                    while c < d:
                        if at < full * length:
                            seq, off = divmod(at, length)
                            room = length - off
                        else:
                            j = int(np.searchsorted(tail_ends, at, side="right")) - 1
                            seq, off, room = full + j, at - int(tail_ends[j]), int(tail_ends[j + 1]) - at
                        m = min(room, d - c)
                        own = ids[c - begin:c - begin + m].tobytes()
                        out.append((pdf["doc_id"].iloc[r], c - begin, m, zlib.crc32(own), end - begin, seq, off,
                                    queues[k], own)[:9 if with_ids else 8])
                        c, at = c + m, at + m
            yield pd.DataFrame(out, columns=[f.split()[0] for f in PIECES.split(", ")] + ["ids"] * with_ids)
    return run


def _windows(schedule: Schedule, found: list[tuple], size: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each (row, queue, begin, end), by bisection on the served ids."""
    most = -(-schedule.n // size)
    k = np.array([f[1] for f in found], np.int64)

    def holding(pos: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(pos), np.int64), np.full(len(pos), most - 1, np.int64)
        while (low < high).any():  # the first window after which more than pos ids of the queue are served
            mid = (low + high) // 2
            steps, back = np.unique(mid, return_inverse=True)
            more = schedule.served((steps + 1) * size)[back, k] > pos
            low, high = np.where(more, low, mid + 1), np.where(more, mid, high)
        return low
    return (holding(np.array([f[2] for f in found], np.int64)),
            holding(np.array([f[3] - 1 for f in found], np.int64)))


def pack(docs: DataFrame, tokenizer: str, end_id: int, targets: dict[str, float] | None = None,
         length: int = LENGTH, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document in a sequence.

    targets: token share of each named source; other sources queue together as ``REST`` with the share left over.
    Without targets every source with ``OWN_QUEUE`` of all ids or more has its own queue and its own share of the
    corpus, so each window is a sample of the whole mixture. Null sources count as the source "", null texts are
    empty (one end id), null ids stay, equal rows are packed as often as they occur, an empty table gives no piece.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), source.alias("source"))
    if targets is None:
        # shares of text, to choose the queues before anything is tokenised
        share = rows.groupBy("source").agg(F.sum(F.length("text") + 1).alias("n"))
        whole = share.agg(F.sum("n")).first()[0] or 0
        named = [r["source"] for r in share.where(F.col("n") >= OWN_QUEUE * whole).select("source").collect()]
    else:
        named = list(targets)
    queue = F.when(F.col("source").isin(named), F.col("source")).otherwise(F.lit(REST)) if named else F.lit(REST)
    ids = written(rows.select("doc_id", "text", queue.alias("queue"))
                  .mapInPandas(_queue_ids(tokenizer, end_id), IDS), "queue-ids")

    # one row a partition and queue: its ids, and those of the partitions before it in the same queue
    sums = ids.groupBy("part", "queue").agg(F.sum("n").alias("n"))
    totals = {r["queue"]: r["n"] for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    queues = sorted(totals)
    if targets is None:
        shares = [totals[q] for q in queues]
    else:
        rest = max(0.0, 1 - sum(targets.values()))
        shares = [targets.get(q, rest) for q in queues]
    schedule = Schedule([totals[q] for q in queues], shares)
    from pyspark.sql import Window
    base = F.coalesce(F.sum("n").over(Window.partitionBy("queue").orderBy("part")
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sums.select("part", "queue", base.alias("base"))
    schema = PIECES + (", ids binary" if with_ids else "")
    return null_ids(ids.join(small(bases, 3), ["part", "queue"])
                    .mapInPandas(_pieces(queues, schedule, length, window, with_ids), schema))


def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 byte_bpe_50k ids, end id 0, at the corpus' own mixture."""
    from tandem.llm.common import documents

    return pack(documents(spark, sf_dir), file("byte_bpe_50k.json"), end_id=0)
