"""Quality classifier by importance resampling.

Two bags of hashed word 1- and 2-grams are counted: the target (documents labelled good) and the raw corpus (every
document). A document's log importance is the sum over its n-grams of log p_target - log p_raw with add-one smoothing.
Adding a Gumbel draw keyed by (seed, doc_id) and keeping the ``k`` largest samples ``k`` documents without replacement
in proportion to their importance.

``weight`` divides the sum by the square root of the number of n-grams (a document's evidence, not its length, decides)
; nothing is capped. The draw has scale ``temperature``; 0 keeps the plain top k.

The counts are sums of fixed-size vectors (``BUCKETS`` numbers a task); the driver holds two of them. The k-th largest
key is found by narrowing a histogram of 4096 slices, never by a sort on one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import any_id, documents, null_ids, prepare, slices, small, written

BUCKETS = 3 << 16  # two thirds for words, one third for word pairs
KEEP = 0.8
SEED = 17
TEMPERATURE = 0.05
MEMO = 500_000


class Grams:
    """Buckets of the 1- and 2-grams of a text; words are ASCII-lower-cased runs of non-space bytes."""

    def __init__(self, buckets: int):
        self.words, self.memo = np.uint64(buckets // 3 * 2), {}
        self.pairs = np.uint64(buckets) - self.words

    def __call__(self, text: str) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        words = text.encode("utf-8", "replace").lower().split()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + np.uint64(0x7F4A7C159E3779B9))
        pair = (pair ^ (pair >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return np.concatenate([(h >> np.uint64(7)) % self.words,
                               self.words + (pair >> np.uint64(7)) % self.pairs]).astype(np.int64)


def _counts(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, total = Grams(buckets), np.zeros((2, buckets), np.int64)
        for pdf in slices(batches, "text"):
            for text, good in zip(pdf["text"], pdf["good"], strict=True):
                c = np.bincount(grams(text), minlength=buckets)
                total[0] += c
                if good:
                    total[1] += c
        yield pd.DataFrame({"raw": [total[0].tobytes()], "target": [total[1].tobytes()]})
    return run


def _summed(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    raw = target = None
    for pdf in pdfs:
        for a, b in zip(pdf["raw"], pdf["target"], strict=True):
            a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
            raw, target = (a, b) if raw is None else (raw + a, target + b)
    if raw is not None:
        yield pd.DataFrame({"raw": [raw.tobytes()], "target": [target.tobytes()]})


def _scored(delta: np.ndarray, seed: int, temperature: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = Grams(len(delta))
        for pdf in slices(batches, "text"):
            log_weight, weight, key = [], [], []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                g = grams(text)
                log_weight.append(float(delta[g].sum()))
                weight.append(log_weight[-1] / max(1.0, float(len(g))) ** 0.5)
                u = (xxhash.xxh3_64_intdigest(str(doc).encode(), seed=seed) + 0.5) / 2.0**64
                key.append(weight[-1] - temperature * float(np.log(-np.log(min(u, 1 - 2.0**-53)))))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": pdf["text"].str.split().str.len(),
                                "log_weight": log_weight, "weight": weight, "gumbel_key": key})
    return run


def importance(docs: DataFrame, labels: DataFrame, keep: float = KEEP, buckets: int = BUCKETS, seed: int = SEED,
               temperature: float = TEMPERATURE) -> DataFrame:
    """doc_id, n_words, log_weight, weight, gumbel_key and kept for every document.

    Target: all documents labelled quality 1 and not toxic. Documents without an n-gram weigh 0. Null texts are empty.
    Rows with equal ids and texts have equal keys; ties in the key go to the smaller ``doc_id`` (null last) and rows
    equal in both are kept together. Without a usable label all weights are 0 and the draw alone decides. ``keep`` is
    the share of documents sampled, rounded up.
    """
    spark = docs.sparkSession
    prepare(spark)
    good = (labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
            .select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    rows = any_id(docs)
    marked = rows.join(small(good.withColumn("good", F.lit(True)), 1), "doc_id", "left")
    sums = marked.select("text", F.coalesce("good", F.lit(False)).alias("good")).mapInPandas(
        _counts(buckets), "raw binary, target binary")
    # fixed-size partial sums meet in a few tasks, then in one row
    first = sums.repartition(8).mapInPandas(_summed, "raw binary, target binary").collect()
    raw = sum((np.frombuffer(bytes(r["raw"]), np.int64) for r in first), np.zeros(buckets, np.int64))
    target = sum((np.frombuffer(bytes(r["target"]), np.int64) for r in first), np.zeros(buckets, np.int64))
    delta = (np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))
             if target.sum() else np.zeros(buckets))
    scored = written(null_ids(rows.mapInPandas(_scored(delta, seed, temperature), "doc_id long, n_words long, "
                                               "log_weight double, weight double, gumbel_key double")), "importance")
    n = scored.count()
    k = int(np.ceil(n * keep))
    limit, tie = _kth(scored, k)
    if limit is None:
        kept = F.lit(True)
    else:
        kept = (F.col("gumbel_key") > limit) | ((F.col("gumbel_key") == limit)
                                                & (F.coalesce("doc_id", F.lit(2**63 - 1)) <= tie))
    return scored.withColumn("kept", kept)


def _kth(scored: DataFrame, k: int) -> tuple[float | None, int]:
    """The k-th largest key and, among its ties, the doc_id of the k-th row; (None, 0) if all rows are kept."""
    if scored.count() <= k:
        return None, 0
    low, high = scored.agg(F.min("gumbel_key"), F.max("gumbel_key")).first()
    at = scored.select("gumbel_key", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"))
    while low < high:  # each pass keeps the one of 4096 slices in which the k-th key lies
        width = (high - low) / 4096
        if low + width == low:
            break
        slot = F.least(F.floor((F.col("gumbel_key") - low) / width), F.lit(4095))
        n = {r[0]: (r[1], r[2], r[3]) for r in at.where(F.col("gumbel_key").between(low, high)).groupBy(
            slot.alias("s")).agg(F.count("*"), F.min("gumbel_key"), F.max("gumbel_key")).collect()}
        for s in sorted(n, reverse=True):
            if n[s][0] >= k:
                low, high = n[s][1], n[s][2]
                break
            k -= n[s][0]
    ties = at.where(F.col("gumbel_key").between(low, high))
    lo, hi = ties.agg(F.min("id"), F.max("id")).first()
    while lo < hi:
        mid = (lo + hi) // 2
        c = ties.where(F.col("id") <= mid).count()
        lo, hi = (lo, mid) if c >= k else (mid + 1, hi)
    return float(low), int(lo)


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
