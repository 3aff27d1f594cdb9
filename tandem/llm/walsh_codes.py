"""Product codes of integer vectors, assigned in the Walsh-Hadamard domain.

A vector of whole numbers (floor(256 * component)) is cut into ``PARTS`` equal consecutive parts; each part position
has a codebook of ``ENTRIES`` entries. Parts and entries are padded with zeros to a power of two D and sent through an
integer Walsh-Hadamard transform, which keeps distances up to the factor D. Its coefficients, fewest sign changes first
(sequency order), hold most of the difference in front, so the sum of squared differences grows early: an entry is given
up as soon as its sum passes the full distance of the entry that leads so far. All sums are whole numbers; the winner's sum divided by
D is its squared distance exactly, and ties go to the lower index.

Fit: the books start as the parts of the smallest ids; each round is one pass over all vectors whose tasks return
counts and sums an entry (their size depends on the books alone), added up by Spark. Books are collected (16 x 64
entries) and sent with the next pass.

Cases. A null vector, or one with a null or non-finite component, is dropped. A shorter vector counts as padded with
zeros to the longest one, and the longest is padded to a multiple of ``PARTS``. Repeated rows are coded each. A null id
is coded too and is the last to seed a book; rows of one id seed in the order of their components. Fewer vectors than
``ENTRIES`` give shorter books, none give no rows. Components too large for 64-bit sums are computed with Python's
integers; an error beyond a long is given as the largest long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import prepare, written
from tandem.llm.int_vectors import MOST, extent, matrix, quantised

PARTS = 16
ENTRIES = 64
ROUNDS = 2
CELLS = 1 << 19  # numbers a block of rows may hold
HOT = 1000  # a label with more than one in HOT of the rows is hot


def sequency(size: int) -> np.ndarray:
    """Positions of the natural-order transform sorted by their number of sign changes; ``size`` is a power of two."""
    bits = size.bit_length() - 1
    changes = []
    for i in range(size):
        back = int(format(i, f"0{bits}b")[::-1], 2) if bits else 0
        n = 0
        while back:  # from Gray code to the plain number
            n, back = n ^ back, back >> 1
        changes.append(n)
    return np.argsort(changes, kind="stable")


def walsh(x: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform along the last axis, zero-padded to a power of two, in sequency order."""
    size = 1 << max(0, x.shape[-1] - 1).bit_length()
    out = np.zeros((*x.shape[:-1], size), x.dtype)
    out[..., :x.shape[-1]] = x
    half = 1
    while half < size:
        pairs = out.reshape(*x.shape[:-1], size // (2 * half), 2, half)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2)
        out = out.reshape(*x.shape[:-1], size)
        half *= 2
    return out[..., sequency(size)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every transformed row of ``x``: the index of the nearest row of ``book`` (ties: the lower), its scaled
    squared distance, and how many squared differences were added up for all of them."""
    n, size = x.shape
    sums = (x[:, :1] - book[None, :, 0]) ** 2
    guess = sums.argmin(axis=1)
    bar = ((x - book[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bar[:, None])
    sums, work = sums[row, entry], n * (len(book) + size)
    for k in range(1, size):
        sums = sums + (x[row, k] - book[entry, k]) ** 2
        work += len(row)
        if k & (k + 1) == 0 and k + 1 < size:  # after 2, 4, 8 ... coefficients the leader's full distance is a better bar
            start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            lead = np.minimum.reduceat(sums, start)[row] == sums
            _, at = np.unique(row[lead.astype(bool)], return_index=True)
            bar = np.minimum(bar, ((x - book[entry[lead.astype(bool)][at]]) ** 2).sum(axis=1))
            work += n * size
        live = (sums <= bar[row]).astype(bool)
        row, entry, sums = row[live], entry[live], sums[live]
    # what is left are full sums: the least of each row, then the lowest entry
    low = bar.copy()
    np.minimum.at(low, row, sums)
    best = (sums == low[row]).astype(bool)
    row, entry = row[best], entry[best]
    _, first = np.unique(row, return_index=True)
    return entry[first], low, work


class Books:
    """The codebooks, and how vectors of ``dim`` components are cut to them."""

    def __init__(self, entries: np.ndarray, dim: int, exact: bool):
        self.entries, self.dim, self.exact = entries, dim, exact  # entries: (parts, entry, width)
        self.waves = walsh(entries)

    def cut(self, column: pa.Array) -> np.ndarray:
        parts, _, width = self.entries.shape
        x = matrix(column, self.dim)
        x = np.concatenate([x, np.zeros((len(x), parts * width - self.dim), np.int64)], axis=1)
        return (x.astype(object) if self.exact else x).reshape(len(x), parts, width)

    def assign(self, column: pa.Array):
        """Blocks of (first row, parts as cut, entry indexes, squared distances)."""
        parts, entries, width = self.entries.shape
        step = max(1, CELLS // (parts * max(entries, self.waves.shape[2])))
        for at in range(0, len(column), step):
            x = self.cut(column.slice(at, step))
            w = walsh(x)
            codes = np.empty((len(x), parts), np.int64)
            dist = np.empty((len(x), parts), object if self.exact else np.int64)
            for p in range(parts):
                codes[:, p], far, _ = nearest(w[:, p], self.waves[p])
                dist[:, p] = far // self.waves.shape[2]
            yield at, x, codes, dist

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()


def first_books(ints: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Books:
    dim, size = extent(ints)
    width = max(1, -(-dim // parts))
    seeds = ints.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    rows = np.array([[*r["q"], *[0] * (parts * width - len(r["q"]))] for r in seeds], object)
    wave = 1 << max(0, width - 1).bit_length()
    # sums of scaled squares, over all parts, must fit 64 bits; else whole numbers of any size
    exact = 4 * wave * parts * wave * size * size >= 1 << 62
    book = rows.reshape(len(seeds), parts, width).transpose(1, 0, 2)
    return Books(np.ascontiguousarray(book if exact else book.astype(np.int64)), dim, exact)


def _sums(books: Books):
    def run(batches):
        parts, entries, width = books.entries.shape
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), object if books.exact else np.int64)
        for batch in batches:
            for _, x, codes, _ in books.assign(batch.column("q")):
                for p in range(parts):
                    n[p] += np.bincount(codes[:, p], minlength=entries)
                    np.add.at(total[p], codes[:, p], x[:, p])
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]),
                 pa.array([[str(s) for s in t] for t in total[part, entry]], pa.list_(pa.string()))],
                names=["part", "entry", "n", "s"])
    return run


def trained(ints: DataFrame, books: Books, rounds: int = ROUNDS) -> Books:
    """The books after ``rounds`` passes: every entry becomes the floor of its parts' mean, unused ones stay."""
    for _ in range(rounds):
        width = books.entries.shape[2]
        sums = [F.sum(F.col("s")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
        rows = (ints.select("q").mapInArrow(_sums(books), "part int, entry int, n long, s array<string>")
                .groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect())  # parts x entries at most
        entries = books.entries.copy()
        for r in rows:
            entries[r["part"], r["entry"]] = [int(r[f"s{k}"]) // r["n"] for k in range(width)]
        books = Books(entries, books.dim, books.exact)
    return books


def encode(ints: DataFrame, books: Books, carry: tuple = ("label",)) -> DataFrame:
    """vec_id, the columns of ``carry``, code (two hex digits a part) and error (squared distances, summed)."""
    def run(batches):
        for batch in batches:
            code, error = [], []
            for _, _, codes, dist in books.assign(batch.column("q")):
                code += [bytes(c.astype(np.uint8)).hex() for c in codes]
                error += [min(int(e), MOST) for e in dist.sum(axis=1)]
            kept = [batch.column(c) for c in ("vec_id", *carry)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(code, pa.string()), pa.array(error, pa.int64())],
                                             names=["vec_id", *carry, "code", "error"])
    kind = ints.select("vec_id", *carry).schema.add("code", "string").add("error", "long")
    return ints.select("vec_id", "q", *carry).mapInArrow(run, kind)


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with label_error, the error summed over equal labels (nulls together).

    Sums are partial aggregates. The few labels that hold more than one row in ``HOT`` (at most ``HOT`` of them) come
    back by broadcast, the others by a join on the label: no task gets a hot one.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST)).cast("long")
    sums = written(coded.groupBy(F.col(label).alias("of")).agg(total.alias("label_error"), F.count("*").alias("n")),
                   "label-errors")
    most = (sums.agg(F.sum("n")).first()[0] or 0) // HOT
    hot = sums.where(F.col("n") > most).select("of", "label_error")
    rest = sums.where(F.col("n") <= most).select("of", "label_error")
    same = F.col(label).eqNullSafe(F.col("of"))
    is_hot = coded.join(F.broadcast(hot), same).drop("of")
    others = coded.join(F.broadcast(hot.select("of")), same, "left_anti")  # no hot label reaches the shuffle
    return is_hot.unionByName(others.join(rest, same).drop("of"))


CODES = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def op11_walsh_hadamard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ints = written(quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), carry=("label",)), "codes-input")
    books = trained(ints, first_books(ints))
    if not books.entries.size:
        return spark.createDataFrame([], CODES)
    coded = with_label_error(written(encode(ints, books), "codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _round(k: int) -> str:
    """Books k + 1 from books k, in DuckDB."""
    return f"""a{k} AS (
  SELECT p.vec_id, p.p, any_value(p.x) AS x, min({DISTANCE} * 64 + b.e) % 64 AS e
  FROM parts p JOIN b{k} b ON p.p = b.p GROUP BY p.vec_id, p.p),
s{k} AS (
  SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM a{k}, range(1, 1 + (SELECT any_value(w) FROM width)) t(i)
  GROUP BY p, e, i),
m{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{k} GROUP BY p, e),
b{k + 1} AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e)"""


DISTANCE = "CAST(list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i]))) AS BIGINT)"
SQL = f"""WITH ints AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
width AS (SELECT max(len(q)) // 16 AS w FROM ints),
parts AS (
  SELECT vec_id, label, p, list_slice(q, p * w + 1, p * w + w) AS x FROM ints, width, range(16) t(p)),
b0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts
  WHERE vec_id IN (SELECT vec_id FROM ints ORDER BY vec_id LIMIT 64)),
{_round(0)},
{_round(1)},
last AS (
  SELECT p.vec_id, p.p, any_value(p.label) AS label, min({DISTANCE} * 64 + b.e) AS m
  FROM parts p JOIN b2 b ON p.p = b.p GROUP BY p.vec_id, p.p),
rows AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', m % 64), '' ORDER BY p) AS code,
         CAST(sum(m // 64) AS BIGINT) AS error
  FROM last GROUP BY vec_id),
book AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) AS h
         FROM (SELECT p, e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS v FROM b2))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT h FROM book) AS codebooks_sha256
FROM rows"""
