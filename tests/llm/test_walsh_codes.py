"""Walsh-Hadamard codes against plain distances."""

import hashlib
import math

import numpy as np
import pytest

from tandem.llm import walsh_codes as wc
from tandem.llm.common import written
from tandem.llm.int_vectors import quantised

SCHEMA = "vec_id long, embedding array<double>, label string, code string, q int"


def plain(rows, parts=16, entries=64, rounds=2):
    """The contract with Python's integers: {(vec_id, code, error, label_error)}, digest of the books."""
    kept = [(i, [min(max(math.floor(256 * x) if abs(x) < 2**60 else int(x) * 256, 1 - 2**63), 2**63 - 1) for x in v], lab)
            for i, v, lab, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max(len(v) for _, v, _ in kept)
    width = max(1, -(-dim // parts))
    cut = [(i, [tuple((v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width]) for p in range(parts)], lab)
           for i, v, lab in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    seeds = [cut[i] for i in order[:entries]]
    books = [[r[1][p] for r in seeds] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, x, _ in cut:
                held.setdefault(best(x[p], books[p])[1], []).append(x[p])
            books[p] = [tuple(sum(c) // len(held[e]) for c in zip(*held[e], strict=True)) if e in held else old
                        for e, old in enumerate(books[p])]
    out = []
    for i, x, lab in cut:
        got = [best(x[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in got), sum(d for d, _ in got), lab))
    total = {}
    for _, _, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    most = 2**63 - 1
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    return (sorted(((i, c, min(e, most), min(total[lab], most)) for i, c, e, lab in out), key=str),
            hashlib.sha256(text.encode()).hexdigest())


def coded(spark, rows):
    ints = written(quantised(spark.createDataFrame(rows, SCHEMA), carry=("label",)), "t")
    books = wc.trained(ints, wc.first_books(ints))
    df = wc.with_label_error(written(wc.encode(ints, books), "t"))
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in df.collect()), key=str), books.sha256()


@pytest.mark.parametrize("size", [1, 2, 4, 8, 32])
def test_transform_keeps_distances_in_sequency_order(size):
    eye = wc.walsh(np.eye(size, dtype=np.int64))
    changes = (np.diff(eye.T, axis=1) != 0).sum(axis=1)
    assert changes.tolist() == list(range(size))
    x = np.random.default_rng(1).integers(-900, 900, (2, size))
    assert ((wc.walsh(x[0]) - wc.walsh(x[1])) ** 2).sum() == size * ((x[0] - x[1]) ** 2).sum()
    assert wc.walsh(np.ones((2, 3), np.int64)).shape == (2, 4)


def test_entries_are_given_up_early():
    r = np.random.default_rng(2)
    book = r.integers(-500, 500, (64, 16))
    x = book[r.integers(0, 64, 300)] + r.integers(-60, 60, (300, 16))
    got, far, work = wc.nearest(wc.walsh(x), wc.walsh(book))
    d = ((x[:, None] - book) ** 2).sum(axis=2)
    assert (got == d.argmin(axis=1)).all() and (far == 16 * d.min(axis=1)).all()
    assert work < 300 * 64 * 16 * 2 / 3


@pytest.mark.parametrize("dim", [32, 35])
def test_codes_against_plain(spark, dim):
    r = np.random.default_rng(dim)
    x = r.normal(size=(300, dim)).round(2)
    x[100:200] = x[0]  # a hot vector
    rows = [(int(i) * 3, v.tolist(), None if i % 3 else f"l{i % 2}", "mine", 1) for i, v in enumerate(x)]
    rows += [(7, None, "l0", "x", 1), (8, [float("nan")] * dim, "l0", "x", 1), (10, [None] * dim, "l1", "x", 1),
             (11, [float("-inf")] * dim, "l1", "x", 1), (None, [0.5] * dim, "l1", "x", 1), (3, [0.25] * dim, "l1", "x", 1),
             (5, [1.0, -2.0], "short", "x", 1), (6, [], "empty", "x", 1), rows[0]]
    assert coded(spark, rows) == plain(rows)


def test_large_components_few_vectors_and_none(spark):
    rows = [(1, [1e30, -1e30, 3.5] + [0.0] * 13, "a", "", 0), (2, [1e12, 5e11, 2.0] + [-7e9] * 13, "a", "", 0),
            (3, [0.0] * 16, None, "", 0)] + [(10 + i, [float(i) * 1e11] * 16, None, "", 0) for i in range(70)]
    assert coded(spark, rows) == plain(rows)
    few = [(4, [0.1] * 16, "a", "", 0), (2, [0.2] * 16, "b", "", 0)]
    assert coded(spark, few) == plain(few)
    ints = written(quantised(spark.createDataFrame([], SCHEMA), carry=("label",)), "t")
    assert wc.trained(ints, wc.first_books(ints)).entries.size == 0


def test_hot_and_rare_labels(spark):
    rows = [(i, "c", i, "hot" if i < 2500 else None if i < 2600 else f"r{i // 2}") for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, code string, error long, label string")
    want = {}
    for _, _, e, lab in rows:
        want[lab] = want.get(lab, 0) + e
    got = wc.with_label_error(df).collect()
    assert len(got) == 4000 and all(r["label_error"] == want[r["label"]] for r in got)
