"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tandem.llm import spelling as sp

SCHEMA = "doc_id long, text string, word string, n int, run string"
LOW = str.maketrans(sp.UPPER, sp.LOWER)


def plain_words(docs, least=5, count=3, every=97):
    n = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= count}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(docs, **settings):
    n = plain_words(docs, **settings)
    near = {w: [v for v in n if v != w and is_near(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(((-n[v], v) for v in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def found(spark, docs, **settings):
    df = sp.variants(spark.createDataFrame(docs, SCHEMA), **settings)
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def made_up(seed, n_words, letters, n_docs=60):
    r = np.random.default_rng(seed)
    vocabulary = ["".join(r.choice(list(letters), r.integers(1, 9))) for _ in range(n_words)]
    weight = 1 / np.arange(1, n_words + 1)
    return [(int(i), " ".join(r.choice(vocabulary, 120, p=weight / weight.sum())), "w", 1, "r") for i in range(n_docs)]


@pytest.mark.parametrize("letters", ["ab", "abC", "aéÀb×"])
def test_variants_against_all_pairs(spark, letters):
    docs = made_up(len(letters), 500, letters)
    docs += [(None, "Straße straße STRASSE strasse Strase straße", "w", 1, "r")] * 3  # no id, repeated rows
    docs += [(900, None, "", 0, ""), (901, "", "", 0, ""), (None, None, None, None, None), (902, "a-b 123 ... ок привет", "", 0, "")]
    assert found(spark, docs, every=7) == plain(docs, every=7)
    assert found(spark, docs) == plain(docs)


def test_chains_lead_to_one_root(spark):
    texts = ["alpha " * 3, "alphb " * 6, "alpcb " * 12, "aldcb " * 24, "atdcb " * 60, "etdcb " * 31]
    docs = [(i, t, "", 0, "") for i, t in enumerate(texts)]
    got = {r[0]: r[2] for r in found(spark, docs, every=10**9)}
    assert set(got) == {"alpha", "alphb", "alpcb", "aldcb", "atdcb", "etdcb"}
    assert all(got[w] == "atdcb" for w in ("alpha", "alphb", "alpcb", "aldcb", "atdcb")) and got["etdcb"] == "etdcb"
    assert found(spark, docs, every=10**9) == plain(docs, every=10**9)


def test_very_long_words_and_texts(spark):
    long = "ab" * 4000
    docs = [(1, f"{long} {long[:500]}x{long[501:]} {long}z " * 3, "", 0, ""), (2, "abcde " * 30000, "", 0, "")]
    assert found(spark, docs, every=10**9) == plain(docs, every=10**9)


def test_no_words(spark):
    assert found(spark, []) == [] and found(spark, [(1, "a b c", "", 0, "")]) == []


def test_minimised_composition():
    words = sorted({"abcde", "abxde", "abcdf", "abxdf", "zbcde"})
    acceptor = sp.Acceptor()
    start = acceptor.add(words)
    # "de" and "df" end alike after abc and abx: their states are one
    after = [acceptor.arcs[acceptor.arcs[acceptor.arcs[start]["a"]]["b"]][c] for c in "cx"]
    assert after[0] == after[1]
    pairs = sorted(sp.composed(acceptor, start, start, False))
    assert pairs == sorted((u, v) for u in words for v in words if u < v and is_near(u, v))
    assert len(pairs) == len(set(pairs))
    longer = sorted({"aabcde", "abcdee", "abcdde", "xabcde"})
    other = acceptor.add(longer)
    pairs = sorted(sp.composed(acceptor, start, other, True))
    assert pairs == sorted((u, v) for u in words for v in longer if is_near(u, v)) and len(pairs) == len(set(pairs))
