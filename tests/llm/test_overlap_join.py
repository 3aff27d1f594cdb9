"""N-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from tandem.llm import overlap_join as oj
from tandem.llm.components import components


def shingles(text, width):
    w = [x for x in (text or "").translate({a: a + 32 for a in range(65, 91)}).replace("\t", " ").split(" ") if x]
    return {tuple(w[i:i + min(width, len(w))]) for i in range(len(w) - min(width, len(w)) + 1)} if w else set()


def brute(rows, width, num, den):
    sets = {d: shingles(t, width) for d, t in rows}
    label = {d: d for d in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return sorted((d, len(sets[d]), root(d)) for d in ids)


def corpus(seed, families=12, copies=14):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows, passage = [], [r.choice(vocab) for _ in range(60)]
    for f in range(families):
        base = [r.choice(vocab) for _ in range(r.choice([4, 9, 20, 60, 90, 200, 500]))]
        if f % 3 == 0:
            base += passage  # shared by documents that do not link
        for _ in range(copies):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 4, 8])):
                k = r.randrange(len(t))
                t[k:k + r.choice([0, 1])] = [r.choice(vocab)] * r.choice([0, 1])
            rows.append(" ".join(t) or "x")
    rows += ["", None, "One two", "one  TWO", "ONE two three", "a b c", "a\tb c", " ", "one", "two"]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width,num,den,block", [(3, 9, 10, 1 << 20), (3, 9, 10, 900), (5, 8, 10, 2000)])
def test_components_match_all_pairs(spark, width, num, den, block):
    rows = corpus(width + block)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, family int, node string")
    got = sorted(tuple(r) for r in oj.near_duplicates(df.repartition(6), width, num, den, block).collect())
    assert got == brute(rows, width, num, den)


def test_t_occurrence_connects_what_links_connect():
    r = np.random.default_rng(4)
    base = np.sort(r.choice(10_000, 80, replace=False)).astype(np.uint64)
    sets = []
    for _ in range(40):
        s = set(base.tolist())
        for _ in range(r.integers(0, 8)):
            s.discard(int(r.choice(base)))
            s.add(int(r.integers(20_000, 30_000)))
        sets.append(np.array(sorted(s), np.uint64))
    pairs = oj.t_occurrence(sets, list(range(40)), list(range(40)), 9, 10)
    label = list(range(40))
    for a, b in pairs:
        label = [label[a] if x == label[b] else x for x in label]
    want = list(range(40))
    for a in range(40):
        for b in range(a):
            i = len(np.intersect1d(sets[a], sets[b]))
            if 10 * i >= 9 * (len(sets[a]) + len(sets[b]) - i):
                want = [want[a] if x == want[b] else x for x in want]
    assert len(set(zip(label, want, strict=True))) == len(set(label)) == len(set(want))
    assert len(pairs) == 40 - len(set(label))


def test_linked_sets_share_a_key():
    r = np.random.default_rng(5)
    for num, den in ((9, 10), (8, 10)):
        for n in [1, 2, 3, 5, 10, 15, 30, 60, 64, 65, 70, 100, 300, 1000] * 4:
            a = r.integers(0, 1 << 62, n).astype(np.uint64)
            cut = int(r.integers(0, n + 1))
            for b in (a[cut:], np.concatenate([a[cut:], r.integers(0, 1 << 62, cut // 2).astype(np.uint64)])):
                i = len(np.intersect1d(a, b))
                if i and den * i >= num * len(np.union1d(a, b)):
                    assert np.isin(oj.part_hashes(a, num, den), oj.part_hashes(b, num, den)).any()


def test_texts_that_share_a_passage_are_no_family(spark, monkeypatch):
    r = random.Random(11)
    passage = [f"w{r.randrange(400)}" for _ in range(60)]
    rows = [(k, " ".join(passage[:r.choice([20, 60])] + [f"w{r.randrange(400)}" for _ in range(r.choice([30, 90, 300]))]))
            for k in range(80)]
    rows.append((80, rows[0][1] + " more"))  # links with the first
    kept, written = {}, oj.written
    monkeypatch.setattr(oj, "written", lambda df, name, *more: kept.setdefault(name, written(df, name, *more)))
    got = oj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 8, 10).collect()
    assert sorted(tuple(x) for x in got) == brute(rows, 5, 8, 10)
    assert kept["family-members"].count() <= 10


def test_sketches_rule_out_no_link_and_most_other_pairs():
    r = np.random.default_rng(9)
    for num, den in ((9, 10), (8, 10)):
        sets = []
        for n in (1, 2, 3, 7, 20, 60, 64, 66, 126, 130, 300, 1000):
            base = r.integers(0, 1 << 62, n).astype(np.uint64)
            for k in range(12):
                cut = int(r.integers(0, n // 6 + 1)) if k < 8 else n // 2
                sets.append(np.unique(np.concatenate([base[cut:], r.integers(0, 1 << 62, cut // 2 if k < 8 else cut).astype(np.uint64)])))
        sizes = np.array([len(s) for s in sets])
        pairs = oj.may_link(sizes, [oj.sketch(s) for s in sets], num, den)
        label = list(range(len(sets)))
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        assert len(pairs) == len(sets) - len(set(label))
        for a in range(len(sets)):
            for b in range(a):
                i = len(np.intersect1d(sets[a], sets[b]))
                if i and den * i >= num * len(np.union1d(sets[a], sets[b])):
                    assert label[a] == label[b]
        for f in range(4, 12):  # half of the elements are others: not one family
            assert len({label[f * 12 + k] for k in range(8, 12)}) > 2


def test_families_of_a_crowd_under_one_key(spark, monkeypatch):
    r = np.random.default_rng(10)
    bases = [r.integers(0, 1 << 62, 100).astype(np.uint64) for _ in range(3)]
    sets = [np.concatenate([b[k:], r.integers(0, 1 << 62, k).astype(np.uint64)]) for b in bases for k in range(5)]
    rows = [(k, len(s), bytearray(oj.sketch(s))) for k, s in enumerate(sets)]
    own = spark.createDataFrame(rows, "h1 long, n long, sketch binary")
    shared = spark.createDataFrame([(1, k) for k in range(15)] + [(2, 0), (2, 7)], "key long, node long")
    got = dict(tuple(x) for x in oj._families(shared, own, 8, 10).collect())
    assert got == {k: k // 5 * 5 for k in range(15)}
    monkeypatch.setattr(oj, "HELD", 10)  # beyond it nothing is ruled out
    got = dict(tuple(x) for x in oj._families(shared, own, 8, 10).collect())
    assert got == dict.fromkeys(range(15), 0)


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(300)] + [(5, 5), (None, 3), (7, 8)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[k] == 0 for k in range(61)) and all(got[200 + k] == 100 for k in range(300))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert oj.near_duplicates(df, 3, 9, 10).count() == 0
