"""Repeat removal against a dictionary of all windows."""

import random

import numpy as np
import pandas as pd
import pytest

from tandem.llm import run_index as ri


def brute(rows, length):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                gone[i:i + length] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((d, len(b), int(gone.sum()), runs, bytes(x for x, g in zip(b, gone, strict=False) if not g)))
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)
    words = ["ab", "the", "é", "ñandu", "qu", "日本", "x", "zz", "lorem"]
    text = lambda n: " ".join(r.choice(words) + str(r.randrange(40)) for _ in range(n))
    passage, line = text(40), text(12)
    rows = [text(r.choice([1, 5, 30, 120])) for _ in range(40)]
    rows += [r.choice(rows) for _ in range(15)]
    for _ in range(15):
        t = text(30)
        k = r.randrange(len(t))
        rows.append(t[:k] + passage[r.randrange(30):] + t[k:] + line)
    for _ in range(10):  # near copies
        t = list(rows[3])
        for _ in range(3):
            t[r.randrange(len(t))] = "#"
        rows.append("".join(t))
    rows += ["a" * 300, "a" * 49, "a" * 50, "ab" * 200, "ba" * 150, "", None, "a" * 51 + "b"]
    r.shuffle(rows)
    return [(10 * k, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("bucket_chars", [1 << 20, 700])
def test_removes_what_all_windows_say(spark, bucket_chars):
    rows = corpus(bucket_chars)
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, th int, key string")
    got = sorted(tuple(r) for r in ri.remove_repeats(df.repartition(5), bucket_chars=bucket_chars).collect())
    assert [(*g[:4], bytes(g[4])) for g in got] == brute(rows, 50)


def test_equal_ids_do_not_repeat_each_other(spark):
    t = "the quick brown fox jumps over the lazy dog and runs away from it all " * 2
    df = spark.createDataFrame([(1, t), (1, t), (2, t + "!")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_removed"]) for r in ri.remove_repeats(df).collect())
    assert got[:2] == [(1, 0), (1, 0)] and got[2][1] == len(t)


def test_empty(spark):
    assert ri.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_run_index_is_the_transform():
    texts = [b"banana", b"ananas", b"banana bandana", b"", b"aaaa"]
    index = ri.RunIndex(texts)
    t, want = index.text.tolist(), []
    for o, x in enumerate(texts):
        want += [([*(c + 1 for c in x[i:]), 0], o, index.begin[o] + i) for i in range(len(x) + 1)]
    want.sort(key=lambda w: (w[0], w[1]))
    assert index.order.tolist() == [w[2] for w in want]
    rebuilt = np.repeat(index.symbol, index.size).tolist()
    assert [s for s in rebuilt if s >= 0] == [t[p - 1] for p in index.order.tolist() if p not in index.begin]
    stats = index.statistics()
    for a, b in zip(want, want[1:], strict=False):
        n = 0
        while a[0][n] == b[0][n] and a[0][n]:
            n += 1
        assert stats[b[2]] == n


def test_columns_named_like_the_stage_s_own(spark):
    shared = "this passage of well over fifty bytes stands in two documents, word for word. "
    docs = spark.createDataFrame([(1, "a " + shared, "m", 7, "p", 1.5), (2, "b " + shared, "n", 8, "q", 2.5), (None, shared, "o", 9, "r", None)],
                                 "doc_id long, text string, id_of string, text_hash long, Spans_Of string, th double")
    out = ri.without_repeats(docs)
    assert out.columns == docs.columns
    rows = sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is None, r[0]))
    assert [r[2:] for r in rows] == [("m", 7, "p", 1.5), ("n", 8, "q", 2.5), ("o", 9, "r", None)]
    assert rows[0][1] == "a " + shared and len(rows[1][1]) < 5 and rows[2][1] == shared


def test_sent_hashes_have_forty_bits_and_fill_all_buckets():
    data = np.random.default_rng(3).integers(97, 123, 40_000).astype(np.uint8)
    key, _, _, _ = ri.anchors(data, np.array([len(data)]))
    assert not (key & np.uint64((1 << 24) - 1)).any()
    assert len(np.unique(key)) > 0.99 * len(key)
    assert len(np.unique((key >> ri.LOW) % np.uint64(64))) == 64


def test_only_contexts_that_meet_others_are_indexed(monkeypatch):
    """A passage that repeats as a whole needs no index; a bucket's others go to indexes of bounded size."""
    from tandem.llm.run_index import RunIndex

    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passages = [text(400) for _ in range(6)]
    rows = [(d, text(60) + "".join(passages) + text(60)) for d in range(3)]
    cut = "".join(passages)
    rows += [(10 + k, cut[:k * 90 + 45] + "#" + cut[k * 90 + 46:]) for k in range(20)]
    sizes = []
    monkeypatch.setattr(ri, "RunIndex", lambda texts: sizes.append(sum(map(len, texts))) or RunIndex(texts))
    pdf = pd.DataFrame(rows, columns=["doc_id", "text"]).assign(th=7)
    keys = pd.concat(ri._keys(50, 16)(iter([pdf])))
    both = keys.groupby("key")["doc_id"].nunique()
    pdf["keys"] = [keys[(keys["doc_id"] == d) & keys["key"].isin(both.index[both > 1])]["key"].tolist() for d in pdf["doc_id"]]

    def removed(some):
        contexts = pd.concat(ri._contexts(50, 16, 1)(iter([some])))
        marks = ri._marks(50, 16)(contexts)
        out = []
        for d, t in zip(some["doc_id"], some["text"], strict=True):
            n, kept = ri._split(t.encode(), marks[marks["doc_id"] == d].to_dict("records"), 7)
            out.append((d, len(t), len(t) - len(kept), n, kept))
        return out

    assert removed(pdf[:3]) == brute(rows[:3], 50)
    assert sum(sizes) < 600 < len(cut)  # only what crosses the ends of the passages
    del sizes[:]
    want = brute(rows, 50)
    assert removed(pdf) == want and len(sizes) == 1
    monkeypatch.setattr(ri, "INDEX_BYTES", 1000)
    del sizes[:]
    assert removed(pdf) == want
    assert len(sizes) > 3 and max(sizes) < 3000


def test_anchors_of_long_texts_are_found_in_parts(monkeypatch):
    data = np.frombuffer(("".join(random.Random(2).choice("abcd") for _ in range(3000))).encode() * 2, np.uint8)
    ends = np.array([0, 700, 700, 5990, len(data)])
    whole = ri.anchors(data, ends)
    monkeypatch.setattr(ri, "PLACES", 256)
    parts = ri.anchors(data, ends)

    def named(found):  # the anchor and document of each window
        return {w: (k, d) for k, f, e, d in zip(*(x.tolist() for x in found), strict=True) for w in range(f, e + 1)}

    assert named(whole) == named(parts)
    assert sorted(named(whole)) == [w for a, b in ((0, 700), (700, 5990)) for w in range(a, b - 49)]
