"""Operators on token ids against the tokenizers library, document by document."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tandem.llm import ans, packing, prefix_counts
from tandem.llm.tokens import encoder, file

ALPHABET = ["a", "be", " ", "  ", "\n", "\t", "'re", "'ll", "'", "é", "日本", "12", "!!", "<|endoftext|>", "<|", "The",
            " '", " 's", "\r\n", "ñ", "　", "\xa0", "don't", "İ", "é", "Straße", "x" * 60]


def texts(n=250, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, f"s{k % 3}", 7) for k, t in enumerate(texts())]
    rows += [(250, None, None, 1), (251, "", "s0", 1), (252, "the cat " * 4000, "s1", 1), (253, "dup", "s2", None),
             (254, "dup", "s2", None)]
    # extra columns that clash with names used inside
    return spark.createDataFrame(rows, "doc_id long, text string, source string, part int").withColumnsRenamed(
        {"part": "n"}).repartition(5)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_memo_gives_the_librarys_ids(name):
    e, lib = encoder(file(name)), Tokenizer.from_file(file(name))
    ts = texts(600, 5)
    for t, ids in zip(ts, e.encode(ts), strict=True):
        assert np.frombuffer(ids, e.dtype).tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_ans_files_round_trip(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    ans.write_ids(docs, path, file("word_bpe_49k.json"), 2, shard_chars=20_000, block=300)
    got = {r["doc_id"]: r for r in ans.read_ids(spark, path).collect()}
    lib, start = Tokenizer.from_file(file("word_bpe_49k.json")), 0
    want = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert len(got) == len(want)
    for doc, text in want:
        ids = np.array(lib.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert bytes(got[doc]["ids"]) == ids.tobytes()
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_ans_blocks_with_checkpoints_and_damage():
    r = np.random.default_rng(1)
    blocks = [r.zipf(1.3, n).clip(max=5000).astype(np.uint16) for n in (1, 63, 64, 70_000, 131_072)]
    table = ans.Table(ans.quantise(np.bincount(np.concatenate(blocks))))
    coded = ans.encode_blocks(blocks, table)
    assert len(coded[4][1]) > 0  # has checkpoints
    back = ans.decode_blocks([(len(b), *c) for b, c in zip(blocks, coded, strict=True)], table)
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))


def test_empty_table(spark, docs, tmp_path):
    none = docs.limit(0)
    ans.write_ids(none, str(tmp_path / "none"), file("word_bpe_49k.json"), 2)
    assert ans.read_ids(spark, str(tmp_path / "none")).count() == 0
    assert packing.pack(none, file("byte_bpe_50k.json"), 0).count() == 0
    assert prefix_counts.count_prefixes(none, file("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("targets", [None, {"s0": 0.7, "s1": 0.1}])
def test_packing_places_every_id_once(spark, docs, targets):
    rows = packing.pack(docs, file("byte_bpe_50k.json"), 0, targets, length=64, window=4, with_ids=True).collect()
    lib = Tokenizer.from_file(file("byte_bpe_50k.json"))
    seqs, own = {}, {}
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        own.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
    for d in docs.collect():
        ids = sum((x[1] for x in sorted(own[d["doc_id"]])), [])
        assert ids == lib.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        assert {x[2] for x in own[d["doc_id"]]} == {len(ids)}
    sizes = []
    for s in range(len(seqs)):
        at = 0
        for off, n in sorted(seqs[s]):
            assert off == at
            at += n
        sizes.append(at)
    assert all(n == 64 or n & (n - 1) == 0 for n in sizes) and sizes.count(64) >= len(sizes) - 6


def test_schedule_keeps_the_mixture_and_carries_deficits():
    s = packing.Schedule([10_000, 5_000, 333], [0.5, 0.3, 0.2])
    at = s.served(np.arange(0, s.n + 1, 7))
    assert (at.sum(axis=1) == np.minimum(np.arange(0, s.n + 1, 7), s.n)).all()
    assert (np.diff(at, axis=0) >= 0).all() and (at <= s.totals).all()
    before = at[: 333 * 5 // 7 - 2]  # until the third queue runs empty, every share holds to an id
    assert np.abs(before - before.sum(axis=1, keepdims=True) * np.array([0.5, 0.3, 0.2])).max() <= 1.5


def test_prefix_tables(spark, docs):
    lib = Tokenizer.from_file(file("byte_bpe_50k.json"))
    for r in prefix_counts.count_prefixes(docs.where("doc_id < 120 or doc_id > 248 and doc_id <> 252"),
                                          file("byte_bpe_50k.json"), limit=3).collect():
        table = prefix_counts.prefix_counts(zlib.decompress(bytes(r["changes"])))
        assert table[-1] == r["n_tokens"] and (table[: r["fits"] + 1][-1] <= 3)
    c = prefix_counts.counter(file("byte_bpe_50k.json"))
    for t in texts(200, 9):
        want = [len(lib.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert prefix_counts.prefix_counts(c.changes(t)).tolist() == want, t


def test_big_and_null_ids(spark):
    big = (1 << 60) + 1
    df = spark.createDataFrame([(big, "a b"), (None, "c d e"), (None, None)], "doc_id long, text string").coalesce(1)
    got = prefix_counts.count_prefixes(df, file("byte_bpe_50k.json")).select("doc_id", "n_tokens").collect()
    assert sorted((str(r[0]), r[1]) for r in got) == sorted([("None", 0), ("None", 3), (str(big), 2)])
    got = packing.pack(df, file("byte_bpe_50k.json"), 0).select("doc_id", "doc_tokens").collect()
    assert sorted((str(r[0]), r[1]) for r in got) == sorted([("None", 1), ("None", 4), (str(big), 3)])


def test_counts_match_the_library(spark, docs):
    lib = Tokenizer.from_file(file("byte_bpe_50k.json"))
    text = {d["doc_id"]: d["text"] or "" for d in docs.collect()}
    for r in prefix_counts.count_prefixes(docs, file("byte_bpe_50k.json"), with_table=False).collect():
        t = text[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"]) == (len(t.encode()), len(lib.encode(t, add_special_tokens=False).ids))


def test_query_counts_come_from_stored_tables(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(2**62 + 1, "ab cd " * 900), (5, ""), (6, None), (None, "one two")], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    stored = []
    keep = prefix_counts.written
    monkeypatch.setattr(prefix_counts, "written", lambda d, name: stored.append(keep(d, name)) or stored[-1])
    got = {r["doc_id"]: r for r in prefix_counts.op10_prefix_token_counts(spark, str(tmp_path)).collect()}
    tables = {r["doc_id"]: prefix_counts.prefix_counts(zlib.decompress(bytes(r["changes"]))) for r in stored[0].collect()}
    assert set(got) == set(tables) == {2**62 + 1, 5, 6, None}
    for d, t in tables.items():
        assert (got[d]["n_tokens"], got[d]["fits"]) == (t[-1], prefix_counts.longest_prefix(t, prefix_counts.LIMIT))
        assert got[d]["over_limit"] == (t[-1] > prefix_counts.LIMIT)
    # the tables alone are read, not the sums next to them
    fake = stored[0].limit(1).selectExpr("doc_id", "n_bytes", "-1L n_tokens", "-1L fits", "changes")
    assert prefix_counts.read_tables(fake).first()["n_tokens"] >= 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_are_cut_in_arrays(name):
    """A batch is never held as one string a piece, and the ids are the library's."""
    import tracemalloc

    e, lib = encoder(file(name)), Tokenizer.from_file(file(name))
    texts = ["", " ab", "ab \n\tAb", "\n\n", "ab" * 30, "é İ ab", "ab ab", " ab" * 400_000, "", "ab "]
    tracemalloc.start()
    got = e.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, e.dtype).tolist() == lib.encode(text, add_special_tokens=False).ids
    assert peak < 16 * len("".join(texts))
    assert e.encode([]) == [] and e.encode(["", ""]) == [b"", b""]


def test_dropout_merges_rare_sizes_together(monkeypatch):
    """Units of many lengths, few of each, are merged in few rounds and cut as one by one; characters without a piece
    become bytes wherever they stand."""
    from tandem.llm import dropout
    from tandem.llm.tokens import PairTable

    path = file("piece_bpe_32k.model")
    words = [w + c * (k % 3) for k in range(24) for c, w in (("é", "information"[:k % 11 + 1] * 3), ("𐍈", "x" * (k + 1)), ("▁", "of"))]
    text = " ".join(words) + "  ͸ " + "ab" * 200
    calls = []
    merge = PairTable.merge
    monkeypatch.setattr(PairTable, "merge", lambda self, sym, *a: calls.append(sym.shape) or merge(self, sym, *a))
    p = dropout.Pieces(path)
    plain = p.encode(text, rate=0.0)
    sizes = {len(w) + 1 for w in words}
    assert len(calls) <= len(sizes) and len(sizes) > 20
    assert p.decode(plain) == text and p.decode(p.encode(text, 7)) == text
    one_by_one = b"".join(dropout.Pieces(path).encode(w, rate=0.0) for w in words)
    assert plain.startswith(one_by_one)
    # the draws of an occurrence do not depend on what is merged beside it
    some = [t * n for n, t in enumerate(("", "a bé ", "weak forms 𐍈 ", "ab"))]
    assert p.encode_all(some, [3, 4, 5, 6]) == [dropout.Pieces(path).encode(t, i) for t, i in zip(some, (3, 4, 5, 6), strict=True)]
