"""Importance resampling and risk-controlled rules."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import importance, pii, risk_rules
from tandem.llm.dropout import decode, encode, pieces
from tandem.llm.tokens import file

MODEL = file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    good = [f"gut{k}" for k in range(200)]
    junk = [f"bad{k}" for k in range(60)]
    rows, labels = [], []
    for k in range(600):
        bad = k % 5 == 0
        words = [r.choice(junk if bad and r.random() < 0.5 else good) for _ in range(r.choice([55, 80, 120]))]
        text = " ".join(words)
        if bad and k % 2 == 0:
            text = text.upper().replace(" ", "!! ")
        rows.append((k, text, "en" if k % 3 else "de", k))
        if k % 2 == 0 or not bad:
            labels.append((k, int(not bad), int(k % 97 == 1)))
    rows += [(600, None, None, None), (601, "", "en", 1), (601, "", "en", 1), (None, "gut1 " * 80, "en", 1),
             (602, "one word " * 30, "en", 1), (603, "a b c a b c " * 20, "en", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, good int").withColumnsRenamed({"good": "kept"})
    return docs.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_importance_separates_and_samples_exactly(spark, corpus):
    docs, labels = corpus
    out = importance.importance(docs, labels, keep=0.8).collect()
    n = docs.count()
    assert len(out) == n
    keys = sorted(((-r["gumbel_key"], r["doc_id"] if r["doc_id"] is not None else 2**63) for r in out))
    k = int(np.ceil(0.8 * n))
    want = set(keys[:k])
    assert {(-r["gumbel_key"], r["doc_id"] if r["doc_id"] is not None else 2**63) for r in out if r["kept"]} == want
    weight = {r["doc_id"]: r["weight"] for r in out}
    good = [weight[d] for d in range(600) if d % 5]
    bad = [weight[d] for d in range(600) if d % 5 == 0]
    assert np.mean([g > b for g in good[:200] for b in bad]) > 0.95
    again = {(r["doc_id"], r["gumbel_key"]) for r in importance.importance(docs.repartition(2), labels).collect()}
    assert again == {(r["doc_id"], r["gumbel_key"]) for r in out}


def test_importance_without_labels_or_documents(spark, corpus):
    docs, labels = corpus
    assert importance.importance(docs.limit(0), labels).count() == 0
    out = importance.importance(docs, labels.limit(0), keep=0.5).collect()
    assert {r["weight"] for r in out} == {0.0}


def test_gumbel_sampling_follows_the_weights(spark):
    # one document with weight log 3 against one with weight 0: kept three times out of four
    import xxhash
    won = 0
    for s in range(4000):
        g = [-np.log(-np.log((xxhash.xxh3_64_intdigest(str(d).encode(), seed=s) + 0.5) / 2.0**64)) for d in (1, 2)]
        won += np.log(3) + g[0] > g[1]
    assert abs(won / 4000 - 0.75) < 0.03


def plain_counts(text):
    w = [x for x in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    wins = {}
    for i in range(len(w) - 2):
        wins.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {p for at in wins.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t")]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_rule_counts(spark):
    r = random.Random(6)
    bits = ["a", "b", "c", "aa ", " ", "\n", "\n\n", "#", "é", "日本", "a b c ", "\t", "|x|", "line one\n"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(200)] + [None, "", "x " * 3000, "a a a a"]
    df = spark.createDataFrame([(k, t, "n_words") for k, t in enumerate(texts)], "doc_id long, text string, stratum string")
    for row in risk_rules.measured(df).collect():
        want = plain_counts(texts[row["doc_id"]])
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want


def test_binomial_tail(spark):
    from math import comb, log
    cases = [(10, 0, 0.1), (50, 3, 0.1), (200, 10, 0.05), (2000, 30, 0.02)]
    df = spark.createDataFrame([(n, k) for n, k, _ in cases], "n long, k long")
    for n, k, p in cases:
        got = df.where((F.col("n") == n) & (F.col("k") == k)).select(risk_rules.log_tail(F.col("n"), F.col("k"), p)).first()[0]
        want = log(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
        assert abs(got - want) < 1e-9


def test_rules_bound_false_rejection(spark, corpus):
    docs, labels = corpus
    out = {r["doc_id"]: r for r in risk_rules.judge(docs, labels, alpha=0.2).collect() if r["doc_id"] is not None}
    good = [d for d in range(600) if d % 5]
    assert np.mean([not out[d]["kept"] for d in good]) <= 0.2
    shouted = [d for d in range(0, 600, 10)]
    assert np.mean([not out[d]["kept"] for d in shouted]) > 0.9
    assert not out[600]["kept"] and out[601]["base_failed"] and out[603]["base_failed"]
    # without labels nothing is proven, and only the base rules reject
    bare = risk_rules.judge(docs, labels.limit(0)).where("kept = base_failed").count()
    assert bare == 0
    assert risk_rules.judge(docs.limit(0), labels).count() == 0


def test_dropout_is_lossless_seeded_and_plain_at_rate_zero(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    r = random.Random(3)
    bits = ["a", "▁", "  ", " ", "日本", "💩", "é", "the", "\n", "\x00", "international", "Straße "]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(200)] + ["", None, "word " * 3000, "word " * 3000]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(None, "no id", "x")],
                               "doc_id long, text string, variant string")
    from tandem.llm.common import NO_ID
    rows = decode(encode(df, MODEL), MODEL).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        if row["doc_id"] != NO_ID:
            assert row["text"] == (texts[row["doc_id"]] or "")
    cut = {row["doc_id"]: bytes(row["ids"]) for row in rows}
    assert cut == {row["doc_id"]: bytes(row["ids"]) for row in encode(df.repartition(3), MODEL).collect()}
    assert cut != {row["doc_id"]: bytes(row["ids"]) for row in encode(df, MODEL, seed=5).collect()}
    p = pieces(MODEL)
    p.memo.clear()
    for t in texts:
        if t and "▁" not in t and "\x00" not in t:
            assert np.frombuffer(p.encode(t, 0, 0.0), p.dtype).tolist() == sp.encode(t), t
    long = np.frombuffer(cut[len(texts) - 1], p.dtype)
    assert len(long) > 3000 or len(np.frombuffer(cut[len(texts) - 2], p.dtype)) > 3000  # some variant drops a merge


def test_every_occurrence_draws_anew():
    from tandem.llm import dropout
    p = pieces(MODEL)
    text = "international word " * 3000
    cuts = {}
    for doc in (7, 8):
        ids = np.frombuffer(p.encode(text, doc), p.dtype).tolist()
        words, own = [], []
        for i in ids:  # a piece that starts with a space starts a word
            if p.bytes[i].startswith(b" ") and own:
                words.append(tuple(own))
                own = []
            own.append(i)
        words.append(tuple(own))
        cuts[doc] = [w for w in words if b"".join(p.bytes[i] for i in w) == b" word"]
    whole = [np.mean([len(w) == 1 for w in c]) for c in cuts.values()]
    assert all(0.5 < x < 0.95 for x in whole)  # some occurrences of a document are split and some are not
    assert len({w for c in cuts.values() for w in c}) > 4
    # the tree of a unit gives what merging each occurrence by itself gives
    r = random.Random(8)
    texts = [" ".join(r.choice(["the", "international", "日本", "▁a", "Straßenbahn", "x" * 30, "", "💩s"]) for _ in range(400))
             for _ in range(5)]
    tree = p.encode_all(texts, [1, 2, 3, 3, -5], 0.3)
    assert tree == [p.encode(t, d, 0.3) for t, d in zip(texts, [1, 2, 3, 3, -5], strict=True)]
    p._forget()
    kept, dropout.LONGEST = dropout.LONGEST, 0
    try:
        assert tree == p.encode_all(texts, [1, 2, 3, 3, -5], 0.3)
    finally:
        dropout.LONGEST = kept
        p._forget()


def test_pii_rows(spark):
    rows = [(1, "mail a.b@mail1.example.com password=f2f5acd241f026fd29 x", "k"), (2, None, "k"), (3, "", "k"),
            (4, "nothing here " * 2000, "k"), (5, "nothing here " * 2000, "k"), (None, "1.2.3.4", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = {r["doc_id"]: r for r in pii.detect(df.repartition(3)).collect()}
    assert len(out) == 6 and out[1]["n_email"] == 1 and out[1]["spans"].startswith("email:5:26")
    assert out[None]["n_ip"] == 1 and all(out[d]["spans"] == "" for d in (2, 3, 4, 5))
    assert pii.detect(df.limit(0)).count() == 0
    clean = pii.redact(df.select("doc_id", "text")).collect()
    assert {r["doc_id"]: r["text"] for r in clean}[2] is None and "a.b@" not in str(clean)


def test_pii_candidates_of_any_length():
    r = random.Random(2)
    for n in (12, 40, 200, 201, 5000):
        for more in ("", "-_/+"):
            key = "k1" + "".join(r.choice("abcDEF0123456789" + more) for _ in range(n - 4)) + "Z9"
            for end in ("", "=", "=="):
                text = f"token: {key}{end} x"
                assert ("secret", 7, 7 + n + len(end)) in [c[:3] for c in pii.candidates(text, [])]
                assert "secret" not in [c[0] for c in pii.candidates(f"token: {key}=== x", [])]
    local, labels = "ab." * 40 + "c", " [dot] ".join(["d" * 70, *"efghij"])
    text = f"write {local} [at] {labels} !"
    assert [c[:3] for c in pii.candidates(text, []) if c[0] == "address"] == [("address", 6, len(text) - 2)]
    assert pii.base_spans(f"{'0' * 30}1.2.{'0' * 5000}.255") == [("ip", 0, 31 + 3 + 5000 + 4)]
    assert pii.base_spans(f"1.2.3.{'0' * 30}256") == [] and pii.base_spans(f"1.2.3.{'9' * 5000}") == []
    pii.candidates("a-" * 200_000 + "1===", [])  # one scan
