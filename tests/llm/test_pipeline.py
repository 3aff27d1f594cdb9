"""The stages on a small corpus, each against a plain version of what it promises."""

import random

import numpy as np
import pytest

import corpus_pipeline as cp
from tandem.llm import pii


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    r = random.Random(8)
    words = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "am") for b in ("em", "um", "or", "at", "is", "que")]
    text = lambda n: " ".join(r.choice(words) + (f"{r.randrange(300)}" if r.random() < 0.3 else "") for _ in range(n))
    passage = text(80)
    rows = [(k, text(r.choice([60, 90, 200])), "en", f"src{k % 4}") for k in range(60)]
    rows += [(60 + k, rows[k][1] + " end", "en", "src0") for k in range(12)]  # near copies
    rows += [(80 + k, text(60) + " " + passage + " " + text(60), "de", "src1") for k in range(5)]
    rows += [(90, text(70) + " mail a.b@mail1.example.com or +1 (407) 555-8973 now", "en", "src2"), (91, "too short", "en", "src2"),
             (92, "same again " * 60, "en", "src3"), (93, None, None, None), (94, "", "en", "src3"),
             (95, text(60) + " ñandú " * 3, "es", None)]
    path = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame([(*x, len(x[1] or "")) for x in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(60)], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    return str(path), {x[0]: x for x in rows}


def test_stages(spark, sf):
    path, rows = sf
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    rules, near, cut, clean = seen.values()
    assert set(rules) == set(rows) - {91, 92, 93, 94}  # short, repeated, null and empty texts; nothing else
    assert set(near) == set(rules) - set(range(60, 72))  # one of each pair of near copies
    gone = {d: len(near[d]["text"]) - len(cut[d]["text"]) for d in near}
    assert all(gone[d] > 300 for d in range(81, 85)) and sum(gone.values()) == sum(gone[d] for d in range(81, 85))
    assert "<email>" in clean[90]["text"] and "<phone>" in clean[90]["text"] and "555" not in clean[90]["text"]
    assert all(clean[d]["text"] == cut[d]["text"] for d in cut if d != 90)
    assert all(r["n_chars"] == len(r["text"]) for r in clean.values())


def test_run_packs_every_id_of_what_is_left(spark, sf):
    from tokenizers import Tokenizer

    from tandem.llm.tokens import file
    path, _ = sf
    rows = cp.run(spark, path).collect()
    lib = Tokenizer.from_file(file("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, path)
        docs = spark.createDataFrame(out.collect(), out.schema)
    n = {r["doc_id"]: len(lib.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == n


def test_empty_documents(spark, sf, tmp_path):
    path, _ = sf
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_base_spans_against_plain_patterns():
    import re
    r = random.Random(1)
    bits = ["a@", "b.", ".", "@", "co", "1", ".2", "-", " ", "x.y", "+", "4111 1111 1111 1111", "+1 (407) 555-8973", "255.1.1.1"]
    for _ in range(4000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        want += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
                 if all(int(p) <= 255 for p in m[0].split("."))]
        digits = lambda s: [int(c) for c in s if c.isdigit()]
        luhn = lambda d: sum(d[::-1][0::2] + [sum(divmod(2 * x, 10)) for x in d[::-1][1::2]]) % 10 == 0
        want += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
                 if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
        want += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]
        assert pii.base_spans(t) == want, t


def test_em_finds_reliable_labelers():
    r = np.random.default_rng(2)
    truth = r.random(20_000) < 0.3
    votes = np.stack([np.where(r.random(20_000) < a, np.where(truth, 1, -1), np.where(truth, -1, 1)) for a in (0.95, 0.9, 0.85, 0.8, 0.75, 0.55)], axis=1)
    votes[r.random(votes.shape) < 0.2] = 0
    p, rates = pii.em(votes, np.ones(len(votes)))
    assert ((p > 0.5) == truth).mean() > 0.95
    good = rates[1, :, 2] / (rates[1, :, 2] + rates[1, :, 0])
    assert (np.diff(good) < 0).all() and good[0] > 0.9 and good[5] < 0.7
