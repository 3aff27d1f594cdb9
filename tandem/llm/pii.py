"""Personal data by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns and always stay. On top of them, loose patterns propose
candidate spans; regex, gazetteer and context labelers vote on each one (+1 personal, -1 not, 0 abstains).
Expectation-maximisation over the counts of all vote patterns of the corpus estimates each labeler's reliability and
a probability for every pattern; a logistic span classifier is trained on these soft labels, with the votes and the
span's shape as features, and decides which candidates become spans.

A candidate's votes and shape are one small integer (``Candidate.code``), so what leaves the executors is one count a
code, at most 3 ** 6 * 12 of them, whatever the corpus. The text is scanned once; models read the counts.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import any_id, documents, null_ids, prepare, slices, with_texts, written

# FIXED VALUES of the contract: kinds in order, and their patterns
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ADDED = ("address", "number", "secret")
_ADDED = {
    "address": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]++"
                          r"(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]++)++"),
    "number": re.compile(r"(?<![0-9A-Za-z+._-])\(?[0-9]{2,5}\)?(?:[\x20.-]?\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z_]|[.-][0-9])"),
    # a whole run of key characters, scanned once: no later start in it ends elsewhere
    "secret": re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}+={0,2}+(?![A-Za-z0-9+/=_-])"),
}
# gazetteers: cue words in the languages of the corpus
CUES = {
    "address": {"mail", "email", "e-mail", "contact", "write", "correo", "courriel", "kontakt", "contacto"},
    "number": {"phone", "tel", "call", "fax", "mobile", "telefon", "telefono", "teléfono", "téléphone", "card", "iban",
               "ssn", "konto", "account", "cuenta", "compte", "karte", "tarjeta", "carte"},
    "secret": {"password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "key",
               "bearer", "credential", "passwort", "contraseña"},
}
AGAINST = {"version", "page", "pages", "chapter", "isbn", "vol", "year", "figure", "table", "line", "http", "https"}
# key forms with a fixed head
_KNOWN = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z_-]{20,}|xox[abprs]-[0-9A-Za-z-]{10,}")
_BEFORE = re.compile(r"[^\W\d_][\w-]*")
LABELERS = 6
SHAPES = 12
NEAR = 24  # code points before and after a candidate that context labelers see


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if k % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then by start.

    >>> base_spans("a@b.co 1.2.3.4")
    [('email', 0, 6), ('ip', 7, 14)]
    """
    out, end = [], 0
    at = text.find("@")
    while at >= 0:  # a match starts where the run of local characters before an @ starts, or where the last one ended
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            out.append(("email", start, end))
        else:
            end = at + 1 if start < at else end
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _votes(kind: str, text: str, start: int, end: int) -> tuple[list[int], int]:
    """Votes of the six labelers and the shape of a candidate."""
    span = text[start:end]
    before, after = text[max(0, start - NEAR):start], text[end:end + NEAR]
    digits = sum(c.isdigit() for c in span)
    letters = sum(c.isalpha() for c in span)
    words = [w.lower() for w in _BEFORE.findall(before)]
    cue = bool(words) and words[-1] in CUES[kind]
    if kind == "address":
        strict, odd = 1, -1 if len(span) < 9 else 0
    elif kind == "number":
        strict = 1 if 9 <= digits <= 19 and any(c in " -()" for c in span) else -1 if digits < 7 else 0
        odd = -1 if len(set(span) - set(" .-()")) <= 2 or re.fullmatch(r"(?:1[89]|20)\d\d(?:[-. ]\d\d?){0,2}", span) else 0
    else:
        changes = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:], strict=False))
        strict = 1 if digits >= 3 and letters >= 3 and changes >= 4 else -1 if not digits else 0
        known = _KNOWN.fullmatch(span)
        strict = 1 if known else strict
        odd = 1 if known else -1 if span.isalpha() and (span.islower() or span.isupper() or span.istitle()) or "-" in span and not digits else 0
    votes = [
        strict,  # regex: the strict form of the kind
        odd,  # regex: forms that are something else
        1 if cue else 0,  # gazetteer: the word before is a cue of the kind
        1 if any(w in CUES[kind] for w in words[-4:]) else -1 if words and words[-1] in AGAINST else 0,  # gazetteer, near
        1 if before.rstrip(" \"'").endswith(("=", ":")) else -1 if before.endswith(("$", "€", "#", "/")) else 0,  # context
        -1 if after.startswith(("%", "/", "€")) else 1 if kind == "secret" and before.endswith(('"', "'")) else 0,  # context
    ]
    size = 0 if len(span) < 12 else 1 if len(span) < 20 else 2 if len(span) < 40 else 3
    return votes, ADDED.index(kind) * 4 + size


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, code) of loose matches that overlap no base span; the code holds shape and votes."""
    taken = sorted((a, b) for _, a, b in base)
    starts, last = [a for a, _ in taken], []
    for _, b in taken:
        last.append(max(b, last[-1]) if last else b)
    out = []

    def free(a: int, b: int) -> bool:
        k = bisect.bisect_left(starts, b)
        return not k or last[k - 1] <= a

    for kind, pattern in _ADDED.items():
        if kind == "address" and "at" not in text:
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            if kind == "secret" and not any(c.isdigit() for c in m[0]):
                continue  # a long plain word is no candidate
            if not free(a, b):
                continue
            votes, shape = _votes(kind, text, a, b)
            code = shape
            for v in votes:
                code = code * 3 + v + 1
            out.append((kind, a, b, code))
    return out


def decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes (rows of -1, 0, 1) and shapes of candidate codes."""
    codes = np.asarray(codes, np.int64)
    votes = np.stack([codes // 3**k % 3 - 1 for k in range(LABELERS - 1, -1, -1)], axis=1)
    return votes, codes // 3**LABELERS


def em(votes: np.ndarray, counts: np.ndarray, rounds: int = 200, tol: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each vote pattern is personal, and each labeler's P(vote | class), shape (2, labelers, 3).

    Labelers are independent given the class; each (class, labeler) has a distribution over -1, 0, +1 with a
    pseudo-count of one a cell, that favours votes that agree with the class. Starts from the mean vote.
    """
    p = 1 / (1 + np.exp(-2.0 * votes.sum(axis=1)))
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    rates = np.zeros((2, votes.shape[1], 3))
    prior = np.array([[1.5, 1.0, 0.5], [0.5, 1.0, 1.5]])[:, None, :]
    for _ in range(rounds):
        w = np.stack([(1 - p) * counts, p * counts])
        rates = np.einsum("cn,nlv->clv", w, hot) + prior
        rates /= rates.sum(axis=2, keepdims=True)
        share = (w.sum(axis=1) + 1) / (w.sum() + 2)
        log = np.log(share)[:, None] + np.einsum("nlv,clv->cn", hot, np.log(rates))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - p).max(initial=0) < tol:
            p = new
            break
        p = new
    return p, rates


def features(codes: np.ndarray) -> np.ndarray:
    votes, shapes = decode(codes)
    return np.concatenate([np.ones((len(votes), 1)), votes == 1, votes == -1,
                           np.arange(SHAPES)[None, :] == shapes[:, None]], axis=1).astype(float)


def train(codes: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic classifier on soft labels, by Newton steps with a ridge."""
    x, w = features(codes), np.zeros(1 + 2 * LABELERS + SHAPES)
    for _ in range(rounds):
        z = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (z - target)) + ridge * w
        hess = (x * (counts * z * (1 - z))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(found: DataFrame) -> dict[int, float]:
    """Code to probability, from the counts of all candidate codes in ``found.codes``."""
    rows = found.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n")).collect()
    if not rows:
        return {}
    codes, n = np.array([r["code"] for r in rows]), np.array([r["n"] for r in rows], float)
    soft, _ = em(decode(codes)[0], n)
    w = train(codes, soft, n)
    z = 1 / (1 + np.exp(-np.clip(features(codes) @ w, -30, 30)))
    return dict(zip(codes.tolist(), z.tolist(), strict=True))


FOUND = "doc_id long, kinds array<string>, starts array<long>, ends array<long>, codes array<int>"


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in slices(batches, "text"):
        rows = []
        for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            base = base_spans(text)
            more = candidates(text, base)
            spans = base + [c[:3] for c in more]
            rows.append((doc, [s[0] for s in spans], [s[1] for s in spans], [s[2] for s in spans], [c[3] for c in more]))
        yield pd.DataFrame(rows, columns=["doc_id", "kinds", "starts", "ends", "codes"])


def find(docs: DataFrame) -> DataFrame:
    """Base spans of each document and then its candidates with their codes; written once. Null texts have none, null
    ids are ``NO_ID``."""
    prepare(docs.sparkSession)
    return written(any_id(docs).mapInPandas(_find, FOUND), "pii-found")


def accepted(spans: list[tuple[str, int, int]], codes: list[int], model: dict[int, float],
             threshold: float = 0.5) -> list[tuple[str, int, int]]:
    """Base spans and the candidates that the classifier takes, by kind and start; candidates stand last in ``spans``."""
    base = spans[:len(spans) - len(codes)]
    more = [s for s, c in zip(spans[len(base):], codes, strict=True) if model.get(c, 0.0) > threshold]
    order = {k: i for i, k in enumerate(KINDS + ADDED)}
    return sorted(base + more, key=lambda s: (order[s[0]], s[1]))


def _digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _results(model: dict[int, float]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                spans = list(zip(r.kinds, map(int, r.starts), map(int, r.ends), strict=True))
                codes = [int(c) for c in r.codes]
                base = spans[:len(spans) - len(codes)]
                n = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((r.doc_id, *n, hashlib.sha256(_digest(base).encode()).hexdigest(),
                             _digest(accepted(spans, codes, model))))
            yield pd.DataFrame(rows, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return run


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row; null ids and repeated rows stay."""
    found = find(docs)
    return null_ids(found.mapInPandas(_results(fit(found)), "doc_id long, n_email long, n_ip long, n_card long, "
                                      "n_phone long, base_sha256 string, spans string"))


def redacted(text: str, model: dict[int, float]) -> str:
    base = base_spans(text)
    more = candidates(text, base)
    parts, at = [], 0
    for kind, a, b in sorted(accepted(base + [c[:3] for c in more], [c[3] for c in more], model),
                             key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"<{kind}>"]
        at = max(at, b)  # what sticks out of an overlap goes as well
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets, and ``n_chars``, if there, to
    match; other columns and null texts stay."""
    model = fit(find(docs))
    return with_texts(docs, lambda batch: [None if t is None else redacted(t, model)
                                           for t in batch.column("text").to_pylist()])


def op6_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(documents(spark, sf_dir))
