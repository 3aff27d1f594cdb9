"""SentencePiece BPE with seeded merge-dropout, and its decoder.

The agenda always takes the best-scored adjacent pair that spells a piece, leftmost on ties. A candidate merge is
skipped when a keyed hash of (seed, document id, offset of the unit in the text, the places it spans) is below the
dropout rate: every occurrence of a word draws anew, and equal inputs give equal segmentations on any machine and in
any retry. Rate 0 is the plain encoding.

What a worker keeps of a unit does not depend on the draws: a tree whose root holds the merges of the plain cut and
its ids, and whose child at a merge holds those that follow when this merge is skipped and all before it are not. An
occurrence draws for the merges of the root, moves to the child at its first skipped merge, draws for the child's, and
so on to a node where nothing is skipped, whose ids are its own. A child is made when it is reached for the second
time; the occurrence that reaches it first is merged by itself, with the same draws and so the same ids.

A unit is a run of spaces with the non-space run after it: no piece of the model goes on after a non-space character
with a space, so no merge crosses units. Characters without a piece, and a literal U+2581 (the model's sign for a
space), are written as byte pieces: decoding gives back every text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tandem.llm.common import any_id, documents, null_ids, prepare, slices
from tandem.llm.tokens import NO_SYMBOL, PairTable, file, like_size

SPACE = "▁"
RATE = 0.1
SEED = 29
MEMO = 250_000  # tree nodes kept by one worker
ONCE = 500_000  # units of one occurrence so far that it remembers
LONGEST = 24  # characters of a unit that has a tree; each occurrence of a longer one is merged by itself
BLOCK = 1 << 17  # units that draw together
_UNIT = re.compile(" *[^ ]+| +")


class _Grow:
    """An array that is added to at its end."""

    def __init__(self, dtype):
        self.all, self.n = np.empty(1 << 12, dtype), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.all):
            more = np.empty(max(len(values), len(self.all)), self.all.dtype)
            self.all = np.concatenate([self.all[:self.n], more])
        self.all[self.n:self.n + len(values)] = values
        self.n += len(values)


def _mix(x: np.ndarray) -> np.ndarray:
    """Hash of 64-bit numbers, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _skipped(key: np.ndarray, span: np.ndarray, rate: float) -> np.ndarray:
    """Whether the occurrence of each key skips the merge over a span."""
    x = span * np.uint64(0x9E3779B97F4A7C15)
    x ^= key
    return (_mix(x) >> np.uint64(32)) < np.uint64(int(rate * 2**32))


class Pieces:
    """The pieces of a model as symbols, the merges that spell them, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.dtype = np.dtype("<u2") if sp.get_piece_size() <= 1 << 16 else np.dtype("<u4")
        plain = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.size = sp.get_piece_size()
        # characters that only occur inside pieces get symbols of their own
        chars = sorted({c for p in plain for c in p if c not in plain})
        self.symbol = {p: i for p, i in plain.items() if len(p) == 1} | {c: self.size + k for k, c in enumerate(chars)}
        self.other = self.size + len(chars)  # a character that no piece has
        known = plain | {c: s for c, s in self.symbol.items() if s >= self.size}
        order = {s: r for r, s in enumerate(sorted({-sp.get_score(i) for i in plain.values()}))}
        merges = {known[p[:k]] << 32 | known[p[k:]]: (order[-sp.get_score(i)], i)
                  for p, i in plain.items() for k in range(1, len(p)) if p[:k] in known and p[k:] in known}
        self.table = PairTable(np.array(list(merges), np.int64), np.array([m[0] for m in merges.values()]),
                               np.array([m[1] for m in merges.values()]))
        self.bytes = [b""] * self.size
        for p, i in plain.items():
            self.bytes[i] = p.replace(SPACE, " ").encode()
        self.n_chars = np.ones(self.size + 1, np.int64)  # of each piece; the last for what has none
        self.n_chars[list(plain.values())] = [len(p) for p in plain]
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        # symbol of every code point; the model's space sign itself goes to bytes, a space is that sign
        self.of_char = np.full(0x110000, self.other, np.int64)
        for c, s in self.symbol.items():
            self.of_char[ord(c)] = s
        self.of_char[ord(" ")], self.of_char[ord(SPACE)] = self.symbol.get(SPACE, self.other), self.other
        self.memo: dict[str, int] = {}  # the root of a unit
        self.once: set[str] = set()  # units that occurred once: a tree is made for the second occurrence
        self._forget()

    def _forget(self) -> None:
        self.memo.clear()
        # of each node: its merges in ``span`` and ``child``, its ids in ``flow``, the merges before its own, the unit
        # and the spans skipped on the way to it
        self.start, self.count, self.before = _Grow(np.int64), _Grow(np.int64), _Grow(np.int64)
        self.id_start, self.id_count = _Grow(np.int64), _Grow(np.int64)
        self.unit: list[str] = []
        self.skips: list[tuple[int, ...]] = []
        self.span, self.child, self.flow = _Grow(np.uint64), _Grow(np.int64), _Grow(self.dtype)

    def _arrays(self) -> tuple[_Grow, ...]:
        return (self.start, self.count, self.before, self.id_start, self.id_count, self.span, self.child, self.flow)

    def _add(self, units: list[str], skips: list[tuple[int, ...]] | None = None, before: np.ndarray | None = None,
             skip=None) -> np.ndarray:
        """Numbers of new nodes: units are merged, ``skip(rows, spans)`` rules out candidates, and the merges after
        the first ``before`` are kept with the ids; none without ``before``."""
        nodes = np.empty(len(units), np.int64)
        length = [len(u) for u in units]
        for rows in like_size(length):
            chars = np.array([length[r] for r in rows.tolist()], np.int64)
            points = np.frombuffer("".join([units[r] for r in rows.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32)
            within = np.arange(chars[0]) < chars[:, None]
            sym = np.full(within.shape, NO_SYMBOL, np.int64)
            sym[within] = self.of_char[points]
            path = np.zeros(sym.shape, np.uint64)

            def ruled_out(row: np.ndarray, begin: np.ndarray, end: np.ndarray, rows=rows) -> np.ndarray:
                return skip(rows[row], (begin << 32 | end).astype(np.uint64))

            merged, n = self.table.merge(sym, ruled_out if skip else None, path)
            place = np.arange(merged.shape[1])
            made = merged.shape[1] - n
            n = chars - made
            held = place < n[:, None]
            odd = ((merged >= self.size) & held).any(axis=1)
            for k in (~odd, odd):
                if not k.any():
                    continue
                if k is odd:
                    flow, count = self._with_bytes(merged[k][held[k]], points[np.repeat(odd, chars)])
                    sizes = np.add.reduceat(count, np.cumsum(n[k]) - n[k])
                else:
                    flow, sizes = merged[k][held[k]], n[k]
                least = len(place) if before is None else before[rows[k]][:, None]
                kept = (place >= least) & (place < made[k][:, None])
                first = self.start.n
                nodes[rows[k]] = np.arange(first, first + len(sizes))
                self.unit += [units[r] if before is not None else "" for r in rows[k].tolist()]
                self.skips += [skips[r] if skips else () for r in rows[k].tolist()]
                self.before.add(np.zeros(len(sizes), np.int64) if before is None else before[rows[k]])
                for start, count, values, to, size in ((self.start, self.count, path[k][kept], self.span, kept.sum(axis=1)),
                                                       (self.id_start, self.id_count, flow, self.flow, sizes)):
                    start.add(to.n + np.cumsum(size) - size)
                    count.add(size)
                    to.add(values)
                self.child.add(np.full(kept.sum(), -1))
        return nodes

    def _children(self, at: np.ndarray) -> np.ndarray:
        """The nodes reached by skipping the merges ``at`` these places of ``span``; -1 where that is done for the
        first time."""
        new, times = np.unique(at[self.child.all[at] < 0], return_counts=True)
        once = (times == 1) & (self.child.all[new] == -1)
        self.child.all[new[once]] = -2
        new = new[~once]
        if len(new):
            parent = np.searchsorted(self.start.all[:self.start.n], new, side="right") - 1
            units = [self.unit[p] for p in parent.tolist()]
            skips = [(*self.skips[p], s) for p, s in zip(parent.tolist(), self.span.all[new].tolist(), strict=True)]
            before = self.before.all[parent] + new - self.start.all[parent]
            table = np.full((len(new), max(map(len, skips))), 0, np.uint64)  # no merge spans 0 to 0
            for k, s in enumerate(skips):
                table[k, :len(s)] = s

            def skip(rows: np.ndarray, spans: np.ndarray) -> np.ndarray:
                out = np.zeros(spans.shape, bool)
                for column in table[rows].T:
                    out |= spans == column[:, None]
                return out

            nodes = self._add(units, skips, before, skip)  # may move the arrays
            self.child.all[new] = nodes
        return np.maximum(self.child.all[at], -1)

    def _block(self, units: list[str], key: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after another, and how many each has."""
        if len(self.unit) > MEMO or self.flow.n > 16 * MEMO:
            self._forget()
        node = np.fromiter(map(self.memo.get, units, repeat(-1)), np.int64, len(units))
        lacking = np.flatnonzero(node < 0)
        own = [units[i] for i in lacking.tolist()]
        fresh = {u: c for u, c in Counter(own).items() if len(u) <= LONGEST}
        new = [u for u, c in fresh.items() if c > 1 or u in self.once]
        if len(self.once) > ONCE:
            self.once.clear()
        self.once.difference_update(new)
        self.once.update(fresh.keys() - set(new))
        roots = self._add(new, before=np.zeros(len(new), np.int64))
        self.memo.update(zip(new, roots.tolist(), strict=True))
        node[lacking] = np.fromiter(map(self.memo.get, own, repeat(-1)), np.int64, len(own))
        live = np.flatnonzero(node >= 0) if rate > 0 else np.empty(0, np.int64)
        while len(live):
            n = self.count.all[node[live]]
            ends = np.cumsum(n)
            who = np.repeat(np.arange(len(live)), n)
            at = np.arange(len(who)) + np.repeat(self.start.all[node[live]] - ends + n, n)
            hit = np.flatnonzero(_skipped(key[live][who], self.span.all[at], rate))
            hit = hit[np.diff(who[hit], prepend=-1) > 0]  # the first of each occurrence
            live = live[who[hit]]
            node[live] = self._children(at[hit])
            live = live[node[live] >= 0]
        far = np.flatnonzero(node < 0)
        lasting = {g: g.n for g in self._arrays()}, len(self.unit)
        if len(far):
            own, k = [units[i] for i in far.tolist()], key[far]
            node[far] = self._add(own, skip=(lambda rows, spans: _skipped(k[rows][:, None], spans, rate)) if rate > 0 else None)
        n = self.id_count.all[node]
        ids = self.flow.all[np.arange(n.sum()) + np.repeat(self.id_start.all[node] - np.cumsum(n) + n, n)]
        # what was merged by itself is not kept
        for g, size in lasting[0].items():
            g.n = size
        del self.unit[lasting[1]:], self.skips[lasting[1]:]
        return ids, n

    def _with_bytes(self, symbols: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without an id become the bytes of the characters that they stand for; how many each symbol became."""
        odd = symbols >= self.size
        n_chars = self.n_chars[np.where(odd, self.size, symbols)]
        char = points[(np.cumsum(n_chars) - n_chars)[odd]]
        text = char.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        count = np.ones(len(symbols), np.int64)
        count[odd] += (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)
        ids = np.repeat(symbols, count)
        ids[np.repeat(odd, count)] = self.byte[np.frombuffer(text, np.uint8)]
        return ids, count

    def encode(self, text: str, doc_id: int = 0, rate: float = RATE, seed: int = SEED) -> bytes:
        """Ids of a text as little-endian integers of ``dtype``; an empty text has none."""
        return self.encode_all([text], [doc_id], rate, seed)[0]

    def encode_all(self, texts: list[str], doc_ids: list[int], rate: float = RATE, seed: int = SEED) -> list[bytes]:
        """``encode`` of many texts."""
        cut = [_UNIT.findall(" " + t) if t else [] for t in texts]
        units = list(chain.from_iterable(cut))
        if not units:
            return [b""] * len(texts)
        n = np.array([len(c) for c in cut], np.int64)
        size = np.fromiter(map(len, units), np.int64, len(units))
        begin = np.cumsum(size) - size
        begin -= np.repeat(begin[np.minimum(np.cumsum(n) - n, len(units) - 1)], n)  # offset within the text
        key = _mix(np.array(doc_ids, np.int64).astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
        key = _mix(np.repeat(key, n) + begin.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        done = [self._block(units[k:k + BLOCK], key[k:k + BLOCK], rate) for k in range(0, len(units), BLOCK)]
        ids = np.concatenate([d[0] for d in done]).tobytes()
        ends = np.concatenate([[0], np.cumsum(np.concatenate([d[1] for d in done]))]) * self.dtype.itemsize
        ends = ends[np.concatenate([[0], np.cumsum(n)])].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def decode(self, ids: bytes) -> str:
        """The text that was encoded.

        >>> pieces(file("piece_bpe_32k.model")).decode(pieces(file("piece_bpe_32k.model")).encode("a  ▁ b"))
        'a  ▁ b'
        """
        return b"".join([self.bytes[i] for i in np.frombuffer(ids, self.dtype).tolist()])[1:].decode("utf-8", "surrogatepass")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _encoded(path: str, rate: float, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pieces(path)
        for pdf in slices(batches, "text", 2 << 20):
            ids = p.encode_all(pdf["text"].tolist(), pdf["doc_id"].tolist(), rate, seed)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids, "bits": p.dtype.itemsize * 8})
    return run


def _decoded(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pieces(path)
        for pdf in slices(batches, "ids"):
            yield pdf.assign(text=[p.decode(i) for i in pdf["ids"]])
    return run


IDS = "doc_id long, ids binary, bits int"


def encode(docs: DataFrame, model: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, ids, bits of every document: a map, nothing is shuffled. Null texts are empty and have no ids;
    rows with equal ids and texts are cut alike; null ids stay, as ``NO_ID``, and draw by that."""
    prepare(docs.sparkSession)
    return any_id(docs).mapInPandas(_encoded(model, rate, seed), IDS)


def decode(ids: DataFrame, model: str) -> DataFrame:
    """``ids`` with the decoded ``text``."""
    return ids.mapInPandas(_decoded(model), IDS + ", text string")


def _digest(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pieces(path)
        for pdf in slices(batches, "ids"):
            wide = [np.frombuffer(i, p.dtype).astype("<u4") for i in pdf["ids"]]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "n_tokens": [len(w) for w in wide],
                "ids_crc32": [zlib.crc32(w.tobytes()) for w in wide],
                "decoded_sha256": [hashlib.sha256(p.decode(i).encode("utf-8", "surrogatepass")).hexdigest()
                                   for i in pdf["ids"]]})
    return run


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segmentation of every document and the hash of the text that its ids decode to."""
    model = file("piece_bpe_32k.model")
    return null_ids(encode(documents(spark, sf_dir), model).mapInPandas(
        _digest(model), "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string"))
