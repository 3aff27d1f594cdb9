"""Ids of whole texts by a public tokenizer file, with a bounded per-worker memo of the pieces between spaces.

No pre-token of the supported files joins a non-space character to a space that follows it, so a text can be cut
before every run of spaces, each piece encoded alone, and the ids joined. Pieces that the memo lacks are encoded
together: the tokenizer file's own merges are applied to all of them in lockstep, one merge of least rank a piece and
round, which is what the library does piece by piece (tests hold the ids against it). Pieces with anything but plain
Latin text, and special strings, go to the library itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

MEMO = 800_000  # pieces kept by one worker
SEP = "\x00"
NO_SYMBOL = 1 << 30  # in no merge: fills up rows
FEW = 512  # rows of a size that are merged together with shorter ones
LONGEST = 40  # symbols of a pre-token that is merged in lockstep; longer ones go to the library

# Other white space than these four may end a run of spaces in one regex engine and not in another: such texts go
# to the library whole.
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \n\t\r", np.uint8))
_ODD = re.compile("[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f\\u2060\\u3000\\ufeff]")
_LATIN = re.compile("[\n\t\r -~\\xa1-\\u012f\\u0131-\\u024f]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level files: itself where it is printable Latin-1, else the
    next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class PairTable:
    """Merges of symbol pairs as an open-addressed hash table in arrays: pair to rank and merged symbol."""

    def __init__(self, keys: np.ndarray, rank: np.ndarray, made: np.ndarray):
        """keys: left symbol << 32 | right symbol, each once."""
        self.bits = max(10, int(8 * len(keys)).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.zeros(1 << self.bits, np.int64)
        self.made = np.zeros(1 << self.bits, np.int64)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.key[at[todo]] == -1]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.key[at[put]], self.rank[at[put]], self.made[at[put]] = keys[put], rank[put], made[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair's merge, -1 where the pair has none."""
        keys = left << 32 | right
        at = self._slot(keys)
        got = self.key[at]
        out = np.where(got == keys, at, -1)
        todo = np.flatnonzero((got != keys) & (got != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            got = self.key[at[todo]]
            hit = got == keys[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit & (got != -1)]
        return out

    def merge(self, sym: np.ndarray, skip=None, path: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Merge rows of equally many symbols (not negative): in each round every row takes its merge of least rank,
        leftmost on ties. ``skip(rows, begins, ends)`` may rule out candidates by the places they span. Returns the
        rows, each filled up to its count of symbols, and the counts; ``path``, of the shape of ``sym``, receives
        begin << 32 | end of each row's merges in their order."""
        sym = sym.copy()
        n = np.full(len(sym), sym.shape[1])
        live, cur, none = np.arange(len(sym)), sym.copy(), np.int64(1 << 40)
        placed = skip is not None or path is not None
        begin = np.tile(np.arange(sym.shape[1] + 1), (len(sym), 1)) if placed else None
        while cur.shape[1] > 1 and len(live):
            slot = self.find(cur[:, :-1].ravel(), cur[:, 1:].ravel()).reshape(len(live), -1)
            rank = np.where(slot >= 0, self.rank[slot], none)
            if skip:
                rank[skip(live, begin[:, :-2], begin[:, 2:])] = none
            p = rank.argmin(axis=1)
            go = rank[np.arange(len(live)), p] < none
            sym[live[~go], :cur.shape[1]] = cur[~go]
            live, cur, p, slot = live[go], cur[go], p[go], slot[go]
            row = np.arange(len(live))
            cur[row, p] = self.made[slot[row, p]]
            if path is not None:
                own = begin[go]
                path[live, sym.shape[1] - n[live]] = own[row, p] << 32 | own[row, p + 2]
            n[live] -= 1
            keep = np.ones((len(live), cur.shape[1] + 1), bool)  # a row loses one symbol a round
            keep[row, p + 1] = False
            if placed:
                begin = begin[go][keep].reshape(len(live), cur.shape[1])
            cur = cur[keep[:, :-1]].reshape(len(live), cur.shape[1] - 1)
        if len(live):
            sym[live, :cur.shape[1]] = cur
        return sym, n


class Merges:
    """What a tokenizer file says about pre-tokens and merges."""

    def __init__(self, spec: dict):
        import regex

        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        kinds = json.dumps(spec.get("pre_tokenizer"))
        split = re.search(r'"Regex": "((?:[^"\\]|\\.)*)"', kinds)
        # FIXED VALUE: the byte-level pre-token pattern, where the file gives none of its own
        own = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        pattern = json.loads(f'"{split[1]}"') if split else own
        # pieces are cut together, with SEP between them
        self.pattern = regex.compile(SEP + "|" + pattern.replace(r"[^\s", r"[^\x00\s"))
        self.lower = "Lowercase" in json.dumps(spec.get("normalizer"))
        symbols = byte_symbols()
        self.inner = np.array([vocab.get(s, -1) for s in symbols], np.int64)
        self.last = np.array([vocab.get(s + end, -1) for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.table = PairTable(np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64),
                               np.arange(len(pairs)), np.array([vocab[a + b] for a, b in pairs], np.int64))

    def encode(self, words: list[bytes], dtype: np.dtype) -> list[bytes]:
        """Ids of pre-tokens given as UTF-8, each of 1 to ``LONGEST`` bytes."""
        out: list[bytes] = [b""] * len(words)
        for rows in same_size([len(w) for w in words]):
            raw = np.frombuffer(b"".join([words[r] for r in rows]), np.uint8).reshape(len(rows), -1)
            sym = self.inner[raw]
            sym[:, -1] = self.last[raw[:, -1]]
            for r, own in zip(rows.tolist(), cut_rows(*self.table.merge(sym), dtype), strict=True):
                out[r] = own
        return out


def same_size(sizes: list[int]) -> list[np.ndarray]:
    """Indices grouped by size."""
    size = np.array(sizes, np.int64)
    order = np.argsort(size, kind="stable")
    return [g for g in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(g)]


def like_size(sizes: list[int]) -> list[np.ndarray]:
    """Indices grouped by size, longest first; where a size has few, shorter ones join it, down to two thirds."""
    groups: list[np.ndarray] = []
    for g in reversed(same_size(sizes)):
        if groups and len(groups[-1]) < FEW and 3 * sizes[g[0]] >= 2 * sizes[groups[-1][0]]:
            groups[-1] = np.concatenate([groups[-1], g])
        else:
            groups.append(g)
    return groups


def cut_rows(sym: np.ndarray, n: np.ndarray, dtype: np.dtype) -> list[bytes]:
    """The first ``n`` symbols of each row as bytes."""
    flow = sym[np.arange(sym.shape[1]) < n[:, None]].astype(dtype).tobytes()
    ends = (np.cumsum(n) * np.dtype(dtype).itemsize).tolist()
    return [flow[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        small = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.dtype = np.dtype("<u2") if small else np.dtype("<u4")
        self.memo: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        m = self.merges
        far = [p for p in pieces if len(p) > LONGEST // 2 or p.isspace() or not _LATIN.fullmatch(p)
               or "<" in p and self.special.search(p)]
        if far:
            self.memo.update(zip(far, self._library(far), strict=True))
            pieces = list(set(pieces).difference(far))
        if not pieces:
            return
        text = SEP.join(pieces) + SEP
        flat = m.pattern.findall(text.lower() if m.lower else text)
        words = list(set(flat) - {SEP})
        known = dict(zip(words, m.encode([w.encode() for w in words], self.dtype), strict=True)) | {SEP: b""}
        ids = [known[w] for w in flat]
        ends = np.cumsum([len(x) for x in ids])[[w == SEP for w in flat]].tolist()
        ids = b"".join(ids)
        self.memo.update(zip(pieces, (ids[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))

    def _pieces(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts in a row, cut before every run of spaces, and the number of pieces before each text
        and in all."""
        if self.merges.lower:
            texts = [t.lower() if t.isascii() or _LATIN.fullmatch(t) else t for t in texts]
        raw = [t.encode() for t in texts]
        begin = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        space = _SPACE[data]
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[begin[:-1][begin[:-1] < begin[1:]]] = True
        at = np.flatnonzero(first)
        offsets = pa.py_buffer(np.append(at, len(data)).astype(np.int64))
        return (pa.Array.from_buffers(pa.large_string(), len(at), [None, offsets, pa.py_buffer(data)]),
                np.searchsorted(at, begin))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``dtype``."""
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        odd = [i for i, t in enumerate(texts) if _ODD.search(t)]
        whole = dict(zip(odd, self._library([texts[i] for i in odd]), strict=True))
        pieces, before = self._pieces(["" if i in whole else t for i, t in enumerate(texts)])
        # each distinct piece is looked up once; its ids are then taken to all its places
        cut = pieces.dictionary_encode()
        distinct = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.merges.lower:
            # a file that lower-cases and drops white space: words alone, and fewer of them
            distinct = [p.strip() for p in distinct]
        own = list(map(memo.get, distinct))
        if new := [k for k, known in enumerate(own) if known is None]:
            self._learn(list({distinct[k] for k in new}))
            for k in new:
                own[k] = memo[distinct[k]]
        ids = pa.array(own, pa.large_binary()).take(cut.indices)
        _, ends, flow = ids.buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1)[before].tolist() if len(ids) else [0] * (len(texts) + 1)
        flow = memoryview(flow) if flow else b""
        return [whole[i] if i in whole else bytes(flow[a:b])
                for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """One encoder for each file and worker."""
    return PieceEncoder(path)


def file(name: str) -> str:
    """The place of a public tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)
