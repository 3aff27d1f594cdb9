"""Exact token counts at every prefix of a text, for a byte-level BPE tokenizer file.

``table[i]`` is the number of tokens that the library gives for the first ``i`` code points. Cutting a text to a
budget, or asking what any prefix costs, is then a look-up.

Within a pre-token the table is a dynamic program over its prefixes: BPE encodings are closed under cutting off the
last token, so the encoding of a prefix is that of a shorter prefix plus one vocabulary token that ends here, and it
is the one whose pair with the token before it would not have merged otherwise. The rules that look ahead (the last
space of a run joins the next word; 're, 've, 'll) change the cut at some prefixes; ``_unit`` counts those prefixes as
the library would cut them.

The table is stored as one signed byte a code point, the change against the prefix before (zlib-packed).
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import NO_ID, any_id, null_ids, prepare, slices, written
from tandem.llm.tokens import byte_symbols, file

MEMO = 400_000
LIMIT = 1024

# FIXED VALUES: the pre-token pattern of the byte-level tokenizer file
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# a unit: a run of white space with the pre-token after it; units never share a pre-token
_UNIT = r"(?:\s*[^\S ])?(?:'s|'t|'re|'ve|'m|'ll|'d)|\s*(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s+"


class PrefixCounter:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): r
                     for r, m in enumerate(spec["model"]["merges"])}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.char = dict(enumerate(byte_symbols()))
        self.ends = ahocorasick.Automaton()
        for t in spec["model"]["vocab"]:
            self.ends.add_word(t, t)
        self.ends.make_automaton()
        self.units = regex.compile(_UNIT)
        self.split_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.apart: dict[tuple[str, str], bool] = {}
        self.alone: dict[str, bool] = {}
        self.memo: dict[str, bytes] = {}

    def _bpe(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            r, i = min((self.rank.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if r == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _stays_apart(self, left: str, right: str) -> bool:
        if (left, right) not in self.apart:
            if len(self.apart) > MEMO:
                self.apart.clear()
            self.apart[left, right] = self._bpe(left + right) == [left, right]
        return self.apart[left, right]

    def _prefixes(self, text: str) -> list[int]:
        """Token count of every code-point prefix of one pre-token, the empty one first."""
        data = text.encode("utf-8", "surrogatepass")
        symbols = data.decode("latin-1").translate(self.char)
        count, last = [0] * (len(symbols) + 1), [""] * (len(symbols) + 1)
        apart, spare = self.apart, self.alone
        found = -1
        for end, token in self.ends.iter(symbols):  # by end, longest first
            if end == found:
                continue
            at = end + 1 - len(token)
            if at:
                pair = (last[at], token)
                fits = apart[pair] if pair in apart else self._stays_apart(*pair)
            else:
                fits = spare[token] if token in spare else self._stays_whole(token)
            if fits:
                count[end + 1], last[end + 1], found = count[at] + 1, token, end
        if len(data) == len(text):
            return count
        ends = [0]
        for c in text:
            ends.append(ends[-1] + len(c.encode("utf-8", "surrogatepass")))
        return [count[e] for e in ends]

    def _stays_whole(self, token: str) -> bool:
        self.alone[token] = self._bpe(token) == [token]
        return self.alone[token]

    def _unit(self, unit: str) -> list[int]:
        """Token counts of the prefixes of white space plus one pre-token, without the empty one."""
        word = unit.lstrip()
        k = len(unit) - len(word)
        if not word or not k:
            counts = self._prefixes(unit)[1:]
            if len(unit) == 3 and unit in CONTRACTIONS:  # 'r is cut as ' and r
                counts[1] = self._prefixes(unit[0])[-1] + self._prefixes(unit[1])[-1]
            return counts
        if unit[k - 1] == " ":  # the last space joins the word
            joined = self._prefixes(" " + word)
            if k == 1:
                return joined[1:]
            run = self._prefixes(unit[:k])
            return run[1:] + [run[k - 1] + c for c in joined[2:]]
        run = self._prefixes(unit[:k])
        base = run[k - 1] + self._prefixes(unit[k - 1])[-1] if k > 1 else run[k]
        return run[1:] + [base + c for c in self._unit(word)]

    def _plain(self, text: str) -> bytes:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        units = self.units.findall(text)
        for u in set(units).difference(memo):
            before, own = 0, bytearray()
            for c in self._unit(u):
                own.append((c - before) & 255)
                before = c
            memo[u] = bytes(own)
        return b"".join(map(memo.__getitem__, units))

    def changes(self, text: str) -> bytes:
        """One signed byte a code point: tokens of the prefix that ends there less tokens of the one before."""
        if not self.split_special or not (found := list(self.split_special.finditer(text))):
            return self._plain(text)
        out, at = [], 0
        for m in found:  # a special string counts one token once it is whole, and is ordinary text until then
            seg = text[at:m.start()]
            before = np.frombuffer(self._plain(seg), np.int8)
            almost = np.frombuffer(self._plain(text[at:m.end() - 1]), np.int8).astype(np.int64)
            last = int(before.sum(dtype=np.int64)) + 1 - int(almost.sum())
            out += [almost.astype(np.int8).tobytes(), np.array([last], np.int8).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])


def prefix_counts(changes: bytes) -> np.ndarray:
    """The table of a text from its stored changes; entry 0 is the empty prefix."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)])


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix that costs at most ``budget`` tokens."""
    return int(np.flatnonzero(table <= budget)[-1])


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def _tables(path: str, limit: int, with_table: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(path)
        for pdf in slices(batches, "text"):
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                changes = c.changes(text)
                n = int(np.frombuffer(changes, np.int8).sum(dtype=np.int64))
                row = (doc, len(text.encode("utf-8", "surrogatepass")), n)
                if with_table:
                    row += (longest_prefix(prefix_counts(changes), limit), zlib.compress(changes, 1))
                else:
                    row += (len(text) if n <= limit else longest_prefix(prefix_counts(changes), limit),)
                out.append(row)
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_tokens", "fits"] + ["changes"] * with_table)
    return run


def count_prefixes(docs: DataFrame, tokenizer: str, limit: int = LIMIT, with_table: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, fits (code points of the longest prefix of at most ``limit`` tokens) and the packed
    table ``changes``. A map over the documents: nothing is shuffled. Null texts are empty (0 tokens), null ids and
    repeated rows stay."""
    prepare(docs.sparkSession)
    schema = "doc_id long, n_bytes long, n_tokens long, fits long" + (", changes binary" if with_table else "")
    return null_ids(any_id(docs).mapInPandas(_tables(tokenizer, limit, with_table), schema))


def _read(limit: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, "changes"):
            tables = (prefix_counts(zlib.decompress(c)) for c in pdf["changes"])
            out = [(int(t[-1]), longest_prefix(t, limit)) for t in tables]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["n_bytes"],
                                "n_tokens": [n for n, _ in out], "fits": [f for _, f in out]})
    return run


def read_tables(stored: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, fits of stored tables: the last two are read off ``changes`` alone."""
    rows = stored.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_bytes", "changes")
    return null_ids(rows.mapInPandas(_read(limit), "doc_id long, n_bytes long, n_tokens long, fits long"))


def op10_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fits, read off the stored prefix tables of all documents."""
    from tandem.llm.common import documents

    counts = read_tables(written(count_prefixes(documents(spark, sf_dir), file("byte_bpe_50k.json")), "prefix-tables"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fits")
