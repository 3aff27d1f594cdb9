"""Removal of long repeated byte strings with run-length indexes.

1. Anchors. Each window of ``LENGTH`` bytes names one anchor, its least ``GRAM``-byte hash (leftmost on ties). Equal
   windows name equal anchors, so only anchors whose hash occurs in two documents can lie in a repeat. A hash is
   checked by one window function over (hash, document) pairs.
2. Contexts. Around each such anchor, the bytes of all windows that name it (at most 2 * LENGTH - GRAM of them) go to a
   bucket of the hash. All equal windows of the corpus meet in one bucket, whatever documents they are in.
3. Index. A bucket's distinct contexts of anchors with two of them or more, which by construction repeat each other,
   become run-compressed Burrows-Wheeler transforms with text positions sampled at the run ends (``RunIndex``), those of
   an anchor always the same one. A context that no other shares its anchor with repeats only as a whole. Only at run
   heads is the match with the suffix before compared byte by byte; along each text the match length of the next
   position follows from the last sample (it shrinks by one), so all matching statistics stream off the samples.
4. Marks. Rows whose matches reach LENGTH bytes form classes of equal windows; a window is removed in every document
   but the smallest of its class.

A context has few bytes however long its document is; buckets grow in number with the corpus, not in size; copies of a
context are one text of the index with a list of places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.llm.common import documents, id_text, prepare, slices, unused, with_texts

LENGTH = 50
GRAM = 16
LOW = np.uint64(24)  # low bits of a hash that are not sent; a false match only costs a look
HASH = np.uint64((1 << 64) - 1) >> LOW << LOW
PIECE = 1 << 18  # characters worked on at a time: the arrays stay in a core's cache
BUCKET_CHARS = 4 << 20  # bytes of the corpus for each bucket
PLACES = 1 << int(LOW)  # numbers that fit beside a hash
INDEX_BYTES = 1 << 17  # bytes of contexts that go to one index: its arrays stay in a core's cache


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on; ``gram`` is a power of two."""
    if gram >= 8:  # eight bytes are read as one number
        h, step = _mix(np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), 0, (1,)), np.uint64(gram)), 8
    else:
        h, step = data.astype(np.uint64) + np.uint64(1), 1
    while step < gram:
        h = _mix(h[:-step], h[step:])
        step *= 2
    return h


def _anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """What ``anchors`` gives and the place of each anchor. A hash and its place are one number, so the least of such
    numbers is the least hash, leftmost on ties."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none, none
    if len(data) > PLACES:  # windows in parts; an anchor between two parts is named in both
        parts = []
        for lo in range(0, len(data) - length + 1, PLACES // 2):
            part = data[lo:lo + PLACES // 2 + length - 1]
            key, first, last, doc, at = _anchors(part, np.clip(ends - lo, 0, len(part)), length, gram)
            parts.append((key, first + lo, last + lo, doc, at + lo))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    best = _grams(data, gram) & HASH
    best |= np.arange(len(best), dtype=np.uint64)
    have, width = 1, length - gram + 1
    while have < width:  # the least of the next ``have`` places
        go = min(have, width - have)
        best = np.minimum(best[:len(best) - go], best[go:])
        have += go
    new = np.ones(len(best) + 1, bool)
    np.not_equal(best[1:], best[:-1], out=new[1:-1])
    begin = np.concatenate([[0], ends[:-1]])
    long = ends - begin >= length
    new[begin[long]] = new[ends[long] - length + 1] = True
    edge = np.flatnonzero(new)
    first, last = edge[:-1], edge[1:] - 1
    doc = np.searchsorted(ends, first, side="right")
    ok = first + length <= ends[doc]
    first, last, doc = first[ok], last[ok], doc[ok]
    return best[first] & HASH, first, last, doc, (best[first] & ~HASH).astype(np.int64)


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(hash, first window, last window, document) of each anchor; ``data`` holds documents that end at ``ends``.

    ``gram`` is a power of two. Windows never cross documents.
    """
    return _anchors(data, ends, length, gram)[:4]


def _pairs(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A document's number, below ``PLACES``, and a hash as one number."""
    return doc.astype(np.uint64) << (np.uint64(64) - LOW) | key >> LOW


def _grouped(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of fewer than ``PLACES`` rows."""
    for pdf in batches:
        for lo in range(0, len(pdf), PLACES - 1):
            yield pdf.iloc[lo:lo + PLACES - 1]


def _keys(length: int, gram: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(hash, document) pairs, each once for a document."""
        for pdf in slices(_short(batches), "text", PIECE):
            key, _, _, doc = anchors(*_grouped([t.encode("utf-8", "surrogatepass") for t in pdf["text"]]), length, gram)
            pair = np.sort(_pairs(doc, key))
            pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])[:len(pair)]]
            yield pd.DataFrame({"key": (pair << LOW).view(np.int64),
                                "doc_id": pdf["doc_id"].to_numpy()[(pair >> (np.uint64(64) - LOW)).astype(np.int64)]})
    return run


CONTEXTS = "bucket long, places binary, ctx binary"
PLACE = np.dtype([("doc", "<i8"), ("start", "<i8"), ("size", "<i4"), ("th", "<i4"), ("gram", "<i4")])


def _contexts(length: int, gram: int, buckets: int):
    def found(part: pd.DataFrame):
        """Buckets, places and bytes of the contexts of a piece."""
        data, ends = _grouped([t.encode("utf-8", "surrogatepass") for t in part["text"]])
        key, first, last, doc, at = _anchors(data, ends, length, gram)
        of = np.repeat(np.arange(len(part)), [len(k) for k in part["keys"]])
        wanted = np.concatenate([np.asarray(k, np.int64) for k in part["keys"]]).view(np.uint64)
        hit = np.flatnonzero(np.isin(_pairs(doc, key), _pairs(of, wanted)))
        key, first, last, doc, at = key[hit], first[hit], last[hit], doc[hit], at[hit]
        places = np.zeros(len(hit), PLACE)
        places["doc"], places["th"] = part["doc_id"].to_numpy()[doc], part["th"].to_numpy()[doc]
        places["start"] = first - np.concatenate([[0], ends[:-1]])[doc]
        places["size"] = last + length - first
        places["gram"] = at - first
        flow = data.tobytes()
        ctx = [flow[f:e] for f, e in zip(first.tolist(), (last + length).tolist(), strict=True)]
        return ((key >> LOW) % np.uint64(buckets)).astype(np.int64), places, ctx

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(_short(batches), "text"):
            parts = [found(part) for part in slices(iter([pdf]), "text", PIECE)]
            bucket, places = (np.concatenate([p[k] for p in parts]) for k in range(2))
            ctx = [c for p in parts for c in p[2]]
            order = np.argsort(bucket, kind="stable")
            bucket, places = bucket[order], places[order]
            ctx = [ctx[k] for k in order.tolist()]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            yield pd.DataFrame([(int(bucket[a]), _packed(places[a:b]), _squeezed(b"".join(ctx[a:b])))
                                for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(ctx)], strict=True) if a < b],
                               columns=[c.split()[0] for c in CONTEXTS.split(", ")])
    return run


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _expanded(data: bytes) -> bytes:
    return pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _packed(places: np.ndarray) -> bytes:
    """Places of contexts, column by column, so that like bytes stand together."""
    return _squeezed(b"".join(places[f].tobytes() for f in PLACE.names))


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    data, at, out = _expanded(data), 0, {}
    n = len(data) // PLACE.itemsize
    for f in PLACE.names:
        out[f] = np.frombuffer(data, PLACE[f], n, at)
        at += n * PLACE[f].itemsize
    return out


class RunIndex:
    """Run-length Burrows-Wheeler transform of a set of texts, each closed by an end sign of its own.

    ``symbol`` and ``size`` describe the runs, ``sample`` has the text position at each run's head and ``end`` at its
    last row. ``order`` (the rows) is kept while the index is being read off.
    """

    def __init__(self, texts: list[bytes]):
        self.size_of = np.array([len(t) for t in texts])
        self.ends = np.cumsum(self.size_of + 1)
        self.begin = self.ends - self.size_of - 1
        self.text = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.int16) + 1
        self.text[self.ends - 1] = 0
        n = len(self.text)
        self.owner = np.repeat(np.arange(len(texts)), self.size_of + 1)
        self.left = self.ends[self.owner] - 1 - np.arange(n)  # bytes from a position to its text's end
        self.order = self._sorted(int(self.left.max(initial=0)))
        # equal end signs stand for different ones, in the order of their texts
        before = np.where(self.order == self.begin[self.owner[self.order]], -1 - self.owner[self.order],
                          self.text[self.order - 1])
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]])) if n else np.zeros(0, np.int64)
        self.symbol, self.size = before[heads], np.diff(np.append(heads, n))
        self.head, self.sample = heads, self.order[heads]
        self.end = self.order[np.append(heads[1:], n) - 1] if n else self.order

    def _sorted(self, longest: int) -> np.ndarray:
        """All suffixes in order, exhausted ones by text: some symbols at once, then by doubling.

        A number that holds the sort key and, in its low bits, the position is sorted as it is, which is several times
        faster than an index sort; texts too long for that are index-sorted.
        """
        n = len(self.text)
        codes = np.zeros(int(self.text.max(initial=0)) + 1, np.int64)
        codes[np.unique(self.text)] = np.arange(len(np.unique(self.text)))
        width, low = int(codes.max(initial=1)).bit_length(), max(1, n - 1).bit_length()
        depth = max(1, (63 - low) // width)
        code, rank = codes[self.text], np.zeros(n, np.int64)
        for k in range(depth):
            sym = np.zeros(n, np.int64)
            sym[:n - k] = code[k:] if k < n else 0
            rank = rank << width | np.where(self.left >= k, sym, 0)
        packed = 3 * (n + 1).bit_length() <= 63
        at = np.arange(n)
        while True:
            if packed:
                both = np.sort(rank << low | at)
                order, sorted_ = both & ((1 << low) - 1), both >> low
            else:
                order = np.argsort(rank, kind="stable")
                sorted_ = rank[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]])) if n else rank
            if depth > longest or not n or rank[order[-1]] == n - 1:
                return order
            nxt = np.zeros(n, np.int64)
            nxt[:n - depth] = rank[depth:] + 1
            rank = rank * (n + 1) + np.where(self.left >= depth, nxt, 0)
            packed = (n * (n + 1) + n).bit_length() + low <= 63
            depth *= 2

    def statistics(self) -> np.ndarray:
        """For each text position the bytes that its suffix shares with the suffix in the row before."""
        n = len(self.text)
        at = np.full(n, -1, np.int64)
        rows = self.head[1:]
        p, q = self.order[rows], self.order[rows - 1]
        words = np.ndarray(n, "<u8", np.concatenate([self.text - 1, np.zeros(8)]).astype(np.uint8), 0, (1,))
        for lo in range(0, len(p), 1 << 15):  # only run heads are compared, eight bytes at a time
            a, b = p[lo:lo + (1 << 15)], q[lo:lo + (1 << 15)]
            most = np.minimum(self.left[a], self.left[b])
            same = most.copy()
            live, k = np.flatnonzero(most), 0
            while len(live):
                other = words[a[live] + k] ^ words[b[live] + k]
                ends = other != 0
                here, other = live[ends], other[ends]
                same[here] = np.minimum(most[here], k + (np.bitwise_count((other & (~other + np.uint64(1))) - np.uint64(1)) >> 3))
                k += 8
                live = live[~ends]
                live = live[most[live] > k]
            at[a] = same
        if n:
            at[self.order[0]] = 0
        given = np.flatnonzero(at >= 0)
        reach = np.zeros(n, np.int64)
        reach[given] = at[given] + given
        # within a run each next position shares one byte less than the one before it
        last = np.maximum.accumulate(np.where(at >= 0, np.arange(n), 0))
        return np.maximum(0, reach[last] - np.arange(n))

    def classes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose suffixes have ``length`` bytes or more, and the class of equal beginnings of each."""
        shared = self.statistics()[self.order]
        long = self.left[self.order] >= length
        return np.flatnonzero(long), np.cumsum(shared < length)[long]


def _first_documents(texts: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``length`` bytes, text by text, the smallest document of its class, and each text's first
    window; ``least`` has the smallest document of a text."""
    index = RunIndex(texts)
    rows, cls = index.classes(length)
    place = index.order[rows]
    first_doc = np.full(int(cls.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(first_doc, cls, least[index.owner[place]])
    window = np.empty(len(index.text), np.int64)
    window[place] = first_doc[cls]
    count = index.size_of - length + 1
    begin = np.cumsum(count) - count
    return window[index.left >= length], begin


def _marks(length: int, gram: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids: dict[bytes, int] = {}
        families: dict[bytes, int] = {}
        of, family, places = [], [], []
        for r in pdf.itertuples():
            flow, at = _expanded(r.ctx), 0
            places.append(_unpacked(r.places))
            for n, g in zip(places[-1]["size"].tolist(), places[-1]["gram"].tolist(), strict=True):
                text = flow[at:at + n]
                k = ids.setdefault(text, len(ids))
                if k == len(family):
                    family.append(families.setdefault(text[g:g + gram], len(families)))
                of.append(k)
                at += n
        of, family, texts = np.array(of), np.array(family), list(ids)
        doc, start, th = (np.concatenate([p[f] for p in places]) for f in ("doc", "start", "th"))
        least = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(least, of, doc)
        # equal windows name equal anchors: a context that no other shares its anchor with has all its windows to itself,
        # and contexts with different anchors may go to different indexes
        low, high = least.copy(), least.copy()
        size = np.array([len(t) for t in texts])
        met = np.flatnonzero(np.bincount(family)[family] > 1)
        met = met[np.argsort(family[met], kind="stable")]
        spans = [np.zeros((0, 4), np.int64)]
        slot, base, windows = np.full(len(texts), -1), 0, []
        new = np.flatnonzero(np.diff(family[met], prepend=-1))
        fill = np.cumsum(size[met])
        at = 0
        while at < len(met):
            to = int(np.searchsorted(fill, (fill[at - 1] if at else 0) + INDEX_BYTES, side="right"))
            k = int(np.searchsorted(new, to, side="right")) - 1  # whole families, one at least
            to = len(met) if to >= len(met) else int(new[k]) if new[k] > at else int(new[k + 1]) if k + 1 < len(new) else len(met)
            some = met[at:to]
            window, begin = _first_documents([texts[k] for k in some.tolist()], least[some], length)
            low[some], high[some] = np.minimum.reduceat(window, begin), np.maximum.reduceat(window, begin)
            slot[some] = base + begin
            base += len(window)
            windows.append(window)
            at = to
        # most contexts repeat as a whole: all of their windows have one smallest document
        whole = high[of] < doc
        spans.append(np.stack([doc[whole], th[whole], start[whole], start[whole] + size[of[whole]]], axis=1))
        some = np.flatnonzero(~whole & (low[of] < doc))
        if len(some):
            window = np.concatenate(windows)
            count = size[of[some]] - length + 1
            row = np.repeat(np.arange(len(some)), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            gone = window[slot[of[some]][row] + step] < doc[some][row]
            row, step = row[gone], step[gone]
            cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(step) > 1)) + 1
            a, b = np.concatenate([[0], cut]), np.append(cut, len(row)) - 1
            at = some[row[a]]
            spans.append(np.stack([doc[at], th[at], start[at] + step[a], start[at] + step[b] + length], axis=1))
        return pd.DataFrame(np.concatenate(spans), columns=["doc_id", "th", "begin", "stop"])
    return run


def _split(data: bytes, spans, th: int) -> tuple[int, bytes]:
    """Maximal runs of the row's spans and the bytes outside of them."""
    merged: list[list[int]] = []
    for a, b in sorted((int(s["begin"]), int(s["stop"])) for s in spans if s["th"] == th) if spans is not None else ():
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept, at = [], 0
    for a, b in merged:
        kept.append(data[at:a])
        at = b
    return len(merged), b"".join([*kept, data[at:]])


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in slices(batches, "text"):
        rows = []
        for doc, text, th, spans in zip(pdf["doc_id"], pdf["text"], pdf["th"], pdf["spans"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            n, kept = _split(data, spans, th)
            rows.append((doc, len(data), len(data) - len(kept), n, kept))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(kept_sha256=[hashlib.sha256(k).hexdigest() for k in pdf["kept"]]).drop(columns="kept")


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text, which tells rows of one doc_id apart."""
    return id_text(docs).where("doc_id is not null").withColumn("th", F.hash("text"))


def _spans(rows: DataFrame, length: int, gram: int, bucket_chars: int) -> DataFrame:
    """doc_id, spans: byte ranges, overlapping, that cover what is to be removed, with the hash of the row's text."""
    prepare(rows.sparkSession)
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-int(chars) // bucket_chars))
    by_key = Window.partitionBy("key")
    shared = (rows.mapInPandas(_keys(length, gram), "key long, doc_id long")
              .withColumn("least", F.min("doc_id").over(by_key)).withColumn("most", F.max("doc_id").over(by_key))
              .where("least < most"))
    wanted = shared.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    contexts = rows.join(wanted, "doc_id").select("doc_id", "th", "text", "keys").mapInPandas(
        _contexts(length, gram, buckets), CONTEXTS)
    marks = contexts.groupBy("bucket").applyInPandas(_marks(length, gram), "doc_id long, th int, begin long, stop long")
    # dealt before they are collected: as plain rows, not as a list for each mark
    return marks.repartition("doc_id").groupBy("doc_id").agg(F.collect_list(F.struct("th", "begin", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes of each document: every byte
    covered by a ``length``-byte string that also starts in a document of smaller ``doc_id`` is removed.

    Strings are judged on the input. Null texts are empty; rows without a ``doc_id`` take no part; rows that share a
    ``doc_id`` do not repeat each other, and each is one result row.
    """
    rows = _keyed(docs)
    spans = _spans(rows, length, gram, bucket_chars)
    return rows.join(spans, "doc_id", "left").select("doc_id", "text", "th", "spans").mapInPandas(_removed, REMOVED)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``docs`` with the texts that ``remove_repeats`` keeps, and ``n_chars``, if there, to match; other columns and
    rows without a ``doc_id`` or text stay as they are. What a cut leaves of a character of several bytes is dropped."""
    spans = _spans(_keyed(docs), length, gram, bucket_chars)
    own_id, text_hash, found = (unused(c, docs.columns) for c in ("id_of", "text_hash", "spans_of"))

    def change(batch) -> list[str | None]:
        columns = [batch.column(c).to_pylist() for c in ("text", text_hash, found)]
        return [t if s is None or t is None else
                _split(t.encode("utf-8", "surrogatepass"), s, h)[1].decode("utf-8", "ignore")
                for t, h, s in zip(*columns, strict=True)]

    at = docs.withColumns({own_id: F.col("doc_id").cast("long"), text_hash: F.hash(F.coalesce("text", F.lit("")))})
    joined = at.join(spans.select(F.col("doc_id").alias(own_id), F.col("spans").alias(found)), own_id, "left")
    return with_texts(joined.select(*docs.columns, text_hash, found), change, (text_hash, found))


def op2_run_length_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).mapInPandas(
        _hashed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
