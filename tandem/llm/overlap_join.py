"""N-gram Jaccard self-join by T-occurrence search.

1. A document's set is its distinct word shingles as 64-bit hashes. Documents with equal sets form a class (a second
   64-bit hash keeps unequal sets apart); only one of each, the smallest id, is joined.
2. Two sets that link differ in at most H elements, H following from the size. Elements are dealt to more than H + 1 parts
   by hash, and the hashes of the H + 1 fullest are a set's keys: linked sets have one of them in common.
3. Sets under one key are held against each other by sketches (the parity of the elements in each of about n cells): two
   sets differ in at least as many elements as their sketches do in cells, so pairs beyond H are ruled out for certain.
   What the others connect is a family; everything that can link lies in one.
4. Within a family a T-occurrence search finds the partners of each set: inverted lists of its elements, the long ones
   set aside, the short ones merged, and candidates with enough occurrences probed in the long ones by binary search
   (DivideSkip). Families beyond ``BLOCK`` elements are cut into blocks, and each pair of blocks is one task's work.
   Candidates already connected to the query are skipped, so a task reports a spanning forest, not all pairs.
5. Links make components; classes carry them to their documents.

Texts are only read; shuffled are part hashes (about two fifths of the elements), sketches (a bit an element) of sets that
share one, and whole sets of family members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.llm.common import documents, id_text, prepare, slices, small, written
from tandem.llm.components import components

BLOCK = 1 << 18  # elements of a block of a family
MEMO = 500_000
SPARE = 0.3  # parts beyond H + 1, as a share of them: the emptiest are no keys
HELD = 4096  # sets under one key up to which sketches are held against each other; beyond, all are one family
PROBES = 64  # long lists probed at a time
MERGE = 12  # entries merged in the time of one binary probe


class Shingles:
    """Sorted 64-bit hashes of the distinct word shingles of a text; A-Z count as a-z, words end at ASCII space."""

    def __init__(self, width: int):
        self.width, self.memo = width, {}

    def __call__(self, text: str) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        words = text.encode("utf-8", "surrogatepass").lower().split()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        n = min(self.width, len(h))
        if not n:
            return h
        x = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):  # mixed after each word, so that order counts
            x = (x ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(x ^ (x >> np.uint64(32)))


def _levels(most: int, num: int, den: int) -> np.ndarray:
    """Upper sizes of the levels: sets that link are in one level or in neighbouring ones."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * den // num))
    return np.array(out)


def _mixed(s: np.ndarray) -> np.ndarray:
    mixed = (s ^ (s >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def part_hashes(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set such that sets with Jaccard >= num / den share one.

    For its own level and the next: |a ^ b| <= (1 - j) / (1 + j) * (|a| + |b|) =: H, and neither is larger than the
    level's upper size, so of H + 1 + r parts at least r + 1 are equal in both (empty ones count). Of two sets with r + 1
    of their parts in common, one is among the H + 1 first of both in any order that depends on the part alone; here the
    fullest come first, because parts of one or two elements are shared by many sets that do not link.
    """
    n = len(s)
    if not n:
        return np.zeros(0, np.uint64)
    sizes = _levels(n, num, den)
    level = int(np.searchsorted(sizes, n))
    above = max(int(sizes[level]) + 1, int(sizes[level]) * den // num)
    mixed = _mixed(s)
    own, out = mixed * (mixed | np.uint64(1)), []
    for k, upper in ((level, int(sizes[level])), (level + 1, above)):
        keep = (den - num) * 2 * upper // (den + num) + 1
        parts = keep + int(SPARE * keep)
        part = ((mixed >> np.uint64(11)) % np.uint64(parts)).astype(np.int64)
        total = np.zeros(parts, np.uint64)
        np.add.at(total, part, own)
        key = total + (np.arange(parts).astype(np.uint64) * np.uint64(1_000_003) + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        key = (key ^ (key >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        key ^= key >> np.uint64(31)
        if parts > keep:
            key = key[np.lexsort((key, -np.bincount(part, minlength=parts)))[:keep]]
        out.append(key)
    return np.concatenate(out)


def sketch(s: np.ndarray) -> bytes:
    """The parity of a set's elements in each of its cells: the power of two from its size on, 64 at least."""
    cells = max(64, 1 << max(len(s) - 1, 0).bit_length())
    at = ((_mixed(s) >> np.uint64(17)) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=cells).astype(np.uint8) & 1).tobytes()


def may_link(sizes: np.ndarray, sketches: list[bytes], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs that connect all sets that pairs not ruled out by sizes and sketches connect."""
    length = np.array([len(x) for x in sketches])
    # sketches of linked sets are equally long or the longer twice as long, and folding it gives that of the shorter
    own = {b: np.frombuffer(b"".join(x for x in sketches if len(x) == b), np.uint64).reshape(-1, b // 8)
           for b in np.unique(length).tolist()}
    place = {b: np.flatnonzero(length == b) for b in own}
    left, out = np.ones(len(sizes), bool), []
    where = np.empty(len(sizes), np.int64)
    for b in own:
        where[place[b]] = np.arange(len(place[b]))
    for first in range(len(sizes)):
        if not left[first]:
            continue
        left[first], todo = False, [first]
        while todo:
            q = todo.pop()
            b = int(length[q])
            x, n = own[b][where[q]], int(sizes[q])
            for other, fold in ((b, 1), (b * 2, 2), (b // 2, 2)):
                if other not in own:
                    continue
                some = place[other][left[place[other]]]
                some = some[(sizes[some] * den >= num * n) & (sizes[some] * num <= den * n)]
                if not len(some):
                    continue
                y = own[other][where[some]]
                if other > b:
                    y = np.bitwise_xor(y[:, :b // 8], y[:, b // 8:])
                z = x if other >= b else x[:other // 8] ^ x[other // 8:]
                apart = np.bitwise_count(y ^ z).sum(axis=1, dtype=np.int64)
                found = some[apart * (num + den) <= (den - num) * (sizes[some] + n)].tolist()
                left[found] = False
                todo += found
                out += [(q, f) for f in found]
    return out


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Shingles(width)
        for pdf in slices(batches, "text"):
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                s = of(text)
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                rows.append((doc, len(s), *np.frombuffer(d, np.int64).tolist(), sketch(s)))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "h1", "h2", "sketch"])
    return run


def _parts(width: int, num: int, den: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, seen = Shingles(width), set()
        for pdf in slices(batches, "text", 2 << 20):
            keys, nodes = [], []
            for text in pdf["text"]:
                s = of(text)
                node = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=16).digest()[:8], "little", signed=True)
                if not len(s) or node in seen:  # a task sends equal sets once
                    continue
                if len(seen) > MEMO:
                    seen.clear()
                seen.add(node)
                k = part_hashes(s, num, den)
                keys.append(k)
                nodes.append(np.full(len(k), node, np.int64))
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "node": np.concatenate(nodes)})
    return run


def _held(num: int, den: int):
    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        ends = np.append(np.flatnonzero(np.diff(pdf["held"].to_numpy())) + 1, len(pdf))
        node, n, own, out, lo = pdf["node"].to_numpy(), pdf["n"].to_numpy(), pdf["sketch"].tolist(), [], 0
        for hi in ends.tolist():
            out += [(lo + a, lo + b) for a, b in may_link(n[lo:hi], own[lo:hi], num, den)]
            lo = hi
        at = np.array(out, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": node[at].min(axis=1), "b": node[at].max(axis=1)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # rows come in order of ``held``; one's rows may lie in several batches
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if len(pdf):
                last = (pdf["held"] == pdf["held"].iloc[-1]).to_numpy()
                rest = pdf[last]
                if not last.all():
                    yield pairs(pdf[~last])
        if rest is not None and len(rest):
            yield pairs(rest)
    return run


def _families(shared: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """node, component: sets (as ``h1``) that share a key and that sizes and sketches do not rule out are connected."""
    by_key = shared.withColumn("among", F.count("*").over(Window.partitionBy("key")))
    # many keys have the same sets: those are held against each other once
    held = (by_key.where(F.col("among") <= HELD).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
            .select("nodes").distinct().select(F.xxhash64("nodes").alias("held"), F.explode("nodes").alias("node")))
    own = sets.where("n > 0").groupBy(F.col("h1").alias("node")).agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    close = (held.join(own, "node").repartition("held").sortWithinPartitions("held")
             .mapInPandas(_held(num, den), "a long, b long").distinct())
    crowd = (by_key.where(F.col("among") > HELD).withColumn("least", F.min("node").over(Window.partitionBy("key")))
             .select(F.col("least").alias("a"), F.col("node").alias("b")).distinct())
    return components(written(close.unionByName(crowd), "close"))


class Links:
    """Union-find over a task's rows with flat labels."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: int, b: int) -> None:
        self.label[self.label == self.label[b]] = self.label[a]


def t_occurrence(sets: list[np.ndarray], queries: list[int], index: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs (query, partner) that link and connect all sets that links connect; every query meets every indexed set."""
    if not queries or not index:
        return []
    sizes = np.array([len(s) for s in sets])
    members = np.repeat(np.array(index), sizes[index])
    values = np.concatenate([sets[i] for i in index])
    order = np.argsort(values, kind="stable")
    values, members = values[order], members[order]
    words, starts = np.unique(values, return_index=True)
    ends = np.append(starts[1:], len(values))
    # (list, set) as one sorted number: a binary search for it probes the list for the set
    code = np.repeat(np.arange(len(words)), ends - starts) * len(sets) + members
    links, out = Links(len(sets)), []
    for q in queries:
        s = sets[q]
        n = len(s)
        need = -(-num * n // den)  # an overlap below it cannot reach num / den of the union
        at = np.searchsorted(words, s)
        at[at == len(words)] = 0
        at = at[words[at] == s]
        if len(at) < need or not n:
            continue
        at = at[np.argsort(ends[at] - starts[at], kind="stable")]
        short, long = at[:len(at) - need + 1], at[len(at) - need + 1:]
        # a partner misses at most need - 1 long lists, so it is in a short one
        found, count = np.unique(np.concatenate([members[starts[a]:ends[a]] for a in short]), return_counts=True)
        ok = (links.label[found] != links.label[q]) & (found != q)
        ok &= (sizes[found] * den >= num * n) & (sizes[found] * num <= den * n)
        found, count = found[ok], count[ok]
        # exact bar of each candidate: overlap * (num + den) >= num * (|a| + |b|)
        bar = -(-num * (n + sizes[found]) // (num + den))
        for lo in range(0, len(long), PROBES):
            left = len(long) - lo
            ok = count + left >= bar
            found, count, bar = found[ok], count[ok], bar[ok]
            if not len(found):
                break
            some = long[lo:lo + PROBES]
            if (ends[some] - starts[some]).sum() < MERGE * len(some) * len(found):
                # many candidates for lists of this length: merging them is cheaper than probing for each
                held = np.concatenate([members[starts[a]:ends[a]] for a in some])
                count = count + np.bincount(held, minlength=len(sets))[found]
                continue
            want = some[:, None] * len(sets) + found[None, :]
            p = np.searchsorted(code, want)
            p[p == len(code)] = 0
            count = count + (code[p] == want).sum(axis=0)
        for f in found[count >= bar].tolist():
            if links.label[f] != links.label[q]:
                links.join(f, q)
                out.append((q, f))
    return out


def _linked(width: int, num: int, den: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        of = Shingles(width)
        pdf = pdf.drop_duplicates(["doc_id", "block", "text"])
        sets = [of(t) for t in pdf["text"]]
        block, i, j = pdf["block"].to_numpy(), pdf["i"].iloc[0], pdf["j"].iloc[0]
        left = np.flatnonzero(block == i).tolist()
        right = left if i == j else np.flatnonzero(block == j).tolist()
        ids = pdf["doc_id"].to_numpy()
        pairs = t_occurrence(sets, right, left, num, den)
        return pd.DataFrame({"a": [ids[a] for a, _ in pairs], "b": [ids[b] for _, b in pairs]}, dtype="int64")
    return run


def near_duplicates(docs: DataFrame, width: int, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id: documents link at Jaccard >= num / den (num > 0) of their shingle sets;
    component_id is the smallest doc_id reachable.

    A text with fewer than ``width`` words is one shingle; without words (or null) it has none and links with nothing.
    Rows without a doc_id take no part; rows that share a doc_id count as that many documents of one id.
    """
    prepare(docs.sparkSession)
    rows = id_text(docs).where("doc_id is not null")
    sets = written(rows.mapInPandas(_sets(width), "doc_id long, n long, h1 long, h2 long, sketch binary"), "sets")
    classes = sets.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))

    parts = rows.mapInPandas(_parts(width, num, den), "key long, node long")
    by_key = Window.partitionBy("key")
    shared = written(parts.withColumn("least", F.min("node").over(by_key)).withColumn("most", F.max("node").over(by_key))
                     .where("least < most").select("key", "node").distinct(), "shared-parts")
    family = _families(shared, sets, num, den).select(F.col("node").alias("h1"), F.col("component").alias("family"))

    # the sets of families, one document a class, with their blocks
    members = written(classes.join(family, "h1").select(F.col("rep").alias("doc_id"), "n", "family"), "family-members")
    blocks = (members.groupBy("family").agg(F.count("*").alias("sets"), F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
              .where("sets > 1").select("family", "blocks"))
    placed = (members.join(blocks, "family")
              .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("doc_id", "family", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    with_text = rows.join(small(placed, 5), "doc_id")
    links = with_text.groupBy("family", "i", "j").applyInPandas(_linked(width, num, den), "a long, b long")
    of_rep = components(links).select(F.col("node").alias("rep"), "component")

    labelled = classes.select("h1", "h2", "rep").join(of_rep, "rep", "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component_id"))
    return (sets.drop("sketch").join(written(labelled, "classes"), ["h1", "h2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def op4_divide_skip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at Jaccard 0.9 of 3-word shingles."""
    return near_duplicates(documents(spark, sf_dir), width=3, num=9, den=10)
