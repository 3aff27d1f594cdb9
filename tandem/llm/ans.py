"""Token-id files by a static range asymmetric numeral system (rANS).

Layout, one Parquet row a block (``shard`` folders, blocks ascending, documents ascending within and across them):

* a block holds whole documents, ``BLOCK`` ids or more (the last of a shard may be shorter), and decodes alone;
* its ids are dealt to ``LANES`` interleaved lanes that share one stream of 32-bit words; the states are 64 bits;
* every ``STEPS`` steps a checkpoint stores the lane states and the word offset, so the stretches of a block decode
  in parallel as well;
* two CRC-32 sums guard the words and the ids; a mismatch raises;
* one frequency table for all blocks, quantised to ``1 << SCALE`` slots, is written beside them.

Counts come from all ids of the corpus. The driver only holds the table (one number an id of the vocabulary) and one
number a shard.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import id_text, prepare, slices, written
from tandem.llm.tokens import encoder, file
from tandem.session import scratch_path

LANES = 64
STEPS = 512
BLOCK = 1 << 16
SCALE = 20
SHARD_CHARS = 24 << 20
MOST_SHARDS = 8192  # beyond it shards grow; the driver holds one number a shard
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)

IDS = ("shard int, block int, start long, n_tokens long, doc_ids array<long>, doc_lens array<long>, ids binary, "
       "bits int")
BLOCKS = ("shard int, block int, start long, n_tokens long, doc_ids array<long>, doc_lens array<long>, bits int, "
          "states binary, checkpoints binary, words binary, words_crc32 long, ids_crc32 long")
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def quantise(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that add up to ``1 << scale``, at least 1 for every id that occurs.

    >>> quantise(np.array([3, 0, 1]), 3).tolist()
    [6, 0, 2]
    """
    counts = np.asarray(counts, dtype=np.int64)
    slots = 1 << scale
    used = np.flatnonzero(counts)
    if not len(used):
        return np.zeros(len(counts), np.int64)
    if len(used) > slots:
        raise ValueError(f"{len(used)} ids do not fit {slots} slots")
    share = counts[used].astype(np.float64) / counts[used].sum() * (slots - len(used))
    freq = np.floor(share).astype(np.int64) + 1
    rest = slots - int(freq.sum())
    freq[np.argsort(-(share - np.floor(share)), kind="stable")[:rest]] += 1
    out = np.zeros(len(counts), np.int64)
    out[used] = freq
    return out


class Table:
    """Frequencies, their running sums, and the id of every slot."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.freq = freq.astype(np.uint64)
        ends = np.cumsum(freq)
        self.cum = (ends - freq).astype(np.uint64)
        self.of_slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.limit = self.freq << (np.uint64(31 - scale) + WORD)


def encode_blocks(blocks: list[np.ndarray], table: Table) -> list[tuple[bytes, bytes, bytes]]:
    """(states, checkpoints, words) of each block; all lanes of all blocks advance together, last id first."""
    n = np.array([len(b) for b in blocks])
    steps = -(-n // LANES)
    most = int(steps.max()) if len(n) else 0
    ids = np.zeros((most, len(blocks), LANES), np.uint32)
    for k, b in enumerate(blocks):
        flat = np.zeros(int(steps[k]) * LANES, np.uint32)
        flat[:len(b)] = b
        ids[:steps[k], k] = flat.reshape(-1, LANES)
    state = np.full((len(blocks), LANES), LOW, np.uint64)
    lane = np.arange(LANES)
    words: list[np.ndarray] = []
    counts = np.zeros((most, len(blocks)), np.int64)
    saved: dict[int, np.ndarray] = {}
    for t in range(most - 1, -1, -1):
        live = t * LANES + lane[None, :] < n[:, None]
        s = ids[t]
        f = np.where(live, table.freq[s], np.uint64(1))
        out = live & (state >= np.where(live, table.limit[s], np.uint64(0)))
        words.append((state[out] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        counts[t] = out.sum(axis=1)
        x = np.where(out, state >> WORD, state)
        q = x // f
        state = np.where(live, (q << table.scale) + (x - q * f) + table.cum[s], state)
        if t and t % STEPS == 0:
            saved[t] = state.copy()
    of = np.repeat(np.tile(np.arange(len(blocks)), most), counts.ravel())
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    stream = stream[np.argsort(of, kind="stable")]
    ends = np.cumsum(counts.sum(axis=0))
    before = np.cumsum(counts, axis=0) - counts
    result = []
    for k in range(len(blocks)):
        points = b"".join(np.array([before[t, k]], "<u8").tobytes() + saved[t][k].astype("<u8").tobytes()
                          for t in range(STEPS, int(steps[k]), STEPS))
        result.append((state[k].astype("<u8").tobytes(), points,
                       stream[ends[k] - counts[:, k].sum():ends[k]].tobytes()))
    return result


def decode_blocks(blocks: list[tuple[int, bytes, bytes, bytes]], table: Table) -> list[np.ndarray]:
    """Ids of blocks given as (n_tokens, states, checkpoints, words); stretches between checkpoints advance together."""
    states, at, n, owner, first = [], [], [], [], []
    stream, base = [], 0
    for k, (size, head, points, words) in enumerate(blocks):
        w = np.frombuffer(words, "<u4")
        cells = [(0, np.frombuffer(head, "<u8"))]
        rows = np.frombuffer(points, "<u8").reshape(-1, LANES + 1)
        cells += [(int(r[0]), r[1:]) for r in rows]
        for j, (offset, state) in enumerate(cells):
            states.append(state)
            at.append(base + offset)
            owner.append(k)
            first.append(j * STEPS * LANES)
            n.append(min(size - j * STEPS * LANES, STEPS * LANES))
        stream.append(w)
        base += len(w)
    if not states:
        return []
    flow = np.concatenate([*stream, np.zeros(1, "<u4")]).astype(np.uint64)
    state = np.array(states, np.uint64)
    at_, n_ = np.array(at), np.array(n)
    most = int(-(-n_.max() // LANES))
    out = np.zeros((most, len(states), LANES), np.uint32)
    lane = np.arange(LANES)
    mask = np.uint64((1 << int(table.scale)) - 1)
    for t in range(most):
        live = t * LANES + lane[None, :] < n_[:, None]
        slot = state & mask
        s = table.of_slot[slot]
        out[t] = s
        x = table.freq[s] * (state >> table.scale) + slot - table.cum[s]
        more = live & (x < LOW)
        where = at_[:, None] + np.cumsum(more, axis=1) - more
        x = np.where(more, (x << WORD) | flow[np.where(more, where, len(flow) - 1)], x)
        state = np.where(live, x, state)
        at_ = at_ + more.sum(axis=1)
    whole = [np.zeros(b[0], np.uint32) for b in blocks]
    for i, k in enumerate(owner):
        whole[k][first[i]:first[i] + n[i]] = out[:, i].reshape(-1)[:n[i]]
    return whole


def _assembled(path: str, end_id: int, block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        docs, lens, parts, size, number, start = [], [], [], 0, 0, 0

        def row():
            return (shard, number, start, size, docs, lens, b"".join(parts), enc.dtype.itemsize * 8)

        for pdf in slices(batches, "text", 4 << 20):
            rows = []
            for doc, ids in zip(pdf["doc_id"], enc.encode(pdf["text"].tolist()), strict=True):
                docs.append(doc)
                parts.append(ids + end)
                lens.append(len(parts[-1]) // enc.dtype.itemsize)
                size += lens[-1]
                if size >= block:
                    rows.append(row())
                    start, number = start + size, number + 1
                    docs, lens, parts, size = [], [], [], 0
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in IDS.split(", ")])
        if docs:
            yield pd.DataFrame([row()], columns=[c.split()[0] for c in IDS.split(", ")])
    return run


def token_blocks(docs: DataFrame, tokenizer: str, end_id: int, shard_chars: int = SHARD_CHARS,
                 block: int = BLOCK) -> DataFrame:
    """Documents in ascending ``doc_id`` order as blocks of raw ids, written once to the shared folder.

    Null texts are empty; rows without a ``doc_id`` take no part; equal ids stand in text order. A range partition
    is a shard; ``start`` counts the ids before the block in its shard.
    """
    rows = id_text(docs).where("doc_id is not null")
    chars = rows.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    shards = max(1, min(MOST_SHARDS, -(-int(chars) // shard_chars)))
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInPandas(_assembled(tokenizer, end_id, block), IDS), "token-blocks")


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(0, np.int64)
    for pdf in slices(batches, "ids"):
        for ids, bits in zip(pdf["ids"], pdf["bits"], strict=True):
            c = np.bincount(np.frombuffer(ids, f"<u{bits // 8}"), minlength=len(total))
            c[:len(total)] += total
            total = c
    used = np.flatnonzero(total)
    yield pd.DataFrame({"id": used, "n": total[used]})


def frequency_table(blocks: DataFrame, scale: int = SCALE) -> np.ndarray:
    """Quantised frequencies of all ids of the corpus, summed on the executors; one row an id reaches the driver."""
    rows = (blocks.select("ids", "bits").mapInPandas(_counted, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return quantise(counts, scale)


def _encoded(freq: np.ndarray, bases: dict[int, int], scale: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(freq, scale)
        for pdf in slices(batches, "ids"):
            ids = [np.frombuffer(b, f"<u{n // 8}") for b, n in zip(pdf["ids"], pdf["bits"], strict=True)]
            coded = encode_blocks(ids, table)
            out = pdf.drop(columns="ids")
            out["start"] = [s + bases[k] for k, s in zip(pdf["shard"], pdf["start"], strict=True)]
            out["states"], out["checkpoints"], out["words"] = zip(*coded, strict=True)
            out["words_crc32"] = [zlib.crc32(c[1], zlib.crc32(c[2])) for c in coded]
            out["ids_crc32"] = [zlib.crc32(b) for b in pdf["ids"]]
            yield out[[c.split()[0] for c in BLOCKS.split(", ")]]
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, scale: int = SCALE,
              shard_chars: int = SHARD_CHARS, block: int = BLOCK) -> None:
    """Encode every document and write ``path``/blocks (a folder a shard) and ``path``/table."""
    spark = docs.sparkSession
    prepare(spark)
    raw = token_blocks(docs, tokenizer, end_id, shard_chars, block)
    freq = frequency_table(raw, scale)
    totals = sorted((r["shard"], r["n"]) for r in raw.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    bases, so_far = {}, 0
    for shard, n in totals:
        bases[shard], so_far = so_far, so_far + n
    (raw.mapInPandas(_encoded(freq, bases, scale), BLOCKS).sortWithinPartitions("shard", "block")
     .write.partitionBy("shard").option("compression", "none").parquet(f"{path}/blocks"))
    spark.createDataFrame([(scale, freq.astype("<u4").tobytes())], "scale int, freq binary") \
        .coalesce(1).write.parquet(f"{path}/table")


def _decoded(freq: np.ndarray, scale: int, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(freq, scale)
        for pdf in slices(batches, "words", 4 << 20):
            for w, c, crc in zip(pdf["words"], pdf["checkpoints"], pdf["words_crc32"], strict=True):
                if zlib.crc32(c, zlib.crc32(w)) != crc:
                    raise ValueError("a block's words are damaged")
            whole = decode_blocks(list(zip(pdf["n_tokens"], pdf["states"], pdf["checkpoints"], pdf["words"],
                                           strict=True)), table)
            rows = []
            for r, ids in zip(pdf.itertuples(), whole, strict=True):
                if zlib.crc32(ids.astype(f"<u{r.bits // 8}").tobytes()) != r.ids_crc32:
                    raise ValueError("a block's ids are damaged")
                at = 0
                wide = ids.astype("<u4")
                for doc, n in zip(r.doc_ids, r.doc_lens, strict=True):
                    own = wide[at:at + n].tobytes()
                    rows.append((doc, r.start + at, n, zlib.crc32(own), own)[:len(columns)])
                    at += n
            yield pd.DataFrame(rows, columns=columns)
    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of ``write_ids`` files: doc_id, start, n_tokens, ids_crc32 and, if asked, their ids (``<u4``)."""
    head = spark.read.schema("scale int, freq binary").parquet(f"{path}/table").first()
    freq = np.frombuffer(bytes(head["freq"]), "<u4").astype(np.int64)
    schema = DOCS + ", ids binary" if with_ids else DOCS
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return blocks.mapInPandas(_decoded(freq, head["scale"], [c.split()[0] for c in schema.split(", ")]), schema)


def op1_ans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    from tandem.llm.common import documents

    prepare(spark)
    path = scratch_path(spark, f"ans-{uuid.uuid4().hex}")
    write_ids(documents(spark, sf_dir), path, file("word_bpe_49k.json"), end_id=2)
    return read_ids(spark, path, with_ids=False)
