"""Alignment of two tokenizers by inverted pair bitmaps.

Tokens of both tokenizers are linked where their byte ranges share a group (see
``token_groups``). For every id pair the documents of a block that hold it
linked form a compressed bitmap: 16-bit positions, or one bit a document where
that is shorter. Beside it lie multiplicity planes: plane k has bit k of the
number of further links of the pair, for each of its documents in turn.

Bitmaps of batches are OR-merged into the block's, their popcounts are summed
over all blocks to the pair's document count, and the pair's posting in each
block then returns the count, and whether it is the highest of its A id, to the
block's documents. A row is one pair of one block, so rows grow with the text
and never faster; a frequent pair has one row a block, whatever its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import written
from reelrank.llm.token_groups import Groups

BATCH_CHARS = 1 << 20
BLOCK_CHARS = 1 << 24
BLOCK_DOCS = 1 << 16
POSTING = "block long, a long, b long, n long, docs binary, dense boolean, planes binary"
_POSTING = pa.schema([("block", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("docs", pa.binary()),
                      ("dense", pa.bool_()), ("planes", pa.binary())])
_loaded: dict[tuple[str, str], Groups] = {}


def groups(byte_bpe: str, piece_model: str) -> Groups:
    if (byte_bpe, piece_model) not in _loaded:
        _loaded[byte_bpe, piece_model] = Groups(byte_bpe, piece_model)
    return _loaded[byte_bpe, piece_model]


def _binary(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data.astype(np.uint8))])


def merged(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of several batches as one, ordered by pair and document; a
    link that several of them hold is one with all its occurrences."""
    order = np.lexsort((doc, pair))
    pair, doc, times = pair[order], doc[order], times[order]
    new = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1]))) if len(pair) else np.zeros(0, int)
    return pair[new], doc[new], np.add.reduceat(times, new) if len(new) else times


def bitmaps(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, n_docs: int) -> tuple:
    """(pairs, documents of each, bitmaps, whether dense, planes) of merged links."""
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(pair)))
    row = np.repeat(np.arange(len(first)), count)
    rank = np.arange(len(pair)) - first[row]
    # documents: positions of two bytes, or a bit each
    dense = count * 16 > n_docs
    size = np.where(dense, (n_docs + 7) // 8, 2 * count)
    start = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    few, many = ~dense[row], dense[row]
    at = start[row[few]] + 2 * rank[few]
    data[at], data[at + 1] = doc[few] & 255, doc[few] >> 8
    if many.any():
        np.bitwise_or.at(data, start[row[many]] + (doc[many] >> 3), np.left_shift(1, doc[many] & 7).astype(np.uint8))
    # planes of what exceeds one link, a bit for each of the pair's documents
    most = np.maximum.reduceat(times, first) - 1 if len(first) else times
    planes = np.ceil(np.log2(most + 1.0)).astype(np.int64)
    width = (count + 7) // 8
    base = np.cumsum(planes * width) - planes * width
    bits = np.zeros(int((planes * width).sum()), np.uint8)
    for k in range(int(planes.max(initial=0))):
        on = np.flatnonzero(((times - 1) >> k) & 1)
        np.bitwise_or.at(bits, base[row[on]] + k * width[row[on]] + (rank[on] >> 3), np.left_shift(1, rank[on] & 7).astype(np.uint8))
    return pair[first], count, _binary(size, data), dense, _binary(planes * width, bits)


def links(n: np.ndarray, docs: pa.Array, dense: np.ndarray, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, links) of postings, read back from their bitmaps."""
    rows, found = [], []
    offset = np.frombuffer(docs.buffers()[1], np.int32)[docs.offset:docs.offset + len(docs) + 1].astype(np.int64)
    data = np.frombuffer(docs.buffers()[2] or b"", np.uint8)
    few = np.flatnonzero(~dense)
    rows.append(np.repeat(few, n[few]))
    step = np.arange(len(rows[0])) - np.repeat(np.cumsum(n[few]) - n[few], n[few])
    at = np.repeat(offset[few], n[few]) + 2 * step
    found.append(data[at].astype(np.int64) + (data[at + 1].astype(np.int64) << 8))
    for r in np.flatnonzero(dense).tolist():
        here = np.flatnonzero(np.unpackbits(data[offset[r]:offset[r + 1]], bitorder="little"))
        rows.append(np.full(len(here), r))
        found.append(here)
    row, doc = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    row, doc = row[order], doc[order]
    rank = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    offset = np.frombuffer(planes.buffers()[1], np.int32)[planes.offset:planes.offset + len(planes) + 1].astype(np.int64)
    bits = np.frombuffer(planes.buffers()[2] or b"", np.uint8)
    width = (n + 7) // 8
    depth = np.diff(offset) // np.maximum(width, 1)
    times = np.ones(len(row), np.int64)
    for k in range(int(depth.max(initial=0))):
        has = np.flatnonzero(depth[row] > k)
        place = offset[row[has]] + k * width[row[has]] + (rank[has] >> 3)
        times[has] += ((bits[place] >> (rank[has] & 7)) & 1).astype(np.int64) << k
    return row, doc, times


def align(docs: DataFrame, byte_bpe: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). ``documents`` has one row per input row: ``id``,
    ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is
    in as many documents as any pair of its A id), ``count_sum`` (document
    counts, summed over links) and ``groups_sha256``. ``pairs`` has the document
    count ``n`` and ``best`` of every linked id pair (``a``, ``b``).

    Every row is a document, also where an id or a text is repeated or the id is
    null. Null and empty texts, and texts whose tokens don't spell the space and
    the text in both tokenizers, have no tokens: zeros and an empty digest. Texts
    are encoded whole; a group of any length is linked by its distinct ids. All
    pairs that tie for an A id's highest count are best. An empty table gives
    empty results; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = dict(rows.dtypes)["id"]
    own = f"id {id_type}, place long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = groups(byte_bpe, piece_model)
        task, blocks, chars, n_docs = TaskContext.get().partitionId() << 32, 0, 0, 0
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def closed() -> Iterator[pa.RecordBatch]:
            pair, doc, times = merged(*(np.concatenate(x) for x in zip(*kept, strict=True)))
            pair, n, where, dense, planes = bitmaps(pair, doc, times, n_docs)
            for lo in range(0, len(pair), 10_000):
                s = slice(lo, lo + 10_000)
                cut = pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair[s]), task + blocks)), pa.array(pair[s] // made.width), pa.array(pair[s] % made.width),
                     pa.array(n[s]), where[s], pa.array(dense[s]), planes[s]], schema=_POSTING)
                yield pa.RecordBatch.from_arrays([*cut.columns, *(pa.nulls(cut.num_rows, t) for t in empty)], schema=whole)

        for b in batches:
            size = np.cumsum(pa.compute.fill_null(pa.compute.utf8_length(b.column("text")), 0).to_numpy(zero_copy_only=False))
            if not b.num_rows:
                continue
            empty = [b.schema.field("id").type, *[pa.int64()] * 5, pa.string()]
            names = ["id", "place", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            whole = pa.schema([*_POSTING, *(pa.field(x, t) for x, t in zip(names, empty, strict=True))])
            at = 0
            while at < b.num_rows:
                base = size[at - 1] if at else 0
                end = min(max(at + 1, int(np.searchsorted(size, base + BATCH_CHARS, "right"))), at + BLOCK_DOCS)
                if kept and (chars + size[end - 1] - base > BLOCK_CHARS or n_docs + end - at > BLOCK_DOCS):
                    yield from closed()
                    kept, chars, n_docs, blocks = [], 0, 0, blocks + 1
                c = made.count(b.column("text").slice(at, end - at).to_pylist())
                kept.append((c.pair, c.text + n_docs, c.times))
                n = end - at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, task + blocks)), *(pa.nulls(n, t) for t in _POSTING.types[1:]), b.column("id").slice(at, n),
                     pa.array(np.arange(n_docs, n_docs + n)), *map(pa.array, (c.n_a, c.n_b, c.n_groups, c.n_links)),
                     pa.array(c.digest, pa.string())], schema=whole)
                chars, n_docs, at = chars + int(size[end - 1] - base), n_docs + n, end
        if kept:
            yield from closed()

    # a block's positions must stay those of the very rows that were counted
    both = written(rows.mapInArrow(walk, f"{POSTING}, {own}"), "pair-bitmaps")
    found = both.filter("a IS NOT NULL").select("block", "a", "b", "n", "docs", "dense", "planes")
    counted = found.groupBy("a", "b").agg(F.sum("n").alias("count"))
    top = counted.groupBy("a").agg(F.max("count").alias("top"))
    pairs = counted.join(top, "a").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))

    def returned(key: tuple, block: pa.Table) -> pa.Table:
        t = block.combine_chunks()
        one = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in t.columns]
        n, dense, docs, planes, count, best = (one[t.schema.get_field_index(x)] for x in ("n", "dense", "docs", "planes", "count", "best"))
        row, doc, times = links(n.to_numpy(), docs, dense.to_numpy(zero_copy_only=False), planes)
        sums = np.zeros((2, int(doc.max(initial=-1)) + 1), np.int64)
        np.add.at(sums[0], doc, times * best.to_numpy(zero_copy_only=False)[row])
        np.add.at(sums[1], doc, times * count.to_numpy()[row])
        has = np.unique(doc)
        return pa.table({"block": pa.array(np.full(len(has), key[0].as_py())), "place": pa.array(has),
                         "n_best": pa.array(sums[0][has]), "count_sum": pa.array(sums[1][has])})

    scores = (found.join(pairs, ["a", "b"]).select("block", "n", "docs", "dense", "planes", "count", "best")
              .groupBy("block").applyInArrow(returned, "block long, place long, n_best long, count_sum long"))
    documents = (both.filter("a IS NULL").join(scores, ["block", "place"], "left")
                 .select("id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                         F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
    return documents, pairs.withColumnRenamed("count", "n")
