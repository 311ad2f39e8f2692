"""Exact top-k inner products on a bit-sliced index.

A vector's components become small integers. The index keeps, for every block
of rows, one bitmap for each bit of each attribute (a slice). A query's scores
for a whole block come from bitmap arithmetic alone: the slices of attribute
d, complemented where the query is negative there, are added at the weights of
the bits of its component, three bitmaps of a weight becoming two by a
carry-save step, until one bitmap is left for each bit of the score. The
largest scores are then read from the most significant slice downward: rows
with the bit set stay as long as enough are left. Rows that still tie where
the last places are given are resolved by id.

Blocks of rows and blocks of queries meet in a grid: a Cartesian product of
their records, each read where it lies, so none is written, shuffled or
broadcast once for each block of the other side. A cell returns k rows for each
of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.llm.common import tasks, written

BLOCK_ROWS = 8192
BLOCK_QUERIES = 512


def quantised(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component, or null if the vector or one of
    its components is null or not finite."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(v.isNotNull() & fine, F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id``, ``score`` of the ``k`` best rows
    of ``vectors`` for each row of ``queries``; ties go to the smaller id.

    Rows that have the query's id are its own and no candidates. Vectors that
    are null, hold a null or non-finite component, or have a null id take no
    part. A vector is compared with queries of its own length. Rows that repeat
    an id are candidates each; a repeated query id counts once (its smallest
    vector). Fewer candidates than ``k`` give fewer rows, none give none.
    """
    def clean(frame: DataFrame) -> DataFrame:
        return (frame.select(F.col(id_col).cast("long").alias("id"), quantised(vector_col, scale).alias("v"))
                .filter("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0"))

    rows = clean(vectors).withColumn("width", F.size("v"))
    asked = clean(queries).groupBy("id").agg(F.min("v").alias("v")).withColumn("width", F.size("v"))
    index = written(build_index(rows), "bit-slices")
    grouped = written(_query_blocks(asked), "query-blocks")
    spark, n = vectors.sparkSession, index.count()  # one scalar
    left = index.repartition(max(1, min(n, tasks(spark)))).rdd.map(tuple)
    right = grouped.coalesce(1).rdd.map(tuple)
    right.checkpoint()
    right.count()  # writes the records, which are read again for every block of rows

    def search(cells: Iterator[tuple[tuple, tuple]]) -> Iterator[tuple[bytes, bytes, bytes]]:
        for (width, _, ids, low, slices), (other, _, query_ids, asked_for) in cells:
            if width == other:
                found = _search_cell(Cell(width, ids, low, slices, query_ids, asked_for), k)
                yield tuple(found[c].to_numpy(np.int64).tobytes() for c in ("query_id", "id", "score"))

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for c in b.itertuples(index=False):
                yield pd.DataFrame({name: np.frombuffer(x, np.int64) for name, x in zip(("query_id", "id", "score"), c, strict=True)})

    cells = spark.createDataFrame(left.cartesian(right).mapPartitions(search), "query_id binary, id binary, score binary", verifySchema=False)
    found = cells.mapInPandas(rows_of, "query_id long, id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def build_index(rows: DataFrame) -> DataFrame:
    """One row per block: ``width``, ``block``, ``ids`` (sorted 64-bit), ``low``
    (the least component) and ``slices``: bitmaps [attribute, bit, row]."""
    blocks = rows.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("n"))
    placed = (rows.withColumn("tie", F.monotonically_increasing_id()).join(F.broadcast(blocks), "width")
              .withColumn("block", F.pmod(F.xxhash64("id", "tie"), F.col("n")).cast("int")))

    def slice_block(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        v = np.stack(part["v"].to_numpy()).astype(np.int64)
        low = int(v.min())
        up = (v - low).astype(np.uint64)
        bits = max(1, int(up.max()).bit_length())
        words = -(-len(part) // 64) * 8
        out = np.zeros((v.shape[1], bits, words), np.uint8)
        for j in range(bits):
            plane = np.packbits((up >> np.uint64(j) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
            out[:, j, :plane.shape[1]] = plane
        return pd.DataFrame({"width": [v.shape[1]], "block": [int(part["block"].iloc[0])],
                             "ids": [part["id"].to_numpy(np.int64).tobytes()], "low": [low], "slices": [out.tobytes()]})

    return (placed.select("width", "block", "id", "v").groupBy("width", "block")
            .applyInPandas(slice_block, "width int, block int, ids binary, low long, slices binary"))


def _query_blocks(asked: DataFrame) -> DataFrame:
    parts = asked.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("n"))
    placed = asked.join(F.broadcast(parts), "width").withColumn("part", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))

    def block(part: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(part["v"].to_numpy()).astype(np.int64)
        return pd.DataFrame({"width": [v.shape[1]], "part": [int(part["part"].iloc[0])],
                             "ids": [part["id"].to_numpy(np.int64).tobytes()], "vectors": [v.tobytes()]})

    return (placed.select("width", "part", "id", "v").groupBy("width", "part")
            .applyInPandas(block, "width int, part int, ids binary, vectors binary"))


class Cell(NamedTuple):
    """A block of rows and a block of queries of the same width."""
    width: int
    ids: bytes
    low: int
    slices: bytes
    query_ids: bytes
    vectors: bytes


def _search_cell(cell: Cell, k: int) -> pd.DataFrame:
    ids = np.frombuffer(cell.ids, np.int64)
    queries = np.frombuffer(cell.query_ids, np.int64)
    asked = np.frombuffer(cell.vectors, np.int64).reshape(len(queries), cell.width)
    slices = np.frombuffer(cell.slices, np.uint64).reshape(cell.width, -1, -(-len(ids) // 64))
    bits = slices.shape[1]
    every = np.zeros(slices.shape[2] * 8, np.uint8)
    every[:-(-len(ids) // 8)] = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
    every = every.view(np.uint64)
    flipped, out = ~slices, []
    for query, q in zip(queries.tolist(), asked, strict=True):
        score = _score_slices(slices, flipped, q)
        here = every.copy()
        for own in range(*np.searchsorted(ids, [query, query + 1])):
            here[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        rows, value = _best(score, here, k)
        # a complement of b bits stands for 2**b - 1 - x
        base = int(cell.low) * int(q.sum()) + int(q[q < 0].sum()) * ((1 << bits) - 1)
        out.append(pd.DataFrame({"query_id": query, "id": ids[rows], "score": value + base}))
    return pd.concat(out)


def _score_slices(slices: np.ndarray, flipped: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Bitmaps of the bits of sum(|q_d| * y_d), least significant first, where
    y_d is the attribute or, under a negative component, its complement."""
    size = np.abs(q)
    waiting: dict[int, list[np.ndarray]] = {}
    for j in range(int(size.max()).bit_length()):
        has = size >> j & 1 == 1
        chosen = np.concatenate([slices[has & (q > 0)], flipped[has & (q < 0)]])  # attribute, bit, row
        for i in range(slices.shape[1] if len(chosen) else 0):
            waiting.setdefault(i + j, []).append(chosen[:, i])
    out, weight = [], 0
    while waiting:
        maps = waiting.pop(weight, [])
        stack = np.concatenate(maps) if maps else np.zeros((0, slices.shape[2]), np.uint64)
        while len(stack) > 1:
            n = len(stack) // 3
            if n:  # three of a weight make a sum of that weight and a carry of the next
                a, b, c = stack[:n], stack[n:2 * n], stack[2 * n:3 * n]
                x = a ^ b
                carry, rest = (a & b) | (x & c), np.concatenate([x ^ c, stack[3 * n:]])
            else:
                carry, rest = (stack[0] & stack[1])[None], (stack[0] ^ stack[1])[None]
            waiting.setdefault(weight + 1, []).append(carry)
            stack = rest
        out.append(stack[0] if len(stack) else np.zeros(slices.shape[2], np.uint64))
        weight += 1
    return out


def _best(score: list[np.ndarray], here: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and scores of the ``k`` largest rows of ``here``; rows of
    equal score at the end are taken in order of their number."""
    sure, maybe = np.zeros_like(here), here
    n_sure = 0
    for plane in reversed(score):
        ones = maybe & plane
        n = int(np.bitwise_count(ones).sum())
        if n_sure + n >= k:
            maybe = ones
        else:
            sure, n_sure, maybe = sure | ones, n_sure + n, maybe & ~plane
    rows = np.concatenate([_set_bits(sure), _set_bits(maybe)[:k - n_sure]])
    value = np.zeros(len(rows), np.int64)
    for j, plane in enumerate(score):
        value += (plane[rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64) << j
    return rows, value


def _set_bits(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
