"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (the parts between line feeds; empty
ones don't count). Every paragraph is hashed to a wide vector and the vectors
of all paragraphs are added, lane by lane, modulo powers of two. So the order
of paragraphs does not matter, and a paragraph is put in or taken out by adding
or subtracting its vector alone.

A vector has two parts. ``EQUAL`` lanes modulo 2^64 are a digest of the whole
paragraph: equal sums mean equal multisets (but for a collision). ``LIKE``
lanes modulo 2^32 hold +1 or -1 for each of the paragraph's word pairs, in
a lane that its hash names: the products of two such sums add up, on average,
to the product of the shingle counts of both texts, from which ``likeness`` is
taken. Sums stay exact up to 2^31 shingles in a lane.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reelrank.llm.successors import in_order
from reelrank.llm.wordhash import hashed_words, mix

EQUAL, LIKE, WORDS = 8, 256, 2
BATCH_CHARS = 1 << 20
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
Vectors = tuple[np.ndarray, np.ndarray]


def paragraphs(text: str | None) -> list[str]:
    return [p for p in (text or "").split("\n") if p]


def _shingles(bounds: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(paragraph, hash) of all runs of WORDS words; a paragraph of fewer words is one."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    left = bounds[1:][owner] - np.arange(len(words))  # words from here to the paragraph's end
    count = np.diff(bounds)[owner]
    first = left == count
    starts = np.flatnonzero((left >= WORDS) | (first & (count < WORDS)))
    size = np.minimum(count[starts], WORDS)
    made = size.astype(_U)
    for k in range(WORDS):
        has = size > k
        made[has] = mix(made[has] * _STEP + words[starts[has] + k])
    return owner[starts], made


def vectors(texts: Sequence[str | None]) -> Vectors:
    """The vectors of texts: unsigned 64-bit (texts x EQUAL) and 32-bit (texts x LIKE)."""
    parts = [paragraphs(t) for t in texts]
    counts = np.array([len(p) for p in parts], np.int64)
    flat = [p for ps in parts for p in ps]
    owner = np.repeat(np.arange(len(texts)), counts)
    equal = np.zeros((len(texts), EQUAL), _U)
    if flat:
        digests = np.frombuffer(b"".join(hashlib.blake2b(p.encode("utf-8"), digest_size=8 * EQUAL).digest() for p in flat), "<u8")
        has = np.flatnonzero(counts)
        equal[has] = np.add.reduceat(digests.reshape(-1, EQUAL).astype(_U), (np.cumsum(counts) - counts)[has], axis=0)
    sums = np.zeros(len(texts) * LIKE, np.int64)
    for at, bounds, words, _ in hashed_words(flat, fold=None):
        paragraph, shingle = _shingles(bounds, words)
        lane = owner[at + paragraph] * LIKE + (shingle & _U(LIKE - 1)).astype(np.int64)
        sign = ((shingle >> _U(32)) & _U(1)).astype(np.int64) * 2 - 1
        low = int(lane[0]) // LIKE * LIKE if len(lane) else 0
        added = np.bincount(lane - low, weights=sign)
        sums[low:low + len(added)] += added.astype(np.int64)
    return equal, sums.astype(np.uint32).reshape(len(texts), LIKE)


def written_out(v: Vectors) -> list[str]:
    """Fingerprints as hexadecimal strings, lanes little-endian."""
    rows = np.concatenate((v[0].astype("<u8").view(np.uint8), v[1].astype("<u4").view(np.uint8)), axis=1)
    return [r.tobytes().hex() for r in rows]


def read_in(prints: Sequence[str]) -> Vectors:
    rows = np.frombuffer(bytes.fromhex("".join(prints)), np.uint8).reshape(len(prints), 8 * EQUAL + 4 * LIKE)
    return np.ascontiguousarray(rows[:, :8 * EQUAL]).view("<u8"), np.ascontiguousarray(rows[:, 8 * EQUAL:]).view("<u4")


def alike(a: Vectors, b: Vectors) -> np.ndarray:
    """Shared shingles as a share of both texts' (2 a.b / (a.a + b.b)), 0 to 1;
    1 for equal fingerprints, 0 if one text has no shingles."""
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    both = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    share = np.clip(2 * (x * y).sum(axis=1) / np.maximum(both, 1), 0, 1)
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    return np.where(same, 1.0, share)


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column; null counts as empty (all lanes 0)."""
    return pandas_udf(lambda t: pd.Series(written_out(vectors(t.tolist())), dtype=object), "string")(text)


def changed(prints: Column, added: Column, removed: Column) -> Column:
    """Fingerprints after the paragraphs of ``added`` were put in and those of
    ``removed`` taken out, without the texts they were made of. Null texts
    change nothing; a null fingerprint stays null."""
    def put(p: pd.Series, plus: pd.Series, minus: pd.Series) -> pd.Series:
        has = p.notna()
        out = pd.Series([None] * len(p), dtype=object)
        if has.any():
            old, new, gone = read_in(p[has].tolist()), vectors(plus[has].tolist()), vectors(minus[has].tolist())
            out[has] = written_out((old[0] + new[0] - gone[0], old[1] + new[1] - gone[1]))
        return out
    return pandas_udf(put, "string")(prints, added, removed)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1; null if one is null."""
    def compared(p: pd.Series, q: pd.Series) -> pd.Series:
        has = p.notna() & q.notna()
        out = pd.Series([None] * len(p), dtype="Float64")
        if has.any():
            out[has] = alike(read_in(p[has].tolist()), read_in(q[has].tolist()))
        return out
    return pandas_udf(compared, "double")(a, b)


def spliced(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the following one's beginning (or all of it)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``n_chars`` (code points), ``fingerprint``,
    ``edited`` (``spliced`` with the next text in ascending order of the id),
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` (likeness to the
    edited and to the next text).

    Ids are integers. A null id counts as the smallest; rows of one id follow
    each other by a 64-bit hash of their texts; after the last row comes the
    first, so a single row follows itself. A null text is empty: its
    fingerprint is all zeros, equal to every other empty one's (likeness 1) and
    unlike any text with words (0). Texts are never cut but by the splice; text
    that is only punctuation counts as words. An empty table gives an empty
    result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def made(ids: list, texts: list[str], v: Vectors) -> pd.DataFrame:
        """Of all rows but the last, which is only a follower."""
        edited = [spliced(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
        e = vectors(edited)
        mine, following = (v[0][:-1], v[1][:-1]), (v[0][1:], v[1][1:])
        return pd.DataFrame({"id": pd.array(ids[:-1], "Int64"), "n_chars": [len(t) for t in texts[:-1]],
                             "fingerprint": written_out(mine), "edited": edited, "edited_fingerprint": written_out(e),
                             "near_edited": alike(mine, e), "near_next": alike(mine, following)})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list = []
        texts: list[str] = []
        v: Vectors = (np.zeros((0, EQUAL), _U), np.zeros((0, LIKE), np.uint32))
        closed = True  # the last row was a follower alone
        for b in batches:
            new_ids = [None if pd.isna(i) else int(i) for i in b["id"]]
            new_texts, follower = b["text"].tolist(), b["follower"].tolist()
            at = 0
            while at < len(new_texts):
                end, size = at, 0
                while end < len(new_texts) and (end == at or size + len(new_texts[end]) <= BATCH_CHARS):
                    size += len(new_texts[end])
                    end += 1
                    if follower[end - 1]:
                        break
                part = vectors(new_texts[at:end])
                if not (closed and follower[at]):  # another copy of a row that followed already
                    ids, texts = ids + new_ids[at:end], texts + new_texts[at:end]
                    v = (np.concatenate((v[0], part[0])), np.concatenate((v[1], part[1])))
                    if len(ids) > 1:
                        yield made(ids, texts, v)
                    closed = follower[end - 1]
                    keep = len(ids) if closed else len(ids) - 1
                    ids, texts, v = ids[keep:], texts[keep:], (v[0][keep:], v[1][keep:])
                at = end

    return in_order(rows, "id", "text").mapInPandas(
        walk, "id long, n_chars long, fingerprint string, edited string, edited_fingerprint string, "
              "near_edited double, near_next double")
