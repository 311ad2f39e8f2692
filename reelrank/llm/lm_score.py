"""Stupid-backoff language-model scores from hash-partitioned count tables.

Documents are dealt into batches of a few megabytes. A batch's n-grams of all
orders are exploded, counted, and cut by ranges of their hash; a row of the
exploded table holds the sorted n-grams of one batch in one range, as packed
arrays. A batch has rows only for ranges it has n-grams in, so the table never
has more rows than n-grams. All rows of a range meet in one group, the count
table of that range, which is joined to each batch's n-grams and sent back to
the batch; there the scores of the words are summed per document. Text, n-grams
and counts move in three shuffles, compressed; nothing of them passes through
the driver.

A document is scored by the counts of all other documents (its own
occurrences are taken off), else no n-gram would be unseen and the model would
never back off.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.wordhash import hashed_words, mix

_U = np.uint64
BATCH_BYTES = 8 << 20
RANGE_BYTES = 8 << 20


def _pack(x: np.ndarray) -> bytes:
    """Integers as planes of equal bytes, compressed: planes of zeros cost next
    to nothing, and the highest other one less than a byte."""
    return zlib.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    data = zlib.decompress(data)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _pack_counts(x: np.ndarray) -> bytes:
    """Counts, most of which are 1: a bit for each, and those over 1."""
    more = x > 1
    return len(x).to_bytes(8, "little") + np.packbits(more).tobytes() + _pack(x[more])


def _unpack_counts(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    end = 8 + -(-n // 8)
    x = np.ones(n, np.uint64)
    x[np.unpackbits(np.frombuffer(data[8:end], np.uint8), count=n).astype(bool)] = _unpack(data[end:])
    return x


class _Grams:
    """The n-grams of a batch of texts: for each order the place of every
    position's n-gram in ``keys`` (sorted hashes), or -1 near a text's start."""

    def __init__(self, texts: list[str], order: int):
        words, ends = [], [0]
        for _, bounds, found, _ in hashed_words(texts):
            words.append(found)
            ends.extend((ends[-1] + bounds[1:]).tolist())
        w = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.ends = np.array(ends)
        self.doc = np.repeat(np.arange(len(ends) - 1), np.diff(self.ends))
        self.nth = np.arange(len(w)) - self.ends[self.doc]
        keys, counts, where, rolled = [], [], [], mix(w + _U(1))
        for k in range(order):
            if k:
                rolled = mix(np.concatenate(([0], rolled[:-1])).astype(np.uint64) * _U(0xD6E8FEB86659FD93) + w + _U(k + 1))
            found, at, count = np.unique(rolled[self.nth >= k], return_inverse=True, return_counts=True)
            where.append((at + sum(map(len, keys))).astype(np.int32))
            keys.append(found)
            counts.append(count)
        keys = np.concatenate(keys)
        by_hash = np.argsort(keys, kind="stable")
        self.keys, self.count = keys[by_hash], np.concatenate(counts)[by_hash]
        sorted_at = np.empty(len(keys), np.int32)
        sorted_at[by_hash] = np.arange(len(keys), dtype=np.int32)
        self.place = []
        for k in range(order):
            place = np.full(len(w), -1, np.int32)
            place[self.nth >= k] = sorted_at[where[k]]
            self.place.append(place)

    def ranges(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``n`` equal ranges of hashes have n-grams, and where each
        of these begins in ``keys``, with the end of the last."""
        found, begin = np.unique(((self.keys >> _U(32)) * _U(n)) >> _U(32), return_index=True)
        return found.astype(np.int64), np.append(begin, len(self.keys))

    def others(self, total: np.ndarray) -> list[np.ndarray]:
        """For each order, how often each position's n-gram occurs in other texts."""
        out = []
        for place in self.place:
            ok = np.flatnonzero(place >= 0)
            _, where, own = np.unique(self.doc[ok] * np.int64(len(self.keys)) + place[ok], return_inverse=True, return_counts=True)
            left = np.zeros(len(place), np.int64)
            left[ok] = total[place[ok]] - own[where]
            out.append(left)
        return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3,
          backoff: float = 0.4) -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``score`` (the sum of the
    words' log scores) and ``backed_off`` (words not scored by their longest
    n-gram).

    Words are runs of bytes other than white space, A-Z folded. A word with k
    words before it is scored by the n-gram of order min(k + 1, ``order``): its
    count over its context's count, in all other documents. If that is unseen,
    ``backoff`` times the score by the n-gram one word shorter; a single word
    by its count over all words of the others, and an unseen word as one of
    one word more than those. A null or empty text has no words and score 0.
    Rows that repeat an id or a text are documents each. An empty table gives
    an empty result. N-grams are told apart by 64-bit hashes.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size, words = rows.agg(F.sum(F.octet_length("text")), F.sum(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")))).first()
    size, words = size or 1, words or 0
    batches, ranges = math.ceil(size / BATCH_BYTES), math.ceil(size / RANGE_BYTES)
    id_type = dict(rows.dtypes)["id"]
    dealt = _dealt(rows, batches)

    def count(group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(_unpack(s), dtype=np.uint64) for s in group["steps"]]
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([_unpack_counts(c) for c in group["counts"]])
        total = np.bincount(where, weights=counts.astype(np.float64)).astype(np.uint64)[where]
        ends = np.cumsum([len(k) for k in keys])
        return pd.DataFrame({"batch": group["batch"], "range": group["range"],
                             "totals": [_pack_counts(t) for t in np.split(total, ends[:-1])]})

    def summed(batch: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        grams = _Grams(_texts(batch), order)
        found = [_unpack_counts(t) for t in totals.sort_values("range")["totals"]]
        total = np.concatenate([np.zeros(0, np.uint64), *found]).astype(np.int64)
        return pd.DataFrame({"id": batch["id"], **_score_words(grams, grams.others(total), words, order, backoff)})

    table = _exploded(dealt, ranges, order).groupBy("range").applyInPandas(count, "batch long, range long, totals binary")
    return (dealt.groupBy("batch").cogroup(table.groupBy("batch"))
            .applyInPandas(summed, f"id {id_type}, n_words long, score double, backed_off long"))


def _dealt(rows: DataFrame, batches: int) -> DataFrame:
    """``id``, ``batch`` and the compressed text, which is shuffled once."""
    @F.pandas_udf("binary")
    def shrunk(texts: pd.Series) -> pd.Series:
        return pd.Series([zlib.compress(t.encode(), 1) for t in texts], dtype=object)

    batch = F.pmod(F.xxhash64("id", "text"), F.lit(batches)).alias("batch")
    return rows.select("id", batch, shrunk("text").alias("text"))


def _texts(batch: pd.DataFrame) -> list[str]:
    return [zlib.decompress(t).decode() for t in batch["text"]]


def _exploded(dealt: DataFrame, ranges: int, order: int) -> DataFrame:
    """``range``, ``batch``, and the steps between and counts of the batch's
    n-grams in the range; a row for each range that has some."""
    def explode(batch: pd.DataFrame) -> pd.DataFrame:
        grams = _Grams(_texts(batch), order)
        found, at = grams.ranges(ranges)
        out = [(r, batch["batch"].iloc[0], _pack(np.diff(grams.keys[a:b], prepend=_U(0))), _pack_counts(grams.count[a:b]))
               for r, a, b in zip(found.tolist(), at[:-1], at[1:], strict=True)]
        return pd.DataFrame(out, columns=["range", "batch", "steps", "counts"])

    return dealt.groupBy("batch").applyInPandas(explode, "range long, batch long, steps binary, counts binary")


def _score_words(grams: _Grams, others: list[np.ndarray], words: int, order: int, backoff: float) -> dict:
    n = np.diff(grams.ends)
    rest = (words - n)[grams.doc]  # words of the other texts
    log = np.full(len(grams.doc), np.nan)
    longest = np.minimum(grams.nth, order - 1)
    used = np.zeros(len(log), np.int64)
    for k in range(order - 1, 0, -1):
        ok = np.isnan(log) & (longest >= k) & (others[k] > 0)
        at = np.flatnonzero(ok)
        log[at] = np.log(others[k][at] / others[k - 1][at - 1])
        used[at] = k
    at = np.flatnonzero(np.isnan(log))
    seen = others[0][at] > 0
    log[at] = np.where(seen, np.log(np.maximum(others[0][at], 1) / np.maximum(rest[at], 1)), -np.log(rest[at] + 1.0))
    log += (longest - used) * math.log(backoff)
    total = np.bincount(grams.doc, weights=log, minlength=len(n))
    return {"n_words": n, "score": total, "backed_off": np.bincount(grams.doc, weights=longest > used, minlength=len(n)).astype(np.int64)}
