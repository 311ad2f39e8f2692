"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as
many pieces of the full sequence length as fit, then one piece for each bit of
the rest. Each piece is a sequence of its own, so no sequence crosses
documents and none has padding; sequences of one length form a bucket, from
which batches of equal length are drawn.

Tokenising runs inside Spark tasks, a text at a time; numbering the sequences
needs one count for each task and length, not a shuffle of the pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.llm.common import written
from reelrank.llm.wordhash import mix

BATCH_CHARS = 1 << 20
CACHE_WORDS = 400_000
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15 | 5)
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)


def _classes() -> np.ndarray:
    """What the tokenizer's pattern makes of a character; odd are those that it
    or its normalizer treats in some way of their own, or that may be part of
    a special token."""
    kind = np.full(0x110000, _ODD, np.uint8)
    kind[[32, *range(9, 14)]] = _SPACE
    for c in range(33, 127):
        kind[c] = _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _SIGN
    kind[[ord("'"), ord("<")]] = _ODD
    kind[[c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]] = _LETTER
    return kind


class Tokens:
    """Ids of texts by a tokenizer whose pattern drops white space and keeps
    runs of letters, single digits and runs of signs apart, so that the ids of
    a text are those of these words in turn. A word's ids are looked up by its
    64-bit hash, on arrays; new words go through the tokenizer's model, and
    whatever holds an odd character through the whole tokenizer, from space to
    space. The table of words is emptied when it is full."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # the same model without the work that plain lower-case words don't need
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.words.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(self.words.model.end_of_word_suffix)]] = True
        self.kind = _classes()
        self.code = mix(np.arange(0x110000, dtype=np.uint64) + _U(1))
        plain = self.kind != _ODD
        lower = np.array([ord(chr(c).lower()) for c in range(256)])
        self.folded = self.code.copy()
        self.folded[:256] = np.where(plain[:256], self.code[lower], self.code[:256])
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, plain: list[str], odd: list[str], is_odd: np.ndarray) -> None:
        """Add the ids of new words; ``keys`` in order, ``plain`` and ``odd``
        in the order of theirs."""
        groups = [plain[i:i + 500] for i in range(0, len(plain), 500)]
        found = [np.array(e.ids, np.uint32) for e in
                 self.words.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)]
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        size = np.zeros(len(keys), np.int64)
        size[~is_odd] = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        others = [np.array(self.tokenizer.encode(o, add_special_tokens=False).ids, np.uint32) for o in odd]
        size[is_odd] = [len(o) for o in others]
        first = np.zeros(len(keys), np.int64)
        first[~is_odd] = np.cumsum(size[~is_odd]) - size[~is_odd] + len(self.ids)
        first[is_odd] = np.cumsum(size[is_odd]) - size[is_odd] + len(self.ids) + len(ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.count = (np.insert(old, at, new) for old, new in (
            (self.keys, keys), (self.first, first), (self.count, size)))
        self.ids = np.concatenate([self.ids, ids, *others])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_CHARS):
                size += len(texts[end])
                end += 1
            yield from self._encode(texts[at:end])
            at = end

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        joined = "\n".join(texts) + "\n"
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.kind[chars]
        space = kind == _SPACE
        part_at = ~space
        part_at[1:] &= space[:-1]
        starts = part_at.copy()
        starts[1:] |= ~space[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        parts = np.flatnonzero(part_at)
        if not len(parts):
            yield from [b""] * len(texts)
            return
        part = np.cumsum(part_at) - 1
        odd_part = np.bincount(part[kind == _ODD], minlength=len(parts)) > 0
        if odd_part.any():  # one word from space to space
            starts &= part_at | ~odd_part[np.maximum(part, 0)]
        starts = np.flatnonzero(starts)
        is_odd = odd_part[part[starts]]
        length = np.add.reduceat(~space, starts, dtype=np.int64)
        run = np.diff(np.append(starts, len(chars)))
        place = np.arange(starts[0], len(chars)) - np.repeat(starts, run)
        power = np.full(int(run.max()), _STEP)
        power[0] = 1
        code = self.folded[chars]
        if odd_part.any():
            code = np.where(np.append(odd_part, False)[part], self.code[chars] + _U(1), code)
        code[space] = 0
        hashes = mix(np.add.reduceat(code[starts[0]:] * np.cumprod(power, dtype=np.uint64)[place], starts - starts[0])
                     + length.astype(np.uint64))
        keys, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        new[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] != keys[at < len(self.keys)]
        if new.any():
            spots = where[new]
            spelt = [joined[a:b] for a, b in zip(starts[spots].tolist(), (starts[spots] + length[spots]).tolist(), strict=True)]
            odd = is_odd[spots]
            self._learn(keys[new], [w.lower() for w, o in zip(spelt, odd.tolist(), strict=True) if not o],
                        [w for w, o in zip(spelt, odd.tolist(), strict=True) if o], odd)
            at = np.searchsorted(self.keys, keys)
        first, count = self.first[at][which], self.count[at][which]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(first - (ends - count), count) + np.arange(ends[-1])]
        data = ids.astype("<u4").tobytes()
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        cut = (4 * np.append(0, ends)[np.searchsorted(starts, text_ends)]).tolist()
        for a, b in zip([0, *cut[:-1]], cut, strict=True):
            yield data[a:b]


_loaded: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]


def piece_lengths(n: int, most: int) -> list[int]:
    """Powers of two, largest first, that add up to ``n``; none over ``most``."""
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 2, -1, -1) if (n % most) >> b & 1]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096,
         end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, with ``with_ids``, ``ids``
    (little-endian unsigned 32-bit). ``length`` is the bucket and a power of two.

    A document's tokens are the ids of its whole text and ``end_id``; a null or
    empty text has ``end_id`` alone. ``sequence_id`` counts the sequences from
    0, bucket by bucket, longest first; ``offset`` is 0, as a sequence is one
    piece. Rows that repeat an id are packed each; a null id stays null. An
    empty table gives an empty result.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length is a power of two")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, encoder = TaskContext.get().partitionId(), tokens(tokenizer)
        made: dict[int, int] = {}
        for b in batches:
            out: list[tuple] = []
            size = 0
            for doc, data in zip(b["id"], encoder.encode(b["text"].tolist()), strict=True):
                data += end
                at, n = 0, len(data) // 4
                for k in piece_lengths(n, length):
                    part = data[4 * at:4 * (at + k)]
                    nth = made[k] = made.get(k, -1) + 1
                    out.append((doc, at, k, zlib.crc32(part), n, task, nth, *([part] if with_ids else [])))
                    at += k
                    size += 4 * k
                if size > 1 << 23:
                    yield frame(out)
                    out, size = [], 0
            yield frame(out)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth", *(["ids"] if with_ids else [])]
    id_type = dict(rows.dtypes)["id"]

    def frame(out: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(out, columns=names)
        if id_type in ("bigint", "int"):
            made["id"] = made["id"].astype("Int64")
        return made

    schema = (f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long"
              + (", ids binary" if with_ids else ""))
    # the tasks' counts must belong to the very rows that are numbered by them
    pieces = written(rows.mapInPandas(cut, schema), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    of_length = counts.groupBy("length").agg(F.sum("n").alias("n"))  # a row for each power of two
    base = of_length.select("length", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    in_length = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    first = (counts.withColumn("before", F.coalesce(in_length, F.lit(0))).join(base, "length")
             .select("length", "task", (F.col("base") + F.col("before")).alias("first")))
    # first has a row for each task and length; Spark sends it to all executors if it is small
    return (pieces.join(first, ["length", "task"])
            .select("id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("first") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                    *(["ids"] if with_ids else [])))
