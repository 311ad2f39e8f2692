"""Sampled segmentations into SentencePiece pieces, and lossless decoding.

A text's lattice has a node at every character and an edge for every piece
that spells the characters between two nodes. A path's probability is
proportional to the product of its pieces' weights. Forward filtering sums the
weights of all paths to each node; backward sampling walks from the end and
picks each edge in proportion to the paths through it, which draws a path
from exactly that distribution. The random numbers are hashes of the row's key
and the place in the text, so a row's segmentation does not depend on how rows
are split over tasks, and a lost task draws the same again.

No piece crosses a line feed or the space before a word, so the lattice falls
into parts there. Spark deals out the rows; a task handles the parts of a few
megabytes of whole texts at once on arrays, equal parts' lattices only once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.wordhash import mix

MARK = "▁"  # how pieces write a space
BATCH_CHARS = 3 << 19
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15 | 5)


class Pieces:
    """A model's pieces by hash, with log weights.

    The weight of the piece of rank r (its place among the model's pieces of
    text) is (r + 10) ** -alpha: pieces are ordered by merge or frequency, and
    a merge model's scores are ranks rather than probabilities. A character
    that is no piece is spelt by the pieces of its UTF-8 bytes, with the
    weight of a last-ranked piece.
    """

    def __init__(self, model: str, alpha: float):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.code = mix(np.arange(0x110000, dtype=np.uint64) + _U(1))
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        names = [sp.id_to_piece(i) for i in range(size)]
        byte = {int(names[i][1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        spelt = {i: names[i].replace(MARK, " ") for i in range(size) if not special[i] and not sp.is_byte(i)}
        if any(" " in s.lstrip(" ") or "\n" in s and len(s) > 1 for s in spelt.values()):
            raise ValueError("a piece crosses a space or a line feed")
        if len(byte) < 256:
            raise ValueError("the model cannot spell every byte")
        self.bytes_of = [spelt[i].encode() if i in spelt else b"" for i in range(size)]
        for b, i in byte.items():
            self.bytes_of[i] = bytes([b])
        self.byte_ids = np.array([byte[b] for b in range(256)], np.uint32)
        ids = np.array(list(spelt), np.int64)
        hashes = np.array([self.hash_of(s) for s in spelt.values()], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order].astype(np.int32)
        self.weights = (-alpha * np.log(np.arange(len(ids)) + 10.0))[order]
        self.rare = -alpha * float(np.log(len(ids) + 10.0))
        self.longest = max(map(len, spelt.values()), default=1)
        # where the hashes with given leading bits begin
        self.begin = np.searchsorted(self.hashes >> _U(44), np.arange((1 << 20) + 1, dtype=np.uint64)).astype(np.int32)
        self.most = int(np.diff(self.begin).max())
        self.padded = np.append(self.hashes, np.zeros(self.most, np.uint64))

    def hash_of(self, text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_STEP) + int(self.code[ord(c)])) % (1 << 64)
        return int(mix(np.array([h], np.uint64))[0])

    def spell(self, ids: bytes) -> str:
        """The text that little-endian ids spell, without the space before it."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()[1:]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the (unmixed) hashes are pieces, and their places in the table."""
        h = mix(h)
        slot = (h >> _U(44)).astype(np.int64)
        at = self.begin[slot]
        maybe = np.flatnonzero(self.begin[slot + 1] > at)
        h, at = h[maybe], at[maybe].astype(np.int64)
        hit = self.padded[at] == h
        for _ in range(self.most - 1):
            rest = np.flatnonzero(~hit)
            at[rest] += 1
            hit[rest] = self.padded[np.minimum(at[rest], len(self.hashes))] == h[rest]
        return maybe[hit], at[hit]


_loaded: dict[tuple[str, float], Pieces] = {}


def pieces_of(model: str, alpha: float) -> Pieces:
    if (model, alpha) not in _loaded:
        _loaded[model, alpha] = Pieces(model, alpha)
    return _loaded[model, alpha]


class _Lattices:
    """Filtered lattices of distinct parts. Nodes are numbered by their place
    in the part, then by part (longest first): node of part p at place k is
    base[k] + p. Edges are sorted by the node they enter; begin has a node's
    first edge, and at the share of the node's paths through an edge and those
    before it."""

    def __init__(self, pieces: Pieces, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        self.rank = np.empty(len(order), np.int32)
        self.rank[order] = np.arange(len(order), dtype=np.int32)
        length = lengths[order]
        alive = np.searchsorted(-length, -np.arange(length[0] + 1), side="right")  # parts that have the place
        self.base = np.concatenate(([0], np.cumsum(alive))).astype(np.int32)
        first = np.cumsum(length) - length
        part = np.repeat(np.arange(len(length), dtype=np.int32), length)
        place = (np.arange(len(part)) - np.repeat(first, length)).astype(np.int32)
        spelt = chars[np.repeat(starts[order], length) + place]
        code, left = pieces.code[spelt], np.repeat(length, length).astype(np.int32) - place
        found = []  # for each piece length the nodes entered, the nodes left, and the pieces' places
        h, at = np.zeros(len(code), np.uint64), np.arange(len(code), dtype=np.int32)
        for k in range(1, pieces.longest + 1):
            keep = np.flatnonzero(left[at] >= k)
            if not len(keep):
                break
            at, h = at[keep], h[keep]
            h = h * _STEP + code[at + (k - 1)]
            hit, where = pieces.find(h)
            spots = at[hit]
            if k == 1:  # characters that are no piece
                bare = np.ones(len(code), bool)
                bare[spots] = False
                bare = np.flatnonzero(bare)
                found.append((self.base[place[bare] + 1] + part[bare], self.base[place[bare]] + part[bare],
                              -1 - spelt[bare].astype(np.int32), pieces.rare))
            found.append((self.base[place[spots] + k] + part[spots], self.base[place[spots]] + part[spots],
                          pieces.ids[where], pieces.weights[where]))
        del code, left, h, at, part, place, spelt
        count = np.zeros(self.base[-1] + 1, np.int32)
        for node, *_ in found:
            count[node + 1] += 1  # a piece length enters a node once
        self.begin = np.cumsum(count, dtype=np.int32)
        self.out, self.piece = np.empty(self.begin[-1], np.int32), np.empty(self.begin[-1], np.int32)
        weight, next_edge = np.empty(self.begin[-1]), self.begin[:-1].copy()
        while found:  # the longest piece into a node first: it is the likeliest
            node, out, piece, w = found.pop()
            to = next_edge[node]
            self.out[to], self.piece[to], weight[to] = out, piece, w
            next_edge[node] = to + 1
        self._filter(np.repeat(np.arange(len(count) - 1, dtype=np.int32), count[1:]), weight)

    def _filter(self, node: np.ndarray, weight: np.ndarray) -> None:
        """Sums over the paths to each node, place by place, and the shares."""
        sums = np.zeros(self.base[-1])
        self.at = np.empty(len(node))
        bounds = self.begin[self.base]
        for a, b in zip(bounds[1:-1], bounds[2:], strict=True):
            here = node[a:b]
            seg = np.flatnonzero(np.concatenate(([True], here[1:] != here[:-1])))
            value = sums[self.out[a:b]] + weight[a:b]
            most = np.maximum.reduceat(value, seg)
            size = np.diff(np.concatenate((seg, [b - a])))
            share = np.exp(value - np.repeat(most, size))
            whole = np.add.reduceat(share, seg)
            sums[here[seg]] = most + np.log(whole)
            run = np.cumsum(share)
            run = (run - np.repeat(run[seg] - share[seg], size)) / np.repeat(whole, size)
            run[seg + size - 1] = 2.0  # over any random number
            self.at[a:b] = run

    def walk(self, which: np.ndarray, lengths: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled pieces of each part in order, and how many each has."""
        node = self.base[lengths] + self.rank[which]
        walker, taken, parts = np.arange(len(node), dtype=np.int32), [], self.base[1]
        while len(walker):
            u = (mix(draws[walker] + _U(len(taken))) >> _U(40)).astype(np.float64) * 2.0**-24
            edge = self.begin[node[walker]]
            over = np.flatnonzero(self.at[edge] <= u)
            while len(over):
                edge[over] += 1
                over = over[self.at[edge[over]] <= u[over]]
            taken.append((walker, self.piece[edge]))
            node[walker] = self.out[edge]
            walker = walker[node[walker] >= parts]
        count = np.zeros(len(node), np.int32)
        for w, _ in taken:
            count[w] += 1
        ends = np.cumsum(count, dtype=np.int64)
        found = np.empty(ends[-1], np.int32)
        for step, (w, p) in enumerate(taken):  # a walk runs from the end of the part to its start
            found[ends[w] - 1 - step] = p
        return found, count


def sample_batch(pieces: Pieces, texts: list[str], keys: np.ndarray) -> list[bytes]:
    """Little-endian ids of one segmentation of each text."""
    full = [i for i, t in enumerate(texts) if t]
    result = [b""] * len(texts)
    if not full:
        return result
    chars = np.frombuffer("".join(" " + texts[i] for i in full).encode("utf-32-le"), np.uint32)
    doc_at = np.cumsum([0] + [len(texts[i]) + 1 for i in full])
    space, feed = chars == 32, chars == 10
    cut = feed.copy()
    cut[1:] |= feed[:-1] | (space[1:] & ~space[:-1])
    cut[doc_at[:-1]] = True
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.concatenate((starts, [len(chars)])))
    place = np.arange(len(chars)) - np.repeat(starts, lengths)
    power = np.full(int(lengths.max()), _STEP)
    power[0] = 1
    hashes = mix(np.add.reduceat(pieces.code[chars] * np.cumprod(power, dtype=np.uint64)[place], starts) + lengths.astype(np.uint64))
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    lattices = _Lattices(pieces, chars, starts[first], lengths[first])
    doc = np.searchsorted(doc_at, starts, side="right") - 1
    nth = (starts - doc_at[doc]).astype(np.uint64)
    draws = mix(keys[full][doc].astype(np.int64).view(np.uint64) + mix(nth + _U(1)))
    found, count = lattices.walk(which, lengths, draws)
    per_doc = np.add.reduceat(count, np.searchsorted(doc, np.arange(len(full))), dtype=np.int64)
    odd = np.flatnonzero(found < 0)
    if len(odd):  # spelt in bytes
        spelt = [chr(-1 - c).encode() for c in found[odd].tolist()]
        size = np.ones(len(found), np.int64)
        size[odd] = [len(s) for s in spelt]
        owner = np.repeat(np.arange(len(full)), per_doc)
        ids = np.repeat(found, size)
        ids[ids < 0] = pieces.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
        per_doc = np.bincount(owner, weights=size, minlength=len(full)).astype(np.int64)
        found = ids
    data, ends = found.astype("<u4").tobytes(), 4 * np.cumsum(per_doc)
    for i, a, b in zip(full, (ends - 4 * per_doc).tolist(), ends.tolist(), strict=True):
        result[i] = data[a:b]
    return result


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0,
           seed: int = 0) -> DataFrame:
    """One row per input row: ``id``, ``text``, ``pieces`` (little-endian
    unsigned 32-bit ids of one sampled segmentation).

    A larger ``alpha`` favours pieces of low rank more. Equal id, text and
    ``seed`` give equal pieces, however rows are dealt out; a null id is a key
    like any other. A null or empty text has no pieces (``text`` is then
    empty). An empty table gives an empty result.
    """
    return _sampled(docs, id_col, text_col, seed, lambda: pieces_of(model, alpha), "binary", lambda p, out: out)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0,
               seed: int = 0) -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: ``id``, ``text``,
    ``pieces``, ``decoded``."""
    both = _sampled(docs, id_col, text_col, seed, lambda: pieces_of(model, alpha), "pieces binary, decoded string",
                    lambda p, out: pd.DataFrame({"pieces": out, "decoded": [p.spell(o) for o in out]}))
    return both.select("id", "text", "pieces.pieces", "pieces.decoded")


def _sampled(docs: DataFrame, id_col: str, text_col: str, seed: int, load, kind: str, shape) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(seed))

    def sampled(texts: pd.Series, keys: pd.Series):
        pieces, texts, keys = load(), texts.tolist(), keys.to_numpy()
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_CHARS):
                size += len(texts[end])
                end += 1
            out += sample_batch(pieces, texts[at:end], keys[at:end])
            at = end
        made = shape(pieces, out)
        return made if isinstance(made, pd.DataFrame) else pd.Series(made, dtype=object)

    sampled.__annotations__["return"] = pd.DataFrame if "," in kind else pd.Series
    return rows.withColumn("pieces", F.pandas_udf(sampled, kind)("text", key))


def decode(encoded: DataFrame, model: str, pieces_col: str = "pieces") -> DataFrame:
    """``encoded`` with ``decoded``: the text that the pieces spell, exactly the
    one encoded; null pieces give the empty text."""
    @F.pandas_udf("string")
    def spelt(column: pd.Series) -> pd.Series:
        pieces = pieces_of(model, 1.0)
        return pd.Series([pieces.spell(p or b"") for p in column], dtype=object)

    return encoded.withColumn("decoded", spelt(pieces_col))
