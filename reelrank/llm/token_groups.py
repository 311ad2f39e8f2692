"""Tokens of two tokenizers over the same bytes, and the groups they share.

A text's bytes (a space and the text) are cut wherever a token of both ends.
Texts are encoded in chunks, cut before every single space between characters
that are no white space: the byte-level tokenizer starts a new word there, and
no piece of the other has a space but at its start, so the tokens of a text are
those of its chunks in turn, and a cut of both. A chunk's tokens, groups and
links are worked out once and looked up afterwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

MOST_CHUNKS = 300_000
MOST_CHARS = 1 << 23
JOINED = 1 << 16
DENSE_GROUP = 4096
_CUT = re.compile(r" (?=\S)")
_SPACES = re.compile(r"\s\s")


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones are themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def chunks(text: str) -> list[str]:
    """The parts of a space and the text; together they are just that."""
    if not _SPACES.search(text) and not text[0].isspace() and not text[-1].isspace():
        return [" " + p for p in text.split(" ")]
    parts = _CUT.split(" " + text)
    out = parts[:1] if parts[0] else []
    for p in parts[1:]:
        if out and out[-1][-1].isspace():  # more than one space
            out[-1] += " " + p
        else:
            out.append(" " + p)
    return out


@dataclass
class Counted:
    """Of a batch of texts: numbers per text, and the distinct (pair, text)
    links with how often each occurs."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digest: list[str]
    pair: np.ndarray
    text: np.ndarray
    times: np.ndarray


class Groups:
    """Both tokenizers and the chunks seen so far; emptied when it has grown
    to MOST_CHUNKS chunks or MOST_CHARS characters."""

    def __init__(self, byte_bpe: str, piece_model: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        value = byte_values()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(value[c] for c in token)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.whole = any("▁" in p.lstrip("▁") for p in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.width = len(self.b_bytes)
        self.a_text = [(f"{i},", f"{i}|") for i in range(len(self.a_bytes))]
        self.b_text = [(f"{i},", f"{i};") for i in range(self.width)]
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.groups_text: list[str] = []
        self.ok = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links
        self.first, self.many = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pair, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids_a(self, new: list[str]) -> list[list[int]]:
        """Chunks of plain form are encoded together: each starts a word and ends one."""
        out: list[list[int]] = [[]] * len(new)
        simple = [i for i, c in enumerate(new) if not c[1:2].isspace() and not c[-1].isspace()]
        at = 0
        while at < len(simple):
            end, size = at, 0
            while end < len(simple) and (end == at or size + len(new[simple[end]]) <= JOINED):
                size += len(new[simple[end]])
                end += 1
            mine = simple[at:end]
            ids = self.a.encode("".join(new[i] for i in mine), add_special_tokens=False).ids
            ends = np.cumsum(self.a_size[ids])
            want = np.cumsum([len(new[i].encode()) for i in mine])
            cut = np.searchsorted(ends, want)
            if not len(ids) or cut[-1] >= len(ends) or (ends[cut] != want).any():
                raise ValueError("the byte-level tokenizer joins words across spaces")
            for i, x, y in zip(mine, [0, *(cut[:-1] + 1).tolist()], (cut + 1).tolist(), strict=True):
                out[i] = ids[x:y]
            at = end
        done = set(simple)
        for i, c in enumerate(new):
            if i not in done:
                out[i] = self.a.encode(c, add_special_tokens=False).ids
        return out

    def _learn(self, new: list[str]) -> None:
        ids_a = self._ids_a(new)
        ids_b = self.b.encode([c[1:] for c in new], num_threads=1)
        data = [c.encode() for c in new]
        ok = np.array([b"".join([self.a_bytes[i] for i in x]) == d and b"".join([self.b_bytes[i] for i in y]) == d
                       for x, y, d in zip(ids_a, ids_b, data, strict=True)])
        good = np.flatnonzero(ok).tolist()
        base_index, base_pairs = len(self.groups_text), len(self.pair)
        counts = np.zeros((len(new), 4), np.int64)
        text = [""] * len(new)
        first, many = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        if good:
            n_a, n_b = np.array([len(ids_a[i]) for i in good]), np.array([len(ids_b[i]) for i in good])
            a, b = (np.array([t for i in good for t in ids[i]], np.int64) for ids in (ids_a, ids_b))
            a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            cuts = np.intersect1d(a_end, b_end, assume_unique=True)
            a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
            a_of, b_of = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
            a_before, b_before = np.cumsum(a_of) - a_of, np.cumsum(b_of) - b_of
            last_group = np.searchsorted(cuts, np.cumsum([len(data[i]) for i in good]))
            chunk_of = np.searchsorted(last_group, np.arange(len(cuts)))
            # the groups written out: A's tokens of a group, then B's
            flat = np.empty(len(a) + len(b), object)
            a_last = np.arange(len(a)) + 1 == (a_before + a_of)[a_group]
            b_last = np.arange(len(b)) + 1 == (b_before + b_of)[b_group]
            flat[np.arange(len(a)) + b_before[a_group]] = [self.a_text[i][e] for i, e in zip(a.tolist(), a_last.tolist(), strict=True)]
            flat[np.arange(len(b)) + (a_before + a_of)[b_group]] = [self.b_text[i][e] for i, e in zip(b.tolist(), b_last.tolist(), strict=True)]
            flat = flat.tolist()
            ends = np.cumsum(n_a + n_b).tolist()
            for i, x, y in zip(good, [0, *ends[:-1]], ends, strict=True):
                text[i] = "".join(flat[x:y])[:-1]
            # links: every token of A with every token of B in its group
            large = a_of * b_of > DENSE_GROUP
            usual = ~large[a_group]
            reps = b_of[a_group[usual]]
            left = np.repeat(a[usual], reps)
            step = np.arange(len(left)) - np.repeat(np.cumsum(reps) - reps, reps)
            right = b[np.repeat(b_before[a_group[usual]], reps) + step]
            where = [np.repeat(chunk_of[a_group[usual]], reps)]
            pairs, times = [left * self.width + right], [np.ones(len(left), np.int64)]
            for g in np.flatnonzero(large).tolist():  # by distinct ids, however long the group
                ua, ca = np.unique(a[a_before[g]:a_before[g] + a_of[g]], return_counts=True)
                ub, cb = np.unique(b[b_before[g]:b_before[g] + b_of[g]], return_counts=True)
                pairs.append((ua[:, None] * self.width + ub).ravel())
                times.append((ca[:, None] * cb).ravel())
                where.append(np.full(len(ua) * len(ub), chunk_of[g]))
            pair, time, chunk = np.concatenate(pairs), np.concatenate(times), np.concatenate(where)
            order = np.lexsort((pair, chunk))
            pair, time, chunk = pair[order], time[order], chunk[order]
            starts = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (chunk[1:] != chunk[:-1])))
            pair, chunk, time = pair[starts], chunk[starts], np.add.reduceat(time, starts)
            per = np.bincount(chunk, minlength=len(good))
            many[good] = per
            first[good] = np.cumsum(per) - per
            counts[good, 0], counts[good, 1] = n_a, n_b
            counts[good, 2] = np.diff(np.append(-1, last_group))
            counts[good, 3] = np.add.reduceat(time, np.cumsum(per) - per)
            self.pair, self.times = np.concatenate((self.pair, pair)), np.concatenate((self.times, time))
        self.index.update(zip(new, range(base_index, base_index + len(new)), strict=True))
        self.groups_text += text
        self.chars += sum(map(len, new))
        self.ok, self.counts = np.concatenate((self.ok, ok)), np.concatenate((self.counts, counts))
        self.first, self.many = np.concatenate((self.first, first + base_pairs)), np.concatenate((self.many, many))

    def count(self, texts: Sequence[str | None]) -> Counted:
        if len(self.index) > MOST_CHUNKS or self.chars > MOST_CHARS:
            self._forget()
        split = [[] if not t else [" " + t] if self.whole else chunks(t) for t in texts]
        new = list({c for parts in split for c in parts if c not in self.index})
        if new:
            self._learn(new)
        n = len(texts)
        size = np.array([len(p) for p in split], np.int64)
        at = np.array([self.index[c] for parts in split for c in parts], np.int64)
        owner = np.repeat(np.arange(n), size)
        usable = size > 0
        usable[owner[~self.ok[at]]] = False
        digest = ["" if not u else hashlib.sha256(";".join([self.groups_text[i] for i in x]).encode()).hexdigest()
                  for u, x in zip(usable.tolist(), np.split(at, np.cumsum(size)[:-1]) if n else [], strict=True)]
        keep = usable[owner]
        at, owner = at[keep], owner[keep]
        sums = np.zeros((n, 4), np.int64)
        np.add.at(sums, owner, self.counts[at])
        reps = self.many[at]
        place = np.repeat(self.first[at] - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
        key = self.pair[place] * n + np.repeat(owner, reps)
        order = np.argsort(key, kind="stable")
        key, times = key[order], self.times[place][order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        key = key[starts]
        times = np.add.reduceat(times, starts) if len(starts) else times
        return Counted(*sums.T, digest, key // max(n, 1), key % max(n, 1), times)
