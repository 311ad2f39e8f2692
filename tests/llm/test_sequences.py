"""Token alignment, periodic runs and fingerprints against plain computations."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.llm import alignment, fingerprints, periodic_runs
from reelrank.llm.q_alignment import op11_token_alignment, tokenizer_paths
from reelrank.llm.q_fingerprints import op13_fingerprints
from reelrank.llm.q_periodic_runs import op12_periodic_runs
from reelrank.llm.token_groups import byte_values, chunks

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n", "a", "  a  b ", "\n\n x\ny\n", "▁literal ▁▁ mark", "日本 \U0001F600\x00\x85 ç", "It's café’s ½ x²",
       "<|endoftext|> a</s>b <unk> <0x41>", "=-" * 3000, "日" * 400, "x" * 70_000 + " y", "same words\n" * 50, "one\ntwo\nthree"]


# ------------------------------------------------------------------ alignment

@pytest.fixture(scope="module")
def plain_tokens():
    import sentencepiece
    from tokenizers import Tokenizer
    paths = tokenizer_paths()
    first = Tokenizer.from_file(paths[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    value = byte_values()

    def tokens(text):
        """(ids and byte ends) of both tokenizers over the whole text at once, or none."""
        if not text:
            return [], [], [], []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        a_bytes = [bytes(value[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
                   for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return [], [], [], []
        return a, np.cumsum([len(x) for x in a_bytes]).tolist(), b, np.cumsum([len(x) for x in b_bytes]).tolist()
    return tokens


def aligned(texts, tokens):
    """What the operator returns for each text, by going through all groups."""
    out, linked = [], []
    for t in texts:
        a, a_end, b, b_end = tokens(t)
        groups, links, lo = [], collections.Counter(), 0
        for cut in sorted(set(a_end) & set(b_end)):
            x = [i for i, e in zip(a, a_end, strict=True) if lo < e <= cut]
            y = [i for i, e in zip(b, b_end, strict=True) if lo < e <= cut]
            groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
            links.update((i, j) for i in x for j in y)
            lo = cut
        linked.append(links)
        out.append([len(a), len(b), len(groups), links.total(), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    count = collections.Counter(p for links in linked for p in links)
    top = collections.defaultdict(int)
    for (i, _), n in count.items():
        top[i] = max(top[i], n)
    return [(*o[:4], sum(m for p, m in links.items() if count[p] == top[p[0]]), sum(m * count[p] for p, m in links.items()), o[4])
            for o, links in zip(out, linked, strict=True)], count


def test_alignment_as_plain_count(docs_of, plain_tokens):
    rng = random.Random(3)
    parts = ["a", "the", "ing", " ", "  ", "\n", "\t", "é", "日本", "'s", "345", "!!", "==", "<|endoftext|>", "▁", "\x85", "ﬁ", "."]
    texts = [t for t in ODD if not t or len(t) < 5000]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    texts += ["the same text"] * 40
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "the same id"), (None, "the null id"), (None, "the null id")]
    documents, pairs = alignment.align(docs_of(rows), *tokenizer_paths())
    expected, count = aligned([t for _, t in rows], plain_tokens)
    got = [tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in documents.collect()]
    assert sorted(got) == sorted(expected)
    found = {(r.a, r.b): (r.n, r.best) for r in pairs.collect()}
    assert {p: n for p, (n, _) in found.items()} == count
    top = collections.Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    assert all(best == (n == top[a]) for (a, _), (n, best) in found.items())


def test_alignment_query(spark, plain_tokens):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    docs = sorted(docs, key=lambda d: d.doc_id)
    expected, _ = aligned([d.text if len(d.text) < 3000 else None for d in docs], plain_tokens)
    got = {r.doc_id: r for r in op11_token_alignment(spark, SF).collect()}
    assert sorted(got) == [d.doc_id for d in docs]
    for d, e in zip(docs, expected, strict=True):
        if len(d.text) < 3000:  # counts come from all documents, so only a document's own numbers here
            r = got[d.doc_id]
            assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (*e[:4], e[6])


def test_alignment_of_none(docs_of):
    documents, pairs = alignment.align(docs_of([(1, "a")]).filter("false"), *tokenizer_paths())
    assert documents.count() == pairs.count() == 0
    documents, pairs = alignment.align(docs_of([(1, None)]), *tokenizer_paths())
    assert [tuple(r) for r in documents.collect()] == [(1, 0, 0, 0, 0, 0, 0, "")] and pairs.count() == 0


def test_pair_bitmaps_round_trip():
    rng = np.random.default_rng(4)
    for n_docs in (1, 7, 300, 65536):
        pair, doc = rng.integers(0, 40, 3000), rng.integers(0, n_docs, 3000)
        doc[pair == 5] = np.arange((pair == 5).sum()) % n_docs  # a dense one
        times = rng.integers(1, 4, 3000)
        times[rng.random(3000) < 0.05] = 1000
        a, b = (pair[:1700], doc[:1700], times[:1700]), (pair[1700:], doc[1700:], times[1700:])
        both = alignment.merged(*(np.concatenate(x) for x in zip(alignment.merged(*a), alignment.merged(*b), strict=True)))
        want = collections.Counter()
        for p, d, t in zip(pair.tolist(), doc.tolist(), times.tolist(), strict=True):
            want[p, d] += t
        pairs, n, docs, dense, planes = alignment.bitmaps(*both, n_docs)
        row, where, found = alignment.links(n, docs, dense, planes)
        assert dict(want) == {(int(pairs[r]), int(d)): int(t) for r, d, t in zip(row, where, found, strict=True)}
        assert sum(n) == len(want)


def test_chunks_are_the_text():
    for t in [t for t in ODD if t]:
        assert "".join(chunks(t)) == " " + t


def test_a_long_group_is_linked_by_distinct_ids(docs_of, plain_tokens, monkeypatch):
    from reelrank.llm import token_groups
    made = token_groups.Groups(*tokenizer_paths())
    monkeypatch.setattr(token_groups, "DENSE_GROUP", 1)
    texts = ["=-=-" * 30 + " the ing日本" * 3, "the ing"]
    c = made.count(texts)
    expected, _ = aligned(texts, plain_tokens)
    assert [tuple(x) for x in zip(c.n_a, c.n_b, c.n_groups, c.n_links, strict=True)] == [e[:4] for e in expected]


# ------------------------------------------------------------- periodic runs

def runs_by_trial(words, least=12):
    """All runs, by trying every period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def test_runs_as_by_trial(docs_of):
    rng = random.Random(1)
    texts = [[], ["a"] * 11, ["a"] * 12, ["a"] * 300, fibonacci(400), [str(bin(i).count("1") % 2) for i in range(512)],
             (["a"] * 50 + ["x"]) * 8, list("abcabcabcabcabx"), list("abcdefg") * 2, list("abcdef") * 2]
    for _ in range(150):
        n, k = rng.randint(0, 200), rng.choice([1, 2, 2, 3, 5, 40])
        words = [f"w{rng.randrange(k)}" for _ in range(n)]
        if n > 30 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 10)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            words[rng.randrange(n)] = rng.choice(["z", words[0]])
        texts.append(words)
    rows = [(i, rng.choice([" ", "\n", " \t\x0b\f\r "]).join(w)) for i, w in enumerate(texts)]
    got = {r.id: r for r in periodic_runs.detect(docs_of(rows)).collect()}
    for i, words in enumerate(texts):
        runs = sorted(runs_by_trial(words), key=lambda r: (r[0], r[2]))
        assert [tuple(r) for r in got[i].runs] == runs and got[i].n_words == len(words)
        assert got[i].collapsed == collapsed(words, runs)


def test_runs_of_odd_texts(docs_of):
    rows = list(enumerate(ODD)) + [(3, "again"), (None, "a " * 20), (None, "a " * 20)]
    frame = docs_of(rows)
    got = periodic_runs.detect(frame).collect()
    assert len(got) == len(rows)
    by = collections.Counter((r.id, r.n_words, len(r.runs)) for r in got)
    assert by[None, 20, 1] == 2 and by[0, 0, 0] == by[1, 0, 0] == 1
    words = ODD[14].split()
    assert next(r for r in got if r.id == 14).runs == [(0, len(words), 2)]
    assert periodic_runs.detect(frame.filter("false")).count() == 0


def test_runs_of_a_long_text():
    import time
    began = time.time()
    for words, runs in ((["a"] * 400_000, 1), ((["a"] * 1000 + ["x"]) * 100, 101), (fibonacci(100_000), None)):
        found = periodic_runs.of_texts([" ".join(words).encode()], 12).to_pylist()[0]["runs"]
        assert runs is None or len(found) == runs
    assert time.time() - began < 30


def test_runs_query(spark):
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SF).collect()}
    with_runs = 0
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = d.text.encode().split()
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        words = [w.decode() for w in words]
        runs = sorted(runs_by_trial(words), key=lambda r: (r[0], r[2]))
        with_runs += bool(runs)
        best = min(((-length, a, q) for a, length, q in runs), default=None)
        first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        listed = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
        assert tuple(got[d.doc_id]) == (d.doc_id, len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(),
                                        hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    assert with_runs > 10 and len(got) == 200


# -------------------------------------------------------------- fingerprints

def plain_print(text):
    """Equal lanes, and the word pairs of all paragraphs with how often each occurs."""
    lanes, pairs = [0] * fingerprints.EQUAL, collections.Counter()
    for p in (text or "").split("\n"):
        if p:
            d = hashlib.blake2b(p.encode(), digest_size=64).digest()
            lanes = [(x + int.from_bytes(d[8 * i:8 * i + 8], "little")) % 2**64 for i, x in enumerate(lanes)]
            words = p.encode().split()
            pairs.update([tuple(words)] if len(words) == 1 else zip(words, words[1:]))
    return lanes, pairs


def test_fingerprints_as_plain_sums(docs_of):
    rng = random.Random(5)
    lines = [" ".join(rng.choice(["a", "b", "the", "word", "é"]) + str(rng.randrange(60)) for _ in range(rng.randint(1, 40))) for _ in range(80)]
    texts = ODD + ["\n".join(rng.sample(lines, rng.randint(1, 20))) for _ in range(200)]
    rows = [(i * 3 - 50, t) for i, t in enumerate(texts)] + [(4, "x y z"), (4, "p q\nr s"), (None, "n u l l"), (None, None)]
    got = fingerprints.with_edits(docs_of(rows)).collect()
    assert len(got) == len(rows)
    single = collections.Counter(i for i, _ in rows)
    order = sorted((i, t or "") for i, t in rows if i is not None)
    by = {r.id: r for r in got if single[r.id] == 1}
    for at, (i, text) in enumerate(order):
        if single[i] > 1 or at + 1 == len(order) or single[order[at + 1][0]] > 1:
            continue
        following, r = order[at + 1][1], by[i]
        edited = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        assert (r.n_chars, r.edited) == (len(text), edited)
        for t, made in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert fingerprints.read_in([made])[0][0].tolist() == plain_print(t)[0]
        for t, near in ((edited, r.near_edited), (following, r.near_next)):
            (mine, x), (other, y) = plain_print(text), plain_print(t)
            shared = sum(n * y[p] for p, n in x.items())
            total = sum(n * n for n in x.values()) + sum(n * n for n in y.values())
            assert 0 <= near <= 1 and (near == 1 or mine != other)
            if mine == other or total >= 60:  # of a few pairs one that shares a lane by chance weighs much
                assert abs(near - (1 if mine == other else 2 * shared / total)) < 0.35
    # null ids come first, rows of one id follow each other, and the last row is followed by the first
    last = by[order[-1][0]]
    first = [t or "" for i, t in rows if i is None]
    assert last.edited in {order[-1][1][:len(order[-1][1]) - last.n_chars // 2] + t[:last.n_chars // 2] for t in first}


def test_fingerprints_do_not_depend_on_order_and_change_in_place(spark):
    rows = [("one two\nthree four\nfive", "five\none two\n\nthree four", "three four", "six seven", "six seven\nfive\none two")]
    frame = spark.createDataFrame(rows, "a string, b string, gone string, new string, after string")
    made = frame.select(fingerprints.fingerprint(F.col("a")).alias("a"), fingerprints.fingerprint(F.col("b")).alias("b"),
                        fingerprints.changed(fingerprints.fingerprint(F.col("a")), F.col("new"), F.col("gone")).alias("changed"),
                        fingerprints.fingerprint(F.col("after")).alias("after"),
                        fingerprints.fingerprint(F.lit(None).cast("string")).alias("none"))
    r = made.first()
    assert r.a == r.b and r.changed == r.after != r.a and set(r.none) == {"0"}
    near = made.select(fingerprints.likeness("a", "b").alias("same"), fingerprints.likeness("a", "none").alias("none"),
                       fingerprints.likeness(F.col("a"), F.lit(None).cast("string")).alias("unknown")).first()
    assert (near.same, near.none, near.unknown) == (1, 0, None)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_fingerprints_of_few(docs_of, n):
    got = fingerprints.with_edits(docs_of([(7, "abcdef"), (8, "uvw")][:n] or [(1, "x")]).filter(F.lit(n > 0))).orderBy("id").collect()
    assert [r.edited for r in got] == [[], ["abcabc"], ["abcuvw", "uva"]][n]


def test_one_id_and_copies_over_many_tasks(docs_of):
    """A third of the rows share an id, and one row is there many times."""
    rows = [(5, f"text number {i}") for i in range(300)] + [(9, "copy of one")] * 200 + [(i, f"other {i}") for i in range(10, 400)]
    got = fingerprints.with_edits(docs_of(rows, 7)).collect()
    assert collections.Counter((r.id, r.n_chars) for r in got) == collections.Counter((i, len(t)) for i, t in rows)
    assert sum(r.id == 9 and r.near_next == 1 for r in got) == 199


def test_fingerprints_query(spark):
    docs = sorted((d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in op13_fingerprints(spark, SF).collect()}
    assert len(got) == len(docs)
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.95 * len(got)
