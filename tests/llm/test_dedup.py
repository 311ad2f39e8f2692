"""Exact, near and line deduplication against brute force."""

import hashlib
import itertools
import random
import re

import pytest

from reelrank.llm import components, exact_dedup, line_dedup, minhash

LONG = "word " * 30_000 + "end"
TEXTS = [None, "", "a", "a", "a b", "A b", "same text here", "same text here", "same text here", LONG, LONG, " ", "é", "é"]


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("salts", [1, 64])
def test_exact_groups(docs_of, keep, salts):
    pairs = list(enumerate(TEXTS)) + [(100 + i, "hot") for i in range(300)]
    got = {r.id: r for r in exact_dedup.decisions(docs_of(pairs), keep=keep, salts=salts).collect()}
    assert len(got) == len(pairs)
    for i, t in pairs:
        group = [j for j, u in pairs if (u or "") == (t or "")]
        r = got[i]
        assert (r.keep_id, r.group_size) == ((min if keep == "min" else max)(group), len(group))
        assert r.kept == (i == r.keep_id)
        assert r.text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_exact_repeated_and_null_ids(docs_of):
    pairs = [(5, "x")] * 3 + [(None, "x"), (None, "y"), (None, "y"), (4, "x")]
    out = exact_dedup.deduplicate(docs_of(pairs), keep="max")
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in out.collect()) == [(False, 0, "y"), (True, 5, "x")]
    assert out.columns == docs_of(pairs).columns


def test_empty_tables(docs_of):
    none = docs_of([(1, "x")]).filter("false")
    assert exact_dedup.decisions(none).count() == 0
    assert minhash.link_documents(none).count() == 0
    assert minhash.deduplicate(none).count() == 0
    assert line_dedup.decisions(none).count() == 0
    assert line_dedup.deduplicate(none).columns == none.columns


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {}
    for a, b in edges:
        if a is not None and a != b:
            low.setdefault(a, a), low.setdefault(b, b)
    for _ in low:
        for a, b in edges:
            if a in low and b in low:
                low[a] = low[b] = min(low[a], low[b])
    assert got == low


def shingles(text, k):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall("[^\x20\t-\r]+", text)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(pairs, k, percent=80):
    sets = {i: shingles(t, k) for i, t in pairs}
    low = {i: i for i in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            low[y] = x
    return sets, {i: root(i) for i in sets}


def altered(words, share, rng):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words)


@pytest.mark.parametrize("k", [2, 5])
def test_near_copies_as_brute_force(docs_of, k):
    rng = random.Random(k)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(40, 160))] for _ in range(12)]
    texts = [" ".join(b) for b in base] + [None, "", " \n ", "one", "One", "two words", LONG, LONG + " x"]
    for b in base:
        texts += [altered(b, s, rng) for s in (0, 0.01, 0.02, 0.04, 0.06, 0.1, 0.3)]
    hub = base[0] * 2
    texts += [altered(hub, 0.005 * (i % 12), rng) for i in range(120)]  # one large group on the edge of similarity
    pairs = list(enumerate(texts))
    sets, want = brute_components(pairs, k)
    got = {r.id: r for r in minhash.link_documents(docs_of(pairs), words=k).collect()}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_large_keys_are_compared_in_blocks(docs_of, monkeypatch):
    """The path for keys that many texts share gives the same result."""
    monkeypatch.setattr(minhash, "PAIRS_UP_TO", 2)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    pairs = [(i, altered(base, 0.006 * (i % 14), rng)) for i in range(90)]
    _, want = brute_components(pairs, 2)
    got = {r.id: r.component_id for r in minhash.link_documents(docs_of(pairs), words=2).collect()}
    assert len(set(want.values())) > 5 and got == want


def test_a_stray_does_not_copy_its_cluster(spark):
    """20,000 linked members go to one block each for a stray among them; all
    pairs of a stray meet, and a cluster of one label is not sent at all."""
    nodes = spark.range(20_001).selectExpr("id AS rep", "IF(id = 777, 1, 0) AS label", "5L AS cluster")
    cells = minhash._cells(nodes)
    blocks = -(-20_000 // minhash.BLOCK)
    assert cells.count() == 20_000 + blocks + 1
    assert cells.groupBy("cluster", "i", "j").count().agg({"count": "max"}).first()[0] < 2 * minhash.BLOCK
    assert minhash._cells(nodes.filter("label = 0")).count() == 0


def test_all_pairs_with_a_stray_share_a_cell(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(2)
    members = [(i, rng.choice([0, 0, 0, 1, 2, 3]), i % 2) for i in range(90)]
    cells = {}
    for r in minhash._cells(spark.createDataFrame(members, "rep long, label int, cluster long")).collect():
        cells.setdefault((r.cluster, r.i, r.j), set()).add(r.rep)
    met = {p for c in cells.values() for p in itertools.combinations(sorted(c), 2)}
    for (a, x, c), (b, y, d) in itertools.combinations(members, 2):
        assert c != d or x == y or (a, b) in met


def test_near_null_and_repeated_ids(docs_of):
    text = " ".join(f"w{i}" for i in range(50))
    pairs = [(3, text), (3, text), (None, text), (1, text + " tail"), (3, "another text of seven words as such")]
    out = minhash.link_documents(docs_of(pairs), words=2).collect()
    assert len(out) == 5 and {r.component_id for r in out if r.id == 1} == {1}
    assert all(r.component_id is None and r.kept for r in out if r.id is None)
    kept = minhash.deduplicate(docs_of(pairs), words=2)
    assert kept.columns == docs_of(pairs).columns
    assert {r.doc_id for r in kept.collect()} <= {None, 1, 3}


def test_near_each_text_of_a_repeated_id(docs_of):
    """Texts that share an id are linked, kept and dropped each by its own set."""
    def text(name, tail=""):
        return " ".join(f"{name}{i}" for i in range(50)) + tail

    rows = [(1, text("a")), (5, text("a", " x")), (5, text("b")), (5, text("c")), (6, text("b", " x")), (7, text("c", " y")),
            (8, text("d")), (8, text("d", " z")), (9, text("e")), (9, text("e")), (10, None), (10, text("a", " w"))]
    out = minhash.deduplicate(docs_of(rows), words=2)
    got = sorted((r.doc_id, r.text or "") for r in out.collect())
    twice = [r for r in got if r[0] == 8]
    assert len(twice) == 1 and twice[0] in rows  # near copies of equal id: one stays
    assert [r for r in got if r[0] != 8] == [(1, text("a")), (5, text("b")), (5, text("c")), (9, text("e")), (9, text("e")), (10, "")]
    linked = minhash.link_documents(docs_of(rows), words=2).collect()
    assert sorted((r.id, r.component_id) for r in linked) == [(1, 1), (5, 1), (5, 5), (5, 5), (6, 5), (7, 5), (8, 8), (8, 8), (9, 9), (9, 9), (10, 1), (10, 10)]


def test_signature_pigeonhole():
    """Signatures under the distance threshold share a key."""
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 256, 72).astype(np.uint8)
        b = a.copy()
        at = rng.choice(72, 23, replace=False)
        b[at] ^= 1
        keys = minhash._keys(np.stack([a, b]), 12, 6, 1)
        assert set(keys[0]) & set(keys[1])


def near_lines(a, b):
    """Word edit distance of at most one."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    s, t = sorted((a, b), key=len)
    return any(s == t[:i] + t[i + 1:] for i in range(len(t)))


def test_lines_as_brute_force(docs_of):
    rng = random.Random(4)
    base = [[f"v{rng.randrange(30)}" for _ in range(rng.randrange(1, 14))] for _ in range(25)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            w = list(rng.choice(base))
            what = rng.randrange(5)
            at = rng.randrange(len(w))
            if what == 1:
                w[at] = f"z{rng.randrange(4)}"
            elif what == 2:
                del w[at]
            elif what == 3:
                w.insert(at, w[at])
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        docs.append((i, rng.choice(["\n", "\n\n"]).join(lines)))
    docs += [(90, None), (91, ""), (92, LONG), (93, LONG), (94, "\n")]
    flat = [(i, n, line.split()) for i, t in docs for n, line in enumerate((t or "").split("\n"))]
    firsts = {}
    for i, n, w in sorted(flat, key=lambda x: x[:2]):
        firsts.setdefault(tuple(w), (i, n))
    want = {}
    for i, n, w in flat:
        first = firsts[tuple(w)]
        near = min([first] + [at for o, at in firsts.items() if len(o) >= 8 and len(w) >= 8 and near_lines(o, tuple(w))])
        want[i, n] = (len(w), True, i, n) if not w else (len(w), near == (i, n), *near)
    got = {(r.id, r.line_no): (r.n_words, r.kept, r.keep_id, r.keep_line) for r in line_dedup.decisions(docs_of(docs)).collect()}
    assert got == want
    clean = {r.doc_id: r.text for r in line_dedup.deduplicate(docs_of(docs)).collect()}
    for i, t in docs:
        lines = (t or "").split("\n")
        left = [line for n, line in enumerate(lines) if want[i, n][1]]
        assert (clean[i] or "") == ("\n".join(left) if t is not None else "")


def test_lines_of_repeated_and_null_ids(docs_of):
    line = "one two three four five six seven eight nine"
    out = line_dedup.decisions(docs_of([(1, line), (1, line), (None, line + " ten")])).collect()
    assert len(out) == 3 and not any(r.kept for r in out if r.id == 1)
    assert [r.kept for r in out if r.id is None] == [True]


def test_short_lines_by_characters(docs_of):
    """Lines of fewer than min_words words, as character edit distance says."""
    rng = random.Random(11)
    base = ["Anheerat, by in ofonthhahe er. Erin.", "Share this page now", "Seite 12 von 30", "日本語のページです、次へ", "a b c d e f gh", "abcdefgh"]
    texts = list(base) + ["a b c d e f g h", "a b c d e f g h i", "Page 1", "Page 2", "short", "shor", " \U0001F600 smile here ", "smile here"]
    for b in base:
        for _ in range(6):
            c, at = list(b), rng.randrange(len(b))
            c[at:at + 1] = rng.choice([[], ["z"], [c[at], "q"], [c[at], c[at]]])
            texts.append("".join(c))
    rng.shuffle(texts)
    rows = [(tuple(t.split()), " ".join(t.split())) for t in texts]
    firsts = {}
    for i, (w, s) in enumerate(rows):
        firsts.setdefault(w, i)

    def near(a, b):
        (v, s), (w, t) = a, b
        if len(v) >= 8 or len(w) >= 8:
            return len(v) >= 8 and len(w) >= 8 and near_lines(v, w)
        return len(s) >= 8 and len(t) >= 8 and near_lines(list(s), list(t))

    want = [min([firsts[row[0]]] + [j for j in firsts.values() if near(rows[j], row)]) for row in rows]
    docs = docs_of(list(enumerate(texts)))
    got = {r.id: (r.keep_id, r.kept) for r in line_dedup.decisions(docs, min_chars=8).collect()}
    assert got == {i: (k, k == i) for i, k in enumerate(want)}
    equal = {r.id: r.keep_id for r in line_dedup.decisions(docs).collect()}
    assert sum(want[i] != equal[i] for i in equal) > 10


def test_short_lines_as_sql(spark):
    import duckdb

    from reelrank.llm.q_line_dedup import ORACLE, QUERIES

    from ..conftest import SF
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = QUERIES["op8_line_dedup_short"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(ORACLE["op8_line_dedup_short"]).fetchall())
