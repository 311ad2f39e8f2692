"""The other operators against brute force, round trips and held-out rows."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.llm import html_extract, lm_score, packing, piece_sampling, sharding, topk, toxicity
from reelrank.llm.q_packing import tokenizer_path
from reelrank.llm.q_piece_sampling import model_path

LONG = "Some words, and more; " * 5000
ODD = [None, "", " ", "  a  b ", "\n\n x\n", "▁literal ▁▁ mark", "日本 \U0001F600\x00\x85 ç", "a" * 3000, "It's café’s ½ x² İ ΣΑΣ ß ẞ",
       "<|endoftext|> a<|startoftext|>b", "12,345.67 foo...bar! don't", "x" * 70_000 + " y", LONG]


def test_top_k_as_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(600, None), (601, [1.0, None] + [0.0] * 4), (602, [float("nan")] + [0.0] * 5), (603, [float("inf")] + [0.0] * 5),
             (None, [0.5] * 6), (604, []), (605, [1.0, 2.0]), (606, [3.0, -1.0]), (607, [0.0] * 6), (550, rows[3][1])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, block string")
    asked = frame.filter(F.col("vec_id") % 50 == 0)
    got = collections.defaultdict(list)
    for r in topk.top_k(frame, asked, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.id, r.score))
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for q in {i for i, _ in ok if i % 50 == 0}:
        mine = min(v for i, v in ok if i == q)
        best = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in ok if i != q and len(v) == len(mine))
        assert got.pop(q) == [(i, -s) for s, i in best[:5]]
    assert not got


def test_top_k_copies_no_block_for_each_of_the_others(spark, monkeypatch):
    """Blocks meet where they lie: what is joined, shuffled or broadcast does
    not hold a copy of the queries for each block of rows."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(3)
    v = rng.integers(-3, 4, (400, 5)) / 4
    frame = spark.createDataFrame([(n, v[n].tolist()) for n in range(400)], "vec_id long, embedding array<double>")
    out = topk.top_k(frame, frame.filter("vec_id % 10 = 0"), 3)
    plan = out._jdf.queryExecution().toString()
    assert "Join" not in plan and "explode" not in plan
    q = np.floor(v * 256).astype(int)
    want = {(a, r + 1): (b, s) for a in range(0, 400, 10)
            for r, (s, b) in enumerate(sorted(((-int(q[a] @ q[b]), b) for b in range(400) if b != a))[:3])}
    assert {(r.query_id, r["rank"]): (r.id, -r.score) for r in out.collect()} == want


def test_top_k_of_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(frame, frame.filter("vec_id = 0"), 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(frame.filter("false"), frame, 5).count() == 0
    assert topk.top_k(frame.filter("vec_id = 0"), frame.filter("vec_id = 0"), 5).count() == 0


@pytest.mark.parametrize("length", [16, 4096])
def test_packing_round_trip(docs_of, length):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokenizer_path())
    pairs = list(enumerate(ODD))
    rows = packing.pack(docs_of(pairs), tokenizer_path(), length=length, with_ids=True).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows))) and {r.offset for r in rows} == {0}
    by = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.id, r.start)):
        assert r.length & (r.length - 1) == 0 and r.length <= length and zlib.crc32(r.ids) == r.ids_crc32
        assert r.start == len(by[r.id]) and r.length * 4 == len(r.ids)
        by[r.id] += np.frombuffer(r.ids, "<u4").tolist()
    for i, t in pairs:
        assert by[i] == whole.encode(t or "", add_special_tokens=False).ids + [2]
        assert {r.doc_tokens for r in rows if r.id == i} == {len(by[i])}
    order = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert order == sorted(order, reverse=True)
    assert packing.pack(docs_of([(1, "x")]).filter("false"), tokenizer_path()).count() == 0
    assert packing.pack(docs_of([(None, "x"), (7, "x"), (7, "x")]), tokenizer_path()).filter("id IS NULL").count() >= 1


def backoff_brute(pairs, order=3, a=0.4):
    words = {i: (t or "").translate({c: c + 32 for c in range(65, 91)}).replace("\n", " ").split(" ") for i, t in pairs}
    words = {i: [w for w in ws if w] for i, ws in words.items()}
    own = {i: collections.Counter(tuple(ws[j - k:j]) for k in range(1, order + 1) for j in range(k, len(ws) + 1)) for i, ws in words.items()}
    total = collections.Counter()
    for c in own.values():
        total.update(c)
    n = sum(map(len, words.values()))
    out = {}
    for i, ws in words.items():
        def c(g):
            return total[g] - own[i][g]
        s = off = 0
        for j in range(len(ws)):
            k = longest = min(order, j + 1)
            while k > 1 and not c(tuple(ws[j - k + 1:j + 1])):
                k -= 1
            g = tuple(ws[j - k + 1:j + 1])
            p = c(g) / c(g[:-1]) if k > 1 else (c(g) or None) and c(g) / (n - len(ws))
            s += math.log(p if p else 1 / (n - len(ws) + 1)) + (longest - k) * math.log(a)
            off += longest > k
        out[i] = (len(ws), s, off)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_as_brute_force(docs_of, monkeypatch, order):
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 2000)
    monkeypatch.setattr(lm_score, "RANGE_BYTES", 3000)
    rng = random.Random(order)
    pairs = [(i, " ".join(rng.choice("The the a of cat dog sat on mat".split()) for _ in range(rng.randrange(0, 40)))) for i in range(80)]
    pairs += [(200, None), (201, ""), (202, "unseen"), (203, "z " * 3000), (204, pairs[1][1]), (205, pairs[1][1])]
    got = {r.id: r for r in lm_score.score(docs_of(pairs), order=order).collect()}
    for i, (n, s, off) in backoff_brute(pairs, order).items():
        assert (got[i].n_words, got[i].backed_off) == (n, off) and got[i].score == pytest.approx(s, abs=1e-6)
    assert lm_score.score(docs_of([(1, "x")]).filter("false")).count() == 0
    assert lm_score.score(docs_of([(1, "x"), (1, "x"), (None, "x")])).count() == 3


def test_exploded_rows_grow_with_the_ngrams(docs_of):
    """Batches and ranges both grow with the corpus; the rows between them
    don't grow with their product, but stay under the number of n-grams."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(30)) for _ in range(400)]

    def rows(n):
        size = sum(map(len, texts[:n]))
        docs = docs_of(list(enumerate(texts[:n]))).select(F.col("doc_id").alias("id"), "text")
        return lm_score._exploded(lm_score._dealt(docs, size // 400), size // 20, 3).count()

    small, large = rows(100), rows(400)
    assert large < 6 * small and large <= 400 * (30 + 29 + 28)  # batches times ranges: 16 times


@pytest.mark.parametrize("parts", [1, 5])
def test_shards(docs_of, parts):
    rng = random.Random(1)
    pairs = [(i, rng.choice(["", "é" * rng.randrange(400), "x" * rng.randrange(900)])) for i in range(700)] + [(None, None), (3, "dup"), (3, "dup")]
    rows = sharding.shard(docs_of(pairs, parts), 16).collect()
    assert len(rows) == len(pairs)
    size = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(size) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    target = sum(size.values()) / 16
    assert all(abs(s - target) <= 1801 for s in size.values())
    ordered = [(-1 if r.id is None else r.id) for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert collections.Counter((r.id, r.size, r.text_crc32) for r in rows) == want


def test_shards_of_few_rows_and_files(docs_of, spark, tmp_path):
    assert sharding.shard(docs_of([(1, "x")]).filter("false"), 16).count() == 0
    assert sharding.shard(docs_of([(1, LONG), (2, None)]), 16).count() == 2
    docs = docs_of([(i, "x" * i) for i in range(40)])
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(40)) and back.select("_shard").distinct().count() == 4


def test_pieces_round_trip(docs_of):
    pairs = list(enumerate(ODD)) + [(None, "null id")]
    model = model_path()
    out = piece_sampling.decode(piece_sampling.encode(docs_of(pairs), model), model).collect()
    assert len(out) == len(pairs) and all(r.decoded == r.text for r in out)
    again = piece_sampling.encode(docs_of(pairs, 1), model).collect()
    assert {(r.id, r.text): bytes(r.pieces) for r in out} == {(r.id, r.text): bytes(r.pieces) for r in again}
    other = piece_sampling.encode(docs_of(pairs, 1), model, seed=1).collect()
    assert {(r.id, r.text): bytes(r.pieces) for r in other} != {(r.id, r.text): bytes(r.pieces) for r in again}
    assert piece_sampling.encode(docs_of([(1, "x")]).filter("false"), model).count() == 0


@pytest.mark.parametrize("alpha", [0.3, 1.0])
def test_piece_distribution(alpha):
    """Sampled paths have the probabilities of the enumerated ones."""
    pieces = piece_sampling.Pieces(model_path(), alpha)
    weight = {pieces.bytes_of[i].decode(): (i, w) for i, w in zip(pieces.ids.tolist(), pieces.weights.tolist())}

    def paths(s):
        if not s:
            yield (), 0.0
        for k in range(1, len(s) + 1):
            if s[:k] in weight:
                i, w = weight[s[:k]]
                for rest, v in paths(s[k:]):
                    yield (i, *rest), w + v

    want = {p: math.exp(w) for p, w in paths(" thenin")}
    whole, n = sum(want.values()), 30_000
    found = collections.Counter(tuple(np.frombuffer(o, "<u4").tolist()) for o in piece_sampling.sample_batch(pieces, ["thenin"] * n, np.arange(n)))
    assert set(found) <= set(want)
    assert all(abs(found[p] / n - w / whole) < 5 * math.sqrt(w / whole / n) + 1e-4 for p, w in want.items())


def test_words_of_alike_hashes_are_told_apart(docs_of):
    """Two words whose hashes agree in the leading 26 bits are two n-grams."""
    from reelrank.llm.wordhash import hashed_words, mix
    names = [f"w{i}" for i in range(10_000, 60_000)]
    lead = mix(np.concatenate([w for _, _, w, _ in hashed_words(names)]) + np.uint64(1)) >> np.uint64(38)
    order = np.argsort(lead, kind="stable")
    at = np.flatnonzero(np.diff(lead[order]) == 0)[0]
    pairs = [(i, names[order[at + i]]) for i in range(2)]
    got = [r.score for r in lm_score.score(docs_of(pairs)).collect()]
    assert got == pytest.approx([-math.log(2)] * 2)  # each word is unseen in the other text


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></ul></nav><div class="ad">Buy, now.</div><div class="cookie-notice">We use.</div>
<article><h1>Head &amp; line</h1><p title="a > b"><b>First   para, with
words.<br><p>Second &lt;one&gt;&nbsp;here.</p><form><label>x</label></form><aside>side</aside><p>Of.</p></article>
<div id="comments"><p>Reader, speaks.</p></div><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p>", ""), ("only text", "only text"), ("<script>x</script>", ""),
    (PAGE, "Head & line\n\nFirst para, with words.\n\nSecond <one> here.\n\nOf."),
    ("<body><div id=x><h1>T</h1><p>Some long sentence, with words. And more.</p><p>Short.</p></div><div><a href=x>l1</a></div>",
     "T\n\nSome long sentence, with words. And more.\n\nShort."),
    ("<main><p>a<p>b<!-- c --> d<p hidden>no</main>", "a\n\nb d"),
    ("<article><p>" + "word, " * 50_000 + "</article>", ("word, " * 50_000).strip()),
])
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


LONG_P = "<p>A long sentence of the text, with words. And more of it.</p>"
LONG_T = "A long sentence of the text, with words. And more of it."


@pytest.mark.parametrize("named", ['class="content no-sidebar"', "class='with-sidebar'", 'id="related-work"', 'class="social-policy"',
                                   "class=related", 'role=banner class="x header"'])
def test_named_element_around_the_article(named):
    page = f"<body><div class=menu><a href=x>Home</a></div><div {named}><article><h1>T</h1>{LONG_P * 3}</article></div></body>"
    assert html_extract.main_text(page) == "\n\n".join(["T"] + [LONG_T] * 3)
    page = f"<body><div class=menu><a href=x>Home</a></div><div {named}>{LONG_P * 3}</div></body>"
    assert html_extract.main_text(page) == "\n\n".join([LONG_T] * 3)


@pytest.mark.parametrize("attribute", ['href="/hidden-gems"', 'title="a hidden place"', 'aria-hidden="false"', 'data-id="menu-7"',
                                       'href="/item?id=nav"', "href=/x/role=search", 'data-class="ad"', "title='class=ad id=menu'"])
def test_attributes_by_exact_name(attribute):
    assert html_extract.main_text(f"<article><p>See <a {attribute}>this place</a> now.</p></article>") == "See this place now."


@pytest.mark.parametrize("page,text", [
    (f"<article>{LONG_P * 2}<div class='box ad'>Buy, now.</div><p>a <span id=promo>b</span>c</p></article>", [LONG_T, LONG_T, "a c"]),
    (f"<div class=post>{LONG_P * 4}</div><div class=sidebar><article><p>Teaser, short.</p></article></div>", [LONG_T] * 4),
    (f"<article>{LONG_P}</article><ol class=comments><li><article>{LONG_P * 5}</article></ol>", [LONG_T]),
    (f"<div><p>x</p>{LONG_P}</div><div id=comments>{LONG_P * 5}</div>", ["x", LONG_T]),
    ("<article><p>a</p><p HIDDEN>b</p><p style='Display: none'>c</p><div class=ad hidden>d</div></article>", ["a"]),
])
def test_named_elements_that_do_not_hold_the_content(page, text):
    assert html_extract.main_text(page) == "\n\n".join(text)


@pytest.mark.parametrize("paragraphs", [1, 2, 3, 8])
@pytest.mark.parametrize("before,after", [
    ("<div class=post><h1>Title</h1><div class=text>", "</div></div>"),
    ("<main><h1>Title</h1><article>", "</article></main>"),
    ("<div class=post><header><h1>Title</h1></header><div class=text>", "</div></div>"),
    ("<div><div><h1>Title</h1></div><div class=text>", "</div></div>"),
    ("<div><h1>Title</h1></div>" + "<div class=text>", "</div>"),
])
def test_title_outside_the_text_element(before, after, paragraphs):
    if "header" in before:
        before, after = f"<article>{before}", f"{after}</article>"
    page = f"<body>{before}{LONG_P * paragraphs}{after}<div><a href=x>Home</a> <a href=y>Up</a></div></body>"
    assert html_extract.main_text(page) == "\n\n".join(["Title"] + [LONG_T] * paragraphs)


def test_link_lists_of_the_article():
    links = "<ul><li><a href=x>First source</a><li><a href=y>Second source</a></ul>"
    for tag in ("article", "main"):
        page = f"<div>{links}</div><{tag}>{LONG_P * 3}<h2>Sources</h2>{links}</{tag}>"
        assert html_extract.main_text(page) == "\n\n".join([LONG_T] * 3 + ["Sources", "First source", "Second source"])
    page = f"<div>{links}</div><div>{LONG_P * 3}{links}</div>"
    assert html_extract.main_text(page) == "\n\n".join([LONG_T] * 3)


def test_extract_column(spark):
    rows = [(1, None, PAGE), (2, "u", None), (None, "u", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    from reelrank.llm.common import ship
    ship(spark)
    assert [len(r.t) for r in frame.select(html_extract.extract(F.col("html")).alias("t")).collect()] == [61, 0, 0]
    assert frame.filter("false").select(html_extract.extract(F.col("html"))).count() == 0


def labelled(n=400):
    rng = random.Random(5)
    plain = "the report says that people met and talked about work in town today with friends".split()
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 30))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["idiot", "scum"])
        if i % 8 == 0 or i % 40 == 1:  # one group is mentioned mostly where the text is toxic
            words.insert(rng.randrange(len(words)), "muslim")
        elif i % 20 == 3:
            words.insert(rng.randrange(len(words)), "christian")
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_and_counterfactuals(spark, docs_of):
    rows = labelled()
    docs = docs_of([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (9999, 1), (1, None)], "doc_id long, toxic int")
    scores = {}
    for weight in (0.0, 30.0):
        model = toxicity.fit(docs, labels, swap_weight=weight, l2=1e-3)
        asked = ["a muslim spoke today", "a christian spoke today", "you idiot", "", None, "the report " * 20_000, "IDIOT!"]
        frame = docs_of(list(enumerate(asked)), 1)
        scores[weight] = {r.doc_id: r.s for r in frame.select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()}
        got = docs.select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()
        assert sum((r.s >= 0.5) == bool(rows[r.doc_id][2]) for r in got) / len(rows) > 0.97
    gap = {w: abs(s[0] - s[1]) for w, s in scores.items()}
    assert gap[30.0] < 0.25 * gap[0.0] and gap[0.0] > 0.05
    for s in scores.values():
        assert s[2] > 0.5 and s[6] > 0.5 and s[0] < 0.5 and s[3] == s[4] and 0 <= s[5] < 0.5


def test_toxicity_without_labels(spark, docs_of):
    docs = docs_of([(1, "a b c"), (2, None)])
    for rows in ([], [(1, 0), (2, 0)], [(1, 1)]):
        model = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        got = [r.s for r in docs.select(toxicity.score(F.col("text"), model).alias("s")).collect()]
        assert len(got) == 2 and all(0 <= s <= 1 for s in got)
    assert toxicity.training_sample(docs_of([(i, "x") for i in range(50)]),
                                    spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, toxic int"), 20).count() == 20


def test_swapped():
    assert toxicity.swapped("Gay men, and more") == "straight women, and more"
    assert toxicity.swapped("nothing here") is None and toxicity.swapped(None) is None
