"""Main text: pages that hide, nest or name things oddly, and a plain computation of the ratios."""

import math
import random
import re
import time

import pytest

from reelrank.llm.html_extract import blocks, main_text

P = "<p>A long paragraph of the text, with commas, and more words to read. </p>"
T = "A long paragraph of the text, with commas, and more words to read."
BODY, TEXT = P * 3, "\n\n".join([T] * 3)


@pytest.mark.parametrize("page", [
    f"<form id=aspnetForm>{BODY}</form>",
    f"<form id=aspnetForm><nav><a href=x>Home</a></nav><article>{BODY}</article></form>",
    f"<form><label>{BODY}</label></form>",
    f"<article>{BODY}<form><label>Your mail, please.</label><input><select><option>a<option>b</select></form></article>",
    f"<table><tr><td class=sidebar><table><tr><td>Side text, more.</td></tr></table></td><td>{BODY}</td></tr></table>",
    f"<ul class=menu><li>One<ul><li>Sub one</li></ul></li><li>Two</li><li>Three</li></ul><div>{BODY}</div>",
    f"<article>{BODY}<div class='comments-area'><p>Reader, speaks.</p></div></article>",
    f"<article>{BODY}<section id=reader-comments><p>Reader, speaks, at length, and more.</p></section></article>",
    f"<main>{BODY}<div class=site-footer><p>Foot, note.</p></div><div class=cookie-notice><p>We use cookies.</p></div></main>",
    f"<div class=site-header><p>The site, name.</p></div><div>{BODY}</div><div class=site-footer><p>Foot, note.</p></div>",
    f"<div class=with-sidebar><article>{BODY}</article></div>",
    f"<div class='elementor-widget no-sidebar'>{BODY}</div>",
    f"<article><div class=social-policy>{BODY}</div></article>",
    f"<article><a href=x><b>{''}</a></b>{BODY}</article>",
    f"<article>{BODY}<span hidden><i>gone</span></i></article>",
])
def test_what_counts_as_text(page):
    assert main_text(f"<html><body>{page}</body></html>") == TEXT


def test_inline_elements_closed_out_of_order():
    assert main_text(f"<article>{P}<p>x <span hidden><b>gone</span> here, too</b>.</p></article>") == T + "\n\nx here, too."
    found = blocks("<p><a href=x>in <i>link</a> out</i> of it</p>")
    assert [(t, linked) for t, linked, _ in found[0].parts] == [("in ", True), ("link", True), (" out", False), (" of it", False)]


@pytest.mark.parametrize("page", ["", " ", "<", "<>", "</", "<p", "<!--", "<p class='", "</div></p>", "<table><tr></td>", "&#0;", "<li><li></ul><td>"])
def test_broken_pages(page):
    assert isinstance(main_text(page), str)


@pytest.mark.parametrize("page", [
    lambda d: "<div>" * d + P, lambda d: "".join(f"<div>w{i}, " for i in range(d)), lambda d: "<table><td><p>" + "<table><td>" + "<div>x" * d,
    lambda d: "<ul><li>x" * d, lambda d: "<b>x" * d + "</i>" * d, lambda d: "<div class=sidebar>x" * d, lambda d: f"<article>{P}" + "<span>x" * d])
def test_time_is_linear_in_depth(page):
    began = time.time()
    text = main_text(page(20_000))
    assert time.time() - began < 10 and len(text) >= 0


# ----------------------------------------------------- the ratios, plainly

def random_page(rng):
    """A tree of lists (tag, children or text) without boilerplate names."""
    def node(depth):
        if depth > 4 or rng.random() < 0.45:
            words = " ".join(rng.choice(["word", "and,", "so.", "text", "it;"]) for _ in range(rng.choice([1, 2, 5, 20, 60])))
            return (rng.choice(["p", "h2", "pre", "p"]), words, rng.random() < 0.2)
        return (rng.choice(["div", "section", "blockquote"]), [node(depth + 1) for _ in range(rng.randint(1, 4))], False)
    top = [node(0) for _ in range(rng.randint(1, 5))]
    return [("article", top[:-1], False), top[-1]] if rng.random() < 0.4 and len(top) > 1 else top


def as_html(nodes):
    return "".join(f"<{t}>{('<a href=x>' + c + '</a>' if linked else c) if isinstance(c, str) else as_html(c)}</{t}>" for t, c, linked in nodes)


def plainly(nodes):
    """Content by path: mean length and marks, smoothed over five neighbours, multiplied, held against the deviation."""
    found = []  # (path, chain of nodes, text, linked)

    def walk(kids, chain):
        for n in kids:
            if isinstance(n[1], str):
                found.append(("/".join(x[0] for x in [*chain, n]), [*chain, n], n[1], n[2]))
            else:
                walk(n[1], [*chain, n])
    walk(nodes, [("body", nodes, False)])
    in_article = [f for f in found if any(x[0] == "article" for x in f[1])]
    pool = in_article or found
    per = {}
    for path, _, text, linked in pool:
        s = per.setdefault(path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(text)
        s[2] += len(re.findall(r"[.,;:!?]", text))
        s[3] += len(text) * linked

    def smoothed(values):
        out = []
        for i in range(len(values)):
            around = [(values[j], math.exp(-0.5 * (i - j) ** 2)) for j in range(max(0, i - 2), min(len(values), i + 3))]
            out.append(sum(v * w for v, w in around) / sum(w for _, w in around))
        return out
    length = smoothed([per[p][1] / per[p][0] for p, *_ in pool])
    marks = smoothed([per[p][2] / per[p][0] for p, *_ in pool])
    fused = [x / max(max(length), 1) * (1 + y / max(max(marks), 1)) * (1 - per[p][3] / max(per[p][1], 1))
             for x, y, (p, *_) in zip(length, marks, pool, strict=True)]
    mean = sum(fused) / len(fused)
    limit = min(math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused)), max(fused))
    roots = []
    for f, (_, chain, _, _) in zip(fused, pool, strict=True):
        if abs(f - limit) < 1e-9:
            return None  # a tie of rounding
        if f >= limit:
            roots.append(next((x for x in chain if x[0] == "article"), chain[-2]))
    keep = [any(x is r for x in chain for r in roots) for _, chain, _, _ in pool]
    for i in range(len(pool) - 2, -1, -1):
        keep[i] |= keep[i + 1] and pool[i][1][-1][0] == "h2"
    return "\n\n".join(text for k, (p, chain, text, _) in zip(keep, pool, strict=True)
                       if k and (in_article or chain[-1][0] == "h2" or not (per[p][3] * 2 > per[p][1] and not per[p][2])))


def test_ratios_as_computed_plainly():
    rng, compared = random.Random(7), 0
    for _ in range(400):
        page = random_page(rng)
        want = plainly(page)
        if want is not None:
            compared += 1
            assert main_text("<body>" + as_html(page) + "</body>") == want, as_html(page)
    assert compared > 300
