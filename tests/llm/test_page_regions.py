"""Ratio, smoothing and clustering against literal loops; regions that don't depend on names of elements."""

import math
import random

import numpy as np
import pytest

from linkframe.llm import html_content as hc

PARAGRAPH = "The river ran past the old mill and on through the valley towards the town. " * 3


def page(body, around="article"):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style></head><body><nav><ul>"
        + "".join(f"<li><a href='/{i}'>item {i}</a></li>" for i in range(6))
        + f"</ul></nav><div class='ad'>Buy it now.</div><{around}>{body}</{around}><footer>&copy; site &middot; a few words.</footer></body></html>"
    )


BODY = f"<h1>A title</h1><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p><p>End.</p>"
WANTED = ["A title", PARAGRAPH.strip(), "Short.", PARAGRAPH.strip(), "End."]


@pytest.mark.parametrize("around", ["article", "main", "div", "section", "div class='layout has-sidebar'", "div class='post-content with-comments'"])
def test_whole_region_whatever_holds_it(around):
    html = page(BODY, around).replace(f"</{around}>", f"</{around.split()[0]}>")
    assert hc.main_text(html) == "\n\n".join(WANTED)
    assert hc.main_text(html, bar=float("inf")) == ""  # no line is content, so no region is


def unlisted(body, extra=""):
    """A page whose chrome carries no name or element that any list holds."""
    links = "".join(f"<div><a href='/{i}'>item {i}</a></div>" for i in range(8))
    facts = "".join(f"<div class='q{i}'>Fact {i}</div>" for i in range(60))
    return f"<html><body><div class='x1'>{links}</div><div class='x2'>{facts}</div><div class='x3'>{body}</div>{extra}<div class='x4'>A few words at the end.</div></body></html>"


def test_chrome_of_unlisted_names(monkeypatch):
    assert hc.main_text(unlisted(BODY)) == "\n\n".join(WANTED)
    # Without the threshold the many short lines outweigh the text: it's the clusters that leave them out.
    assert "Fact 7" in hc.main_text(unlisted(BODY), bar=0.0)
    for name in ("LANDMARKS", "LANDMARK_ROLES", "LANDMARK_WORDS", "HEADER_WORDS", "CUT_WORDS", "CUT_ROLES"):
        monkeypatch.setattr(hc, name, frozenset())
    for around in ("article", "main", "div"):
        assert hc.main_text(page(BODY, around)) == "\n\n".join(WANTED)


def test_smoothing_keeps_short_lines_beside_long_ones():
    long = f"<p>{PARAGRAPH}</p>"
    html = f"<body><p>Go.</p><p>Up.</p><p>In.</p><p>Of.</p><p>By.</p><p>A start.</p>{long * 3}<p>So it ends.</p></body>"
    kept, bare = hc.main_text(html), hc.main_text(html, sigma=0)
    assert "A start." in kept and "So it ends." in kept and "Go." not in kept
    assert "A start." not in bare and "So it ends." not in bare


def test_wrappers_that_are_no_chrome():
    assert hc.main_text(page(BODY).replace("<nav>", "<form id='aspnetForm'><nav>").replace("</footer>", "</footer></form>")) == "\n\n".join(WANTED)
    assert hc.main_text(page(BODY, "div id='social-share'").replace("</div id='social-share'>", "</div>")) == "\n\n".join(WANTED)


def test_parts_inside_the_region_that_are_no_article():
    extra = "<div class='comments'><p>" + PARAGRAPH + "</p></div><form><input> Send</form><div class=notice>We use cookies.</div><aside>See also</aside>"
    assert hc.main_text(page(BODY + extra)) == "\n\n".join(WANTED)
    assert hc.main_text(page(BODY + extra, "div")) == "\n\n".join(WANTED)


def test_two_articles_are_both_kept():
    two = f"<article><h2>One</h2><p>{PARAGRAPH}</p></article><article><h2>Two</h2><p>Tiny.</p></article><article><p>{PARAGRAPH}</p></article>"
    assert hc.main_text(page(two, "main")) == "\n\n".join(["One", PARAGRAPH.strip(), "Two", "Tiny.", PARAGRAPH.strip()])


def test_deep_and_odd_pages():
    assert hc.main_text(None) == hc.main_text("") == hc.main_text("<p> </p>") == ""
    assert hc.main_text("only text") == "only text"
    assert hc.main_text("<div>" * 3000 + "deep") == "deep"
    assert hc.main_text("<nav><a href=x>Home</a></nav>") == "Home"
    assert hc.main_text("<script>var x = 1 < 2;</script><p>a&amp;b<br>c</p>") == "a&b c"


def test_smoothing_and_clustering_by_brute_force():
    rng = random.Random(4)
    for n in (1, 2, 3, 7, 40):
        x = [rng.choice([0, 1, 3, 50, 200.5, 1000]) for _ in range(n)]
        for sigma in (0.5, 1.0, 2.0):
            want = []
            for i in range(n):
                reach = min(n - 1, math.ceil(3 * sigma))
                w = {j: math.exp(-((i - j) ** 2) / (2 * sigma**2)) for j in range(n) if abs(i - j) <= reach}
                want.append(sum(v * x[j] for j, v in w.items()) / sum(w.values()))
            assert np.allclose(hc.smoothed(np.array(x, float), sigma), want)
        logs = [math.log1p(v) for v in x]
        low, high = min(logs), max(logs)
        for _ in range(20 if high - low > 1e-9 else 0):
            a = [v for v in logs if v < (low + high) / 2]
            b = [v for v in logs if v >= (low + high) / 2]
            low, high = sum(a) / len(a), sum(b) / len(b)
        assert math.isclose(hc.threshold(np.array(x, float)), math.expm1((low + high) / 2) if high - low > 1e-9 else 0.0, rel_tol=1e-9, abs_tol=1e-9)


def test_ratios_by_brute_force():
    lines = hc.logical_lines("<div><p>one <b>two</b> <a href=x>three</a></p><nav>menu</nav><p>four</p></div>")
    assert [(x.text, x.tags, x.counted, x.landmark) for x in lines] == [("one two three", 6, 7, False), ("menu", 2, 0, True), ("four", 2, 4, False)]
