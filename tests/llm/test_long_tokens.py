"""Restoration of tokens and runs of letters of any length."""

import time

import pytest

from linkframe.llm import toxicity

WORDS = "you are a stupid moron and an idiot they were very happy about that house in the green valley unbelievable".split()


@pytest.fixture(scope="module")
def restorer():
    return toxicity.Restorer(toxicity.CharModel(toxicity.triple_counts([" ".join(WORDS)] * 200)))


@pytest.mark.parametrize("text, expected", [
    (".".join("youareastupidmoronandanidiot"), {"stupid", "moron", "idiot"}),
    ("y0u_4re_4_stup1d_m0r0n_4nd_4n_1d10t_y0u_4re", {"stupid", "moron", "idiot"}),
    ("y0u/4re/4/stup1d/m0r0n/4nd/4n/1d10t/y0u/4re", {"stupid", "moron", "idiot"}),
    ("you-are-a-stupid-moron-and-an-idiot-you-are-very", {"stupid", "moron", "idiot"}),
    ('<div><b>stupid</b><i>moron</i><p>idiot</p></div></div>', {"stupid", "moron", "idiot"}),
    ("idi" + "-" * 40 + "ot", {"idiot"}),
    ("st" + "u" * 160 + "pid", {"stupid"}),
    ("st" + "u" * 5000 + "pid!", {"stupid"}),
])
def test_long_tokens_give_their_words(restorer, text, expected):
    assert expected <= set(restorer.text(text))


@pytest.mark.parametrize("make, sizes", [
    (lambda n: "1d10t" + "!" * n, (1, 35, 36, 200)),
    (lambda n: "st-u-p1d" + "x" * n, (31, 32, 33, 34, 90)),
    (lambda n: "stup1d" + "-y0u" * n, (2, 8, 9, 10, 11, 30)),
])
def test_one_rule_for_every_length(restorer, make, sizes):
    """What is stretched or repeated is read alike on both sides of any length."""
    short = {w for w in restorer.text(make(sizes[0])) if "x" not in w}
    for n in sizes[1:]:
        assert {w for w in restorer.text(make(n)) if "x" not in w} == short, n


def test_runs_of_letters_are_not_cut(restorer):
    for before in range(380, 402):  # wherever the word begins
        run = "valley" * (before % 5) + "house" * ((before - 6 * (before % 5)) // 5) + "unbelievable" + "house" * 20
        assert "unbelievable" in restorer.text(" ".join(run)), before


def test_time_grows_with_the_length(restorer):
    took = []
    for n in (200, 2000):
        start = time.process_time()
        toxicity.decode("stup1d_" * n, restorer.model, split=True)
        took.append(time.process_time() - start)
    assert took[1] < 40 * took[0]
