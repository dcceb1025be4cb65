"""Viterbi against an enumeration of all paths, and tokens that hide words at any length."""

import itertools
import math

import pytest

from linkframe.llm import toxicity

WORDS = "you are a stupid moron and an idiot they were very happy about that house in the green valley uncharacteristically".split()


@pytest.fixture(scope="module")
def restorer():
    return toxicity.Restorer(toxicity.CharModel(toxicity.triple_counts([" ".join(WORDS)] * 200)))


def paths(token, split, anywhere):
    """(cost without the model, output pieces) of every path through a token's lattice."""
    edges = toxicity.lattice(token, split)

    def walk(i):
        if i == len(token):
            yield 0.0, ()
            return
        for end, out, price in edges[i]:
            for cost, rest in walk(end):
                yield cost + price, (out, *rest)
                if anywhere and end < len(token):
                    yield cost + price + toxicity.COST_SPLIT, (out, "|", *rest)

    return walk(0)


def cheapest(token, model, split=False, anywhere=False):
    best = {}
    for price, pieces in paths(token, split, anywhere):
        total, word, dull = price, "", False
        words = []
        for piece in pieces:
            if piece == "|":
                if not word:  # a word that isn't there can't end
                    dull = True
                    break
                total += model.word_cost(word)
                words.append(word)
                word = ""
            elif piece == " ":
                if word:
                    total += model.word_cost(word)
                    words.append(word)
                else:
                    total += toxicity.COST_DROP_SEPARATOR - toxicity.COST_SPLIT
                word = ""
            else:
                word += piece
        if dull:
            continue
        if word or not (split or anywhere):
            total += model.word_cost(word)
            words += [word] if word else []
        text = " ".join(words)
        best[text] = min(best.get(text, math.inf), total)
    cost = min(best.values())
    return {t for t, c in best.items() if c < cost + 1e-3}, cost


@pytest.mark.parametrize("token", ["1d10t", "id!ot", "m0r0n", "st.u.p", "aaab", "4nd", "h4ppy", "g.r3en", "7h3", "!!", "a"])
def test_viterbi_is_the_cheapest_path(restorer, token):
    for split, anywhere in itertools.product((False, True), repeat=2):
        found, cost = toxicity.decode(token, restorer.model, split, anywhere)
        texts, least = cheapest(token, restorer.model, split, anywhere)
        assert abs(cost - least) < 1e-3 and found in texts, (token, split, anywhere, found, texts)


@pytest.mark.parametrize("text, word", [
    ("1d10t" + "!" * 60, "idiot"),
    ("i" + "." * 45 + "d.i.o.t", "idiot"),
    ("i" * 170 + "diot", "idiot"),
    (" ".join("uncharacteristically"), "uncharacteristically"),
    ("They were " + " ".join("stupid") + " and happy", "stupid"),
    (" ".join("youarea" + "moron" * 3), "moron"),
])
def test_hidden_words_of_any_length(restorer, text, word):
    assert word in restorer.text(text) and word in restorer.counts(text)


def test_counts_are_those_of_the_text(restorer):
    text = ("The stup1d house, the h o u s e. " * 500 + "x" * 300 + " ") * 3
    assert restorer.counts(text) == toxicity.Counter(restorer.text(text))
    small = [p for p in toxicity.blocks_of(text, 100)]
    assert "".join(small) == text and [w for p in small for w in p.split()] == text.split()
    assert toxicity.Restorer(restorer.model, memory=100).counts(text) == restorer.counts(text)


def test_repeated_letters_runs_count_once(restorer):
    assert restorer.counts(" ".join("idiot"))["idiot"] == 1
    assert restorer.counts(" ".join("idiot") + "\nhouse house valley " + " ".join("idiot"))["idiot"] == 2
