"""The learned scores and their gradients, and the tag-path ratios, against plain forms."""

import html as entities
import math
import os
import re
from html.parser import HTMLParser

import numpy as np
import pytest

from sievework.llm import htmlmain, ordinal, toxicity

TEXTS = ["you are a nice person", "you idiot go away", "what a lovely day it is", "idiots all of you", "fine words here", "go away fool"]
TOXIC = [0, 1, 0, 1, 0, 1]


class Recorded(toxicity.Adam):
    """Keeps what it held and the gradient it got at each step."""

    made: list = []

    def __init__(self, x, rate):
        super().__init__(x, rate)
        self.seen = []
        Recorded.made.append(self)

    def step(self, g):
        self.seen.append((self.x.astype(np.float64).copy(), np.array(g, np.float64)))
        super().step(g)


def differences(loss, x, some):
    out = []
    for at in some:
        up, down = x.copy(), x.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        out.append((loss(up) - loss(down)) / 2e-5)
    return out


def test_toxicity_gradients_are_those_of_the_loss(monkeypatch):
    monkeypatch.setattr(toxicity, "Adam", Recorded)
    monkeypatch.setattr(toxicity, "STEPS", 3)
    Recorded.made = []
    toxicity.fit(TEXTS, TOXIC, {0: 0.5, 1: 0.5})
    vectors, soft, bias = Recorded.made
    every = list(dict.fromkeys(w for t in TEXTS for w in t.split()))
    used = {b: i for i, b in enumerate(np.unique(toxicity.subwords(every)[0]).tolist())}
    bag = {w: [used[b] for b in toxicity.subwords([w])[0].tolist()] for w in every}

    def loss(v, s, b):
        value, total = v @ (s[1] - s[0]), 0.0
        for text, y in zip(TEXTS, TOXIC):
            score = [np.mean([value[i] for i in bag[w]]) for w in text.split()]
            z = [(a + c) / 2 + b[0] for a, c in zip(score, [*score[1:], score[-1]])]
            clean = math.prod(1 - 1 / (1 + math.exp(-x)) for x in z)
            total -= math.log(1 - clean if y else clean)
        return total / len(TEXTS) + toxicity.DECAY / 2 * (value**2).sum()

    rng = np.random.default_rng(0)
    for k in range(3):
        (v, dv), (s, ds), (b, db) = (p.seen[k] for p in (vectors, soft, bias))
        some = [(int(rng.integers(len(v))), int(rng.integers(v.shape[1]))) for _ in range(40)]
        assert np.allclose(differences(lambda x: loss(x, s, b), v, some), [dv[at] for at in some], rtol=2e-2, atol=2e-5)
        places = [(i, j) for i in range(2) for j in range(s.shape[1])]
        assert np.allclose(differences(lambda x: loss(v, x, b), s, places), [ds[at] for at in places], rtol=2e-2, atol=2e-5)
        assert np.allclose(differences(lambda x: loss(v, s, x), b, [0]), db, rtol=2e-2, atol=2e-5)


def test_toxicity_scores_equal_a_plain_form():
    m = toxicity.fit(TEXTS, TOXIC, {0: 0.9, 1: 0.1})

    def plain(text):
        words = text.lower().split()
        score = [np.mean([m.value[b] for b in toxicity.subwords([w])[0]]) for w in words]
        clean = 1.0
        for a, c in zip(score, [*score[1:], score[-1]]):
            clean *= 1 - 1 / (1 + math.exp(-((a + c) / 2 + m.bias)))
        odds = m.factor * (1 - clean) / clean
        return odds / (1 + odds)

    for text in [*TEXTS, "idiottt", "ä öde", "nice " * 50]:
        assert m.score(text) == pytest.approx(plain(text), rel=1e-4, abs=1e-9)


GRADED = ["all good words here", "fine text of words", "so so words", "meh text", "bad bad BAD 12", "X 99 !!"]
GRADES = [2, 2, 1, 1, 0, 0]


def test_ordinal_gradients_are_those_of_the_loss(monkeypatch):
    monkeypatch.setattr(ordinal, "Adam", Recorded)
    monkeypatch.setattr(ordinal, "STEPS", 3)
    Recorded.made = []
    shares = {0: 0.2, 1: 0.3, 2: 0.5}
    ordinal.fit(GRADED, GRADES, shares)
    first, second, cuts = Recorded.made
    texts = [ordinal.words(t) for t in GRADED]
    used = {b: i for i, b in enumerate(sorted({b for t in texts for w in t for b in ordinal.features(w)}))}
    weight = [shares[g] ** 0.5 / (GRADES.count(g) / len(GRADES)) for g in GRADES]
    weight = [w / sum(weight) for w in weight]

    def loss(a, b, c):
        cut, total = [c[0], c[0] + math.exp(c[1])], 0.0
        for words, g, w in zip(texts, GRADES, weight):
            mean = np.mean([np.mean([a[used[f]] for f in ordinal.features(x)]) for x in words])
            marks = sum(math.exp(np.mean([b[used[f]] for f in ordinal.features(x)]) + ordinal.FIRST_MARK) for x in words)
            z = mean - math.log1p(marks)
            tail = [1.0, *(1 / (1 + math.exp(t - z)) for t in cut), 0.0]
            total -= w * math.log(tail[g] - tail[g + 1])
        return total + ordinal.DECAY / 2 * ((a**2).sum() + (b**2).sum())

    for k in range(3):
        (a, da), (b, db), (c, dc) = (p.seen[k] for p in (first, second, cuts))
        some = list(range(0, len(a), 2))
        assert np.allclose(differences(lambda x: loss(x, b, c), a, some), da[some], rtol=2e-2, atol=2e-5)
        assert np.allclose(differences(lambda x: loss(a, x, c), b, some), db[some], rtol=2e-2, atol=2e-5)
        assert np.allclose(differences(lambda x: loss(a, b, x), c, [0, 1]), dc, rtol=2e-2, atol=2e-5)


def test_tails_equal_a_plain_form():
    m = ordinal.fit(GRADED, GRADES, {0: 0.2, 1: 0.3, 2: 0.5})
    for text in [*GRADED, "unseen Words", "again again again"]:
        words = ordinal.words(text)
        mean = np.mean([np.mean([m.weights[f, 0] for f in ordinal.features(w)]) for w in words])
        marks = sum(math.exp(np.mean([m.weights[f, 1] for f in ordinal.features(w)]) + ordinal.FIRST_MARK) for w in words)
        z = mean - math.log(1 + marks)
        assert m.tails(text) == pytest.approx([1 / (1 + math.exp(t - z)) for t in m.thresholds], rel=1e-4, abs=1e-7)


class Nodes(HTMLParser):
    """(path of block tags, prior, text) of the text nodes of a page whose tags are all closed."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.open, self.found, self.said = [], [], ""

    def text(self):
        said, self.said = " ".join(entities.unescape(self.said).split()), ""
        if said and not any(tag in htmlmain.CHROME | htmlmain.RAW for tag, *_ in self.open):
            blocks = [x for x in self.open if x[0] not in htmlmain.INLINE or x[2]]
            prior = (htmlmain.MAIN_WEIGHT if any(t in htmlmain.MAIN for t, *_ in blocks) else 1) * (htmlmain.CHROME_WEIGHT if any(x[2] for x in blocks) else 1)
            self.found.append(("/".join(x[1] for x in blocks), prior, said))

    def handle_starttag(self, tag, attributes):
        names = " ".join(v or "" for k, v in attributes if k in ("class", "id", "role"))
        against = bool(names and tag not in {"html", "body"} | htmlmain.MAIN and htmlmain.CHROME_WORD.search(names))
        if tag not in htmlmain.INLINE or against:
            self.text()
        if tag not in htmlmain.VOID:
            self.open.append((tag, f"{tag}.{names}" if names else tag, against))

    def handle_endtag(self, tag):
        if tag not in htmlmain.INLINE or self.open[-1][2]:
            self.text()
        assert self.open.pop()[0] == tag

    def handle_data(self, data):
        self.said += data

    def handle_entityref(self, name):
        self.said += f"&{name};"

    def handle_charref(self, name):
        self.said += f"&#{name};"


def plain_text(found):
    length, marks, count = {}, {}, {}
    for path, _, text in found:
        count[path] = count.get(path, 0) + 1
        length[path] = length.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + sum(c in ".,;:!?。、，；：！？…" for c in text)
    smooth = lambda total, i: sum(w * total[p] / count[p] for w, p in zip((0.25, 0.5, 0.25), (found[max(0, i - 1)][0], found[i][0], found[min(len(found) - 1, i + 1)][0])))
    value = [smooth(length, i) * (0.5 + smooth(marks, i)) * found[i][1] for i in range(len(found))]
    limit = 0.5 * max(sum(value) / len(value), 16) if value else 0
    good = {p for p in count if sum(v for v, f in zip(value, found) if f[0] == p) / count[p] >= limit}
    keep = [f[0] in good for f in found]
    for i in reversed(range(len(found) - 1)):
        keep[i] = keep[i] or keep[i + 1] and re.match(r"h[1-6]\b", found[i][0].rsplit("/", 1)[-1]) is not None
    return " ".join(f[2] for k, f in zip(keep, found) if k)


def page_of(rng):
    """A page whose tags are all closed."""
    say = lambda n: " ".join(rng.choice(["word", "longer", "it &amp; that,", "end.", "<b>bold</b>", "<a href='x'>link</a>", "&eacute;t&#233;", "\n  more"]) for _ in range(n))
    para = lambda: f"<p>{say(rng.randrange(1, 40))}</p>"
    items = lambda n, c="": f"<ul{c}>" + "".join(f"<li>{say(2)}</li>" for _ in range(n)) + "</ul>"
    parts = ["".join(para() for _ in range(rng.randrange(1, 6))), items(rng.randrange(1, 9)), f"<h2>{say(3)}</h2>{para()}", f"<div class='sidebar'>{para()}</div>", f"<aside>{para()}</aside>", f"<div class='x{rng.randrange(3)}'>{para()}{para()}</div>", f"<span class='promo'>{say(4)}</span>", "<img src='a'>", say(3), f"<table><tr><td>{say(2)}</td><td>{say(9)}</td></tr></table>"]
    body = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
    main = rng.choice(["article", "div", "section"])
    return f"<html><head><title>t</title></head><body><nav>{items(4)}</nav><{main}>{body}</{main}>{items(3, ' class=menu')}<script>x</script><footer>{say(3)}</footer></body></html>"


def test_tag_path_ratios_equal_a_plain_form():
    import random

    rng, kept = random.Random(9), 0
    for _ in range(600):
        page = page_of(rng)
        parser = Nodes()
        parser.feed(page)
        parser.text()
        assert parser.found == htmlmain.blocks(page), page
        assert plain_text(parser.found) == htmlmain.main_text(page), page
        kept += 0 < len(htmlmain.main_text(page)) < sum(len(t) for _, _, t in parser.found)
    assert kept > 400


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_the_ratios_of_all_pages_equal_a_plain_form():
    import pyarrow.parquet as pq

    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist():
        assert plain_text(htmlmain.blocks(page or "")) == htmlmain.main_text(page)


def test_a_word_of_one_letter_alone():
    m = toxicity.fit(TEXTS, TOXIC, {0: 0.9, 1: 0.1})
    assert 0 <= m.score("a") <= 1 and m.score("a a") >= m.score("a")
    assert toxicity.fit(["a", "b"], [0, 1], {0: 0.5, 1: 0.5}).score("b") > 0.1
