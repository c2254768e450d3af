"""Decisions and training steps of the models against plain loops over single rows."""

import math
import random

import numpy as np
import pytest

from riskloom.llm import language, pii, quality


def slots_of(gram):
    """The filter slots of an n-gram, by integers of any length."""
    mixed = gram * 0x9E3779B97F4A7C15 % 2**64
    mixed ^= mixed >> 32
    mixed = mixed * 0xD6E8FEB86659FD93 % 2**64
    bits = language.SLOTS.bit_length() - 1
    return [(mixed >> (64 - bits * (i + 1))) % language.SLOTS for i in range(language.PROBES)]


def grams_of(text):
    code = [ord(c) if c.isalpha() else 0 for c in " " + text.lower() + " "]
    return [code[i - 1] << 42 | code[i] << 21 | code[i + 1] for i in range(1, len(code) - 1) if code[i]]


def test_the_whole_language_decision():
    rng = random.Random(3)
    letters = {f"l{k:02d}": [chr(97 + (k * 3 + i) % 26) for i in range(9)] for k in range(70)}

    def text_of(name, n):
        return " ".join("".join(rng.choice(letters[name]) for _ in range(rng.randint(1, 7))) for _ in range(n))

    known = {name: np.unique(np.array(grams_of(text_of(name, 300)), np.int64)) for name in letters}
    made = language.Filters.build(sorted(known), known)
    filled = {name: {slot for gram in grams.tolist() for slot in slots_of(gram)} for name, grams in known.items()}
    texts = [text_of(name, rng.randint(1, 30)) for name in list(letters)[::5]] + ["", None, "123 !!", "ÄÖ ß ١", "z" * 500]
    names, scores = made.decide(texts)
    for text, name, score in zip(texts, names, scores):
        grams = grams_of(text or "")
        right = {}
        for lang in sorted(known):
            false = (len(filled[lang]) / language.SLOTS) ** language.PROBES
            hits = sum(all(slot in filled[lang] for slot in slots_of(gram)) for gram in grams)
            right[lang] = max(0.0, (hits - len(grams) * false) / (1 - false))
        best = max(sorted(right), key=lambda lang: right[lang])
        assert name == (best if grams else "und")
        assert score == pytest.approx(right[best] / max(sum(right.values()), 1e-12) if grams else 0.0, abs=1e-9)


@pytest.fixture
def labelled():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=40) > 0).astype(float)
    return x, y, rng.uniform(0.5, 2, 40)


def test_a_training_step_goes_down_the_slope_of_the_loss(labelled, monkeypatch):
    x, y, weight = labelled
    monkeypatch.setattr(quality, "STEPS", 1)
    net = quality.train(x, y, weight)
    rng = np.random.default_rng(quality.SEED)
    start = [rng.normal(0, quality.WIDTH**-0.5, (3, quality.HIDDEN)), np.zeros(quality.HIDDEN),
             rng.normal(0, quality.HIDDEN**-0.5, quality.HIDDEN), np.zeros(1)]
    z = (x - x.mean(0)) / (x.std(0) + 1e-9)

    def loss(values):
        first, first_bias, second, second_bias = values
        total = 0.0
        for row, label, w in zip(z, y, weight):
            logit = np.tanh(row @ first + first_bias) @ second + second_bias[0]
            p = 1 / (1 + math.exp(-logit))
            total -= w * (label * math.log(p) + (1 - label) * math.log(1 - p))
        return total / weight.sum() + 1e-4 * ((first**2).sum() + (second**2).sum())

    # The first step of Adam moves every weight by its rate against the sign of its slope.
    for k, after in enumerate([net.first, net.first_bias, net.second, np.array([net.second_bias])]):
        for at in list(np.ndindex(start[k].shape))[:12]:
            near = [[v.copy() for v in start] for _ in range(2)]
            near[0][k][at] += 1e-5
            near[1][k][at] -= 1e-5
            slope = (loss(near[0]) - loss(near[1])) / 2e-5
            if abs(slope) > 1e-5:
                assert after[at] - start[k][at] == pytest.approx(-0.02 * math.copysign(1, slope), rel=1e-2)


def test_training_parts_what_can_be_parted(labelled):
    x, y, weight = labelled
    net = quality.train(x, y, weight)
    assert ((net.score(x) > 0.5) == (y == 1)).mean() > 0.95


def test_the_temperature_is_that_of_the_least_loss(labelled):
    x, y, weight = labelled
    net = quality.train(x, y, weight)
    rng = np.random.default_rng(8)
    other = rng.normal(size=(60, 3))
    truth = (other[:, 0] + rng.normal(size=60) > 0).astype(float)
    w = rng.uniform(0.5, 2, 60)
    n = truth.sum()
    soft = np.where(truth == 1, (n + 1) / (n + 2), 1 / (len(truth) - n + 2))

    def loss(t):
        p = 1 / (1 + np.exp(-net.logit(other) / t))
        return -(w * (soft * np.log(p) + (1 - soft) * np.log(1 - p))).sum()

    grid = np.exp(np.linspace(math.log(0.02), math.log(90), 4000))
    assert loss(quality.calibrate(net, other, truth, w)) <= min(map(loss, grid)) + 1e-6


def plain_em(rows):
    """Expectation-maximisation over single candidates (kind, votes): one probability for each row."""
    out = [0.0] * len(rows)
    for kind in {k for k, _ in rows}:
        mine = [(i, v) for i, (k, v) in enumerate(rows) if k == kind]
        soft = {i: min(0.95, max(0.05, 0.5 + 0.5 * sum(v) / max(1, sum(map(abs, v))))) for i, v in mine}
        for _ in range(pii.ROUNDS):
            mass = [1 + sum(soft.values()), 1 + sum(1 - p for p in soft.values())]
            rate = [[{x: (1 + sum((p if side == 0 else 1 - p) for (i, v), p in zip(mine, [soft[i] for i, _ in mine]) if v[j] == x)) / (mass[side] + 3)
                      for x in (-1, 0, 1)} for j in range(5)] for side in (0, 1)]
            for i, v in mine:
                yes, no = (mass[side] * math.prod(rate[side][j][x] for j, x in enumerate(v)) for side in (0, 1))
                soft[i] = yes / (yes + no)
        for i, p in soft.items():
            out[i] = p
    return out


def test_reliabilities_equal_those_of_single_rows():
    rng = random.Random(9)
    rows = [(kind, tuple(rng.choice((-1, 0, 1, 1)) for _ in range(5))) for kind in (0, 3) for _ in range(150)]
    counts = {}
    for row in rows:
        counts[row] = counts.get(row, 0) + 1
    got = pii.reliabilities([(kind, *votes, n) for (kind, votes), n in sorted(counts.items())])
    for (kind, votes), p in zip(rows, plain_em(rows)):
        assert got[(kind, *votes)] == pytest.approx(p, abs=1e-9)


def test_the_span_classifier_equals_plain_loops(spark):
    text = ("mail joe@x.org or call +1 555 123 4567 and (555) 123-4567\nhost 10.0.0.1 version 1.2.3.4 card 4111 1111 1111 1111\n"
            "no 300.1.1.1 order 555-123-4567 x joe [at] mail [dot] com isbn 4111 1111 1111 1112\n")
    docs = spark.createDataFrame([(i, text[i:] * (1 + i % 3)) for i in range(20)], "doc_id long, text string")
    stored = pii.candidates(docs, "doc_id", "text")
    odds, weights = pii.classifier(stored)
    spans = [s for row in stored.collect() for s in row.spans]
    soft = plain_em([(s.kind, tuple(s[name] for name in pii.LABELERS)) for s in spans])
    for kind in {s.kind for s in spans}:
        mine = [(s, p) for s, p in zip(spans, soft) if s.kind == kind]
        prior = math.log((1 + sum(p for _, p in mine)) / (1 + sum(1 - p for _, p in mine)))
        assert odds[kind] == pytest.approx(prior, abs=1e-7)
        for name in pii.LABELERS + pii.FEATURES:
            for value in {s[name] for s, _ in mine}:
                some = [p for s, p in mine if s[name] == value]
                want = math.log((1 + sum(some)) / (1 + sum(1 - p for p in some))) - prior
                assert weights[(kind, name, value)] == pytest.approx(want, abs=1e-7)
