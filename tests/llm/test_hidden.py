import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marquee.llm import hidden

LOWER = str.maketrans({chr(a): chr(a + 32) for a in range(65, 91)})


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


@pytest.fixture(scope="module")
def fit(odd_documents):
    return hidden.fitted(odd_documents)


def test_scores_equal_a_plain_forward_recursion(spark, odd_documents, fit):
    rows, counts, classes, model = fit
    docs = odd_documents.collect()
    count = Counter(w for d in docs if not out(d.doc_id) for w in tokens(d.text))
    ends = sum(not out(d.doc_id) for d in docs)
    total, kinds = sum(count.values()) + ends, len(count) + 1
    want = []
    for d in docs:
        words = tokens(d.text)
        base = sum(math.log10((c + 1) / (total + kinds + 1)) for c in [count[w] for w in words] + [ends])
        number = [classes.own.get(w, hidden.OWN + hidden.ending(w)) for w in words] + [classes.end]
        state, value = None, 0.0
        for n in number:
            state = (model.first if state is None else state @ model.move) * model.draw[n]
            value += math.log10(state.sum())
            state = state / state.sum()
        for w, n in zip(words, number, strict=False):
            if n >= hidden.OWN:
                value += math.log10((count[w] + 1) / (classes.mass[n - hidden.OWN] + classes.kinds[n - hidden.OWN] + 1))
        want.append((d.doc_id, out(d.doc_id), len(words) + 1, sum(count[w] > 0 for w in words) + 1, total, round(base, 6), round(value, 6)))
    got = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in hidden.scored(rows, counts, classes, model).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_training_beats_single_tokens(fit):
    rows, counts, classes, model = fit
    got = hidden.scored(rows, counts, classes, model).collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def small(states=3, classes=5, seed=1):
    rng = np.random.default_rng(seed)
    part = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(shape))
    return hidden.Model(part(states), part(states), part(states, states), part(states, classes).T)


def test_probabilities_of_all_texts_of_a_length_sum_to_one():
    model = small()
    texts = list(itertools.product(range(5), repeat=4))
    numbers = np.array(texts, np.uint16).ravel()
    for stretch in (1, 2, 3, 4, 100):
        assert abs((10 ** hidden.likelihood(model, numbers, np.arange(0, len(numbers) + 1, 4), stretch)).sum() - 1) < 1e-9


def test_stretches_chain_exactly():
    model, rng = small(4, 9, 2), np.random.default_rng(3)
    sizes = [1, 2, 5, 40, 41, 500, 3]
    numbers, stops = rng.integers(0, 9, sum(sizes)).astype(np.uint16), np.append(0, np.cumsum(sizes))
    whole = hidden.likelihood(model, numbers, stops, 10_000)
    for stretch in (1, 7, 40):
        assert np.allclose(hidden.likelihood(model, numbers, stops, stretch), whole, rtol=1e-12)


def test_expected_counts_equal_all_paths():
    model, numbers = small(), np.array([0, 3, 1, 4, 4, 2, 0, 1], np.uint16)
    stops = np.array([0, 5, 8])
    first, move, draw = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for a, b in zip(stops, stops[1:], strict=False):
        ways = {}
        for path in itertools.product(range(3), repeat=int(b - a)):
            p = model.first[path[0]] * model.draw[numbers[a], path[0]]
            for i in range(1, b - a):
                p *= model.move[path[i - 1], path[i]] * model.draw[numbers[a + i], path[i]]
            ways[path] = p
        total = sum(ways.values())
        for path, p in ways.items():
            first[path[0]] += p / total
            for i, s in enumerate(path):
                draw[numbers[a + i], s] += p / total
                if i:
                    move[path[i - 1], s] += p / total
    sums = hidden.nothing(model)
    hidden.add_up(model, numbers, stops, sums)
    assert np.allclose(sums.first, first, atol=1e-5) and np.allclose(sums.move, move, atol=1e-5) and np.allclose(sums.draw, draw, atol=1e-5)


def test_rounds_never_lower_the_likelihood(monkeypatch):
    monkeypatch.setattr(hidden, "PRIOR", 0.0)
    rng = np.random.default_rng(4)
    numbers = np.concatenate([rng.integers(0, 4, 60) + 4 * (i % 2) for i in range(40)]).astype(np.uint16)
    stops, share = np.arange(0, 2401, 60), np.full(8, 1 / 8)
    model, last = hidden.beginning(share, 2), -np.inf
    for _ in range(8):
        hidden.add_up(model, numbers, stops, sums := hidden.nothing(model))
        model = hidden.better(sums, share)
        now = hidden.likelihood(model, numbers, stops).sum()
        assert now > last - 0.5
        last = now
    assert np.abs(model.move.diagonal() - 1).max() < 0.1


def test_no_documents_and_none_to_learn_from(spark, no_documents):
    assert hidden.score(no_documents).collect() == []
    held = [i for i in range(200) if out(i)][:3]
    rows = hidden.score(spark.createDataFrame([(i, "Some words", "x") for i in held], "doc_id long, text string, score string")).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(True, 3, 0, 0, 0.0)] * 3
