"""The network's steps, taken for all classes at once, give what they give class by class."""

import numpy as np

from claimflow.llm import lm


def softmax(x):
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def test_rows_are_shifted_by_their_greatest_value():
    for width in (64, 48, 7, 1):
        x = np.random.default_rng(width).normal(0, 9, (33, width)).astype(np.float32)
        want = x - x.max(1, keepdims=True)
        lm._shift(x)
        assert (x == want).all()


def test_chosen_logarithms_are_those_of_the_softmax():
    x = np.random.default_rng(1).normal(0, 4, (50, 64)).astype(np.float32)
    chosen = np.arange(50) % 64
    want = np.log(softmax(x.astype(np.float64)))[np.arange(50), chosen]
    assert np.allclose(lm._log_chosen(x, chosen), want, atol=1e-5)


def test_a_step_is_the_gradient_of_every_class_and_leaves_the_others():
    rng = np.random.default_rng(2)
    p = lm.start(np.ones(lm.TOKENS))
    p["w_token"] += rng.normal(0, 0.1, p["w_token"].shape).astype(np.float32)
    squares = {k: np.zeros_like(v) for k, v in p.items()}
    tokens = rng.integers(0, 5 * lm.CLASSES, 200).astype(np.int32)          # of five classes only
    line = np.concatenate(([lm.PAD] * lm.SIDE, tokens, [lm.PAD] * lm.SIDE)).astype(np.int32)
    places = np.arange(200) + lm.SIDE
    before = {k: v.copy() for k, v in p.items()}
    lm.train_step(p, squares, line, places)
    order = places[np.argsort(line[places], kind="stable")]
    _, h = lm._hidden(before, lm._context(line, order))
    for c in range(lm.CLASSES):
        rows = line[order] // lm.CLASSES == c
        if not rows.any():
            assert (p["w_token"][c] == before["w_token"][c]).all() and not squares["w_token"][c].any()
            continue
        d = softmax(h[rows] @ before["w_token"][c] + before["b_token"][c])
        d[np.arange(len(d)), line[order][rows] % lm.CLASSES] -= 1
        g = h[rows].T @ (d / len(places))
        want = before["w_token"][c] - lm.RATE * g / (np.sqrt(g * g) + 1e-6)
        assert np.allclose(p["w_token"][c], want, atol=1e-4)
