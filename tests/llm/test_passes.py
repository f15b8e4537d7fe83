"""The learner's grouped and blocked sums against plain ones."""

import numpy as np
import pytest

from civiclake.llm import recurrent as net


@pytest.fixture
def parameters():
    rng = np.random.default_rng(7)
    p = net.Parameters.initial(rng.integers(1, 50, net.WORDS).astype(float), 300.0)
    for a in p.arrays():
        a += (rng.standard_normal(a.shape) * 0.2).astype(np.float32)
    return p


@pytest.mark.parametrize("keys", [[], [3], [0] * 900, list(range(70)), [5, 1, 5, 5, 1, 69, 0, 5] * 30 + [8]])
def test_row_sums(keys):
    keys = np.array(keys, np.int32)
    rows = np.random.default_rng(1).standard_normal((len(keys), 6)).astype(np.float32)
    want = np.zeros((70, 6))
    np.add.at(want, keys, rows)
    assert np.allclose(net.row_sums(rows, keys, 70), want, atol=1e-4)


@pytest.mark.parametrize("targets", [
    [net.WORDS] * 5, [0, 0, 31, 32, net.WORDS, net.WORDS - 1], [40] * (3 * net.BLOCK), [40] * (net.BLOCK + 1) + list(range(0, net.WORDS, 9))])
def test_output_gradients_are_those_of_each_target(parameters, targets):
    p, targets, weight = parameters, np.array(targets, np.int32), np.float32(0.25)
    hidden = np.random.default_rng(2).standard_normal((len(targets), net.HIDDEN)).astype(np.float32)
    want = [np.zeros((len(targets), net.HIDDEN)), *[np.zeros(a.shape) for a in p.arrays()[2:]]]

    def error(h, weights, bias, chosen):
        logits = h @ weights + bias
        share = np.exp(logits - logits.max())
        share /= share.sum()
        share[chosen] -= 1
        return share * weight

    for i, (h, t) in enumerate(zip(hidden.astype(float), targets.tolist())):
        c, w = divmod(t, net.CLASS_WORDS)
        e = error(h, p.class_weight, p.class_bias, c)
        want[0][i] += p.class_weight @ e
        want[1] += np.outer(h, e)
        want[2] += e
        if t < net.WORDS:
            e = error(h, p.word_weight[c], p.word_bias[c], w)
            want[0][i] += p.word_weight[c] @ e
            want[3][c] += np.outer(h, e)
            want[4][c] += e
    d_hidden, softmax = net.output_gradients(p, hidden, targets, weight)
    for got, expected in zip((d_hidden, *softmax), want):
        assert np.allclose(got, expected, atol=1e-4)


def test_steps_are_adaptive_moments_of_the_mean_gradient(parameters):
    rng = np.random.default_rng(3)
    counts = np.array([70, 1, 40, 33])
    targets = rng.integers(0, net.WORDS + 1, counts.sum()).astype(np.int32)
    packed = net.pack(targets, np.minimum(targets, net.WORDS - 1), counts, 3, net.WORDS - 1)
    learner = net.Learner(net.Parameters(*[a.copy() for a in parameters.arrays()]))
    learner.learn(packed)
    p = net.Parameters(*[a.copy() for a in parameters.arrays()])
    means, squares = ([np.zeros(a.shape) for a in p.arrays()] for _ in range(2))
    state, step = np.zeros((packed.inputs.shape[1], net.HIDDEN), np.float32), 0
    for part in net.windows(packed):
        inputs, begins, valid = packed.inputs[part], packed.begins[part], packed.document[part] >= 0
        run = net.forward(p, state[part[1]], inputs, begins)
        state, step = run.after[-1], step + 1
        d_hidden, softmax = net.output_gradients(p, run.after[valid], packed.targets[part][valid])
        d_after = np.zeros((*valid.shape, net.HIDDEN), np.float32)
        d_after[valid] = d_hidden
        for a, m, s, d in zip(p.arrays(), means, squares, (*net.backward(p, run, inputs, begins, d_after), *softmax)):
            d = d / valid.sum()
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            a -= (0.01 * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step) * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
    assert step > 1 and learner.learned == counts.sum()
    for got, want, before in zip(learner.p.arrays(), p.arrays(), parameters.arrays()):
        assert np.abs(want - before).max() > 0.005
        assert np.quantile(np.abs(got - want), 0.99) < 1e-3
