"""The network's gradients against differences of its loss."""

import numpy as np

from civiclake.llm import recurrent as net


def test_gradients_are_slopes_of_the_loss():
    rng = np.random.default_rng(4)
    p = net.Parameters.initial(rng.integers(1, 50, net.WORDS).astype(float), 300.0)
    for a in p.arrays():
        a += (rng.standard_normal(a.shape) * 0.3).astype(np.float32)
    inputs, targets = rng.integers(0, 40, (6, 5)).astype(np.int32), rng.integers(0, net.WORDS + 1, (6, 5)).astype(np.int32)
    targets[::2] = net.WORDS
    begins = rng.random((6, 5)) < 0.2
    start = rng.standard_normal((5, net.HIDDEN)).astype(np.float32)

    def loss():
        after = net.forward(p, start, inputs, begins).after
        assert np.allclose(after, net.states(p, start, inputs, begins), atol=1e-5)
        return -net.log_probability(p, after.reshape(-1, net.HIDDEN), targets.ravel()).sum(dtype=float)

    run = net.forward(p, start, inputs, begins)
    d_hidden, softmax = net.output_gradients(p, run.after.reshape(-1, net.HIDDEN), targets.ravel())
    slopes = (*net.backward(p, run, inputs, begins, d_hidden.reshape(6, 5, net.HIDDEN)), *softmax)
    for a, slope in zip(p.arrays(), slopes):
        way = np.where(np.abs(slope) > 0, np.sign(slope), 0).astype(np.float32)  # along all of them at once
        step = np.float32(1e-2 / np.sqrt(max(1, (way != 0).sum())))
        held = a.copy()
        a += step * way
        above = loss()
        a[...] = held - step * way
        below = loss()
        a[...] = held
        want = float(np.abs(slope).sum())
        assert abs((above - below) / (2 * float(step)) - want) < 0.05 * want + 0.05
