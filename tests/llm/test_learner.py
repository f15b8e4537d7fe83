"""The language model learns from every token of every text."""

import numpy as np

from civiclake.llm import recurrent as net


def test_every_token_is_learned_from_with_a_carried_state(monkeypatch):
    rng = np.random.default_rng(4)
    counts = np.array([1, 5, 200, 33, 64, 1, 90, 2, 17, 700])
    targets = rng.integers(0, net.WORDS, counts.sum()).astype(np.int32)
    packed = net.pack(targets, targets, counts, 3, net.WORDS - 1)
    learner = net.Learner(net.Parameters.initial(np.ones(net.WORDS), 1.0))
    runs, plain = [], net.forward

    def forward(p, state, inputs, begins):
        runs.append((state.copy(), plain(p, state, inputs, begins)))
        return runs[-1][1]

    monkeypatch.setattr(net, "forward", forward)
    learner.learn(packed)
    assert learner.learned == counts.sum()
    assert len(runs) == -(-len(packed.inputs) // net.WINDOW)
    for (_, before), (state, _) in zip(runs, runs[1:]):
        assert np.array_equal(state, before.after[-1][:, :][:len(state)])
