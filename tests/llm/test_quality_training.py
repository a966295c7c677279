"""The trained classifier against the update rule written out with dictionaries, one coordinate at a time."""

import math
import random

import numpy as np

from martloom.llm import quality


def plain_ftrl(examples, passes, alpha, beta, l1, l2):
    """Weights by coordinate; the one named ``bias`` is not regularised."""
    z, n = {}, {}

    def weight(i):
        own = 0.0 if i == "bias" else l1
        rest = 0.0 if i == "bias" else l2
        if abs(z.get(i, 0.0)) <= own:
            return 0.0
        return -math.copysign(abs(z[i]) - own, z[i]) / ((beta + math.sqrt(n[i])) / alpha + rest)

    for _ in range(passes):
        for features, label in examples:
            row = {**features, "bias": 1.0}
            w = {i: weight(i) for i in row}
            p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in row.items())))
            for i, x in row.items():
                g = (p - label) * x
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / alpha * w[i]
    return {i: weight(i) for i in z}


def test_training_equals_the_plain_update_rule():
    rng = random.Random(3)
    good, bad = ["clear words here", "a plain line", "some more text"], ["buy now now", "click click", "free free offer"]
    texts = [(" ".join(rng.choices(good if label else bad, k=rng.randint(1, 6))), label) for label in rng.choices((0, 1), k=60)]
    rows = [(*quality.features(text, 12), label) for text, label in texts]
    options = {"passes": 3, "alpha": 0.7, "beta": 1.0, "l1": 0.05, "l2": 0.1}
    model = quality.train_ftrl(rows, 12, **options)
    wanted = plain_ftrl([(dict(zip(map(int, b), map(float, v))), label) for b, v, label in rows], **options)
    assert math.isclose(model.bias, wanted.pop("bias"), rel_tol=1e-9)
    dense = np.zeros(1 << 12)
    for bucket, weight in wanted.items():
        dense[bucket] = weight
    assert np.allclose(model.weights, dense, rtol=1e-9, atol=1e-12) and np.count_nonzero(dense) > 5
    # Scores are sparse dot products over the buckets of a text.
    for text, _ in texts[:10]:
        logit = model.bias + sum(dense[b] * v for b, v in zip(*quality.features(text, 12)))
        assert math.isclose(model.score(text), 1 / (1 + math.exp(-logit)), rel_tol=1e-9)
