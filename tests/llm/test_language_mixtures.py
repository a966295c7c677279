"""Inferred mixtures against plain expectation-maximisation over every set of languages."""

import itertools
import math

import numpy as np
import pytest

from martloom.llm import language

SAMPLES = {
    "a": "the river runs under the old bridge and the water is cold in the morning when the wind blows",
    "b": "der fluss fließt unter der alten brücke und das wasser ist kalt am morgen wenn der wind weht",
    "c": "la rivière coule sous le vieux pont et son eau est froide le matin quand le vent souffle fort",
    "d": "rzeka płynie pod starym mostem a woda jest zimna rano kiedy wieje wiatr od strony gór",
}


@pytest.fixture(scope="module")
def model():
    sums = []
    for text in SAMPLES.values():
        row = np.full(language.BUCKETS, 0.2)
        found, n = language.ngram_counts(text)
        row[found] += 50 * n
        sums.append(row / row.sum())
    return language.LanguageModel(tuple(SAMPLES), np.array(sums), 6.0)


def plain(model, text):
    """The best set of languages by penalised likelihood, every set tried, and its shares."""
    buckets, counts = language.ngram_counts(text)
    grams, total = list(zip(buckets.tolist(), counts.tolist())), int(counts.sum())
    best = None
    for size in range(1, len(model.languages) + 1):
        for chosen in itertools.combinations(range(len(model.languages)), size):
            shares = {i: 1 / size for i in chosen}
            for _ in range(400):
                gained = dict.fromkeys(chosen, 0.0)
                for bucket, n in grams:
                    whole = sum(shares[i] * model.odds[i, bucket] for i in chosen)
                    for i in chosen:
                        gained[i] += n * shares[i] * model.odds[i, bucket] / whole
                shares = {i: g / total for i, g in gained.items()}
            fit = sum(n * math.log(sum(shares[i] * model.odds[i, b] for i in chosen)) for b, n in grams)
            value = fit - model.penalty * size * math.log(total + 1)
            if best is None or value > best[0]:
                best = value, {model.languages[i]: s for i, s in shares.items()}
    return best[1]


@pytest.mark.parametrize("parts", ["a", "d", "ab", "bcd", "abcd", "aab"])
def test_mixture_equals_every_set_tried(model, parts):
    text = " ".join(SAMPLES[p] for p in parts)
    found, wanted = language.mixture(model, text), plain(model, text)
    assert set(found) == set(wanted) == set(parts)
    assert all(abs(found[x] - wanted[x]) < 0.01 for x in wanted)


def test_languages_of_equal_likelihood_share_by_order(model):
    """Two languages with the same probabilities: the first by name is taken, alone, each time."""
    twin = language.LanguageModel(("a", "z", "b"), model.odds[[0, 0, 1]], 6.0)
    assert language.mixture(twin, SAMPLES["a"]) == {"a": 1.0}
    assert language.mixture(model, " .,; 12") == {}
