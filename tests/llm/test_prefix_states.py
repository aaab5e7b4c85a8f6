"""Cost of solving pieces for the prefix counts."""

import random

import public_tokenizers

from tripwise.llm.prefix_counts import PrefixCounter


class Counted(dict):
    lookups = 0

    def get(self, *key):
        self.lookups += 1
        return super().get(*key)


def test_states_spare_lookups_of_substrings():
    counter = PrefixCounter(public_tokenizers.path("byte_bpe_50k.json"))
    plain = counter.vocabulary
    counter.vocabulary = Counted(plain)
    deal = random.Random(5)
    words = ["".join(deal.choices(["ing", "on", "the", "re", "ti", "ha"], k=deal.randint(1, 6))) for _ in range(4000)]
    for word in words:
        assert counter.piece(word)[-1] == len(counter.model.tokenize(word))
    assert counter.vocabulary.lookups < sum(map(len, set(words))) / 2
    assert len(counter.states) <= len(counter.beginnings)
    for state, endings in zip(counter.states, counter.endings):
        assert endings == [(plain[state[k:]], len(state) - k) for k in range(len(state)) if state[k:] in plain]
