"""The two models and their metrics by brute force over the whole vocabulary."""

import math
from collections import Counter

UNK = "<unk>"


class Dense:
    def __init__(self, observer, performer, alpha, lam, temperature=1.0):
        """``observer`` and ``performer`` are lists of token lists."""
        self.alpha, self.lam, self.t = alpha, lam, temperature
        self.vocabulary = sorted({w for text in observer + performer for w in text}) + [UNK]
        self.counts = {}
        for role, corpus in (("p", observer), ("q", performer)):
            unigram, bigram, context = Counter(), Counter(), Counter()
            for text in corpus:
                unigram.update(text)
                for prev, nxt in zip(text, text[1:]):
                    bigram[prev, nxt] += 1
                    context[prev] += 1
            self.counts[role] = unigram, bigram, context

    def unigram(self, role, word):
        counts = self.counts[role][0]
        return (counts[word] + self.alpha) / (sum(counts.values()) + self.alpha * len(self.vocabulary))

    def raw(self, role, prev, word):
        _, bigram, context = self.counts[role]
        if context[prev] == 0:
            return self.unigram(role, word)
        return self.lam * bigram[prev, word] / context[prev] + (1 - self.lam) * self.unigram(role, word)

    def distribution(self, role, prev):
        weights = {w: self.raw(role, prev, w) ** (1 / self.t) for w in self.vocabulary}
        whole = sum(weights.values())
        return {w: x / whole for w, x in weights.items()}

    def known(self, word):
        return word if word in self.vocabulary else UNK

    def nll(self, prev, word):
        return -math.log(self.distribution("q", prev)[self.known(word)])

    def h(self, prev):
        p, q = self.distribution("p", prev), self.distribution("q", prev)
        return -sum(p[w] * math.log(q[w]) for w in self.vocabulary)

    def score(self, tokens):
        nlls = [self.nll(a, b) for a, b in zip(tokens, tokens[1:])]
        ppl = sum(nlls) / len(nlls) if nlls else math.nan
        return ppl / (sum(map(self.h, tokens)) / len(tokens))
