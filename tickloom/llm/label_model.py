"""A generative model of voters that do not know the truth.

Each voter fires or not; what is known of all documents is how often each pattern of votes occurs. Voters that move
together beyond what the class explains form cliques, which are described by a joint table; cliques are independent
given the class. Expectation maximisation estimates the tables and the share of the class; patterns of rows whose class is known
are held to it.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

ROUNDS = 60
SMOOTHING = 1.0
LINKED = 0.15           # correlation given the class from which on voters are joined
CLIQUE = 4              # voters in one joint table, the strongest links first


class LabelModel(NamedTuple):
    share: float                    # of the class
    cliques: list[list[int]]
    tables: list[np.ndarray]        # per clique: log P(pattern | class), 2 x 2^voters
    accuracy: np.ndarray            # per voter: P(it is right), both classes alike in weight

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(class) for rows of votes packed into a number, voter k in bit k."""
        score = np.full(len(votes), np.log(self.share) - np.log(1 - self.share))
        for clique, table in zip(self.cliques, self.tables):
            pattern = patterns(votes, clique)
            score += table[1, pattern] - table[0, pattern]
        return 1 / (1 + np.exp(-score.clip(-500, 500)))


def patterns(votes: np.ndarray, clique: list[int]) -> np.ndarray:
    """The votes of a clique as a number of as many bits."""
    return sum(((votes >> voter) & 1) << k for k, voter in enumerate(clique))


def _tables(votes: np.ndarray, weight: np.ndarray, p: np.ndarray, cliques: list[list[int]]) -> list[np.ndarray]:
    out = []
    for clique in cliques:
        size = 1 << len(clique)
        counts = np.stack([np.bincount(patterns(votes, clique), weight * q, size) for q in (1 - p, p)]) + SMOOTHING / size
        out.append(np.log(counts / counts.sum(axis=1, keepdims=True)))
    return out


def linked_cliques(votes: np.ndarray, weight: np.ndarray, p: np.ndarray, voters: int) -> list[list[int]]:
    """Groups of voters that are correlated given the class, the most strongly linked joined first."""
    fired = ((votes[:, None] >> np.arange(voters)) & 1).astype(float)
    joint = np.zeros((voters, voters))
    for q in (p, 1 - p):
        w = weight * q
        total = max(w.sum(), 1e-12)
        off = fired - w @ fired / total
        cov = (off * w[:, None]).T @ off / total
        size = np.sqrt(np.diagonal(cov).clip(1e-9))
        joint = np.maximum(joint, np.abs(cov / np.outer(size, size)))
    group = {k: [k] for k in range(voters)}
    for strength, a, b in sorted(((joint[a, b], a, b) for a in range(voters) for b in range(a)), reverse=True):
        one, two = group[a], group[b]
        if strength < LINKED:
            break
        if one is not two and len(one) + len(two) <= CLIQUE:
            for k in two:
                group[k] = one
            one.extend(two)
    return [sorted(g) for g in {id(g): g for g in group.values()}.values()]


def fit_labels(votes: np.ndarray, count: np.ndarray, known: np.ndarray, voters: int, start: np.ndarray | None = None) -> LabelModel:
    """The model of patterns that occur `count` times; `known` is the class of their rows, or nan. First guesses of P(class) per pattern
    are `start`, or come from the known rows, or, without both classes among these, from the number of votes. Cliques are looked
    for from the beginning where a guess has a base, else when the estimates have settled."""
    weight, held = count.astype(float), ~np.isnan(known)
    cliques = [[k] for k in range(voters)]
    based = start is not None or {0.0, 1.0} <= set(known[held])
    if start is not None:
        p = np.asarray(start, float)
    elif based:
        p = LabelModel(0.5, cliques, _tables(votes, weight * held, np.nan_to_num(known), cliques), np.zeros(0)).posterior(votes)
    else:
        fired = ((votes[:, None] >> np.arange(voters)) & 1).sum(axis=1)
        p = (fired > max(1, (fired * weight).sum() / max(weight.sum(), 1))) * 0.8 + 0.1
    p = np.where(held, np.nan_to_num(known), p)
    unheld = ~held if not held.all() else held              # known rows may be drawn by class, so they say nothing of its share
    for turn in range(ROUNDS):
        if turn % 10 == 0 and (based or turn >= ROUNDS // 2):
            cliques = linked_cliques(votes, weight, p, voters)
        share = float((weight[unheld] @ p[unheld] + SMOOTHING / 2) / (weight[unheld].sum() + SMOOTHING))
        model = LabelModel(min(max(share, 1e-6), 1 - 1e-6), cliques, _tables(votes, weight, p, cliques), np.zeros(0))
        p = np.where(held, np.nan_to_num(known), model.posterior(votes))
    single = _tables(votes, weight, p, [[k] for k in range(voters)])
    return model._replace(accuracy=np.array([(np.exp(t[1, 1]) + np.exp(t[0, 0])) / 2 for t in single]))
