"""A linear-chain conditional random field with two tags, in arrays: marginals and training.

The chain of a document starts as if an untagged token came before it. Forward and backward messages run over all
documents at once: chains are cut into blocks, each block's transfer matrix is the product of its tokens' matrices, blocks
are linked in order within a document, and messages inside blocks follow. The result is that of the plain recursion.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Layout:
    """Tokens of many documents in rows of BLOCK; `rows[t]`, `columns[t]` is token t's place."""

    def __init__(self, first: np.ndarray):
        sizes = np.diff(first)
        self.blocks = -(-sizes // BLOCK)
        self.head = np.cumsum(self.blocks) - self.blocks
        document = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(int(sizes.sum())) - np.repeat(first[:-1] - first[0], sizes)
        self.rows, self.columns = self.head[document] + place // BLOCK, place % BLOCK
        self.count = int(self.blocks.sum())

    def spread(self, values: np.ndarray, fill: float) -> np.ndarray:
        out = np.full((BLOCK, self.count), fill)
        out[self.columns, self.rows] = values
        return out


def messages(emission: np.ndarray, first: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Layout]:
    """Forward messages before each token, backward ones after it (both scaled, shape (2, tokens)), and odds exp(emission)."""
    plan, x = Layout(first), np.exp(np.clip(emission, -30, 30))
    (a00, a01), (a10, a11) = np.exp(transition)
    odds, real = plan.spread(x, 1.0), plan.spread(np.ones(len(x), bool), 0.0).astype(bool)
    m00, m10 = np.where(real, a00, 1.0), np.where(real, a10, 0.0)
    m01, m11 = np.where(real, a01 * odds, 0.0), np.where(real, a11 * odds, 1.0)
    p00, p01, p10, p11 = (np.full(plan.count, v) for v in (1.0, 0.0, 0.0, 1.0))
    for k in range(BLOCK):
        p00, p01 = p00 * m00[k] + p01 * m10[k], p00 * m01[k] + p01 * m11[k]
        p10, p11 = p10 * m00[k] + p11 * m10[k], p10 * m01[k] + p11 * m11[k]
        scale = p00 + p01 + p10 + p11
        p00, p01, p10, p11 = p00 / scale, p01 / scale, p10 / scale, p11 / scale
    f0, f1 = np.ones(plan.count), np.zeros(plan.count)
    b0, b1 = np.ones(plan.count), np.ones(plan.count)
    order = np.argsort(-plan.blocks, kind="stable")
    sizes = plan.blocks[order]
    for j in range(1, int(sizes[0]) if len(sizes) else 0):
        live = plan.head[order[: np.searchsorted(-sizes, -j)]] + j
        u0 = f0[live - 1] * p00[live - 1] + f1[live - 1] * p10[live - 1]
        u1 = f0[live - 1] * p01[live - 1] + f1[live - 1] * p11[live - 1]
        f0[live], f1[live] = u0 / (u0 + u1), u1 / (u0 + u1)
    for j in range(int(sizes[0]) - 1 if len(sizes) else 0, 0, -1):
        live = plan.head[order[: np.searchsorted(-sizes, -j)]] + j
        u0 = p00[live] * b0[live] + p01[live] * b1[live]
        u1 = p10[live] * b0[live] + p11[live] * b1[live]
        b0[live - 1], b1[live - 1] = u0 / (u0 + u1), u1 / (u0 + u1)
    before, after = np.empty((2, BLOCK, plan.count)), np.empty((2, BLOCK, plan.count))
    for k in range(BLOCK):
        before[0, k], before[1, k] = f0, f1
        f0, f1 = f0 * m00[k] + f1 * m10[k], f0 * m01[k] + f1 * m11[k]
        f0, f1 = f0 / (f0 + f1), f1 / (f0 + f1)
    for k in range(BLOCK - 1, -1, -1):
        after[0, k], after[1, k] = b0, b1
        b0, b1 = m00[k] * b0 + m01[k] * b1, m10[k] * b0 + m11[k] * b1
        b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
    at = (slice(None), plan.columns, plan.rows)
    return before[at], after[at], x, plan


def pair_marginals(emission: np.ndarray, first: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """For each token, the probabilities of (tag before, tag), shape (2, 2, tokens)."""
    before, after, x, _ = messages(emission, first, transition)
    weight = np.exp(transition)
    joint = before[:, None] * weight[:, :, None] * np.stack([after[0], x * after[1]])[None]
    return joint / joint.sum((0, 1))


def marginals(emission: np.ndarray, first: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The probability of the tag for each token."""
    return pair_marginals(emission, first, transition)[:, 1].sum(0) if len(emission) else np.zeros(0)


def train(
    features: np.ndarray, tags: np.ndarray, first: np.ndarray, n_features: int, rounds: int = 40, rate: float = 0.4, ridge: float = 1e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features and of transitions, by Adam on the exact log-likelihood.

    `features` holds several feature numbers for each token, shape (kinds, tokens); all are summed.
    """
    weights, transition = np.zeros(n_features), np.array([[0.0, -2.0], [0.0, -2.0]])
    state = [np.zeros(n_features + 4) for _ in range(2)]
    same = np.diff(first) > 0
    starts = first[:-1][same] - first[0]
    previous = np.concatenate([[0], tags[:-1]]) if len(tags) else tags
    previous[starts] = 0
    seen = np.zeros((2, 2))
    np.add.at(seen, (previous, tags), 1)
    scale = max(1.0, tags.sum())
    observed = sum(np.bincount(f, tags, n_features) for f in features)
    for step in range(1, rounds + 1):
        joint = pair_marginals(weights[features].sum(0), first, transition)
        p = joint[:, 1].sum(0)
        gradient = observed - sum(np.bincount(f, p, n_features) for f in features)
        gradient = np.concatenate([gradient, (seen - joint.sum(2)).ravel()]) / scale
        gradient -= ridge * np.concatenate([weights, transition.ravel()])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights, transition = weights + move[:-4], transition + move[-4:].reshape(2, 2)
    return weights, transition
