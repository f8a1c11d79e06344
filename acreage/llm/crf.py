"""A linear-chain conditional random field with two labels, trained by gradient steps and decoded by Viterbi."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

Features = Sequence[str]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Chain:
    """Weights: ``emission[feature]`` is the gain of label 1 over 0; ``step[a][b]`` scores label b after label a."""

    emission: dict[str, float]
    start: tuple[float, float]
    step: tuple[tuple[float, float], tuple[float, float]]

    def gains(self, rows: Sequence[Features]) -> list[float]:
        weight = self.emission.get
        return [sum(weight(f, 0.0) for f in row) for row in rows]

    def decode(self, rows: Sequence[Features]) -> list[int]:
        """The labels of highest score together (Viterbi); a tie goes to label 0."""
        if not rows:
            return []
        gains, ((s00, s01), (s10, s11)) = self.gains(rows), self.step
        zero, one = self.start[0], self.start[1] + gains[0]
        back = []
        for g in gains[1:]:
            to0, to1 = (1 if one + s10 > zero + s00 else 0), (1 if one + s11 > zero + s01 else 0)
            back.append((to0, to1))
            zero, one = (one + s10 if to0 else zero + s00), (one + s11 if to1 else zero + s01) + g
        label = 1 if one > zero else 0
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]


def train(pages: Sequence[tuple[Sequence[Features], Sequence[int]]], rounds: int = 150, rate: float = 0.2, prior: float = 1e-3) -> Chain:
    """Maximum likelihood with a Gaussian prior. Expected counts come from forward and backward sums over all pages at once,
    padded to the longest; steps are scaled by the running size of each weight's gradient. Nothing in it is random."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for rows, _ in pages for row in rows for f in row})
    number = {f: i for i, f in enumerate(names)}
    size, longest = len(pages), max(len(rows) for rows, _ in pages)
    x = np.zeros((size, longest, len(names)), np.float32)
    y = np.zeros((size, longest), int)
    mask = np.zeros((size, longest), bool)
    for i, (rows, labels) in enumerate(pages):
        mask[i, : len(rows)], y[i, : len(rows)] = True, labels
        for j, row in enumerate(rows):
            x[i, j, [number[f] for f in row]] = 1
    pairs = mask[:, 1:]
    seen_step = np.zeros((2, 2))
    np.add.at(seen_step, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    seen_start = np.bincount(y[:, 0], minlength=2).astype(float)
    w, start, step = np.zeros(len(names)), np.zeros(2), np.zeros((2, 2))
    moments = [np.zeros(p.shape) for p in (w, start, step) for _ in range(2)]
    for turn in range(1, rounds + 1):
        gain = np.where(mask, x @ w, 0.0)
        emit = np.stack([np.zeros_like(gain), gain], axis=2)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = start + emit[:, 0]
        for t in range(1, longest):
            moved = _log_sum(ahead[:, t - 1, :, None] + step[None], axis=1) + emit[:, t]
            ahead[:, t] = np.where(mask[:, t, None], moved, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = _log_sum(step[None] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(mask[:, t + 1, None], moved, 0.0)
        total = _log_sum(ahead[:, -1], axis=1)
        node = np.exp(ahead + behind - total[:, None, None])
        edge = ahead[:, :-1, :, None] + step + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected_step = (np.exp(edge) * pairs[:, :, None, None]).sum((0, 1))
        grads = (
            np.einsum("itf,it->f", x, np.where(mask, y - node[:, :, 1], 0.0)) / size - prior * w,
            (seen_start - node[:, 0].sum(0)) / size - prior * start,
            (seen_step - expected_step) / size - prior * step,
        )
        for k, (value, g) in enumerate(zip((w, start, step), grads)):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            value += rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return Chain({f: float(w[i]) for f, i in number.items()}, tuple(start.tolist()), tuple(map(tuple, step.tolist())))
