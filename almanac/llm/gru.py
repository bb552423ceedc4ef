"""A bidirectional gated recurrent layer with attention pooling, in numpy, with its gradients."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class BiGru:
    """Sequences go first by step and last by row: inputs are (steps, features, rows), the mask
    (steps, rows). With rows last, each part of the gates is one block of memory.

    ``W`` and ``b`` project an input to the update gate, the reset gate and the candidate, ``U``
    the state; ``v`` scores the states of both directions for the pooling.
    """

    def __init__(self, features: int, hidden: int, rng: np.random.Generator):
        def start(rows: int, columns: int) -> np.ndarray:
            return (rng.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

        self.hidden = hidden
        self.params = {}
        for side in "fb":
            self.params |= {f"W{side}": start(features, 3 * hidden),
                            f"U{side}": start(hidden, 3 * hidden),
                            f"b{side}": np.zeros(3 * hidden, np.float32)}
        self.params["v"] = start(2 * hidden, 1)[:, 0]

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What inputs (.., features, rows) add to the gates; equal inputs can share it."""
        return {side: self.params[f"W{side}"].T @ x + self.params[f"b{side}"][:, None]
                for side in "fb"}

    def _run(self, side: str, steps, projected, mask: np.ndarray, states: np.ndarray,
             keep: list | None) -> None:
        hidden, u = self.hidden, np.ascontiguousarray(self.params[f"U{side}"].T)
        h = np.zeros((hidden, mask.shape[1]), states.dtype)
        for t in steps:
            gates, from_h = projected(side, t), u @ h
            both = sigmoid(gates[:2 * hidden] + from_h[:2 * hidden])
            z, r = both[:hidden], both[hidden:]
            n = np.tanh(gates[2 * hidden:] + r * from_h[2 * hidden:])
            if keep is not None:
                keep.append((t, h, z, r, n, from_h[2 * hidden:], mask[t]))
            h = h + mask[t] * ((1 - z) * (n - h))
            states[t] = h

    def forward(self, projected, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """The pooled states (2 * hidden, rows); rows without steps have zeros.

        ``projected(side, step)`` gives the projections of a step's inputs.
        """
        steps, hidden, v = range(len(mask)), self.hidden, self.params["v"]
        kept = {side: [] if keep is not None else None for side in "fb"}
        states = np.zeros((len(mask), 2 * hidden, mask.shape[1]), v.dtype)
        self._run("f", steps, projected, mask, states[:, :hidden], kept["f"])
        self._run("b", reversed(steps), projected, mask, states[:, hidden:], kept["b"])
        scores = np.where(mask > 0, v @ states, v.dtype.type(-1e9))
        weights = np.exp(scores - scores.max(axis=0, initial=-1e9)) * mask
        weights /= np.maximum(weights.sum(axis=0), v.dtype.type(1e-9))
        pooled = np.einsum("tr,thr->hr", weights, states)
        if keep is not None:
            keep |= {"states": states, "weights": weights, "pooled": pooled, "runs": kept}
        return pooled

    def backward(self, x: np.ndarray, keep: dict, slope: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters and of the inputs for the pooled states' gradient."""
        states, weights, hidden = keep["states"], keep["weights"], self.hidden
        inner = (states * slope).sum(axis=1)
        by_score = weights * (inner - (weights * inner).sum(axis=0))
        by_state = weights[:, None] * slope + by_score[:, None] * self.params["v"][:, None]
        grads = {"v": np.einsum("tr,thr->h", by_score, states)}
        by_x = np.zeros_like(x)
        for side, part in (("f", slice(0, hidden)), ("b", slice(hidden, None))):
            u, w = self.params[f"U{side}"], self.params[f"W{side}"]
            grad_u = np.zeros_like(u)
            by_gates = np.zeros((len(x), 3 * hidden, x.shape[2]), x.dtype)
            carried = np.zeros((hidden, x.shape[2]), x.dtype)
            for t, h, z, r, n, from_h, m in reversed(keep["runs"][side]):
                whole = by_state[t][part] + carried
                now = m * whole
                dz = now * (h - n) * z * (1 - z)
                dn = now * (1 - z) * (1 - n * n)
                dr = dn * from_h * r * (1 - r)
                by_gates[t] = np.concatenate([dz, dr, dn])
                by_h = np.concatenate([dz, dr, dn * r])
                grad_u += h @ by_h.T
                carried = (1 - m) * whole + now * z + u @ by_h
            grads |= {f"U{side}": grad_u, f"b{side}": by_gates.sum(axis=(0, 2)),
                      f"W{side}": (x @ by_gates.transpose(0, 2, 1)).sum(axis=0)}
            by_x += w @ by_gates
        return grads, by_x


class Adam:
    """Steps for a dictionary of parameters, changed in place; gradients are clipped."""

    def __init__(self, rate: float = 0.01):
        self.rate, self.step = rate, 0
        self.mean: dict[str, np.ndarray] = {}
        self.square: dict[str, np.ndarray] = {}

    def update(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for name, grad in grads.items():
            grad = grad / max(1.0, norm)
            mean = self.mean[name] = 0.9 * self.mean.get(name, 0.0) + 0.1 * grad
            square = self.square[name] = 0.99 * self.square.get(name, 0.0) + 0.01 * grad * grad
            rate = self.rate * np.sqrt(1 - 0.99 ** self.step) / (1 - 0.9 ** self.step)
            params[name] -= (rate * mean / (np.sqrt(square) + 1e-7)).astype(np.float32)
