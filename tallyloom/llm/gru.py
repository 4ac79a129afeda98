"""A bidirectional gated recurrent network over bytes, trained by backpropagation through time."""

from __future__ import annotations

import numpy as np

F32 = np.float32


class ByteGru:
    """Labels every byte. Features come first in all arrays: states are (hidden, windows), so gates are whole slices.

    Gates are piecewise linear, clip(x + 1/2, 0, 1), the candidate is x / (1 + |x|): no exponentials in the loop.
    """

    def __init__(self, labels: int, hidden: int = 8, seed: int = 0) -> None:
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(F32)
        self.hidden, self.labels = hidden, labels
        self.params = {"out": draw(labels, 2 * hidden, scale=0.3), "bias": np.zeros((labels, 1), F32)}
        for way in ("ahead", "back"):
            self.params[f"in_{way}"] = draw(3 * hidden, 256, scale=0.3)
            self.params[f"state_{way}"] = draw(3 * hidden, hidden, scale=0.3)

    def _scan(self, x: np.ndarray, way: str, keep: dict | None = None) -> np.ndarray:
        """States (time, hidden, windows) of one direction; ``keep`` collects what the backward pass needs."""
        size, (steps, n) = self.hidden, x.shape
        into, state = self.params[f"in_{way}"].copy(), self.params[f"state_{way}"]
        into[: 2 * size] += F32(0.5)
        into[:size, 0] = F32(64)  # byte 0 pads short windows: the state passes through unchanged
        out = np.empty((steps, size, n), F32)
        gates, recur = np.empty((3 * size, n), F32), np.empty((3 * size, n), F32)
        h, scratch = np.zeros((size, n), F32), np.empty((size, n), F32)
        for t in range(steps) if way == "ahead" else range(steps - 1, -1, -1):
            np.take(into, x[t], axis=1, out=gates, mode="clip")
            np.matmul(state, h, out=recur)
            both = gates[: 2 * size]
            both += recur[: 2 * size]
            np.maximum(both, F32(0), out=both)
            np.minimum(both, F32(1), out=both)
            update, reset, new = gates[:size], gates[size : 2 * size], gates[2 * size :]
            np.multiply(reset, recur[2 * size :], out=scratch)
            new += scratch
            np.abs(new, out=scratch)
            scratch += F32(1)
            new /= scratch
            if keep is not None:
                keep[t] = (h, gates.copy(), recur[2 * size :].copy())
            np.subtract(h, new, out=scratch)
            scratch *= update
            np.add(new, scratch, out=out[t])
            h = out[t]
        return out

    def probabilities(self, x: np.ndarray, keep: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(time, labels, windows) probabilities of each byte's label, and the states they come from."""
        ahead = self._scan(x, "ahead", None if keep is None else keep.setdefault("ahead", {}))
        back = self._scan(x, "back", None if keep is None else keep.setdefault("back", {}))
        weights, size = self.params["out"], self.hidden
        scores = np.matmul(weights[:, :size], ahead)
        scores += np.matmul(weights[:, size:], back)
        scores += self.params["bias"]
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores, np.concatenate((ahead, back), axis=1) if keep is not None else ahead

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over the bytes in ``mask`` (time, windows) and its gradients; ``y`` has a label per window."""
        keep: dict = {}
        probs, states = self.probabilities(x, keep)
        total, size = max(1.0, float(mask.sum())), self.hidden
        at = np.arange(x.shape[1])
        loss = -(np.log(probs[:, y, at] + 1e-12) * mask).sum() / total
        wrong = probs.copy()
        wrong[:, y, at] -= 1
        wrong *= (mask / total)[:, None, :].astype(F32)
        grads = {"out": np.einsum("tln,thn->lh", wrong, states), "bias": wrong.sum(axis=(0, 2))[:, None]}
        into_states = np.matmul(self.params["out"].T, wrong)
        for k, way in enumerate(("ahead", "back")):
            state = self.params[f"state_{way}"]
            d_state, d_in = np.zeros_like(state), np.empty((x.shape[0], 3 * size, x.shape[1]), F32)
            carried = np.zeros((size, x.shape[1]), F32)
            for t in range(x.shape[0] - 1, -1, -1) if way == "ahead" else range(x.shape[0]):
                before, gates, recur = keep[way][t]
                update, reset, new = gates[:size], gates[size : 2 * size], gates[2 * size :]
                d_h = into_states[t, k * size : (k + 1) * size] + carried
                d_new = d_h * (1 - update) * (1 - np.abs(new)) ** 2
                d_gates = np.concatenate((d_h * (before - new), d_new * recur))
                d_gates *= (gates[: 2 * size] > 0) & (gates[: 2 * size] < 1)
                d_in[t, : 2 * size], d_in[t, 2 * size :] = d_gates, d_new
                d_recur = np.concatenate((d_gates, d_new * reset))
                d_state += d_recur @ before.T
                carried = d_h * update + state.T @ d_recur
            grads[f"state_{way}"] = d_state
            flat = x.ravel()
            grads[f"in_{way}"] = np.stack([np.bincount(flat, d_in[:, g].ravel(), 256) for g in range(3 * size)]).astype(F32)
        return float(loss), grads

    def fit(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, steps: int, batch: int = 128, rate: float = 0.02, seed: int = 0) -> list[float]:
        """Adam over random batches of windows (time, windows); each label is drawn equally often. Returns the losses."""
        rng = np.random.Generator(np.random.PCG64(seed))
        by_label = [np.flatnonzero(y == label) for label in range(self.labels)]
        first, second = ({k: np.zeros_like(v) for k, v in self.params.items()} for _ in range(2))
        losses = []
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(rows, max(1, batch // self.labels)) for rows in by_label if len(rows)])
            loss, grads = self.gradients(x[:, pick], y[pick], mask[:, pick])
            losses.append(loss)
            length = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            now = rate * min(1.0, 2.0 - 2.0 * step / (steps + 1)) * min(1.0, 5.0 / (length + 1e-9)) ** 0.5
            for k, g in grads.items():
                first[k] += F32(0.1) * (g - first[k])
                second[k] += F32(0.01) * (g * g - second[k])
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.params[k] = (self.params[k] - now * move).astype(F32)
        return losses
