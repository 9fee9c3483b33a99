"""A bidirectional gated recurrent network with attention pooling, in numpy: forward, backward, Adam."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def initial(words: int, grams: int, size: int, hidden: int, rng: np.random.Generator) -> Params:
    """Parameters for vocabularies of so many words and character n-grams; the last row of either stands for none."""
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    out = {
        "word": (rng.standard_normal((words + 1, size)) * 0.1).astype(np.float32),
        "gram": (rng.standard_normal((grams + 1, size)) * 0.1).astype(np.float32),
        "attend": draw(2 * hidden, 2 * hidden), "query": draw(2 * hidden, 1)[:, 0],
        "out": draw(2 * hidden, 1)[:, 0], "bias": np.zeros(1, np.float32),
    }
    for way in ("forth", "back"):
        out[f"{way}_in"] = draw(2 * size, 3 * hidden)
        out[f"{way}_state"] = draw(hidden, 3 * hidden)
        out[f"{way}_bias"] = np.zeros(3 * hidden, np.float32)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run(inputs, mask: np.ndarray, state: np.ndarray, reverse: bool, keep: list | None = None) -> np.ndarray:
    """States (time, batch, hidden) of one direction. `inputs(t)` gives the projected inputs of a step, `mask` (time,
    batch) is 0 past the end of a sequence, where the state stays as it is; `keep` collects what the way back needs."""
    steps, batch = mask.shape
    hidden = state.shape[0]
    h = np.zeros((batch, hidden), np.float32)
    out = np.empty((steps, batch, hidden), np.float32)
    for t in range(steps)[:: -1 if reverse else 1]:
        x, u = inputs(t), h @ state
        gates = sigmoid(x[:, : 2 * hidden] + u[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        new = np.tanh(x[:, 2 * hidden :] + r * u[:, 2 * hidden :])
        m = mask[t][:, None]
        step = m * (1 - z)
        after = h + step * (new - h)
        if keep is not None:
            keep.append((t, h, z, r, new, u[:, 2 * hidden :], m))
        h = out[t] = after
    return out


def pool(p: Params, states: np.ndarray, mask: np.ndarray):
    """Logit of each sequence: its states weighed by attention."""
    seen = np.tanh(states @ p["attend"])
    weight = seen @ p["query"] + (mask - 1) * 1e4
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * states).sum(axis=0)
    return pooled @ p["out"] + p["bias"][0], seen, weight, pooled


def project(p: Params, x: np.ndarray) -> dict[str, np.ndarray]:
    return {way: x @ p[f"{way}_in"] + p[f"{way}_bias"] for way in ("forth", "back")}


def logits(p: Params, projected: dict[str, np.ndarray], index: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows given as (time, batch) indices into the projected inputs of distinct words."""
    states = np.concatenate(
        [run(lambda t, way=way: projected[way][index[t]], mask, p[f"{way}_state"], way == "back") for way in ("forth", "back")], axis=2
    )
    return pool(p, states, mask)[0]


def gradients(p: Params, x: np.ndarray, index: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, Params, np.ndarray]:
    """Mean cross entropy, gradients of the parameters above the inputs, and of the inputs x (a row per distinct word)."""
    projected, kept = project(p, x), {"forth": [], "back": []}
    states = np.concatenate(
        [run(lambda t, way=way: projected[way][index[t]], mask, p[f"{way}_state"], way == "back", kept[way]) for way in ("forth", "back")], axis=2
    )
    logit, seen, weight, pooled = pool(p, states, mask)
    chance = sigmoid(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
    d = ((chance - label) / len(label)).astype(np.float32)
    g: Params = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
    d_pooled = d[:, None] * p["out"]
    d_states = weight[:, :, None] * d_pooled
    d_weight = (states * d_pooled).sum(axis=2)
    d_weight = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_seen = d_weight[:, :, None] * p["query"] * (1 - seen * seen)
    g["query"] = np.einsum("tbh,tb->h", seen, d_weight)
    flat = states.reshape(-1, states.shape[2])
    g["attend"] = flat.T @ d_seen.reshape(flat.shape)
    d_states += d_seen @ p["attend"].T
    d_x = np.zeros_like(x)
    hidden = p["forth_state"].shape[0]
    for i, way in enumerate(("forth", "back")):
        state, d_proj = p[f"{way}_state"], np.zeros_like(projected[way])
        g[f"{way}_state"] = np.zeros_like(state)
        d_h = np.zeros((mask.shape[1], hidden), np.float32)
        for t, h, z, r, new, u, m in reversed(kept[way]):
            d_h = d_h + d_states[t, :, i * hidden : (i + 1) * hidden]
            d_step = d_h * m
            d_new = d_step * (1 - z) * (1 - new * new)
            d_z = d_step * (h - new) * z * (1 - z)
            d_r = d_new * u * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            np.add.at(d_proj, index[t], np.concatenate([d_z, d_r, d_new], axis=1))
            g[f"{way}_state"] += h.T @ d_u
            d_h = d_h * (1 - m * (1 - z)) + d_u @ state.T
        g[f"{way}_in"], g[f"{way}_bias"] = x.T @ d_proj, d_proj.sum(axis=0)
        d_x += d_proj @ p[f"{way}_in"].T
    return loss, g, d_x


class Adam:
    def __init__(self, p: Params, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: Params, rows: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        """Follow the gradients of whole parameters, and of some rows of others."""
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, (at, d) in [*((k, (slice(None), d)) for k, d in g.items()), *rows.items()]:
            self.m[k][at] += 0.1 * (d - self.m[k][at])
            self.v[k][at] += 0.001 * (d * d - self.v[k][at])
            self.p[k][at] -= scale * self.m[k][at] / (np.sqrt(self.v[k][at]) + 1e-8)
