"""A bidirectional gated recurrent network over bytes, trained by backpropagation through time; numpy only.

Both directions read a window of bytes from a zero state. A linear layer over the two states at a position gives that
position's label probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DIRECTIONS = ("f", "b")


@dataclass
class Network:
    """Parameters: for each direction, byte inputs X [256, 3h], recurrence U [h, 3h]; output W [2h, labels], bias."""

    parameters: dict[str, np.ndarray]

    @property
    def hidden(self) -> int:
        return self.parameters["Uf"].shape[0]

    @classmethod
    def random(cls, hidden: int, labels: int, seed: int) -> Network:
        rng, p = np.random.default_rng(seed), {}
        for d in DIRECTIONS:
            p[f"X{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
            p[f"U{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        p["W"], p["bias"] = rng.normal(0, 0.3, (2 * hidden, labels)), np.zeros(labels)
        return cls({k: v.astype(np.float32) for k, v in p.items()})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _forward(X: np.ndarray, U: np.ndarray, window: np.ndarray, live: np.ndarray | None, keep: bool):
    """States [time, lane, h] of one direction; the steps' gates too, if they are to be kept."""
    steps, lanes, h = len(window), window.shape[1], U.shape[0]
    states, state, gates = np.empty((steps, lanes, h), np.float32), np.zeros((lanes, h), np.float32), []
    for t in range(steps):
        x, a = X[window[t]], state @ U
        zr = _sigmoid(x[:, : 2 * h] + a[:, : 2 * h])
        z, r, c = zr[:, :h], zr[:, h:], a[:, 2 * h :]
        n = np.tanh(x[:, 2 * h :] + r * c)
        new = n + z * (state - n)
        if live is not None:
            new *= live[t][:, None]
        if keep:
            gates.append((z, r, n, c, state))
        states[t] = state = new
    return states, gates


def _backward(U: np.ndarray, window: np.ndarray, live: np.ndarray, gates, d_states: np.ndarray):
    """Gradients of X and U, through time."""
    h = U.shape[0]
    dX, dU, d_state = np.zeros((256, 3 * h), np.float32), np.zeros_like(U), np.zeros_like(d_states[0])
    for t in range(len(window) - 1, -1, -1):
        z, r, n, c, before = gates[t]
        d = (d_state + d_states[t]) * live[t][:, None]
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (before - n) * z * (1 - z)
        dr = dn * c * r * (1 - r)
        into = np.concatenate([dz, dr, dn], axis=1)
        np.add.at(dX, window[t], into)
        through = np.concatenate([dz, dr, dn * r], axis=1)
        dU += before.T @ through
        d_state = d * z + through @ U.T
    return dX, dU


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def probabilities(net: Network, window: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
    """[time, lane, label] of bytes [time, lane]; ``live`` is 0 at padding, which both directions pass with a zero state."""
    p = net.parameters
    forth, _ = _forward(p["Xf"], p["Uf"], window, live, False)
    back, _ = _forward(p["Xb"], p["Ub"], window[::-1], None if live is None else live[::-1], False)
    h = net.hidden
    return _softmax(forth @ p["W"][:h] + back[::-1] @ p["W"][h:] + p["bias"])


def gradients(net: Network, window: np.ndarray, live: np.ndarray, label: np.ndarray):
    """Mean cross entropy over all live positions, and its gradients."""
    p, h = net.parameters, net.hidden
    forth, gates_f = _forward(p["Xf"], p["Uf"], window, live, True)
    back, gates_b = _forward(p["Xb"], p["Ub"], window[::-1], live[::-1], True)
    both = np.concatenate([forth, back[::-1]], axis=2)
    probability = _softmax(both @ p["W"] + p["bias"])
    share = live / live.sum()
    lanes = np.arange(window.shape[1])
    loss = -(np.log(np.maximum(probability[:, lanes, label], 1e-30)) * share).sum()
    d_logits = probability
    d_logits[:, lanes, label] -= 1
    d_logits *= share[:, :, None]
    flat = d_logits.reshape(-1, d_logits.shape[2])
    d_both = d_logits @ p["W"].T
    grads = {"W": both.reshape(-1, 2 * h).T @ flat, "bias": flat.sum(axis=0)}
    grads["Xf"], grads["Uf"] = _backward(p["Uf"], window, live, gates_f, d_both[:, :, :h])
    grads["Xb"], grads["Ub"] = _backward(p["Ub"], window[::-1], live[::-1], gates_b, d_both[::-1, :, h:])
    return loss, grads


def train(windows: list[bytes], labels: np.ndarray, n_labels: int, hidden: int, rounds: int, lanes: int, rate: float, seed: int) -> Network:
    """Adam over random batches of windows; the same network for the same input."""
    net, rng = Network.random(hidden, n_labels, seed), np.random.default_rng(seed)
    window, live = padded(windows)
    first = {k: np.zeros_like(v) for k, v in net.parameters.items()}
    second = {k: np.zeros_like(v) for k, v in net.parameters.items()}
    for step in range(1, rounds + 1):
        pick = rng.integers(0, len(windows), lanes)
        _, grads = gradients(net, window[:, pick], live[:, pick], labels[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        pace = rate * (1 - step / (rounds + 1)) + rate * 0.02
        for k, g in grads.items():
            g = g / max(1.0, norm)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.parameters[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def padded(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes [time, lane] and 1 where there is one."""
    steps = max(map(len, windows), default=0)
    data = np.frombuffer(b"".join(w.ljust(steps, b"\0") for w in windows), np.uint8).reshape(len(windows), steps)
    live = np.arange(steps)[:, None] < np.array([len(w) for w in windows])[None, :]
    return np.ascontiguousarray(data.T), live.astype(np.float32)
