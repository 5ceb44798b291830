"""A small character convolutional network in numpy: embedding, convolution, maximum over places, hidden layer, calibrated logit."""

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

WIDTH = 5
EMBEDDING = 12
FILTERS = 32
HIDDEN = 16
EPOCHS = 12
BATCH = 64
RATE = 0.004
#: places that share one maximum: what is seen left of, inside and right of the candidate stays apart
Parts = tuple[tuple[int, int], ...]


@dataclass
class CharNet:
    """``codes``: an array (window, place) of small numbers; ``parts``: the ranges of places pooled apart."""

    alphabet: int
    parts: Parts
    seed: int = 0
    slope: float = 1.0  # of the calibration
    shift: float = 0.0
    threshold: float = 0.5
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        pooled = FILTERS * len(self.parts)
        self.weights = {
            "embed": rng.normal(0, 0.3, (self.alphabet, EMBEDDING)),
            "conv": rng.normal(0, (2 / (WIDTH * EMBEDDING)) ** 0.5, (WIDTH * EMBEDDING, FILTERS)), "conv_bias": np.zeros(FILTERS),
            "hidden": rng.normal(0, (2 / pooled) ** 0.5, (pooled, HIDDEN)), "hidden_bias": np.zeros(HIDDEN),
            "out": rng.normal(0, 0.3, HIDDEN), "out_bias": np.zeros(1)}

    def _forward(self, codes: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.weights, len(codes)
        around = codes[:, np.arange(codes.shape[1] - WIDTH + 1)[:, None] + np.arange(WIDTH)]
        seen = w["embed"][around].reshape(n, around.shape[1], -1)
        felt = seen @ w["conv"] + w["conv_bias"]
        places = [start + felt[:, start:end].argmax(1) for start, end in self.parts]
        best = np.concatenate([np.take_along_axis(felt, p[:, None], 1)[:, 0] for p in places], 1)
        pooled = np.maximum(best, 0)
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
        return {"around": around, "seen": seen, "places": places, "pooled": pooled, "hidden": hidden, "logit": hidden @ w["out"] + w["out_bias"][0]}

    def _gradients(self, codes: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean of the logistic loss."""
        w, f, n = self.weights, self._forward(codes), len(codes)
        back = (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - truth) * weight / weight.sum()
        g = {"out": f["hidden"].T @ back, "out_bias": np.array([back.sum()])}
        hidden = np.outer(back, w["out"]) * (f["hidden"] > 0)
        g["hidden"], g["hidden_bias"] = f["pooled"].T @ hidden, hidden.sum(0)
        pooled = (hidden @ w["hidden"].T) * (f["pooled"] > 0)
        g["conv"], g["conv_bias"], g["embed"] = np.zeros_like(w["conv"]), pooled.reshape(n, -1, FILTERS).sum((0, 1)), np.zeros_like(w["embed"])
        rows = np.arange(n)[:, None]
        for i, place in enumerate(f["places"]):
            own = pooled[:, i * FILTERS:(i + 1) * FILTERS]
            seen = f["seen"][rows, place]  # (window, filter, what the filter saw)
            g["conv"] += np.einsum("nfe,nf->ef", seen, own)
            to_seen = (own[:, :, None] * w["conv"].T).reshape(-1, EMBEDDING)
            np.add.at(g["embed"], f["around"][rows, place].ravel(), to_seen)
        return g

    def moments(self) -> dict[str, dict[str, np.ndarray]]:
        """Adam's means of the gradients and of their squares, before the first step."""
        return {m: {k: np.zeros_like(v) for k, v in self.weights.items()} for m in ("mean", "square")}

    def fit_once(self, codes: np.ndarray, truth: np.ndarray, weight: np.ndarray, moments: dict, step: float, rng: np.random.Generator) -> float:
        """One pass of Adam over shuffled batches from the weights, moments and step given; returns the last step. ``weight`` is one on average."""
        order, mean, square = rng.permutation(len(codes)), moments["mean"], moments["square"]
        for at in range(0, len(order), BATCH):
            rows, step = order[at:at + BATCH], step + 1
            whole = weight[rows].sum() / len(rows)  # a batch counts by its weights
            for k, g in self._gradients(codes[rows], truth[rows], weight[rows]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * whole * g
                square[k] = 0.999 * square[k] + 0.001 * (whole * g) ** 2
                self.weights[k] = self.weights[k] - RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        return step

    def fit(self, codes: np.ndarray, truth: np.ndarray, weight: np.ndarray | None = None, epochs: int = EPOCHS) -> "CharNet":
        """Passes over the same windows; the order depends on the seed alone."""
        rng, moments, step = np.random.default_rng(self.seed + 1), self.moments(), 0.0
        weight = np.ones(len(codes)) if weight is None else weight / weight.mean()
        for _ in range(epochs):
            step = self.fit_once(codes, truth, weight, moments, step, rng)
        return self

    def packed(self, moments: dict, step: float) -> np.ndarray:
        """Weights, moments and step as one vector, of which means can be taken."""
        return np.concatenate([*(v.ravel() for own in (self.weights, *moments.values()) for v in own.values()), [step]])

    def unpack(self, vector: np.ndarray) -> tuple[dict, float]:
        """Takes the weights; moments and step."""
        moments, at = self.moments(), 0
        for own in (self.weights, *moments.values()):
            for k, v in own.items():
                own[k], at = vector[at:at + v.size].reshape(v.shape).copy(), at + v.size
        return moments, float(vector[at])

    def calibrate(self, codes: np.ndarray, truth: np.ndarray, recall: float) -> "CharNet":
        """Slope and shift of the logit by Newton steps on held-out windows; then the highest threshold, up to one half, that keeps ``recall`` of the true ones."""
        logit, truth = self.logits(codes), truth.astype(float)
        if len(np.unique(truth)) < 2:
            return self

        def sums(slope, shift, high, low):
            p = 1 / (1 + np.exp(-np.clip(slope * logit + shift, -30, 30)))
            curve, off = p * (1 - p), p - np.where(truth == 1, high, low)
            return (curve * logit * logit).sum(), (curve * logit).sum(), curve.sum(), (off * logit).sum(), off.sum()

        self.set_line(sums, int(truth.sum()), int((1 - truth).sum()))
        return self.set_threshold(float(np.sort(logit[truth == 1])[int(np.floor((1 - recall) * truth.sum()))]))

    def set_line(self, sums: Callable[[float, float, float, float], tuple], true: int, false: int) -> None:
        """Newton steps; ``sums(slope, shift, target of true, target of false)``: of p(1-p) times logit squared, logit and 1, and of p less target times logit and 1."""
        line = np.array([1.0, 0.0])
        for _ in range(50):
            xx, x, one, to_slope, to_shift = sums(*line.tolist(), (true + 1) / (true + 2), 1 / (false + 2))
            move = np.linalg.solve(np.array([[xx, x], [x, one]]) + 1e-3 * np.eye(2), np.array([to_slope, to_shift]) + 1e-3 * (line - [1.0, 0.0]))
            line = line - move * min(1.0, 2 / max(np.abs(move).max(), 1e-12))
            if np.abs(move).max() < 1e-9:
                break
        self.slope, self.shift = max(float(line[0]), 1e-3), float(line[1])

    def set_threshold(self, logit: float) -> "CharNet":
        """The lowest logit that is kept; one half at most."""
        self.threshold = float(min(0.5, self._chance(np.array([logit]))[0]))
        return self

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self._forward(codes[at:at + 512])["logit"] for at in range(0, len(codes), 512))])

    def _chance(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))

    def score(self, codes: np.ndarray) -> np.ndarray:
        return self._chance(self.logits(codes))
