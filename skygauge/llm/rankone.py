"""Eigenvalues and eigenvectors of a symmetric matrix kept up to date under added rank-one terms."""

import numpy as np

EPS = np.finfo(float).eps
ROUNDS = 60


def secular(poles: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum weight / (poles - x), one above each pole: (roots, matrix of poles[j] - root[i]).

    ``poles`` rise strictly and every weight is positive. A root is found as the distance to its nearer pole, so the differences
    keep their relative accuracy. Steps fit the function by the two poles around the root; where one leaves the bracket, it is halved.
    """
    k = len(poles)
    after = np.append(poles[1:], poles[-1] + weight.sum())
    gap = after - poles
    middle = poles + gap / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        right = (1 + (weight / (poles - middle[:, None])).sum(1) < 0) & (np.arange(k) < k - 1)
    origin = np.where(right, after, poles)
    delta = poles - origin[:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(np.arange(k) < k - 1, gap / 2, gap))
    at = (low + high) / 2
    to_left, to_right = poles - origin, after - origin
    left_side = np.tri(k, dtype=bool)
    inner = np.arange(k) < k - 1
    for _ in range(ROUNDS):
        apart = delta - at[:, None]
        with np.errstate(all="ignore"):
            terms = weight / apart
            f = 1 + terms.sum(1)
            slopes = terms / apart
            psi, phi = (slopes * left_side).sum(1), (slopes * ~left_side).sum(1)
            a, b = to_left - at, to_right - at
            c = f - a * psi - np.where(inner, b * phi, 0)
            half = (a + b) * f - a * b * (psi + phi)
            product = a * b * f
            root = np.sqrt(np.maximum(half * half - 4 * product * c, 0))
            step = np.where(half <= 0, (half - root) / (2 * c), 2 * product / (half + root))
            step = np.where(inner, step, a + psi * a * a / c)
        low, high = np.where(f < 0, at, low), np.where(f < 0, high, at)
        done = (np.abs(f) <= 4 * EPS * k * (1 + np.abs(terms).sum(1))) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        new = at + step
        new = np.where((new > low) & (new < high), new, (low + high) / 2)  # also where the step is no number
        at = np.where(done, at, new)
        if done.all():
            break
    return origin + at, delta - at[:, None]


class Spectrum:
    """Count, mean and scatter of rows; the scatter as eigenvalues (rising) and eigenvectors (columns)."""

    def __init__(self, count: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.count, self.mean, self.values, self.vectors = count, mean, values, vectors

    @classmethod
    def empty(cls, d: int) -> "Spectrum":
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def add_row(self, row: np.ndarray) -> None:
        """A centred rank-one update: the scatter grows by n / (n + 1) times the deviation's square."""
        deviation = row - self.mean
        if self.count:
            self._grow(np.sqrt(self.count / (self.count + 1)) * deviation)
        self.count += 1
        self.mean = self.mean + deviation / self.count

    def add_block(self, rows: np.ndarray) -> None:
        """The rows at once: orthogonal reflections leave as many rows as there are dimensions, with the same scatter; each is one update."""
        if len(rows) <= rows.shape[1]:
            for row in rows:
                self.add_row(row)
            return
        mean = rows.mean(0)
        self._join(len(rows), mean, np.linalg.qr(rows - mean, mode="r"))

    def add(self, other: "Spectrum") -> None:
        """Successive rank-one updates with the other's scaled eigenvectors, then with the difference of the means."""
        if other.count:
            self._join(other.count, other.mean, (other.vectors * np.sqrt(np.maximum(other.values, 0))).T)

    def _join(self, count: int, mean: np.ndarray, updates: np.ndarray) -> None:
        for update in updates:
            self._grow(update)
        total = self.count + count
        if self.count:
            self._grow(np.sqrt(self.count * count / total) * (mean - self.mean))
        self.mean = self.mean + (mean - self.mean) * (count / total)
        self.count = total

    def _grow(self, v: np.ndarray) -> None:
        """scatter + v v', by the secular equation of what deflation leaves."""
        values, vectors = self.values, self.vectors
        z = vectors.T @ v
        size = float(z @ z)
        if size == 0:
            return
        tolerance = 8 * EPS * max(abs(values[-1]), abs(values[0]), size)
        # equal eigenvalues: a reflection inside their space leaves one entry of z
        starts = np.flatnonzero(np.append(True, np.diff(values) > tolerance))
        ends = np.append(starts[1:], len(values))
        for s, e in zip(starts, ends):
            if e - s > 1:
                part = z[s:e].copy()
                length = np.linalg.norm(part)
                if length == 0:
                    continue
                mirror = part.copy()
                mirror[-1] += np.copysign(length, part[-1])
                mirror /= np.linalg.norm(mirror)
                vectors[:, s:e] -= 2 * np.outer(vectors[:, s:e] @ mirror, mirror)
                z[s:e] = 0
                z[e - 1] = -np.copysign(length, part[-1])
        moving = np.flatnonzero(np.abs(z) * np.sqrt(size) > tolerance)
        if not len(moving):
            return
        poles, weight = values[moving], z[moving] ** 2
        roots, apart = secular(poles, weight)
        # the vector for which the roots are exact: keeps the new eigenvectors orthogonal
        between = poles[:, None] - poles
        np.fill_diagonal(between, 1.0)
        exact = np.sqrt(np.abs(np.prod(-apart / between, axis=0))) * np.sign(z[moving])
        turn = exact / apart
        turn /= np.linalg.norm(turn, axis=1)[:, None]
        vectors[:, moving] = vectors[:, moving] @ turn.T
        values[moving] = roots
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.count], self.mean, self.values, self.vectors.ravel()]).astype(np.float64).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Spectrum":
        flat = np.frombuffer(data, np.float64)
        d = int((len(flat) + 0.25) ** 0.5) - 1  # 1 + 2 d + d * d numbers
        return cls(int(flat[0]), flat[1:1 + d].copy(), flat[1 + d:1 + 2 * d].copy(), flat[1 + 2 * d:].reshape(d, d).copy())
