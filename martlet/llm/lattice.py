"""The E8 lattice in numpy: nearest points, neighbours, cell keys."""

from __future__ import annotations

import itertools

import numpy as np

from martlet.llm.texts import mix


def shortest_vectors() -> np.ndarray:
    """The 240 vectors of E8 of squared length 2: the steps to the neighbouring cells."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((-1.0, 1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((-1.0, 1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


STEPS = shortest_vectors()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8: integers with an even sum."""
    r = np.rint(x)
    off = x - r
    odd = np.flatnonzero(r.sum(1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(1)
    r[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return r


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points (n, 8): the closer of D8 and D8 + 1/2."""
    a, b = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = np.square(x - a).sum(1) <= np.square(x - b).sum(1)
    return np.where(closer[:, None], a, b)


def cell_keys(points: np.ndarray, table: int, dims: int) -> np.ndarray:
    """A 64-bit key of each row of lattice points (n, 8 * blocks) in a table of vectors of a length."""
    twice = np.rint(2 * points).astype(np.int64).view(np.uint64)
    h = mix(np.full(len(points), np.uint64(dims))) + np.uint64(table + 1)
    for c in range(points.shape[1]):
        h = mix(h ^ mix(twice[:, c] + np.uint64(c + 1)))
    return h.view(np.int64)


class Tables:
    """Random projections to ``blocks`` E8 lattices in each of ``tables`` hash tables."""

    def __init__(self, dims: int, tables: int, blocks: int, scale: float, probes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.dims, self.blocks, self.probes, self.scale = dims, blocks, probes, scale
        self.projections, self.shifts = [], []
        for _ in range(tables):
            width = 8 * blocks
            g = rng.standard_normal((dims, max(width, dims)))
            # orthonormal columns where the space has room for them
            q = np.linalg.qr(g)[0][:, :width] if width <= dims else g[:, :width] / np.sqrt(dims)
            self.projections.append(q * np.sqrt(dims / 64.0))
            self.shifts.append(rng.uniform(0, 2, width))

    def keys(self, units: np.ndarray) -> np.ndarray:
        """(n, tables, 1 + probes): the own cell first, then the nearest neighbouring cells."""
        n = len(units)
        out = np.empty((n, len(self.projections), 1 + self.probes), np.int64)
        for t, (p, shift) in enumerate(zip(self.projections, self.shifts)):
            y = (units @ p) * self.scale + shift
            home = np.concatenate([nearest(y[:, 8 * b:8 * b + 8]) for b in range(self.blocks)], 1)
            out[:, t, 0] = cell_keys(home, t, self.dims)
            # gain of each step in each block: how much closer the neighbouring point is than others
            gain = np.concatenate([(y[:, 8 * b:8 * b + 8] - home[:, 8 * b:8 * b + 8]) @ STEPS.T
                                   for b in range(self.blocks)], 1)
            best = np.argsort(-gain, axis=1, kind="stable")[:, :self.probes]
            for k in range(self.probes):
                near = home.copy()
                block, step = np.divmod(best[:, k], len(STEPS))
                cols = 8 * block[:, None] + np.arange(8)
                near[np.arange(n)[:, None], cols] += STEPS[step]
                out[:, t, 1 + k] = cell_keys(near, t, self.dims)
        return out
