"""Histogram gradient-boosted regression trees in NumPy (M6).

Used inside tasks on the series of a partition: one small model per SKU series.
Second-order boosting for squared error (gradient = prediction - label,
hessian = 1), L2 leaf regularisation ``reg_lambda``, ``min_child_weight``,
at most ``max_bin`` quantile bins per feature, depth-wise growth, shrinkage
``learning_rate``, base score = label mean, early stopping on validation RMSE
with ``early_stopping_rounds`` patience, prediction at the best iteration.
Split finding per tree level is one ``bincount`` over (node, feature, bin); gains are
taken at the cells that hold rows. A tree gives the leaf of every row, so no row is scored again while
fitting. ``fit_many`` grows the trees of many series together: the cost of a series is its cells, not NumPy's calls.
"""

from __future__ import annotations

import io

import numpy as np

#: (tree, row) pairs that ``predict`` holds at once.
PREDICT_CELLS = 2 ** 16


class HistGBT:
    def __init__(self, n_estimators=100, max_depth=5, learning_rate=0.1, reg_lambda=1.0,
                 min_child_weight=1.0, max_bin=256, early_stopping_rounds=None, gamma=0.0):
        self.n_estimators = n_estimators
        self.max_depth = max_depth
        self.learning_rate = learning_rate
        self.reg_lambda = reg_lambda
        self.min_child_weight = min_child_weight
        self.max_bin = max_bin
        self.early_stopping_rounds = early_stopping_rounds
        self.gamma = gamma
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base_score = 0.0
        self.best_iteration = -1
        self.gain_sum = None
        self.split_count = None

    # ------------------------------------------------------------------ binning
    def _make_cuts(self, X: np.ndarray) -> list[np.ndarray]:
        cuts = []
        for f in range(X.shape[1]):
            u = np.unique(X[:, f])
            if len(u) > self.max_bin:
                u = np.unique(np.quantile(X[:, f], np.linspace(0, 1, self.max_bin)))
            cuts.append(u)
        return cuts

    def _bin(self, X: np.ndarray) -> np.ndarray:
        B = np.empty(X.shape, dtype=np.int32)
        for f, c in enumerate(self.cuts):
            B[:, f] = np.clip(np.searchsorted(c, X[:, f], side="right") - 1, 0, len(c) - 1)
        return B

    @staticmethod
    def _leaf_values(trees: list[tuple], X: np.ndarray) -> np.ndarray:
        """(tree, row) -> value of the leaf: all rows walk down all trees together, level by level."""
        feat, thr, val = (np.stack(part) for part in zip(*trees))
        first = (np.arange(len(trees)) * feat.shape[1])[:, None]     # where a tree's nodes begin
        feat, thr, val = feat.ravel(), thr.ravel(), val.ravel()
        node = np.zeros((len(trees), X.shape[0]), dtype=np.int64)
        rows, cells = np.arange(X.shape[0]) * X.shape[1], np.ascontiguousarray(X).ravel()
        while True:
            at = first + node
            f = feat[at]
            inner = f >= 0
            if not inner.any():
                return val[at]
            right = ~(cells[rows + np.where(inner, f, 0)] < thr[at])
            node = np.where(inner, 2 * node + 1 + right, node)

    # ----------------------------------------------------------------- training
    def fit(self, X, y, X_val=None, y_val=None):
        fit_many([self], [(X, y, X_val, y_val)])
        return self

    def _prepare(self, X: np.ndarray, y: np.ndarray) -> None:
        self.n_features = X.shape[1]
        self.cuts = self._make_cuts(X)
        self.max_bin = max(2, max(len(c) for c in self.cuts))
        self.gain_sum = np.zeros(self.n_features)
        self.split_count = np.zeros(self.n_features)
        self.base_score = float(y.mean()) if len(y) else 0.0
        self.trees = []

    def predict(self, X) -> np.ndarray:
        X = np.asarray(X, dtype=float)
        out = np.full(X.shape[0], self.base_score)
        trees = self.trees[: self.best_iteration + 1]
        if trees:
            step = max(1, PREDICT_CELLS // len(trees))
            for start in range(0, len(X), step):
                part = out[start:start + step]
                for value in self._leaf_values(trees, X[start:start + step]):     # in the order of the trees
                    part += value
        return out

    def feature_importance(self) -> np.ndarray:
        """Average gain per split of each feature, normalised to sum 1."""
        avg = np.divide(self.gain_sum, self.split_count, out=np.zeros_like(self.gain_sum),
                        where=self.split_count > 0)
        s = avg.sum()
        return avg / s if s > 0 else avg

    # ------------------------------------------------------------ persistence
    def to_bytes(self) -> bytes:
        buf = io.BytesIO()
        k = self.best_iteration + 1
        np.savez_compressed(buf, feat=np.stack([t[0] for t in self.trees[:k]]) if k else np.zeros((0, 1)),
                            thr=np.stack([t[1] for t in self.trees[:k]]) if k else np.zeros((0, 1)),
                            val=np.stack([t[2] for t in self.trees[:k]]) if k else np.zeros((0, 1)),
                            base=np.array([self.base_score]))
        return buf.getvalue()

    @classmethod
    def from_bytes(cls, b: bytes) -> "HistGBT":
        z = np.load(io.BytesIO(b))
        m = cls()
        m.base_score = float(z["base"][0])
        m.trees = [(z["feat"][i].astype(np.int32), z["thr"][i], z["val"][i]) for i in range(len(z["feat"]))]
        m.best_iteration = len(m.trees) - 1
        return m


# --------------------------------------------------------------------- fitting
def fit_many(models: list[HistGBT], data: list[tuple]) -> list[HistGBT]:
    """Fit each model on its (X, y, X_val, y_val); all have the parameters of the first and as many features.

    Trees of all series grow level by level together, so the cost of a NumPy call is shared. A series' numbers depend
    on its own rows only: sums run in the order of its rows and bins, and one that stops early leaves the others alone.
    """
    p = models[0]
    sets = []
    for m, (X, y, X_val, y_val) in zip(models, data, strict=True):
        X, y = np.asarray(X, dtype=float), np.asarray(y, dtype=float)
        m._prepare(X, y)
        held = X_val is not None and len(X_val) > 0
        sets.append((X, y, np.asarray(X_val, dtype=float) if held else X[:0], np.asarray(y_val, dtype=float) if held else y[:0]))
    series = np.arange(len(models))
    sizes, held = [len(x[1]) for x in sets], [len(x[3]) for x in sets]
    of = np.concatenate([np.repeat(series, sizes), np.repeat(series, held)])         # training rows first
    target = np.concatenate([x[1] for x in sets] + [x[3] for x in sets])
    grower = _Grower(models, np.concatenate([m._bin(x[0]) for m, x in zip(models, sets)]
                                            + [m._bin(x[2]) for m, x in zip(models, sets)]), of, sum(sizes))
    pred = np.array([m.base_score for m in models])[of]
    ends = sum(sizes) + np.cumsum([0, *held])
    best, best_it = [np.inf] * len(models), [-1] * len(models)
    going = np.array([n > 0 for n in sizes])
    rows = np.flatnonzero(going[of])
    for it in range(p.n_estimators):
        if not going.any():
            break
        feat, thr, val, leaf = grower.grow(pred - target, rows, np.flatnonzero(going))
        pred[rows] += val[of[rows], leaf[rows]]
        stopped = False
        for i in np.flatnonzero(going).tolist():
            models[i].trees.append((feat[i], thr[i], val[i]))
            if held[i]:
                part = slice(ends[i], ends[i + 1])
                rmse = float(np.sqrt(np.mean((pred[part] - target[part]) ** 2)))
                if rmse < best[i]:
                    best[i], best_it[i] = rmse, it
                elif p.early_stopping_rounds and it - best_it[i] >= p.early_stopping_rounds:
                    going[i], stopped = False, True
        if stopped:
            rows = np.flatnonzero(going[of])
    for i, m in enumerate(models):
        m.best_iteration = best_it[i] if held[i] else len(m.trees) - 1
    return models


class _Grower:
    """Grows one tree for each of many series; a node's cells are the (feature, bin) pairs of its series."""

    def __init__(self, models: list[HistGBT], B: np.ndarray, of: np.ndarray, n: int):
        m = models[0]
        self.depth, self.rate, self.lam, self.mcw = m.max_depth, m.learning_rate, m.reg_lambda, m.min_child_weight
        self.least = max(m.gamma, 1e-12)
        self.models, self.of, self.n, self.F = models, of, n, m.n_features
        self.first = np.array([np.cumsum([0, *[len(c) for c in x.cuts]]) for x in models])
        self.cells = self.first[:, -1]
        self.cuts = np.concatenate([c for x in models for c in x.cuts])
        self.cut_start = np.cumsum(self.cells) - self.cells
        self.bins = np.ascontiguousarray(B).ravel()
        self.cell = B[:n] + self.first[of[:n], :-1]
        self.gain_sum = np.zeros((len(models), self.F))
        self.split_count = np.zeros((len(models), self.F))
        for i, x in enumerate(models):
            x.gain_sum, x.split_count = self.gain_sum[i], self.split_count[i]

    def grow(self, g: np.ndarray, rows: np.ndarray, active: np.ndarray):
        """(feature, threshold, value) of the nodes of each series' new tree, and the leaf of every row.

        Rows behind the first ``n`` only walk down the trees. Nodes of a level stand by series, then from left to right.
        """
        size = 2 ** (self.depth + 1) - 1
        shape = (len(self.models), size)
        feat, thr, val = np.full(shape, -1, dtype=np.int32), np.zeros(shape), np.zeros(shape)
        leaf = np.zeros(len(g), dtype=np.int64)
        ns, ids = active, np.zeros(len(active), dtype=np.int64)      # series and number of this level's nodes
        number = np.zeros(len(self.models), dtype=np.int64)
        number[active] = np.arange(len(active))
        local = number[self.of[rows]]
        size_of = np.abs(g[:self.n])
        self.bound = float(np.bincount(self.of[:self.n], weights=size_of).max() * size_of.max()) if self.n else 0.0
        for depth in range(self.depth + 1):
            m = int(np.searchsorted(rows, self.n))
            at, lt = rows[:m], local[:m]
            ga = g[at]
            G = np.bincount(lt, weights=ga, minlength=len(ids))
            H = np.bincount(lt, minlength=len(ids)).astype(float)
            val[ns, ids] = -G / (H + self.lam)
            if depth == self.depth:
                break
            open_ = H >= max(2 * self.mcw, 2)                        # fewer rows cannot make two children
            if not open_.all():
                if not open_.any():
                    break
                go = open_[local]
                rows, local = rows[go], (np.cumsum(open_) - 1)[local[go]]
                ns, ids, G, H = ns[open_], ids[open_], G[open_], H[open_]
                m = int(np.searchsorted(rows, self.n))
                at, lt = rows[:m], local[:m]
                ga = g[at]
            node, f, t, gain = self._splits(at, lt, ga, G, H, ns)
            if len(node) == 0:
                break
            ns, ids = ns[node], ids[node]
            feat[ns, ids] = f
            thr[ns, ids] = self.cuts[self.cut_start[ns] + self.first[ns, f] + t + 1]
            np.add.at(self.gain_sum, (ns, f), gain)                  # in the order of the nodes
            np.add.at(self.split_count, (ns, f), 1)
            if len(node) < len(G):
                number = np.full(len(G), -1)
                number[node] = np.arange(len(node))
                local = number[local]
                go = local >= 0
                rows, local = rows[go], local[go]
            right = self.bins[rows * self.F + f[local]] > t[local]   # bin <= t  <=>  x < cuts[t + 1]
            local = 2 * local + right
            ns, ids = np.repeat(ns, 2), np.repeat(2 * ids, 2)
            ids[0::2] += 1
            ids[1::2] += 2
            leaf[rows] = ids[local]
        return feat, thr, val * self.rate, leaf

    def _splits(self, at: np.ndarray, lt: np.ndarray, ga: np.ndarray, G: np.ndarray, H: np.ndarray, ns: np.ndarray):
        """Node, feature, bin and gain of the best split (the first largest by feature, then bin) of the nodes that have one.

        Gains are taken only at cells that hold rows: an empty one repeats the gain of the cell before it. One
        running sum, set back to zero where a feature begins, rates all cells up to ``slack``, a bound of its rounding; the
        few within that of a node's best are rated again by the plain sum over their feature's bins.
        """
        F, lam, mcw = self.F, self.lam, self.mcw
        wide = self.cells[ns]
        base = np.cumsum(wide) - wide
        idx = (self.cell[at] + base[lt][:, None]).ravel()
        total = int(wide.sum())
        hh = np.bincount(idx, minlength=total)
        seen = np.flatnonzero(hh > 0)
        hg = np.bincount(idx, weights=np.repeat(ga, F), minlength=total)[seen]
        begin = (base[:, None] + self.first[ns, :-1]).ravel()        # every (node, feature) has a cell with rows
        start = np.searchsorted(seen, begin)
        last = np.append(start[1:], len(seen)) - 1
        per_node = np.diff(np.append(start[::F], len(seen)))
        back, count = hg.copy(), hh[seen].astype(float)
        back[start[1:]] -= np.repeat(G, F)[:-1]
        count[start[1:]] -= np.repeat(H, F)[:-1]
        GL, HL = np.cumsum(back), np.cumsum(count)
        GR, HR = np.repeat(G, per_node) - GL, np.repeat(H, per_node) - HL
        HR[last] = 1.0
        about = GL * GL / (HL + lam) + GR * GR / (HR + lam)
        about[last] = -np.inf                                        # nothing to the right
        if mcw > 1:
            about[(HL < mcw) | (HR < mcw)] = -np.inf
        top = np.maximum.reduceat(about, start[::F])
        slack = 2.0 ** -48 * (len(seen) + len(at) + 64) * self.bound
        near = np.flatnonzero(about >= np.repeat(np.where(top > -np.inf, top - slack, np.inf), per_node))
        if len(near) == 0:
            return near, near, near, near
        seg = np.searchsorted(start, near, side="right") - 1
        node = seg // F
        count = near - start[seg] + 1
        which = np.repeat(np.arange(len(near)), count)
        cell = np.arange(len(which)) + np.repeat(start[seg] - (np.cumsum(count) - count), count)
        left = np.bincount(which, weights=hg[cell], minlength=len(near))
        Gn, Hn, HLn = G[node], H[node], HL[near]
        gain = left ** 2 / (HLn + lam) + (Gn - left) ** 2 / (Hn - HLn + lam) - Gn ** 2 / (Hn + lam)
        head = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        most = np.maximum.reduceat(gain, head)
        equal = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(head, len(node)))))
        at = equal[np.searchsorted(equal, head)]
        at = at[gain[at] > self.least]
        return node[at], seg[at] % F, seen[near[at]] - begin[seg[at]], gain[at]
