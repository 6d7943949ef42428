"""Second-order boosted trees over histograms (M5, M7).

Rows enter as cells: features cut into at most `max_bins` bins at quantiles, and
per distinct combination of bins the number of rows of each label.  The table
of cells is written once; its size depends on the bins, not on the rows.  Each
tree level is one pass over it: every task adds up gradients and hessians
of its cells per (node, feature, bin), and the sums of at most `MOST_TASKS` tasks come
to the driver, which adds them up and picks the splits.  A tree needs a pass per level, so
passes are kept short: cells are packed as arrays, `CHUNK_CELLS` a row, dealt to the cores, and
a pass is one stage without a shuffle.  Margins of finished trees are stored with
the cells every `STORE_EVERY` trees, so a level re-evaluates a bounded number of trees.

A split sends a row left if its value is at most the cut.  Gains, leaf weights
and the limits on hessians are those of regularised second-order boosting;
equal gains go to the smaller feature, then to the smaller cut.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.session import store

STORE_EVERY = 16  # trees
ONE_TASK_CELLS = 1 << 20  # about 33 MB and as much again to work in; a level takes about as long as starting a job
CHUNK_CELLS = 1 << 16
MOST_TASKS = 256  # each sends at most 16 bytes x nodes x features x bins a pass
NO_CUT = 255  # every bin goes left
MAX_BINS = 64


@dataclass
class Tree:
    """A full binary tree: node k has the children 2k + 1 and 2k + 2; leaves are the nodes of the last level."""

    feature: np.ndarray
    cut: np.ndarray  # the last bin that goes left
    value: np.ndarray

    def leaves(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """The node, counted inside its level, that each row of `codes` (rows x features) reaches."""
        # by whole columns, which is quicker than by rows, and in the shortest types
        kind, cut = np.uint8 if levels <= 8 else np.uint32, self.cut.astype(codes.dtype)

        def below(at: int, levels: int) -> np.ndarray:
            right = codes[:, self.feature[at]] > cut[at]
            if levels == 1:
                return right.astype(kind)
            left = below(2 * at + 1, levels - 1)
            other = below(2 * at + 2, levels - 1) + kind(1 << (levels - 1))
            return left ^ ((left ^ other) & np.negative(right.astype(kind)))  # the right one where `right`, by bits

        return below(0, levels).astype(np.int64) if levels else np.zeros(len(codes), np.int64)

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(codes, int(np.log2(len(self.value))))]


@dataclass
class BoostedTrees:
    """Trees over binned features; `edges[f]` are the cuts of feature f."""

    features: tuple[str, ...]
    edges: list[np.ndarray]
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    held_out_loss: list[float] = field(default_factory=list)

    def codes(self, values: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, values[:, f], "left") for f, e in enumerate(self.edges)]).astype(np.uint8)

    def margin(self, codes: np.ndarray) -> np.ndarray:
        return self.base + sum((t.predict(codes) for t in self.trees), np.zeros(len(codes)))

    def probability(self) -> Column:
        """The positive class' probability, from columns named as the features (null counts as 0)."""
        model = self

        @F.pandas_udf("double")
        def scored(*cols: pd.Series) -> pd.Series:
            values = np.column_stack([c.fillna(0.0).to_numpy(np.float64) for c in cols])
            return pd.Series(1 / (1 + np.exp(-model.margin(model.codes(values)))))

        return scored(*[F.col(c).cast("double") for c in self.features])


def best_split(g: np.ndarray, h: np.ndarray, reg_lambda: float, min_child_weight: float) -> tuple[float, int, int]:
    """(gain, feature, cut) of one node from gradient and hessian sums (features x bins); no gain: (0, 0, NO_CUT)."""
    gl, hl = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    gt, ht = gl[:, -1:], hl[:, -1:]
    gr, hr = gt - gl, ht - hl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl * gl / (hl + reg_lambda) + gr * gr / (hr + reg_lambda) - gt * gt / (ht + reg_lambda)
    gain = np.where((hl >= min_child_weight) & (hr >= min_child_weight), gain, -np.inf)
    gain[:, -1] = -np.inf  # nothing goes right
    top = float(gain.max(initial=-np.inf))
    if not np.isfinite(top) or top <= 1e-9 * max(1.0, abs(float(gt[0, 0]))):
        return 0.0, 0, NO_CUT
    f, b = divmod(int(np.argmax(gain >= top - 1e-12 * abs(top))), g.shape[1])
    return top, f, b


def leaf_value(g: float, h: float, rate: float, reg_lambda: float) -> float:
    return -rate * g / (h + reg_lambda) if h + reg_lambda > 0 else 0.0


def bin_edges(rows: DataFrame, features: tuple[str, ...], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Cuts at quantiles of each feature (one aggregate); at most `max_bins` - 1 of them, the largest value is none."""
    at = [k / max_bins for k in range(1, max_bins)]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), at).alias(c) for c in features],
                     *[F.max(F.col(c).cast("double")).alias(f"_max_{c}") for c in features]).first()
    return [np.array(sorted({float(v) for v in found[c] or [] if v < found[f"_max_{c}"]})) for c in features]


def binned(rows: DataFrame, features: tuple[str, ...], edges: list[np.ndarray], label: str, held_out: Column) -> DataFrame:
    """The cells: `codes` (binary, a byte per feature), rows by label, and whether they are held out."""
    def code(c: str, e: np.ndarray) -> Column:
        if not len(e):
            return F.lit(0)
        cuts = F.array(*[F.lit(float(v)) for v in e])
        return F.size(F.filter(cuts, lambda v: v < F.col(c).cast("double")))

    packed = F.unhex(F.concat(*[F.lpad(F.hex(code(c, e)), 2, "0") for c, e in zip(features, edges, strict=True)]))
    return rows.select(packed.alias("codes"), F.col(label).alias("_y"), held_out.alias("held_out")).groupBy(
        "codes", "held_out").agg(F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).alias("pos"),
                                 F.sum(F.when(F.col("_y") == 1, 0).otherwise(1)).alias("neg")).withColumn(
        "margin", F.lit(0.0))


GROUP_BINS = 1 << 12


def feature_groups(bins: list[int]) -> list[list[int]]:
    """Features whose bins are counted jointly: first fit, by number of bins, of at most `GROUP_BINS` combinations."""
    groups: list[list[int]] = []
    for f in sorted(range(len(bins)), key=lambda f: -bins[f]):
        fits = next((g for g in groups if np.prod([bins[k] for k in g]) * bins[f] <= GROUP_BINS), None)
        if fits is None:
            groups.append([f])
        else:
            fits.append(f)
    return groups


class _Sums:
    """Gradients and hessians per (node, feature, bin) of one level, and the held-out loss, added up over batches of cells."""

    def __init__(self, model: BoostedTrees, pending: list[Tree], tree: Tree, level: int, weight: float):
        self.model, self.pending, self.tree, self.level, self.weight = model, pending, tree, level, weight
        shape = (1 << level, len(model.features), MAX_BINS)
        self.g, self.h, self.loss, self.seen = np.zeros(shape), np.zeros(shape), 0.0, 0.0

    def add(self, codes: np.ndarray, pos: np.ndarray, neg: np.ndarray, margin: np.ndarray, out: np.ndarray) -> None:
        weight = self.weight
        margin = margin + self.model.base + sum((t.predict(codes) for t in self.pending), np.zeros(len(codes)))
        p = 1 / (1 + np.exp(-margin))
        if out.any():
            if self.level == 0:
                m, p1, n1 = margin[out], pos[out], neg[out]
                self.loss += float((weight * p1 * np.logaddexp(0, -m) + n1 * np.logaddexp(0, m)).sum())
                self.seen += float((weight * p1 + n1).sum())
            pos, neg = np.where(out, 0, pos), np.where(out, 0, neg)
        g = weight * pos * (p - 1) + neg * p
        h = (weight * pos + neg) * p * (1 - p)
        node, nodes = self.tree.leaves(codes, self.level).astype(np.uint32), 1 << self.level
        bins = [len(e) + 1 for e in self.model.edges]
        for group in feature_groups(bins):  # a count for several features, whose sums are its margins
            at, shape = node, (nodes, *(bins[f] for f in group))
            for f in group:
                at = at * np.uint32(bins[f]) + codes[:, f]
            at = at.astype(np.int64)
            for total, values in ((self.g, g), (self.h, h)):
                found = np.bincount(at, values, int(np.prod(shape))).reshape(shape)
                for k, f in enumerate(group, 1):
                    total[:, f, :bins[f]] += found.sum(axis=tuple(a for a in range(1, len(shape)) if a != k))

    def sums(self) -> tuple[np.ndarray, np.ndarray, float, float]:
        return self.g, self.h, self.loss, self.seen


def _arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, width)
    pos, neg, margin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pos", "neg", "margin"))
    return codes, pos, neg, margin, batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)


PACKED = "codes binary, pos binary, neg binary, margin binary, held_out binary"  # arrays; the codes column by column
TYPES = {"pos": np.int64, "neg": np.int64, "margin": np.float64, "held_out": np.bool_}


def _packed(codes: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    arrays = [codes.T, *(c.astype(t) for c, t in zip(columns, TYPES.values(), strict=True))]
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays],
                                      ["codes", *TYPES])


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    for row in batch.to_pylist():
        yield (np.frombuffer(row["codes"], np.uint8).reshape(width, -1).T,
               *(np.frombuffer(row[c], t) for c, t in TYPES.items()))


def pack_cells(cells: DataFrame, width: int, tasks: int) -> DataFrame:
    """The cells, dealt to `tasks` tasks, as arrays of about `CHUNK_CELLS` of them a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            held.append(_arrays(b, width))
            if sum(len(h[0]) for h in held) >= CHUNK_CELLS:
                yield _packed(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
        if held:
            yield _packed(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return cells.repartition(tasks).mapInArrow(run, PACKED)


class _SparkCells:
    """The packed cells, stored; a level's sums are one stage over them."""

    def __init__(self, cells: DataFrame, model: BoostedTrees, weight: float):
        self.model, self.weight, self.pending = model, weight, []
        tasks = min(MOST_TASKS, cells.sparkSession.sparkContext.defaultParallelism)
        self.cells = store(pack_cells(cells, len(model.features), tasks), "boosting-cells")

    def sums(self, tree: Tree, level: int) -> tuple[np.ndarray, np.ndarray, float, float]:
        total = _Sums(self.model, list(self.pending), tree, level, self.weight)
        made = (self.model, list(self.pending), tree, level, self.weight)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _Sums(*made)
            for b in batches:
                for chunk in _unpacked(b, len(own.model.features)):
                    own.add(*chunk)
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.g.tobytes()], pa.binary()), pa.array([own.h.tobytes()], pa.binary()),
                 pa.array([own.loss]), pa.array([own.seen])], ["g", "h", "loss", "seen"])

        for r in self.cells.mapInArrow(run, "g binary, h binary, loss double, seen double").collect():  # one row a task
            total.g += np.frombuffer(r["g"]).reshape(total.g.shape)
            total.h += np.frombuffer(r["h"]).reshape(total.h.shape)
            total.loss, total.seen = total.loss + r["loss"], total.seen + r["seen"]
        return total.sums()

    def grown(self, tree: Tree) -> None:
        """Remember a finished tree; now and then the margins are written with the cells."""
        self.pending.append(tree)
        if len(self.pending) < STORE_EVERY:
            return
        trees, width = self.pending, len(self.model.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for codes, pos, neg, margin, out in _unpacked(b, width):
                    yield _packed(codes, pos, neg, margin + sum((t.predict(codes) for t in trees), np.zeros(len(codes))), out)

        self.cells, self.pending = store(self.cells.mapInArrow(run, PACKED), "boosting-cells"), []


class _TaskCells:
    """At most ONE_TASK_CELLS cells, held by one task."""

    def __init__(self, batches: list[tuple[np.ndarray, ...]], model: BoostedTrees, weight: float):
        self.parts = [np.asfortranarray(np.concatenate(x)) for x in zip(*batches, strict=True)]
        self.model, self.weight = model, weight

    def sums(self, tree: Tree, level: int) -> tuple[np.ndarray, np.ndarray, float, float]:
        own = _Sums(self.model, [], tree, level, self.weight)
        own.add(*self.parts)
        return own.sums()

    def grown(self, tree: Tree) -> None:
        self.parts[3] = self.parts[3] + tree.predict(self.parts[0])


def _boost(cells, model: BoostedTrees, rounds: int, depth: int, rate: float, reg_lambda: float, min_child_weight: float,
           patience: int | None) -> BoostedTrees:
    bins = np.arange(MAX_BINS)
    while True:
        tree = Tree(np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, NO_CUT), np.zeros(1 << depth))
        for level in range(depth):
            g, h, loss, seen = cells.sums(tree, level)
            if level == 0:
                model.held_out_loss.append(loss / seen if seen else float("nan"))
                best = int(np.argmin(model.held_out_loss)) if seen and patience else len(model.trees)
                stale = bool(patience) and len(model.trees) - best >= patience  # else all trees are kept
                if len(model.trees) == rounds or stale or not np.any(np.abs(g) > 1e-9):
                    model.trees = model.trees[:best]
                    return model
            for node in range(1 << level):
                at = (1 << level) - 1 + node
                _, f, cut = best_split(g[node], h[node], reg_lambda, min_child_weight)
                tree.feature[at], tree.cut[at] = f, cut
                if level == depth - 1:
                    for side, part in enumerate((bins <= cut, bins > cut)):
                        tree.value[2 * node + side] = leaf_value(g[node][f][part].sum(), h[node][f][part].sum(), rate, reg_lambda)
        model.trees.append(tree)
        cells.grown(tree)


def fit_boosted_trees(rows: DataFrame, features: tuple[str, ...], label: str, held_out: Column, rounds: int = 200,
                      depth: int = 4, rate: float = 0.05, reg_lambda: float = 1.0, min_child_weight: float = 1.0,
                      positive_weight: float = 1.0, patience: int | None = 10, max_bins: int = MAX_BINS,
                      one_task_cells: int = ONE_TASK_CELLS) -> BoostedTrees:
    """Logistic boosting on `rows`, without the `held_out` ones, which only say when to stop.

    Training ends after `rounds` trees, when no gradient is left, or when `patience` trees in a row have not lowered the
    held-out loss; then trees after the lowest loss are dropped.  Without `patience` all trees are grown and kept.  Cells that are at most `one_task_cells` are
    summed inside one task, which spares a job per level; more are summed by many tasks, with the same result.
    """
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"max_bins must lie between 2 and {MAX_BINS}")
    model = BoostedTrees(features, bin_edges(rows.filter(~held_out), features, max_bins))
    cells = store(binned(rows, features, model.edges, label, held_out), "boosting-cells")
    settings = (rounds, depth, rate, reg_lambda, min_child_weight, patience)
    if cells.limit(one_task_cells + 1).count() > one_task_cells:
        return _boost(_SparkCells(cells, model, positive_weight), model, *settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_arrays(b, len(model.features)) for b in batches]
        if held:
            fitted = _boost(_TaskCells(held, model, positive_weight), model, *settings)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fitted)], pa.binary())], ["model"])

    found = cells.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else model


def fit_cells(codes: np.ndarray, n: np.ndarray, total: np.ndarray, sizes: tuple[int, ...], rounds: int = 50, depth: int = 3,
              rate: float = 0.1, reg_lambda: float = 1.0, min_child_weight: float = 1.0) -> tuple[float, list[Tree]]:
    """Squared-error boosting on cells in memory: `n` rows and their target's sum `total` per combination of codes.

    Returns the base (the mean target) and the trees.  The work is per cell, however many rows they stand for.
    """
    width, bins = codes.shape[1], max(sizes)
    base = float(total.sum() / n.sum())
    margin, trees = np.full(len(n), base), []
    for _ in range(rounds):
        g, h = n * margin - total, n.astype(float)
        tree = Tree(np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, NO_CUT), np.zeros(1 << depth))
        for level in range(depth):
            node, nodes = tree.leaves(codes, level), 1 << level
            at = (node[:, None] * width + np.arange(width)) * bins + codes
            size = nodes * width * bins
            gs = np.bincount(at.ravel(), np.repeat(g, width), size).reshape(nodes, width, bins)
            hs = np.bincount(at.ravel(), np.repeat(h, width), size).reshape(nodes, width, bins)
            for k in range(nodes):
                _, tree.feature[nodes - 1 + k], tree.cut[nodes - 1 + k] = best_split(gs[k], hs[k], reg_lambda, min_child_weight)
        leaf = tree.leaves(codes, depth)
        gl, hl = np.bincount(leaf, g, 1 << depth), np.bincount(leaf, h, 1 << depth)
        tree.value = np.array([leaf_value(a, b, rate, reg_lambda) for a, b in zip(gl, hl, strict=True)])
        margin = margin + tree.value[leaf]
        trees.append(tree)
    return base, trees
