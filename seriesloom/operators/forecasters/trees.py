"""Gradient boosting of many small models at once.

The model is a key: every training row belongs to one (cut, fold or parameter) model, and each tree level splits the
nodes of all models of a series together. Spark deals out the series; a series has as many rows as months, or months by
snapshots, so a task's arrays stay small whatever the number of series.

Splits are exact for models of every size: each gap between two values of a node is tried. Models of at most LARGE rows,
and all whose rows are weighted or drawn, sort their rows by every feature once and keep them sorted as nodes are parted,
so that the sums left of every possible split are one running sum. Larger models are fitted one after the other, rank each
feature's distinct values once and add up a level's rows by node, feature and rank instead; the sums that have rows stand
in the same order, without a sort. As every row weighs 1 there, weights are exact and both ways give the same trees.

Thresholds lie half-way between the training values they separate. Missing values stand last and go to the side
that gains more. Among equal gains (to ten digits of the model's spread) the first feature and the lowest threshold win.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from seriesloom.config import BoostConfig
from seriesloom.schema import SERIES

LARGE = 256


def by_series(rows: DataFrame):
    """Rows grouped by series over all cores: the groups are small in bytes but dear to fit, so the number of partitions
    is given and adaptive execution does not put them together."""
    spark = rows.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.repartition(partitions, *SERIES).groupBy(*SERIES)


def result(parts: list[pd.DataFrame], schema: str, series: list) -> pd.DataFrame:
    """Parts with different columns as one result of a series: absent and missing values are null in every type."""
    kinds = dict(c.split() for c in schema.split(", "))
    done = pd.concat([p for p in parts if len(p)]).reindex(columns=list(kinds))
    for c, kind in kinds.items():
        if kind == "int":
            done[c] = done[c].astype("Int32")
    done = done.astype(object).where(done.notna(), None)
    done[SERIES] = series
    return done


@dataclass
class Forest:
    """Trees of all models: arrays by (tree, model, node); a node without a split sends all rows to its left."""

    start: np.ndarray
    step: float
    feature: np.ndarray
    limit: np.ndarray
    missing_left: np.ndarray
    leaf: np.ndarray
    gain: np.ndarray

    def predict(self, x: np.ndarray, model: np.ndarray) -> np.ndarray:
        """Sum of start and leaves for each row of x under the model given for it."""
        out, depth = self.start[model].astype(float), int(self.leaf.shape[2]).bit_length() - 1
        rows = np.arange(len(x))
        for at in range(0, len(self.feature), 50):  # so many trees at a time
            trees = np.arange(at, min(at + 50, len(self.feature)))[:, None]
            node = np.zeros((len(trees), len(x)), dtype=np.int64)
            for level in range(depth):
                place = node + (1 << level) - 1
                value = x[rows, self.feature[trees, model, place]]
                left = np.where(np.isnan(value), self.missing_left[trees, model, place], value <= self.limit[trees, model, place])
                node = 2 * node + ~left
            out += self.step * self.leaf[trees, model, node].sum(axis=0)
        return out


def fit(x: np.ndarray, y: np.ndarray, model: np.ndarray, models: int, config: BoostConfig, weight: np.ndarray | None = None, classify: bool = False) -> Forest:
    """Boosted trees of `models` models; row i of x and y trains model[i]. Squared error, or log loss for labels 0 and 1.

    A model without rows predicts 0 (its start). With classify, starts and predictions are log-odds.
    """
    if classify or weight is not None or config.row_share < 1 or len(x) <= LARGE * models:
        return _fit(x, y, model, models, config, weight, classify, False)
    alone = []
    for m in range(models):  # one after the other: a large model's arrays fill the cache
        mine = model == m
        alone.append(_fit(x[mine], y[mine], np.zeros(int(mine.sum()), dtype=np.int64), 1, config, None, False, True))
    joined = {c: np.concatenate([getattr(f, c) for f in alone], axis=1) for c in ("feature", "limit", "missing_left", "leaf")}
    return Forest(np.concatenate([f.start for f in alone]), config.step, **joined, gain=np.concatenate([f.gain for f in alone]))


def _fit(x: np.ndarray, y: np.ndarray, model: np.ndarray, models: int, config: BoostConfig, weight: np.ndarray | None, classify: bool, large: bool) -> Forest:
    rows, features = x.shape
    plain = weight is None and config.row_share == 1
    weight = np.ones(rows) if weight is None else weight
    rng = np.random.default_rng(config.seed)
    mass = np.bincount(model, weights=weight, minlength=models)
    mean = np.bincount(model, weights=weight * y, minlength=models) / np.maximum(mass, 1e-12)
    if classify:
        p = np.clip(mean, 1e-6, 1 - 1e-6)
        start = np.where(mass > 0, np.log(p / (1 - p)), 0.0)
    else:
        start = np.where(mass > 0, mean, 0.0)
    spread = np.maximum(np.bincount(model, weights=weight * (y - mean[model]) ** 2, minlength=models), 1e-300)
    inner, leaves = (1 << config.depth) - 1, 1 << config.depth
    shape = (config.trees, models)
    forest = Forest(start, config.step, np.zeros((*shape, inner), np.int32), np.full((*shape, inner), np.inf), np.ones((*shape, inner), bool), np.zeros((*shape, leaves)), np.zeros((models, features)))
    if large:
        ranks, known = _ranks(x)
        places = _places(ranks, known, np.arange(features))
    # Rows of a model in the order of each feature, missing values last.
    sorted_rows = None if large else np.stack([np.lexsort((x[:, j], model)) for j in range(features)]) if features else np.zeros((0, rows), dtype=np.int64)
    score = start[model].astype(float)
    for tree in range(config.trees):
        if classify:
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (y - p), np.maximum(weight * p * (1 - p), 1e-16)
        else:
            g, h = weight * (y - score), None if plain else weight
        if config.row_share < 1:
            drawn = rng.random(rows) < config.row_share
            g, h = g * drawn, h * drawn
        used = np.sort(rng.permutation(features)[: max(1, int(features * config.column_share))]) if config.column_share < 1 else np.arange(features)
        node = np.zeros(rows, dtype=np.int64)
        if large:
            if config.column_share < 1:
                places = _places(ranks, known, used)
            repeated = np.tile(g, len(used))
        else:
            order = sorted_rows[used]
        for level in range(config.depth):
            if not rows or not len(used):
                left = np.ones(rows, dtype=bool)
            elif large:
                left = _split_ranked(forest, tree, level, node, *places, repeated, used, spread, config)
            else:
                left = _split(forest, tree, level, model, node, order, x, g, h, used, spread, config)
                if level + 1 < config.depth:
                    order = _parted(order, left, (model << level) + node)
            node = 2 * node + ~left
        key = model * leaves + node
        gs, hs = np.bincount(key, weights=g, minlength=models * leaves), np.bincount(key, weights=h, minlength=models * leaves).astype(float)
        value = np.where(hs > 0, gs / np.where(hs > 0, hs + config.l2, 1.0), 0.0)
        forest.leaf[tree] = value.reshape(models, leaves)
        score = score + config.step * value[key]
    return forest


def _ranks(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rank of every value by feature and row, distinct values of each feature); missing values have the last rank."""
    known = [np.unique(v[~np.isnan(v)]) for v in x.T]
    ranks = [np.searchsorted(values, v) for values, v in zip(known, x.T, strict=True)]
    return np.array(ranks, dtype=np.int64).reshape(x.T.shape), known


def _places(ranks: np.ndarray, known: list[np.ndarray], used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The used features' ranks side by side: (place by feature and row, value by place, first place of each feature)."""
    value = np.concatenate([np.zeros(0), *(np.append(known[j], np.nan) for j in used)])
    begin = np.cumsum([0, *(len(known[j]) + 1 for j in used)])[:-1]
    return ranks[used] + begin[:, None], value, begin


def _split_ranked(forest, tree, level, node, place, value, begin, g, used, spread, config) -> np.ndarray:
    """Best split of every node of one model's level from sums by place, g given once a feature; otherwise as _split."""
    at = (place + node * len(value)).ravel()
    count = np.bincount(at)
    cells = np.flatnonzero(count > 0)  # by node, feature and value
    live = np.flatnonzero(np.bincount(node))
    first = np.searchsorted(cells, (live[:, None] * len(value) + begin).ravel())
    last = np.append(first[1:], len(cells)) - 1
    length = last - first + 1
    whole = np.add.reduceat(length, np.arange(0, len(length), len(used)))  # cells of each node
    spot = cells - np.repeat(live * len(value), whole)
    values = value[spot]
    missing = np.isnan(values)
    any_missing = bool(missing.any())

    def running(v):
        """(sum up to each cell within its feature and node, sum of the node, sum of its missing values)."""
        total = np.cumsum(v)
        total -= np.repeat(total[first] - v[first], length)
        lost = np.repeat(np.where(missing[last], v[last], 0.0), length) if any_missing else 0.0
        return total, total[last[:: len(used)]], lost

    lg, tg, mg = running(np.bincount(at, weights=g)[cells])
    lh, th, mh = running(count[cells].astype(float))
    least = max(config.least_weight, 1e-12)
    # A split lies after a known value that another one follows.
    possible = ~missing
    possible[last] = False
    all_g, all_h = np.repeat(tg, whole), np.repeat(th, whole)

    def gains(a, b):
        rest = all_h - b
        fits = (b >= least) & (rest >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = a * a
            gain /= b + config.l2
            other = all_g - a
            other *= other
            other /= rest + config.l2
            gain += other
        return np.where(possible & fits, gain, -np.inf)

    gain, to_left = gains(lg, lh), None
    if any_missing:
        other = gains(lg + mg, lh + mh)
        to_left = other > gain
        gain = np.where(to_left, other, gain)
    best = np.maximum.reduceat(gain, first).reshape(len(live), len(used))
    slack = 1e-10 * spread[0]
    column = (best >= best.max(axis=1, keepdims=True) - slack).argmax(axis=1)
    nodes = np.arange(len(live))
    top = best[nodes, column]
    chosen = nodes * len(used) + column
    hits = np.flatnonzero(gain >= np.repeat(top - slack, whole))
    cut = hits[np.searchsorted(hits, first[chosen])]
    top = top - tg**2 / np.maximum(th + config.l2, 1e-300)
    good = top > slack
    low, high = values[cut], values[np.minimum(cut + 1, last[chosen])]
    limit = np.where(np.isnan(high), np.inf, low + (high - low) / 2)
    limit = np.where(good, np.where(limit >= high, low, limit), np.inf)
    heavier = 2 * lh[cut] >= th
    if any_missing:
        heavier = np.where(missing[last[chosen]], to_left[cut], heavier)
    missing_left = np.where(good, heavier, True)
    in_tree = (1 << level) - 1 + live
    forest.feature[tree, 0, in_tree] = np.where(good, used[column], 0)
    forest.limit[tree, 0, in_tree] = limit
    forest.missing_left[tree, 0, in_tree] = missing_left
    np.add.at(forest.gain, (0, used[column][good]), top[good])
    number = np.searchsorted(live, node)
    mine = place[column[number], np.arange(len(node))]
    left = np.where(np.isnan(value[mine]), missing_left[number], mine <= spot[cut][number])
    return left | ~good[number]


def _runs(key_in_order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place of each node's rows, last place, node number of each place); the same for every feature."""
    first = np.flatnonzero(np.concatenate(([True], key_in_order[1:] != key_in_order[:-1])))
    last = np.append(first[1:], len(key_in_order)) - 1
    return first, last, np.repeat(np.arange(len(first)), last - first + 1)


def _parted(order: np.ndarray, left: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Every node's rows with those that go left in front, otherwise as they were."""
    first, _, run = _runs(key[order[0]])
    goes = left[order]
    before = np.cumsum(goes, axis=1)
    start = (before[:, first] - goes[:, first])[:, run]
    lefts = before - start
    many = (np.maximum.reduceat(before, first, axis=1) - (before[:, first] - goes[:, first]))[:, run]
    place = np.where(goes, first[run] + lefts - 1, first[run] + many + (np.arange(order.shape[1]) - first[run]) - lefts)
    out = np.empty_like(order)
    np.put_along_axis(out, place, order, axis=1)
    return out


def _split(forest, tree, level, model, node, order, x, g, h, used, spread, config) -> np.ndarray:
    """Best split of every node of a level, written into the forest; returns for each row whether it goes left."""
    key = (model << level) + node
    first, last, run = _runs(key[order[0]])
    owner = model[order[0, first]]
    values = x[order, used[:, None]]
    missing = np.isnan(values)
    any_missing = bool(missing.any())

    def running(v):
        """(sum up to each place within its node, sum of the node, sum of its missing values)."""
        placed = v[order]
        total = np.cumsum(placed, axis=1)
        base = total[:, first] - placed[:, first]
        lost = np.add.reduceat(np.where(missing, placed, 0.0), first, axis=1)[:, run] if any_missing else 0.0
        total -= base[:, run]
        return total, total[:1, last][:, run], lost

    lg, tg, mg = running(g)
    if h is None:  # every row weighs 1: its place says how many are left of it
        lh, th = (np.arange(order.shape[1]) - first[run] + 1.0)[None, :], (last - first + 1.0)[run][None, :]
        mh = np.add.reduceat(missing, first, axis=1, dtype=float)[:, run] if any_missing else 0.0
    else:
        lh, th, mh = running(h)
    least = max(config.least_weight, 1e-12)
    # A split lies after a known value that the next one differs from.
    following = np.concatenate((values[:, 1:], np.full((len(used), 1), np.nan)), axis=1)
    possible = values != following
    possible[:, last] = False
    if any_missing:
        possible &= ~missing

    def gains(a, b):
        rest = th - b
        fits = (b >= least) & (rest >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = a * a
            gain /= b + config.l2
            other = tg - a
            other *= other
            other /= rest + config.l2
            gain += other
        return np.where(possible & fits, gain, -np.inf)

    gain, to_left = gains(lg, lh), None
    if any_missing:
        other = gains(lg + mg, lh + mh)
        to_left = other > gain
        gain = np.where(to_left, other, gain)
    best = np.maximum.reduceat(gain, first, axis=1)
    slack = 1e-10 * spread[owner]
    column = (best >= best.max(axis=0) - slack).argmax(axis=0)
    nodes, places = np.arange(len(first)), np.arange(order.shape[1])
    top = best[column, nodes]
    hit = np.where(gain[column[run], places] >= (top - slack)[run], places, order.shape[1])
    at = np.minimum(np.minimum.reduceat(hit, first), last)
    top = top - (tg[0] ** 2 / np.maximum(th[0] + config.l2, 1e-300))[last]
    good = top > slack
    low, high = values[column, at], following[column, at]
    limit = np.where(np.isnan(high), np.inf, low + (high - low) / 2)
    limit = np.where(good, np.where(limit >= high, low, limit), np.inf)
    heavier = 2 * np.broadcast_to(lh, gain.shape)[column, at] >= th[0, at]
    if any_missing:
        lost = np.logical_or.reduceat(missing, first, axis=1)[column, nodes]
        heavier = np.where(lost, to_left[column, at], heavier)
    missing_left = np.where(good, heavier, True)
    place = (1 << level) - 1 + node[order[0, first]]
    forest.feature[tree, owner, place] = np.where(good, used[column], 0)
    forest.limit[tree, owner, place] = limit
    forest.missing_left[tree, owner, place] = missing_left
    np.add.at(forest.gain, (owner[good], used[column][good]), top[good])
    number = np.empty(len(key), dtype=np.int64)
    number[order[0]] = run
    value = x[np.arange(len(key)), forest.feature[tree, owner, place][number]]
    return np.where(np.isnan(value), missing_left[number], value <= limit[number])


def probability(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-log_odds))
