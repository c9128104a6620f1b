"""The alignment of all chains at once against the same rules chain by chain, by results and by time."""

import time

import numpy as np

from seriesloom.llm import passages
from seriesloom.llm.passages import AFTER_SHIFT, DROP, MAX_GAP, MAX_MISS, MIN_PIECE, REACH, SHIFT, _common, _dense


def _straight(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matches of two runs of words read side by side, up to where mismatches outweigh matches."""
    n = min(len(a), len(b))
    equal = a[:n] == b[:n]
    score = np.cumsum(np.where(equal, 1, -2))
    fallen = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > DROP)
    n = int(fallen[0]) if len(fallen) else n
    # The end is where matches outnumber mismatches most, the last such place: a change near the end does not cut it off.
    score = np.cumsum(np.where(equal[:n], 1, -1))
    return equal[: n - int(np.argmax(score[::-1]))] if n and score.max() > 0 else equal[:0]


def _extent(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matches of two runs of words from their start on; a few words more in one of them shift it."""
    hit, i, j = np.zeros(len(a), dtype=bool), 0, 0
    while True:
        equal = _straight(a[i:], b[j:])
        hit[i : i + len(equal)] = equal
        i, j = i + len(equal), j + len(equal)
        shifts = ((x, total - x) for total in range(1, SHIFT + 1) for x in range(total + 1))
        for x, y in shifts:
            one, two = a[i + x : i + x + AFTER_SHIFT], b[j + y : j + y + AFTER_SHIFT]
            if len(one) == len(two) == AFTER_SHIFT and (one == two).all():
                i, j = i + x, j + y
                break
        else:
            return hit[:i]


def plain(segments: np.ndarray, a: np.ndarray, a_from: int, b: np.ndarray, b_from: int) -> list[tuple[int, int, int]]:
    """Passages (start, end, matched words) of the document along one chain."""
    hit = np.zeros(len(a), dtype=bool)
    last = None
    for pos, src, n in segments.tolist():
        p, s = pos - a_from, src - b_from
        hit[p : p + n] |= a[p : p + n] == b[s : s + n]
        if last and p > last[0] and s > last[1]:
            hit[last[0] : p] |= _common(a[last[0] : p].tolist(), b[last[1] : s].tolist())
        last = (p + n, s + n)
    p, s = int(segments[0, 0]) - a_from, int(segments[0, 1]) - b_from
    left = _extent(a[:p][::-1], b[:s][::-1])
    hit[p - len(left) : p] |= left[::-1]
    right = _extent(a[last[0] :], b[last[1] :])
    hit[last[0] : last[0] + len(right)] |= right
    at = np.flatnonzero(hit)
    matched = np.concatenate(([0], np.cumsum(hit)))
    out = []
    for block in np.split(at, np.flatnonzero(np.diff(at) > MAX_GAP + 1) + 1) if len(at) else []:
        pieces = [x for run in np.split(block, np.flatnonzero(np.diff(block) > MAX_MISS + 1) + 1) for x in _dense(run, run + 1, matched)]
        pieces = np.array([x for x in pieces if matched[x[1]] - matched[x[0]] >= MIN_PIECE], dtype=np.int64).reshape(-1, 2)
        out += [(a_from + start, a_from + end, int(matched[end] - matched[start])) for start, end in _dense(pieces[:, 0], pieces[:, 1], matched)]
    return out


def changed(rng, words):
    """The words with some replaced, dropped or added."""
    out = []
    for word in words.tolist():
        chance = rng.random()
        out += [word] if chance > 0.12 else [int(rng.integers(1 << 31))] if chance > 0.06 else [] if chance > 0.03 else [word, int(rng.integers(1 << 31))]
    return np.array(out, dtype=np.uint32)


def cases(rng, n):
    """Segments of chains, the document and the source of each: unlike texts around a shared passage with changes."""
    for _ in range(n):
        shared = rng.integers(1 << 31, size=rng.integers(6, 130)).astype(np.uint32)
        a = np.concatenate([rng.integers(1 << 31, size=rng.integers(0, 200)), shared, rng.integers(1 << 31, size=rng.integers(0, 200))]).astype(np.uint32)
        b = np.concatenate([rng.integers(1 << 31, size=rng.integers(0, 200)), changed(rng, shared), rng.integers(1 << 31, size=rng.integers(0, 200))]).astype(np.uint32)
        places = {x: i for i, x in reversed(list(enumerate(b.tolist())))}
        pos = [(i, places[x]) for i, x in enumerate(a.tolist()) if x in places]
        pos = [(i, j) for i, j in pos if i + 5 <= len(a) and j + 5 <= len(b) and (a[i : i + 5] == b[j : j + 5]).all()]
        if not pos:
            continue
        p, s = np.array(pos).T
        one = np.zeros(len(p), np.int64)
        for links in passages.chain([tuple(x) for x in passages.diagonals(one, one, p, s)[:, 2:].tolist()]):
            yield np.array(links), a, b


def test_alignment_at_once_is_the_alignment_one_by_one_in_a_fifth_of_its_time():
    found = list(cases(np.random.default_rng(5), 3000))
    began, want = time.process_time(), []
    for i, (links, a, b) in enumerate(found):
        x, y = (max(0, int(links[0, k]) - REACH) for k in (0, 1))
        to_a, to_b = (int(links[-1, k] + links[-1, 2]) + REACH for k in (0, 1))
        want += [(i, *z) for z in plain(links, a[x:to_a], x, b[y:to_b], y)]
    plain_time = time.process_time() - began
    sizes = np.array([(len(a), len(b)) for _, a, b in found])
    low = np.cumsum(sizes, axis=0) - sizes
    segments = np.concatenate([np.column_stack([np.full(len(x), i), x[:, 0] + low[i, 0], x[:, 1] + low[i, 1], x[:, 2]]) for i, (x, _, _) in enumerate(found)])
    all_a, all_b = (np.concatenate([x[k] for x in found]) for k in (1, 2))
    began = time.process_time()
    got = passages.aligned(segments, all_a, low[:, 0], low[:, 0] + sizes[:, 0], all_b, low[:, 1], low[:, 1] + sizes[:, 1])
    took = time.process_time() - began
    got[:, 1:3] -= low[got[:, 0], 0][:, None]
    assert len(want) > 2000 and sorted(want) == sorted(map(tuple, got.tolist()))
    assert took < plain_time / 5


def test_no_chains():
    assert len(passages._word_marks(passages.pa.array([], "string"))) == 0
    one = np.array([[0, 0, 0, 5]])
    assert len(passages.aligned(one, np.arange(5, dtype=np.uint32), np.array([0]), np.array([5]), np.arange(5, dtype=np.uint32), np.array([0]), np.array([5]))) == 0
