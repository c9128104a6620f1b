"""Repeated passages by collinear chaining of shared k-mer seeds.

Seeds are the minimisers of a text's k-word runs: any two texts that share a long enough run share a seed in it. Each
seed is tied to its first document (least doc_id), so a seed of m documents gives m - 1 matches and no more. The matches
of a document with one earlier document are merged along their diagonals and chained in the order of both texts: the
best chain ending in a match is its length plus the best of the chains before it, less a cost for the gaps, found by a
prefix maximum in a Fenwick tree. The chains are aligned on the words of both texts (gaps by longest common
subsequence, ends by extension until mismatches outweigh matches), which makes fuzzy passages whole. Every chain is
aligned, also that of a single seed: only the alignment shows how long its passage is. Passages of all earlier documents
are united; those of MIN_WORDS words or more are the result. Copies of a whole text are found by hash and name the least
doc_id of their text.

Only matches with earlier documents count, so the first occurrence of a passage stays. A repeat within one document is
no match. Null texts, and texts shorter than a passage, have none. Repeated rows and rows without doc_id: rows of one
doc_id and one text are one document, rows without doc_id are no document. An empty table gives no row; extra columns
are ignored. Positions count words `[^\\x20\\x09-\\x0D]+` from 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NAMED, chunks, drop, id_text, mix, table, text_hash, windows, word_codes, word_counts, word_hashes, written

#: Any unchanged run of K + WINDOW - 1 = 9 words shares a seed, so a passage of which every tenth word is changed has several.
K, WINDOW = 5, 5
MIN_WORDS = 50
#: Matched words that a piece of a passage has at least; pieces are joined to passages.
MIN_PIECE = 8
#: Cost of a word of gap in a chain; widest gap between matches that alignment bridges; words looked at beyond an end.
GAP_COST, MAX_GAP, REACH = 0.2, 32, 64
#: An end stops where mismatches (each worth two matches) have cost this much; a piece of a passage ends at longer mismatches.
DROP, MAX_MISS = 10, 6
#: Words by which an end may shift to go on, and equal words that it must then find.
SHIFT, AFTER_SHIFT = 8, 5
IDENTITY = 0.8


def minimisers(hashes: np.ndarray, starts: np.ndarray, k: int = K, window: int = WINDOW, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of the seeds of all texts that have at least `least` words."""
    n, sizes = len(hashes), np.diff(starts)
    if n < k + window:  # no text can have a whole window
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    runs = windows(hashes, k)
    last = starts[1:][text] - k - window + 1  # where the last whole window of the text starts
    whole = (np.arange(n) <= last) & (sizes[text] >= max(least, k + window - 1))
    low = runs.copy()
    for i in range(1, window):
        np.minimum(low[: n - i], runs[i:], out=low[: n - i])
    chosen = np.zeros(n, dtype=bool)
    for i in range(window):
        chosen[i:] |= whole[: n - i] & (low[: n - i] == runs[i:])
    at = np.flatnonzero(chosen)
    return text[at], at - starts[:-1][text[at]], runs[at]


def seeds(docs: DataFrame) -> DataFrame:
    """hash, doc_id, pos and whether it is the hash's first place in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text, pos, found = minimisers(*word_hashes(batch.column("text")))
            order = np.lexsort((pos, found, text))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (found[order][1:] != found[order][:-1]) | (text[order][1:] != text[order][:-1])
            first = np.zeros(len(order), dtype=bool)
            first[order] = new
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), batch.column("doc_id").take(pa.array(text)), pa.array(pos.astype(np.int32)), pa.array(first)], names=["seed", "doc_id", "pos", "first"])

    return docs.mapInArrow(run, "seed long, doc_id long, pos int, first boolean")


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        if held and held[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def whole_keys(batches: Iterator[pa.RecordBatch], key: str, rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of some rows or more that hold all rows of their keys, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(x.num_rows for x in held) < rows or held[0].column(key)[0] == batch.column(key)[-1]:
            continue
        table_ = pa.Table.from_batches(held).combine_chunks()
        keys = table_.column(key).to_numpy()
        to = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
        if to:
            yield table_.slice(0, to)
            held = table_.slice(to).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def diagonals(doc: np.ndarray, source: np.ndarray, pos: np.ndarray, src: np.ndarray, k: int = K) -> np.ndarray:
    """Matches merged along their diagonal where they are at most MAX_GAP apart: sorted rows (doc, source, pos, src, length)."""
    order = np.lexsort((pos, pos - src, source, doc))
    doc, source, pos, src = doc[order], source[order], pos[order].astype(np.int64), src[order].astype(np.int64)
    new = np.ones(len(pos), dtype=bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(source) != 0) | (np.diff(pos - src) != 0) | (np.diff(pos) > k + MAX_GAP)
    first = np.flatnonzero(new)
    ends = pos[np.append(first[1:], len(pos)) - 1] + k
    out = np.column_stack([doc[first], source[first], pos[first], src[first], ends - pos[first]])
    return out[np.lexsort(out.T[::-1])]


def chain(segments: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Best chains of segments, each segment in one chain, cut where a gap is too wide to align."""
    if len(segments) == 1:
        return [segments]
    # A chain may go on from a segment that ends before this one starts in both texts. The sweep runs over the
    # starts in the document; the tree is over the ends in the source.
    places = {e: i + 1 for i, e in enumerate(sorted({s + n for _, s, n in segments}))}
    ends = sorted(places)
    tree: list[tuple[float, int]] = [(-1.0, -1)] * (len(places) + 1)
    score, before = [0.0] * len(segments), [-1] * len(segments)
    closing = sorted(range(len(segments)), key=lambda i: segments[i][0] + segments[i][2])
    at = 0
    for i, (pos, src, n) in enumerate(segments):
        while at < len(closing) and segments[closing[at]][0] + segments[closing[at]][2] <= pos:
            j = closing[at]
            end, s_end = segments[j][0] + segments[j][2], segments[j][1] + segments[j][2]
            place, entry = places[s_end], (score[j] + GAP_COST * (end + s_end), j)
            while place < len(tree):
                tree[place] = max(tree[place], entry)
                place += place & -place
            at += 1
        low, high = 0, len(ends)
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if ends[middle] <= src else (low, middle)
        best, place = (-1.0, -1), low
        while place:
            best = max(best, tree[place])
            place -= place & -place
        gain = best[0] - GAP_COST * (pos + src) if best[1] >= 0 else 0.0
        score[i] = n + max(0.0, gain)
        before[i] = best[1] if gain > 0 else -1
    used, out = [False] * len(segments), []
    for i in sorted(range(len(segments)), key=lambda i: -score[i]):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(segments[i])
            i = before[i]
        links.reverse()
        piece = links[:1]
        for one in links[1:]:
            pos, src, n = piece[-1]
            if one[0] - pos - n > MAX_GAP or one[1] - src - n > MAX_GAP:
                out.append(piece)
                piece = []
            piece.append(one)
        if piece:
            out.append(piece)
    return out


def chains(matches: DataFrame) -> DataFrame:
    """doc_id, its sources and for each the segments (chain, pos, src, length) of all chains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_keys(batches, "doc_id"):
            found = diagonals(*(group.column(c).to_numpy() for c in ("doc_id", "source", "pos", "src_pos")))
            first = np.flatnonzero(np.append(True, (np.diff(found[:, :2], axis=0) != 0).any(axis=1)))
            last = np.append(first[1:], len(found))
            # Every chain is kept: what it reaches shows only when it is aligned. Most pairs have one segment.
            raw = np.column_stack([np.zeros(len(found), np.int64), found[:, 2:]]).astype("<i4").tobytes()
            segments = [raw[16 * x : 16 * y] for x, y in zip(first.tolist(), last.tolist(), strict=True)]
            for i in np.flatnonzero(last - first > 1).tolist():
                linked = chain([tuple(x) for x in found[first[i] : last[i], 2:].tolist()])
                segments[i] = np.array([(c, *x) for c, links in enumerate(linked) for x in links], dtype="<i4").tobytes()
            # One row for each document, so that its text is fetched once.
            docs, at = np.unique(found[first, 0], return_index=True)
            offsets = pa.array(np.append(at, len(first)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs), pa.ListArray.from_arrays(offsets, pa.array(found[first, 1])), pa.ListArray.from_arrays(offsets, pa.array(segments, pa.binary()))],
                names=["doc_id", "sources", "segments"],
            )

    return matches.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(run, "doc_id long, sources array<long>, segments array<binary>")


def _word_marks(words: pa.Array) -> np.ndarray:
    """32 bits for each word, from all its bytes and their places; equal in all tasks."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words) or offsets[0] == offsets[-1]:
        return np.zeros(len(words), np.uint32)
    raw = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    sizes = np.diff(offsets)
    place = _ranges(np.zeros(len(sizes), np.int64), sizes).astype(np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(raw + (place << np.uint64(8))))))
    at = offsets - offsets[0]
    return (mix(sums[at[1:]] - sums[at[:-1]]) >> np.uint64(32)).astype(np.uint32)


def _regions(texts: pa.Array, rows: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of the words in the parts of the rows' texts that the words from low to high are, joined; where each part starts and its length."""
    distinct = texts.dictionary_encode()
    word, words, starts = word_codes(distinct.dictionary)
    marks = _word_marks(words)
    codes = np.asarray(distinct.indices, dtype=np.int64)[rows]
    first = starts[codes] + lows
    sizes = np.maximum(np.minimum(starts[codes + 1], starts[codes] + highs) - first, 0)
    return marks[word[_ranges(first, sizes)]], np.cumsum(sizes) - sizes, sizes


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs first[i], first[i] + 1, ... of the given sizes, joined."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _segments(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Segments (chain, pos, src, length) of all rows, and how many each row has; every row has one."""
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, 4).astype(np.int64)
    return flat, np.asarray(pc.binary_length(column), dtype=np.int64) // 16


def _touched(segments: np.ndarray, counts: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word (exclusive) that the segments of each row may touch; side 0 the document, 1 the source."""
    first = np.cumsum(counts) - counts
    low = np.minimum.reduceat(segments[:, 1 + side], first) - REACH
    return np.maximum(low, 0), np.maximum.reduceat(segments[:, 1 + side] + segments[:, 3], first) + REACH


#: Shifts (words of the document, words of the source) in the order in which they are tried.
_SHIFTS = np.array([(x, total - x) for total in range(1, SHIFT + 1) for x in range(total + 1)])
#: Ends that are extended at once.
AT_ONCE = 4096


def _extents(a: np.ndarray, a_at: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_len: np.ndarray, step: int) -> np.ndarray:
    """Matches of pairs of runs of at most REACH words from their start on, for all pairs at once; a row for each pair.

    Words are read side by side up to where mismatches outweigh matches; a few words more in one of them shift it, and
    the reading goes on.
    """
    t = np.arange(REACH)

    def words(of: np.ndarray, at: np.ndarray, size: np.ndarray, nothing: int) -> np.ndarray:
        read = of[np.clip(at[:, None] + step * t, 0, max(len(of) - 1, 0))].astype(np.int64) if len(of) else np.full((len(at), REACH), nothing)
        return np.column_stack([np.where(t < size[:, None], read, nothing), np.full(len(at), nothing)])

    # Words beyond an end equal nothing.
    one, two = words(a, a_at, a_len, -1), words(b, b_at, b_len, -2)
    hit = np.zeros((len(a_at), REACH), dtype=bool)
    live, i, j = np.arange(len(a_at)), np.zeros(len(a_at), np.int64), np.zeros(len(a_at), np.int64)
    window = np.arange(SHIFT + AFTER_SHIFT)
    while len(live):
        at = np.minimum(i[:, None] + t, REACH)
        equal = np.take_along_axis(one, at, 1) == np.take_along_axis(two, np.minimum(j[:, None] + t, REACH), 1)
        score = np.cumsum(np.where(equal, 1, -2), axis=1)
        fallen = np.maximum.accumulate(np.maximum(score, 0), axis=1) - score > DROP
        n = np.where(fallen.any(axis=1), fallen.argmax(axis=1), REACH)
        # The end is where matches outnumber mismatches most, the last such place: a change near the end does not cut it off.
        score = np.where(t < n[:, None], np.cumsum(np.where(equal, 1, -1), axis=1), -REACH)
        size = np.where(score.max(axis=1) > 0, REACH - score[:, ::-1].argmax(axis=1), 0)
        row, word = np.nonzero(equal & (t < size[:, None]))
        hit[live[row], at[row, word]] = True
        i, j = i + size, j + size
        x = np.take_along_axis(one, np.minimum(i[:, None] + window, REACH), 1)
        y = np.take_along_axis(two, np.minimum(j[:, None] + window, REACH), 1)
        same = x[:, :, None] == y[:, None, :]
        goes_on = same[:, : SHIFT + 1, : SHIFT + 1].copy()
        for k in range(1, AFTER_SHIFT):
            goes_on &= same[:, k : k + SHIFT + 1, k : k + SHIFT + 1]
        tried = goes_on[:, _SHIFTS[:, 0], _SHIFTS[:, 1]]
        more = tried.any(axis=1)
        shift = _SHIFTS[tried.argmax(axis=1)[more]]
        live, one, two, i, j = live[more], one[more], two[more], i[more] + shift[:, 0], j[more] + shift[:, 1]
    return hit


def _common(a: list[int], b: list[int]) -> list[bool]:
    """Which words of a are in a longest common subsequence with b."""
    lengths = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            lengths[i][j] = lengths[i + 1][j + 1] + 1 if a[i] == b[j] else max(lengths[i + 1][j], lengths[i][j + 1])
    hits, i, j = [False] * len(a), 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            hits[i] = True
            i, j = i + 1, j + 1
        elif lengths[i + 1][j] >= lengths[i][j + 1]:
            i += 1
        else:
            j += 1
    return hits


def _dense(starts: np.ndarray, ends: np.ndarray, matched: np.ndarray) -> list[tuple[int, int]]:
    """Longest spans, from a start to an end, in which at least IDENTITY of the words match; none overlaps another.

    Starts and ends belong to pieces in order; matched[i] counts the matches before word i.
    """
    over_start, over_end = matched[starts] - IDENTITY * starts, matched[ends] - IDENTITY * ends + 1e-6
    out, todo = [], [(0, len(starts))]
    while todo:
        low, high = todo.pop()
        if low >= high:
            continue
        # The furthest end that is dense from each start: the best surplus from an end on never rises.
        rest = np.maximum.accumulate(over_end[low:high][::-1])[::-1]
        last = low + np.searchsorted(-rest, -over_start[low:high], side="right") - 1
        length = np.where(last >= np.arange(low, high), ends[last] - starts[low:high], 0)
        i = int(np.argmax(length))
        if length[i] > 0:
            out.append((int(starts[low + i]), int(ends[last[i]])))
            todo += [(low, low + i), (int(last[i]) + 1, high)]
    return sorted(out)


def aligned(segments: np.ndarray, a: np.ndarray, a_low: np.ndarray, a_high: np.ndarray, b: np.ndarray, b_low: np.ndarray, b_high: np.ndarray) -> np.ndarray:
    """Passages (chain, start, end, matched words) of the documents along all chains.

    `segments` has (chain, place in a, place in b, length), sorted by chain, chains counted from 0; a and b hold the words of
    all documents and sources, and a chain may touch those from its low to its high. Start and end are places in a.
    """
    of, p, s, n = segments.T
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    last = np.append(first[1:], len(of)) - 1
    lead, s_lead = np.minimum(p[first] - a_low, REACH), np.minimum(s[first] - b_low, REACH)
    a_end, b_end = p[last] + n[last], s[last] + n[last]
    tail, s_tail = np.minimum(a_high - a_end, REACH), np.minimum(b_high - b_end, REACH)
    # The words of each chain, one chain after the other; moved[chain] leads from a place in a to that in `hit`.
    sizes = a_end + tail - p[first] + lead
    base = np.cumsum(sizes) - sizes
    moved = base + lead - p[first]
    hit = np.zeros(int(sizes.sum()), dtype=bool)
    hit[_ranges(p + moved[of], n)[a[_ranges(p, n)] == b[_ranges(s, n)]]] = True
    gap = 1 + np.flatnonzero((of[1:] == of[:-1]) & (p[1:] > (p + n)[:-1]) & (s[1:] > (s + n)[:-1]))
    for k in gap.tolist():
        x, y = p[k - 1] + n[k - 1], s[k - 1] + n[k - 1]
        hit[x + moved[of[k]] : p[k] + moved[of[k]]] |= _common(a[x : p[k]].tolist(), b[y : s[k]].tolist())
    for low in range(0, len(first), AT_ONCE):
        part = slice(low, low + AT_ONCE)
        row, word = np.nonzero(_extents(a, p[first][part] - 1, lead[part], b, s[first][part] - 1, s_lead[part], -1))
        hit[(p[first] + moved)[part][row] - 1 - word] = True
        row, word = np.nonzero(_extents(a, a_end[part], tail[part], b, b_end[part], s_tail[part], 1))
        hit[(a_end + moved)[part][row] + word] = True
    at = np.flatnonzero(hit)
    matched = np.concatenate(([0], np.cumsum(hit)))
    owner = np.searchsorted(base, at, side="right") - 1
    away, other = np.diff(at), np.diff(owner) != 0
    block = np.concatenate(([0], np.cumsum(other | (away > MAX_GAP + 1))))
    start = np.flatnonzero(np.append(True, other | (away > MAX_MISS + 1))) if len(at) else np.zeros(0, np.int64)
    stop = np.append(start[1:], len(at))
    # A run of fewer matches has no piece.
    start, stop = start[stop - start >= MIN_PIECE], stop[stop - start >= MIN_PIECE]
    found, blocks = [], block[start].tolist()
    whole = (stop - start >= IDENTITY * (at[stop - 1] + 1 - at[start]) - 1e-6).tolist()
    ends = zip(blocks, whole, start.tolist(), stop.tolist(), at[start].tolist(), (at[stop - 1] + 1).tolist(), strict=True)
    for in_block, dense, x, y, from_, to in ends:  # a run that is dense as a whole is the longest dense span in it
        spans = [(from_, to)] if dense else _dense(at[x:y], at[x:y] + 1, matched)
        found += [(in_block, *z) for z in spans if matched[z[1]] - matched[z[0]] >= MIN_PIECE]
    pieces = np.array(found, dtype=np.int64).reshape(-1, 3)
    cut = np.flatnonzero(np.diff(pieces[:, 0])) + 1
    alone = np.diff(np.concatenate(([0], cut, [len(pieces)]))) == 1
    out = []
    for one, single in zip(np.split(pieces[:, 1:], cut), alone.tolist(), strict=True):
        out += one.tolist() if single else _dense(one[:, 0], one[:, 1], matched)
    spans = np.array(out, dtype=np.int64).reshape(-1, 2)
    chain_ = np.searchsorted(base, spans[:, 0], side="right") - 1
    return np.column_stack([chain_, spans - moved[chain_][:, None], matched[spans[:, 1]] - matched[spans[:, 0]]])


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text and number of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("hash"), pa.array(word_counts(batch.column("text")), pa.int64())], names=["doc_id", "hash", "n_words"])

    return docs.select("doc_id", "text", text_hash(F.col("text")).alias("hash")).mapInArrow(run, "doc_id long, hash binary, n_words long")


def passages(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, start_word, end_word, n_words, source_id of every passage of a document that an earlier one holds."""
    source = id_text(docs).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    hashed = counted(source)
    heads = hashed.groupBy("hash").agg(F.min("doc_id").alias("head"))
    copies = written(hashed.join(heads, "hash").where("doc_id <> head").select("doc_id", "head", "n_words").distinct(), "copies")
    found = written(seeds(source), "seeds")
    seed_folder = NAMED[-1]
    # Both sides of the next joins are tables, so that adaptive execution can split a seed that many documents hold.
    shared = written(found.groupBy("seed").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last")).where("source <> last").select("seed", "source"), "shared-seeds")
    places = written(found.join(shared, "seed"), "seed-places")
    held = NAMED[-2:]
    first = written(places.where("first AND doc_id = source").groupBy("seed").agg(F.min("pos").alias("src_pos")), "seed-sources")
    held.append(NAMED[-1])
    drop(docs.sparkSession, [seed_folder])
    matches = places.where("doc_id <> source").join(first, "seed").select("doc_id", "pos", "source", "src_pos")
    texts = source.select(F.col("doc_id").alias("of"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            lists = batch.column("sources")
            each = pc.list_parent_indices(lists)
            flat = pa.RecordBatch.from_arrays([batch.column("doc_id").take(each), pc.list_flatten(lists), pc.list_flatten(batch.column("segments"))], names=["doc_id", "source", "segments"])
            low, high = _touched(*_segments(flat.column("segments")), 0)
            words, starts, sizes = _regions(batch.column("text"), np.asarray(each), low, high)
            raw = words.astype("<u4").tobytes()
            parts = [raw[x : x + n] for x, n in zip((4 * starts).tolist(), (4 * sizes).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*flat.columns, pa.array(low.astype(np.int32)), pa.array(parts, pa.binary())], names=["doc_id", "source", "segments", "a_from", "a"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            segments, counts = _segments(batch.column("segments"))
            row = np.repeat(np.arange(batch.num_rows), counts)
            b_from, b_to = _touched(segments, counts, 1)
            b, b_low, b_size = _regions(batch.column("text"), np.arange(batch.num_rows), b_from, b_to)
            a = np.frombuffer(b"".join(batch.column("a").to_pylist()), dtype="<u4")
            a_from, a_size = np.asarray(batch.column("a_from"), dtype=np.int64), np.asarray(pc.binary_length(batch.column("a")), dtype=np.int64) // 4
            a_low = np.cumsum(a_size) - a_size
            new = np.append(True, (row[1:] != row[:-1]) | (segments[1:, 0] != segments[:-1, 0]))
            placed = np.column_stack([np.cumsum(new) - 1, segments[:, 1] + (a_low - a_from)[row], segments[:, 2] + (b_low - b_from)[row], segments[:, 3]])
            of = row[new]
            found = aligned(placed, a, a_low[of], (a_low + a_size)[of], b, b_low[of], (b_low + b_size)[of])
            if len(found):
                of = of[found[:, 0]]
                words = found[:, 1:3] + (a_from - a_low)[of][:, None]
                columns = [batch.column("doc_id").take(pa.array(of)), *(pa.array(x) for x in (words[:, 0], words[:, 1], found[:, 3])), batch.column("source").take(pa.array(of))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start_word", "end_word", "matched", "source_id"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_key(batches, "doc_id"):
            rows = sorted(zip(*(group.column(c).to_pylist() for c in ("start_word", "end_word", "source_id")), strict=True))
            whole: list[list[int]] = []
            for start, end, origin in rows:
                if whole and start <= whole[-1][1] + 1:
                    one = whole[-1]
                    if end - start > one[3]:
                        one[2], one[3] = origin, end - start
                    one[1] = max(one[1], end)
                else:
                    whole.append([start, end, origin, end - start])
            doc = group.column("doc_id")[0].as_py()
            out = [(doc, a, b, b - a, origin) for a, b, origin, _ in whole if b - a >= least]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "start_word", "end_word", "n_words", "source_id"])

    linked = chains(matches.join(copies.select("doc_id"), "doc_id", "left_anti"))
    sliced = linked.join(texts, F.col("doc_id") == F.col("of")).select("doc_id", "sources", "segments", "text").mapInArrow(cut, "doc_id long, source long, segments binary, a_from int, a binary")
    pieces = sliced.join(texts, F.col("source") == F.col("of")).select("doc_id", "source", "segments", "a_from", "a", "text").mapInArrow(align, "doc_id long, start_word long, end_word long, matched long, source_id long")
    result = "doc_id long, start_word long, end_word long, n_words long, source_id long"
    # Written, so that the shuffles of seeds and texts are gone before the caller moves documents.
    fuzzy = written(pieces.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(unite, result), "passages")
    drop(docs.sparkSession, held)
    whole = copies.where(F.col("n_words") >= least)
    return fuzzy.union(whole.select("doc_id", F.lit(0).cast("long"), "n_words", "n_words", "head"))


def cut_passages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents without their repeated passages; a document of which no word is left goes. Columns stay as they are.

    The words around a cut keep their own white space. `n_chars`, where there is one, is counted anew for changed texts.
    """
    spans = found.groupBy(F.col("doc_id").alias("of")).agg(F.array_sort(F.collect_list(F.struct("start_word", "end_word"))).alias("spans"))
    joined = docs.join(spans, docs["doc_id"] == spans["of"], "left")
    changed, names = joined.where(F.col("spans").isNotNull()), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in chunks(batches):
            texts = []
            for text, spans_ in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                at, parts, places = 0, [], [m.span() for m in word.finditer(text)]
                for span in spans_:
                    a, b = span["start_word"], min(span["end_word"], len(places))
                    parts.append(text[at : places[a][0]])
                    at = places[b][0] if b < len(places) else len(text)
                texts.append("".join([*parts, text[at:]]))
            new = pa.array(texts, pa.string())
            columns = [new if c == "text" else pc.utf8_length(new).cast(batch.schema.field(c).type) if c == "n_chars" else batch.column(c) for c in names]
            batch = pa.RecordBatch.from_arrays(columns, names=names)
            yield batch.filter(pa.array([not not word.search(t) for t in texts], pa.bool_()))

    same = joined.where(F.col("spans").isNull()).select(*(docs[c] for c in names))
    return same.union(changed.select(*(docs[c] for c in names), "spans").mapInArrow(run, docs.schema))


def op4_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))


QUERIES = {"op4_collinear_chains": op4_collinear_chains}
ORACLES: dict[str, str] = {}
