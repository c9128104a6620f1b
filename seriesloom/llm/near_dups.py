"""Near-duplicates by ProbMinHash over weighted word shingles, banding, and exact verification.

A shingle (five words) that its text holds n times weighs 1 + ln(n), so that one line said a hundred times doesn't
outweigh the rest of a text. Each shingle starts a Poisson process whose rate is its
weight: its arrivals hit random registers, each register keeps the shingle that arrived first, and a text is done when
no process can arrive before the latest register. Two texts agree in a register with the probability Jaccard
similarity of their weighted shingles. Registers are grouped into bands; texts that agree in a band are candidates, and
a candidate pair is a link if its exact similarity reaches the threshold.

Equal texts are one node. In a bucket, all members are first compared with the least one. Buckets whose members then
lie in more than one component go on: their members are compared with those of other components block by block, each
pair of blocks in a task of its own that counts common shingles and returns no more links than join components. So no
link between components stays unseen, and members that are connected already are not compared again. In the first
comparison pairs are compared by signature before their texts are fetched.

Rows: null texts and texts without words are in no class but their own. Texts of fewer than five words have one
shingle. Repeated rows share a class. Rows without doc_id belong to the class of their text. An empty table gives no
row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, id_text, mix, table, text_hash, windows, word_hashes, written
from .components import components
from .passages import by_key

SHINGLE, SIMILARITY = 5, 0.8
#: 32 bands of 4 registers: a pair at 0.8 has no band in common with probability 5e-8.
BANDS, ROWS = 32, 4
#: A pair goes to verification if its estimate is at most this much below the threshold (over 5 deviations).
MARGIN = 0.2
#: Nodes of a block, where the members of open buckets are compared.
BLOCK = 256


def shingles(hashes: np.ndarray, starts: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles of each text, by text and shingle."""
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    runs = windows(hashes, k) if len(hashes) else np.zeros(0, np.uint64)
    whole = np.arange(len(hashes)) + k <= starts[1:][text] if len(hashes) else np.zeros(0, bool)
    runs, text = runs[whole], text[whole]
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):  # one shingle of all words and their number
        own = [mix(windows(hashes[starts[i] : starts[i + 1]], int(sizes[i]))[:1] + np.uint64(sizes[i]))[0] for i in short]
        runs, text = np.concatenate((runs, np.array(own, dtype=np.uint64))), np.concatenate((text, short))
    order = np.lexsort((runs, text))
    runs, text = runs[order], text[order]
    first = np.flatnonzero(np.concatenate(([True], (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])))) if len(runs) else np.zeros(0, np.int64)
    return text[first], runs[first], 1 + np.log(np.diff(np.append(first, len(runs))))


def prob_min_hash(text: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_texts: int, registers: int) -> np.ndarray:
    """Registers of each text; texts without elements keep zeros.

    All texts of a batch advance together, one arrival of every still active process at a time.
    """
    best = np.full(n_texts * registers, np.inf)
    winner = np.zeros(n_texts * registers, dtype=np.uint64)
    alone = np.bincount(text, minlength=n_texts) == 1  # one element wins every register
    lone = alone[text]
    winner.reshape(n_texts, registers)[text[lone]] = elements[lone, None]
    text, elements, weights = text[~lone], elements[~lone], weights[~lone]
    arrival, step = np.zeros(len(text)), 0
    while len(text):
        draw = mix(elements ^ np.uint64((0xD6E8FEB86659FD93 * (2 * step + 1)) & 0xFFFFFFFFFFFFFFFF))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        arrival = arrival - np.log(uniform) / weights
        place = text * registers + (mix(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, place, arrival)
        won = best[place] == arrival
        winner[place[won]] = elements[won]
        alive = np.unique(text)
        latest = np.zeros(n_texts)
        latest[alive] = best.reshape(n_texts, registers)[alive].max(axis=1)
        active = arrival < latest[text]
        text, elements, weights, arrival = text[active], elements[active], weights[active], arrival[active]
        step += 1
    return winner.reshape(n_texts, registers)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(registers), bands), dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys ^ registers[:, r::rows][:, :bands])
    return mix(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two (sorted elements, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    every = np.union1d(a[0], b[0])
    wa, wb = np.zeros(len(every)), np.zeros(len(every))
    wa[np.searchsorted(every, a[0])] = a[1]
    wb[np.searchsorted(every, b[0])] = b[1]
    both = (wa > 0) & (wb > 0)
    pairs, count = np.unique(np.stack((wa[both], wb[both])), axis=1, return_counts=True)
    return float(sum(n / np.maximum(wa / x, wb / y).sum() for (x, y), n in zip(pairs.T, count, strict=True)))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, hash of the text, band keys and a byte of each register; bands are null for texts without words."""
    registers = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            coded = batch.column("hash").dictionary_encode()
            codes = pc.fill_null(coded.indices, -1).to_numpy()
            firsts = np.unique(codes, return_index=True)[1]
            firsts = firsts[codes[firsts] >= 0]  # one row for each distinct text of the batch
            hashes, starts = word_hashes(batch.column("text").take(pa.array(firsts)))
            found = prob_min_hash(*shingles(hashes, starts), len(firsts), registers)
            keys, small = band_keys(found, bands, rows), found.astype(np.uint8)
            worded = np.diff(starts) > 0
            at = dict(zip(codes[firsts].tolist(), range(len(firsts)), strict=True))
            places = [at.get(c, -1) for c in codes.tolist()]
            ok = [p >= 0 and bool(worded[p]) for p in places]
            band_lists = pa.array([keys[p] if o else None for p, o in zip(places, ok, strict=True)], pa.list_(pa.int64()))
            sketch = pa.array([small[p].tobytes() if o else None for p, o in zip(places, ok, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("hash"), band_lists, sketch], names=["doc_id", "hash", "bands", "sketch"])

    rows_ = id_text(docs).select("doc_id", "text", text_hash(F.col("text")).alias("hash"))
    return rows_.mapInArrow(run, "doc_id long, hash binary, bands array<long>, sketch binary")


def _estimated(pairs: DataFrame, sketches: DataFrame, threshold: float, registers: int) -> DataFrame:
    """Pairs whose signatures agree in enough registers, corrected for bytes that agree by chance."""
    least = threshold - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, registers) for c in ("sketch_a", "sketch_b"))
                share = ((a == b).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
                yield batch.select(["a", "b"]).filter(pa.array(share >= least))

    one = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    two = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose exact similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text_a"):
            sides = []
            for column in ("text_a", "text_b"):
                text, elements, weights = shingles(*word_hashes(batch.column(column)))
                cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
                sides.append([(elements[x:y], weights[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)])
            value = np.array([similarity(x, y) for x, y in zip(*sides, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value)], names=["a", "b", "similarity"]).filter(pa.array(value >= threshold - 1e-9))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, similarity double")


def links(nodes: DataFrame, texts: DataFrame, threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(links a > b between nodes, component of every linked node). nodes: node, bands, sketch; texts: node, text."""
    sketches = nodes.select("node", "sketch")
    spread = nodes.select("node", F.explode("bands").alias("key"))
    # Tables, so that adaptive execution can split the joins at a bucket of any size.
    buckets = written(spread.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("leader")).where("n > 1"), "bucket-sizes")
    shared = written(spread.join(buckets, "key"), "buckets")
    order = [F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")]
    pairs = written(shared.select(F.col("node").alias("x"), F.col("leader").alias("y")).where("x <> y").select(*order).distinct(), "pairs")
    found = written(_verified(_estimated(pairs, sketches, threshold, bands * rows), texts, threshold).dropDuplicates(["a", "b"]), "links")
    parts = components(found.select("a", "b"))
    members = _open(shared.where("n > 2").select("key", "node"), parts)
    if members.isEmpty():
        return found, parts
    more = _between(members, texts, threshold)
    return (every := written(found.select("a", "b").union(more), "links")), components(every)


def _open(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with their component."""
    own = parts.select(F.col("node").alias("of"), "component")
    named = written(members.join(own, F.col("node") == F.col("of"), "left").withColumn("component", F.coalesce("component", "node")).drop("of"), "named")
    keys = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    return written(named.join(written(keys, "open-keys"), "key"), "open-buckets")


def _links_of(rows: pa.Table, threshold: float) -> list[tuple[int, int]]:
    """Links between nodes of different components in two blocks; of links that join the same two components one is enough."""
    nodes, names, side = (rows.column(c).to_pylist() for c in ("node", "component", "side"))
    sets = []
    for raw in rows.column("shingles").to_pylist():
        n = len(raw) // 16
        sets.append((np.frombuffer(raw, dtype="<u8", count=n), np.frombuffer(raw, dtype="<f8", offset=8 * n)))
    totals = np.array([w.sum() for _, w in sets])
    others = [i for i in range(len(nodes)) if side[i] >= 0]  # the second block, or the only one
    owner = np.repeat(others, [len(sets[i][0]) for i in others])
    tokens, weights = (np.concatenate([sets[i][x] for i in others]) for x in (0, 1))
    order = np.argsort(tokens, kind="stable")
    tokens, owner, weights = tokens[order], owner[order], weights[order]
    parent = {c: c for c in names}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    out = []
    for i in range(len(nodes)):
        if side[i] > 0:
            continue
        mine, own = sets[i]
        left, right = np.searchsorted(tokens, mine, "left"), np.searchsorted(tokens, mine, "right")
        n = right - left
        at = np.repeat(left - (np.cumsum(n) - n), n) + np.arange(n.sum())
        held = np.bincount(owner[at], weights=np.repeat(own, n), minlength=len(nodes)) / totals[i]
        back = np.bincount(owner[at], weights=weights[at], minlength=len(nodes)) / totals
        # With common weight shares p and q two texts are at most 1 / (1/p + 1/q - 1) alike: the similarity sums a
        # concave function of the two weights of each common shingle, so it is largest if their ratio is the same.
        with np.errstate(divide="ignore"):
            likely = np.flatnonzero(1 / held + 1 / back <= 1 + 1 / threshold + 1e-9)
        for j in likely.tolist():
            if root(names[i]) != root(names[j]) and similarity(sets[i], sets[j]) >= threshold - 1e-9:
                parent[root(names[i])] = root(names[j])
                out.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
    return out


def _between(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links that join different components of open buckets.

    Nodes that share open buckets, directly or through others, are a group. A group is dealt into blocks of about BLOCK
    nodes, and each pair of blocks is one small task that counts common shingles through an index of the second block.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text, elements, weights = shingles(*word_hashes(batch.column("text")))
            cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
            data = [elements[x:y].tobytes() + weights[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "component", "group")), pa.array(data, pa.binary())], names=["node", "component", "group", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches, "pair"):
            found = _links_of(rows, threshold)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    heads = written(members.groupBy("key").agg(F.min("node").alias("b")), "open-heads")
    groups = components(members.join(heads, "key").select(F.col("node").alias("a"), "b"))
    nodes = members.select("node", "component").distinct().join(groups.select("node", F.col("component").alias("group")), "node")
    nodes = written(nodes, "open-nodes")
    sized = written(nodes.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "open-groups")
    filled = nodes.join(texts, "node").select("node", "component", "group", "text").mapInArrow(sets, "node long, component long, group long, shingles binary")
    dealt = written(filled, "open-sets").join(sized, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), -1).otherwise(1)
    pair = F.xxhash64("group", F.least("block", "other"), F.greatest("block", "other"))
    dealt = dealt.select("node", "component", "shingles", side.alias("side"), pair.alias("pair"))
    return dealt.repartition("pair").sortWithinPartitions("pair", "side", "node").mapInArrow(compare, "a long, b long")


def classes(docs: DataFrame, threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id (least doc_id of the class) and whether the row's document is the one that stands for it."""
    signed = written(signatures(docs, bands, rows), "signatures")
    worded = signed.where(F.col("bands").isNotNull())
    heads = written(worded.where(F.col("doc_id").isNotNull()).groupBy("hash").agg(F.min("doc_id").alias("node")), "texts")
    of = heads.select("node", F.col("hash").alias("of"))
    nodes = worded.join(of, (F.col("doc_id") == F.col("node")) & (F.col("hash") == F.col("of"))).select("node", "bands", "sketch").distinct()
    texts = id_text(docs).select(F.col("doc_id").alias("node"), "text")
    _, parts = links(written(nodes, "nodes"), texts, threshold, bands, rows)
    known = heads.join(parts, "node", "left").select("hash", F.coalesce("component", "node").alias("head"))
    named = signed.select("doc_id", "hash").join(known, "hash", "left").select("doc_id", F.coalesce("head", "doc_id").alias("class_id"))
    return named.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("stays"))


def op5_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


QUERIES = {"op5_prob_min_hash": op5_prob_min_hash}
ORACLES: dict[str, str] = {}
