"""Phrase collocations by SON partitioning.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and written as blocks: the words of one
language in one task's rows as numbers into the block's own word list. Blocks are dealt to SHARDS shards.

1. Every shard is mined completely: its blocks count all their phrases of 1 to 5 words, the counts of a shard are summed,
   and a phrase is locally frequent if it reaches the shard's part of the support,
   ceil(support * words of the shard / all words).
2. The locally frequent phrases of all shards together are the candidates: a phrase that reaches the support overall
   reaches its part in one shard at least, so none is missed. The shards' sums stand side by side by then, and phrases
   that stay below the support together go at once.
3. Every block counts all candidates that it holds, whichever shard they come from, and these counts, keyed by the
   words themselves, are packed by the same ranges and summed over all blocks.

A phrase travels in step 1 as 48 bits of a hash and its count, sorted and packed by ranges of the hash, and a block gets
back one bit for each of its phrases. Equal hashes of different phrases could only add a candidate, since step 3 compares
words. The ranges follow the number of words, so that a task holds about RANGE_PHRASES phrases of them; beyond MOST_RANGES
ranges the phrases are mined in several passes. No set of phrases is collected or broadcast by hint; a shard is as many
blocks as it needs, and a phrase reaches its range once per block, so no phrase is hot.

Rows: a null or empty text has no words; repeated rows count each time; a null lang is `und`; an empty table gives no
row; extra columns are not read. Ranking ties go to the smaller phrase in UTF-8 byte order, and ranks have no ties.
Scores are exact in 38 decimal digits: word counts up to 10^17.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NAMED, chunks, drop, mix, table, written

SUPPORT, LONGEST, TOP = 100, 5, 2000
#: Parts that are mined by themselves; the local support is about SUPPORT / SHARDS whatever the size of the input.
SHARDS = 8
#: Words of a block, at most one chunk of texts more.
BLOCK_WORDS = 1_500_000
#: Phrases of a range, about; ranges of one pass.
RANGE_PHRASES, MOST_RANGES = 2_000_000, 1 << 14
BITS = 48
#: Salts of the first of two rounds that take each language's best.
SALTS = 64

BLOCKS = "block long, shard int, lang string, words binary, codes binary, n long"
PARCELS = "range int, block long, shard int, need long, data binary"
REPLIES = "block long, range int, bits binary"
COUNTED = "range int, lang string, data binary"
COUNTS = "lang string, phrase string, k int, f long"
BREAK = np.uint32(0)
STEP = np.uint64(0x9FB21C651E98DF25)


# ---- blocks ----------------------------------------------------------------
def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _words_out(words: list) -> bytes:
    return _pack(json.dumps(words, ensure_ascii=False).encode("utf-8", "surrogatepass"))


def _words_in(data: bytes) -> list:
    return json.loads(_unpack(data).decode("utf-8", "surrogatepass"))


def piece_words(texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """(distinct words, a number for every word in order: 0 between pieces and texts, otherwise 1 + place of the word)."""
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    # A full stop cannot be part of a word, so it stands for every end of a piece.
    cut = pc.replace_substring_regex(pc.binary_join_element_wise(lowered, "", "."), r"[.,;:!?\n\v\f\r]+", " . ")
    values = pc.ascii_split_whitespace(cut).flatten()
    coded = values.filter(pc.greater(pc.binary_length(values), 0)).dictionary_encode()
    words, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices, dtype=np.int64)
    if "." not in words:
        return words, (codes + 1).astype(np.uint32)
    stop = words.index(".")
    renamed = np.arange(1, len(words) + 1) - (np.arange(len(words)) > stop)
    renamed[stop] = 0
    return words[:stop] + words[stop + 1 :], renamed[codes].astype(np.uint32)


class _Gathered:
    """Words of one language: one list of distinct words and the numbers of all chunks of texts."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.codes: list[np.ndarray] = []
        self.n = 0

    def add(self, words: list[str], codes: np.ndarray) -> None:
        here = np.array([0] + [self.place.setdefault(w, len(self.place) + 1) for w in words], dtype=np.uint32)
        self.codes.append(here[codes])
        self.n += int(np.count_nonzero(codes))


def blocks(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per block; a task closes its blocks when they hold BLOCK_WORDS words together."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, _Gathered] = {}

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for lang, g in held.items():
                if not g.n:
                    continue
                block = task * (1 << 32) + made
                made += 1
                row = [block, int(mix(np.array([block]))[0] % np.uint64(shards)), lang, _words_out(list(g.place)), _pack(np.concatenate(g.codes).tobytes()), g.n]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64()], strict=True)],
                                                 names=["block", "shard", "lang", "words", "codes", "n"])
            held.clear()

        for batch in chunks(batches):
            langs = batch.column("lang").dictionary_encode()
            which = np.asarray(langs.indices)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                held.setdefault(lang, _Gathered()).add(*piece_words(batch.column("text").filter(pa.array(which == i))))
            if sum(g.n for g in held.values()) >= BLOCK_WORDS:
                yield from close()
        yield from close()

    rows = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return rows.mapInArrow(build, BLOCKS)


# ---- one phrase length in one block -----------------------------------------
def _hashes(codes: np.ndarray, of_word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the k words from each place on, whether no break lies among them)."""
    n = max(0, len(codes) - k + 1)
    out, whole = np.zeros(n, dtype=np.uint64), np.ones(n, dtype=bool)
    for j in range(k):
        out = out * STEP + of_word[codes[j : j + n]]
        whole &= codes[j : j + n] != BREAK
    return mix(out), whole


def _counted(codes: np.ndarray, keys: np.ndarray, at: np.ndarray, k: int, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(phrases, counts, keys) of the phrases at the places `at`; places of equal key but other words are counted one by one."""
    distinct, first, inverse, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    model = at[first]
    other = np.zeros(len(at), dtype=bool)
    for j in range(k):
        other |= codes[at + j] != codes[model[inverse] + j]

    def text(i: int) -> str:
        return " ".join(words[c - 1] for c in codes[i : i + k].tolist())

    if other.any():
        n = n - np.bincount(inverse[other], minlength=len(n))
    found = Counter((text(i), key) for i, key in zip(at[other].tolist(), keys[other].tolist(), strict=True))
    return [*map(text, model.tolist()), *(p for p, _ in found)], np.append(n, list(found.values())).astype(np.int64), np.append(distinct, np.array([key for _, key in found], dtype=np.uint64))


def _phrases(row: dict, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places of the block's phrases of k words, their keys): 48 bits of a hash of language, length and words."""
    words, codes = _words_in(row["words"]), np.frombuffer(_unpack(row["codes"]), dtype=np.uint32)
    seed = np.uint64(xxhash.xxh3_64_intdigest(row["lang"].encode("utf-8", "surrogatepass")))
    of_word = np.array([0] + [xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)
    for k in range(1, longest + 1):
        keys, whole = _hashes(codes, of_word, k)
        places = np.flatnonzero(whole)
        yield k, places, mix(keys[places] ^ seed) >> np.uint64(64 - BITS)


def _distinct(row: dict, longest: int, passes: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block in order and their counts; of several passes each takes its share of the keys."""
    found = []
    for _, _, keys in _phrases(row, longest):
        found.append(np.unique(keys if passes == 1 else keys[keys % np.uint64(passes) == turn], return_counts=True))
    keys, n = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    # Two lengths may share a key: their counts are one.
    first = np.flatnonzero(np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where the ranges of the sorted keys begin; a last entry for the end."""
    edges = np.arange(ranges + 1, dtype=np.uint64) << np.uint64(BITS - (ranges.bit_length() - 1))
    return np.searchsorted(keys, edges)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: high bytes of small numbers are zero and pack to nothing."""
    return _pack(values.astype("<u8").view("u1").reshape(-1, 8).T.tobytes())


def _from_planes(data: bytes) -> np.ndarray:
    raw = _unpack(data)
    return np.ascontiguousarray(np.frombuffer(raw, dtype="u1").reshape(8, -1).T).view("<u8").reshape(-1)


def _mine(longest: int, ranges: int, passes: int, turn: int):
    """mapInArrow function: a block's phrases and counts, one parcel for each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = _distinct(row, longest, passes, turn)
                cuts = _cuts(keys, ranges)
                full = np.flatnonzero(np.diff(cuts))
                data = []
                for r in full.tolist():
                    a, b = cuts[r], cuts[r + 1]
                    data.append(_planes(np.concatenate((np.diff(keys[a:b], prepend=np.uint64(0)), n[a:b].astype(np.uint64)))))
                m = len(full)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([row["block"]] * m, pa.int64()), pa.array([row["shard"]] * m, pa.int32()), pa.array([row["need"]] * m, pa.int64()), pa.array(data, pa.binary())],
                    names=[x.split()[0] for x in PARCELS.split(", ")])

    return run


def _union(shards: int, support: int):
    """applyInArrow function: local sums of a range's phrases, the candidates among them, a bit for each phrase of each parcel."""

    def run(parcels: pa.Table) -> pa.Table:
        halves = [np.split(_from_planes(x), 2) for x in parcels.column("data").to_pylist()]
        keys = np.concatenate([np.cumsum(gaps, dtype=np.uint64) for gaps, _ in halves])
        sizes = [len(gaps) for gaps, _ in halves]
        n = np.concatenate([n for _, n in halves]).astype(np.int64)
        _, inverse = np.unique(keys, return_inverse=True)
        shard = np.repeat(np.array(parcels.column("shard").to_pylist()), sizes)
        need = np.repeat(np.array(parcels.column("need").to_pylist()), sizes)
        distinct = int(inverse.max()) + 1
        # Whole numbers below 2^53 add up exactly as doubles.
        enough = np.bincount(inverse, weights=n, minlength=distinct) >= support
        local = np.zeros(distinct, dtype=bool)
        for s in range(shards):
            mine = shard == s
            sums = np.bincount(inverse[mine], weights=n[mine], minlength=distinct)
            local[inverse[mine]] |= sums[inverse[mine]] >= need[mine]
        chosen = (enough & local)[inverse]
        ends = np.cumsum(sizes)
        bits = [_pack(np.packbits(chosen[e - size : e]).tobytes()) for e, size in zip(ends.tolist(), sizes, strict=True)]
        return pa.table({"block": parcels.column("block"), "range": parcels.column("range"), "bits": pa.array(bits, pa.binary())})

    return run


def _count(longest: int, ranges: int, passes: int, turn: int):
    """mapInArrow function: exact counts of the candidates in a block, by their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, _ = _distinct(row, longest, passes, turn)
                cuts, chosen = _cuts(keys, ranges), np.zeros(len(keys), dtype=bool)
                for reply in row["replies"]:
                    a, b = cuts[reply["range"]], cuts[reply["range"] + 1]
                    chosen[a:b] = np.unpackbits(np.frombuffer(_unpack(reply["bits"]), dtype="u1"), count=b - a)
                candidates = keys[chosen]
                words, codes = _words_in(row["words"]), np.frombuffer(_unpack(row["codes"]), dtype=np.uint32)
                phrases, n, of, ks = [], [], [], []
                for k, places, found in _phrases(row, longest):
                    good = np.isin(found, candidates)
                    if good.any():
                        p, m, key = _counted(codes, found[good], places[good], k, words)
                        phrases += p
                        n.append(m)
                        of.append(key)
                        ks.append(np.full(len(m), k))
                if not phrases:
                    continue
                of = np.concatenate(of)
                order = np.argsort(of, kind="stable")
                n, ks, cuts = np.concatenate(n)[order].tolist(), np.concatenate(ks)[order].tolist(), _cuts(of[order], ranges)
                phrases = [phrases[i] for i in order.tolist()]
                full = np.flatnonzero(np.diff(cuts))
                data = [_words_out([phrases[cuts[r] : cuts[r + 1]], ks[cuts[r] : cuts[r + 1]], n[cuts[r] : cuts[r + 1]]]) for r in full.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([row["lang"]] * len(full), pa.string()), pa.array(data, pa.binary())], names=["range", "lang", "data"])

    return run


def _sum(support: int):
    """applyInArrow function: the phrases of a range that reach the support, with their counts over all blocks."""

    def run(parcels: pa.Table) -> pa.Table:
        sums: Counter = Counter()
        for lang, data in zip(parcels.column("lang").to_pylist(), parcels.column("data").to_pylist(), strict=True):
            for phrase, k, n in zip(*_words_in(data), strict=True):
                sums[lang, phrase, k] += n
        kept = [(*key, f) for key, f in sums.items() if f >= support]
        columns = zip(*kept, strict=True) if kept else ([], [], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.string(), pa.int32(), pa.int64()], strict=True)], names=["lang", "phrase", "k", "f"])

    return run


# ---- SON --------------------------------------------------------------------
def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, phrase, k, f of all phrases of 1 to `longest` words found `support` times; lang, n words."""
    spark, before = docs.sparkSession, set(NAMED)
    made = written(blocks(docs, shards), "blocks")
    totals = written(made.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    # ceil(support * n_shard / n) in whole numbers.
    need = F.expr(f"cast((cast({support} as decimal(20,0)) * n_shard + n - 1) div n as long)")
    local = made.groupBy("shard", "lang").agg(F.sum("n").alias("n_shard")).join(totals, "lang").select("shard", "lang", need.alias("need"))
    size = made.agg(F.sum("n"), F.count("*")).first()
    wanted = max(1, (size[0] or 0) * longest // RANGE_PHRASES)
    passes = -(-wanted // MOST_RANGES)
    ranges = 1 << (-(-wanted // passes) - 1).bit_length()
    # A row is a few MB and takes seconds, so as many tasks as blocks may share them.
    stage = written(made.join(written(local, "local"), ["shard", "lang"]).repartition(max(1, size[1]), "block"), "needed")
    counts = None
    for turn in range(passes):
        replies = written(stage.mapInArrow(_mine(longest, ranges, passes, turn), PARCELS).groupBy("range").applyInArrow(_union(shards, support), REPLIES), "replies")
        held = replies.groupBy("block").agg(F.collect_list(F.struct("range", "bits")).alias("replies"))
        part = written(stage.join(held, "block").mapInArrow(_count(longest, ranges, passes, turn), COUNTED).groupBy("range").applyInArrow(_sum(support), COUNTS), "counts")
        counts = part if counts is None else counts.unionByName(part)
    # A phrase has one key, so it is counted in one pass.
    phrases = written(counts, "phrases")
    drop(spark, [x for x in NAMED if x not in before and not x.rsplit("/", 1)[1].startswith(("phrases-", "totals-"))])
    return phrases, totals


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS, percent: int = 100) -> DataFrame:
    """The `top` phrases of each language by their weakest cut: lang, rank, phrase, a, l, r, n, score.

    A phrase inside a longer one that is found at least percent / 100 times as often is dropped.
    """
    phrases, totals = frequent_phrases(docs, support, longest, shards)
    longer = phrases.where("k > 2").select("lang", F.split("phrase", " ").alias("w"), "k", "f")
    # A longer phrase with one word more holds a phrase of any length more, and is found as often or more.
    inner = longer.select("lang", "f", F.explode(F.array(F.array_join(F.expr("slice(w, 1, k - 1)"), " "), F.array_join(F.expr("slice(w, 2, k - 1)"), " "))).alias("phrase"))
    covered = written(inner.groupBy("lang", "phrase").agg(F.max("f").alias("f_longer")), "covered")
    kept = phrases.where("k > 1").join(covered, ["lang", "phrase"], "left").where(F.col("f_longer").isNull() | (F.col("f_longer") * 100 < F.col("f") * percent))
    kept = kept.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = kept.select("lang", "phrase", "a", "cut", F.array_join(F.expr("slice(w, 1, cut)"), " ").alias("first"), F.array_join(F.expr("slice(w, cut + 1, size(w) - cut)"), " ").alias("rest"))
    known = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    score = F.expr("(cast(a as decimal(17,0)) * cast(n as decimal(17,0)) * cast(1000 as decimal(4,0))) div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))")
    worst = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    worst = worst.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = worst.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


_SQL = """
WITH RECURSIVE piece AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS piece
  FROM (SELECT lang, doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\\x0A-\\x0D]') AS p FROM documents)),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
longer AS (SELECT lang, string_split(phrase, ' ') AS w, k, f FROM f WHERE k > 2),
inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT lang, w, f, m, unnest(generate_series(1, k - m + 1)) AS i FROM longer, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k) GROUP BY ALL),
cand AS (SELECT f.lang, f.k, f.phrase, f.f AS a FROM f LEFT JOIN inside ON f.lang = inside.lang AND f.phrase = inside.phrase
         WHERE f.k > 1 AND (inside.f IS NULL OR 100 * inside.f < 100 * f.f)),
cuts AS (SELECT lang, phrase, a, c, array_to_string(string_split(phrase, ' ')[1 : c], ' ') AS p1, array_to_string(string_split(phrase, ' ')[c + 1 : k], ' ') AS p2
         FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM cand)),
scored AS (SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p1 JOIN f y ON y.lang = cuts.lang AND y.phrase = p2 JOIN total ON total.lang = cuts.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst) WHERE rank <= 2000
"""

QUERIES = {"op13_son_phrases": op13_son_phrases}
ORACLES = {"op13_son_phrases": _SQL}
