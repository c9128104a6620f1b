"""Quality rules by tokeniser fertility: characters per token, byte-fallback share and token entropy of every document.

A public vocabulary with byte fallback cuts each word into pieces. Text unlike its language needs more pieces for a
word, falls back to bytes, or spends its tokens on few pieces. What is normal depends on the language and, for the
entropy, on the length, so there is one band per (language, length class): median and median absolute deviation over
all documents that pass the base rules, documents with the same figures counting once so that copies don't set a band.
Where a class has too few documents, the first of these bands that has enough holds: its length over all languages, the
nearest length class of the language (at most NEAR classes away), the nearest over all languages, the language over all
lengths, all documents however few. Entropy grows with length, so a band that stands in judges it only for documents of
its (median) length class or longer. Where no band of the language itself holds, the byte-fallback share has an
absolute bound besides.

Words are `[^\\x20\\x09-\\x0D]+`. Nulls and empty texts have no words and fail the base rule. A null language is one of
its own. Repeated rows are judged alike. An empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, table, windows, word_codes, written

WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
SYMBOLS = r"[#*$%&|<>]"
#: Bands in deviations from the median; None is open. The least deviation keeps a band from closing around alike texts.
CHARS_BAND, ENTROPY_BAND = (-8.0, 8.0), (-3.0, None)
#: A text below both is rejected as well.
BOTH_BELOW = (-2.5, -2.0)
LEAST_CHARS_DEV, LEAST_ENTROPY_DEV = 0.045, 0.12
#: Byte-fallback share above the median.
MAX_BYTES_ABOVE = 0.2
#: Byte-fallback share of a document whose language has no band of its own.
MAX_BYTES = 0.5
MIN_GROUP = 30
#: Length classes (half octaves) to a band that stands in.
NEAR = 2
#: Distinct words whose pieces a worker remembers; it only saves time.
REMEMBERED = 500_000

FIGURES = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, n_byte_tokens long, entropy double"


def repeated_words(codes: np.ndarray, starts: np.ndarray, k: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of k words which occurs twice or more in the text."""
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = np.arange(len(codes)) + k <= starts[1:][text] if len(codes) else np.zeros(0, bool)
    hashes = windows(codes, k) ^ windows(text, 1) if len(codes) else np.zeros(0, np.uint64)
    order = np.sort(hashes[inside])
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    covered = np.zeros(len(codes) + 1, dtype=np.int64)
    if len(twice):
        at = np.flatnonzero(inside & np.isin(hashes, twice))
        np.add.at(covered, at, 1)
        np.add.at(covered, at + k, -1)
    total = np.concatenate(([0], np.cumsum(np.cumsum(covered)[:-1] > 0)))
    return total[starts[1:]] - total[starts[:-1]]


def dup_lines(text: str | None) -> int:
    """Lines with a word that are equal to an earlier line."""
    seen, n = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\v\f\r"):
            n += line in seen
            seen.add(line)
    return n


class Pieces:
    """Ids of single words in a sentencepiece vocabulary, remembered."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.known: dict[str, bytes] = {}

    def of(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = words
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            self.known.update((w, np.array(ids, dtype="<u4").tobytes()) for w, ids in zip(part, self.model.encode(part, num_threads=1), strict=True))
        return [self.known[w] for w in words]


_PIECES: dict[str, Pieces] = {}


def token_figures(codes: np.ndarray, words: pa.Array, starts: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, byte tokens, entropy in bits of the tokens) of each text."""
    found = pieces.of(words.to_pylist())
    size = np.array([len(x) // 4 for x in found], dtype=np.int64)
    ids, first = np.frombuffer(b"".join(found), dtype="<u4").astype(np.int64), np.concatenate(([0], np.cumsum(size)))[:-1]
    per_word = size[codes]
    ends = np.concatenate(([0], np.cumsum(per_word)))
    stream = ids[np.repeat(first[codes] - ends[:-1], per_word) + np.arange(ends[-1])]
    bounds = ends[starts]
    n = np.diff(bounds)
    byte_total = np.concatenate(([0], np.cumsum(pieces.is_byte[stream])))
    text = np.repeat(np.arange(len(n)), n)
    keys, count = np.unique(text * len(pieces.is_byte) + stream, return_counts=True)
    share = count / n[keys // len(pieces.is_byte)]
    entropy = np.bincount(keys // len(pieces.is_byte), weights=-share * np.log2(share), minlength=len(n))
    return n, byte_total[bounds[1:]] - byte_total[bounds[:-1]], np.round(entropy.astype(np.float64), 3)


def document_figures(docs: DataFrame, model: str) -> DataFrame:
    """Base counts and token figures of every document, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _PIECES.setdefault(model, None) or Pieces(model)
        _PIECES[model] = pieces
        for batch in chunks(batches):
            texts = pc.fill_null(batch.column("text"), "")
            codes, words, starts = word_codes(texts)
            chars = np.concatenate(([0], np.cumsum(np.asarray(pc.utf8_length(words), dtype=np.int64)[codes])))
            n, n_bytes, entropy = token_figures(codes, words, starts, pieces)
            columns = [
                batch.column("doc_id"), batch.column("lang"), np.diff(starts), chars[starts[1:]] - chars[starts[:-1]],
                pc.count_substring_regex(texts, SYMBOLS), np.array([dup_lines(t) for t in texts.to_pylist()]),
                repeated_words(codes, starts), n, n_bytes,
            ]
            arrays = [x if isinstance(x, pa.Array) and x.type in (pa.int64(), pa.string()) else pa.array(np.asarray(x), pa.int64()) for x in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(entropy)], names=[x.split()[0] for x in FIGURES.split(", ")])

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    return source.mapInArrow(run, FIGURES)


#: The groupings that have a band: a language's length class, a length class, a language, all documents; and the least cells of each.
LEVELS = {"own": (["lang", "length_class"], MIN_GROUP), "any": (["length_class"], MIN_GROUP), "language": (["lang"], MIN_GROUP), "all": ([], 1)}
LEVEL_KEY = ["level", "at_lang", "at_class"]
MIDDLES = ["chars_mid", "entropy_mid", "byte_share_mid", "chars_dev", "entropy_dev"]


def _levelled(rows: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Each row once for every level, with its key there: level, at_lang and, where the keys name it, at_class (null elsewhere)."""
    each = [
        F.struct(
            F.lit(level).alias("level"), (F.col("lang") if "lang" in names else F.lit(None).cast("string")).alias("at_lang"),
            (F.col("length_class") if "length_class" in names else F.lit(None).cast("int")).alias("at_class"),
        )
        for level, names in keys.items()
    ]
    return rows.select("*", F.inline(F.array(*each)))


def _bands(cells: DataFrame) -> DataFrame:
    """level, at_lang, at_class, at_mid (median length class) and band: median and least-bounded deviation of the figures in
    each group of each level that has enough cells. It has a row for each language and length class at most."""
    figures = ["chars", "entropy", "byte_share"]
    each = _levelled(cells, {level: names for level, (names, _) in LEVELS.items()})
    middle = each.groupBy(*LEVEL_KEY).agg(*(F.percentile(c, F.lit(0.5)).alias(f"{c}_mid") for c in [*figures, "length_class"]), F.count("*").alias("n"))
    least_cells = F.create_map(*(F.lit(x) for level, (_, least) in LEVELS.items() for x in (level, least)))
    middle = written(middle.where(F.col("n") >= least_cells[F.col("level")]).drop("n").withColumnsRenamed({k: f"{k}_" for k in LEVEL_KEY}), "quality-middles")
    dev = [F.round(F.abs(F.col(c) - F.col(f"{c}_mid")), 3) for c in figures]
    # One level is a single group, so its rows must not be shuffled to their median: the medians go to the rows.
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in LEVEL_KEY]
    wide = each.join(F.broadcast(middle), same).groupBy(*LEVEL_KEY, *(f"{c}_mid" for c in [*figures, "length_class"])).agg(
        *(F.percentile(d, F.lit(0.5)).alias(f"{c}_dev") for c, d in zip(figures, dev, strict=True))
    )
    least = {"chars": LEAST_CHARS_DEV, "entropy": LEAST_ENTROPY_DEV}
    wide = wide.withColumns({f"{c}_dev": F.greatest(F.col(f"{c}_dev") * F.lit(1.4826), F.lit(v)) for c, v in least.items()})
    return written(wide.select(*LEVEL_KEY, F.col("length_class_mid").alias("at_mid"), F.struct(*MIDDLES).alias("band")), "quality-bands")


def _outside(z: Column, band: tuple[float | None, float | None]) -> Column:
    low, high = band
    return (F.lit(False) if low is None else z < F.lit(low)) | (F.lit(False) if high is None else z > F.lit(high))


def judge(docs: DataFrame, model: str) -> DataFrame:
    """All documents with their counts, their figures, base_failed and kept."""
    per_token = F.col("n_tokens").cast("double")
    figures = document_figures(docs, model).select(
        "*", ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.when(per_token > 0, F.round(F.col("word_chars") / per_token, 3)).alias("chars"),
        F.when(per_token > 0, F.round(F.col("n_byte_tokens") / per_token, 3)).alias("byte_share"),
        F.when(per_token > 0, F.floor(2 * F.log2(per_token)).cast("int")).alias("length_class"),
    )
    figures = written(figures, "quality")
    cells = figures.where(~F.col("base_failed")).select("lang", "length_class", "n_tokens", "chars", "entropy", "byte_share").distinct()
    bands = _bands(written(cells.select("lang", "length_class", "chars", "entropy", "byte_share"), "quality-cells"))
    # A row for each language and length class: which bands there are. These tables do not grow with the documents.
    groups = figures.where("length_class IS NOT NULL").select("lang", "length_class").distinct()
    found = _levelled(groups, {level: [k for k in names if k == "lang"] for level, (names, _) in LEVELS.items()}).drop("at_class")
    named = bands.select(F.col("level").alias("of"), F.col("at_lang").alias("of_lang"), "at_class", "at_mid", "band")
    found = found.join(F.broadcast(named), (F.col("level") == F.col("of")) & F.col("at_lang").eqNullSafe(F.col("of_lang")), "left")
    is_own, is_any = F.col("of") == "own", F.col("of") == "any"
    away = F.abs(F.col("at_class") - F.col("length_class"))

    def here(level: str, what: str = "band", at: Column | None = None) -> Column:
        return F.max(F.when((F.col("of") == level) & (F.lit(True) if at is None else at), F.col(what)))

    def nearest(level: Column) -> Column:
        return F.min_by(F.when(level & (away <= NEAR), F.struct("band", F.col("at_class").alias("at"))), F.when(level, F.struct(away, F.col("at_class"))))

    groups = found.groupBy("lang", "length_class").agg(
        here("own", at=away == 0).alias("own"), here("any", at=away == 0).alias("any"), nearest(is_own).alias("near_own"), nearest(is_any).alias("near_any"),
        here("language").alias("lang_band"), here("language", "at_mid").alias("lang_mid"), here("all").alias("all_band"), here("all", "at_mid").alias("all_mid"),
    )
    # The length class that the band stands for; a document shorter than that has less entropy anyway.
    stands_for = F.when(F.coalesce("own", "any").isNotNull(), F.col("length_class")).otherwise(
        F.coalesce("near_own.at", "near_any.at", F.when(F.col("lang_band").isNotNull(), F.col("lang_mid")), "all_mid"))
    groups = groups.select(
        F.col("lang").alias("band_lang"), F.col("length_class").alias("band_class"), (F.col("length_class") < stands_for).alias("no_entropy"),
        F.coalesce("own", "near_own.band", "lang_band").isNull().alias("strange"), F.coalesce("own", "any", "near_own.band", "near_any.band", "lang_band", "all_band").alias("band"),
    )
    joined = figures.join(F.broadcast(groups), F.col("lang").eqNullSafe(F.col("band_lang")) & (F.col("length_class") == F.col("band_class")), "left")
    band = {c: F.col(f"band.{c}") for c in MIDDLES}
    z_chars = (F.col("chars") - band["chars_mid"]) / band["chars_dev"]
    z_entropy = F.when(~F.col("no_entropy"), (F.col("entropy") - band["entropy_mid"]) / band["entropy_dev"])
    reasons = [
        _outside(z_chars, CHARS_BAND), _outside(z_entropy, ENTROPY_BAND), (z_chars < BOTH_BELOW[0]) & (z_entropy < BOTH_BELOW[1]),
        F.col("byte_share") - band["byte_share_mid"] > MAX_BYTES_ABOVE, F.coalesce(F.col("strange"), F.lit(True)) & (F.col("byte_share") > MAX_BYTES),
    ]
    rejected = F.greatest(*reasons)  # a reason that cannot be judged is null and passed over
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(rejected, F.lit(False))).alias("kept"),
        F.col("chars").alias("chars_per_token"), "byte_share", "entropy",
    )


def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op3_fertility": op3_fertility}
ORACLES: dict[str, str] = {}
