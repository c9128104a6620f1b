"""Vector codes by per-dimension value dictionaries.

A component x becomes the integer floor(4096 * x), and a vector is cut into 8 equal parts with a codebook of 16 entries
each. Vectors are written once as blocks: for every dimension the block's distinct integers in order (its dictionary)
and for every vector the places of its components in them. To compare a block with the codebooks, the squared
difference of each distinct integer to the component of each entry is tabulated; the distance of a part is then the sum
of the table rows that its dictionary codes point to. A round of Lloyd's method is one job over the blocks: a task adds
up how often each entry took each dictionary code, turns this into sums, and hands on at most one row per entry and
component; the driver receives the codebooks, whose size depends on the dimension alone.

All arithmetic is whole-numbered. 64-bit integers serve blocks whose distances fit, Python's integers all others, and
sums travel in limbs of 32 bits, so that finite components of any size give exact codebooks.

Rows: vectors that are null or hold a null or a component that is not finite take no part. Vectors of one length share
codebooks; those of another length have their own, and where 8 does not divide the length, parts differ by one
component (no components: every distance is 0). Fewer than 16 vectors give as many entries. Among equal vec_ids the
lesser vector comes first, a null vec_id last. Repeated rows are coded each. label_error adds over equal labels of all
lengths, nulls together. An error beyond 64 bits is null. An empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NAMED, drop, table, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of a block; a table of squared differences then has at most so many rows per dimension.
BLOCK_ROWS = 8192
LIMB = 32
LONG = 1 << 63

BLOCKS = "dims int, n int, ids binary, id_nulls binary, labels binary, label_nulls binary, dictionaries binary, codes binary"
SUMS = "dims int, part int, entry int, place int, limb int, value long"
CODES = "vec_id long, label long, dims int, code string, error long"


def part_bounds(dims: int, parts: int = PARTS) -> list[int]:
    return [dims * p // parts for p in range(parts + 1)]


# ---- blocks ----------------------------------------------------------------
def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite numbers: 64-bit integers where they fit, else Python's."""
    low = np.floor(values * float(SCALE)) if not len(values) or np.abs(values).max() < 1e300 else np.full(1, np.inf)
    if not len(low) or np.abs(low).max() < float(1 << 62):
        return low.astype(np.int64)
    exact = np.empty(len(values), dtype=object)
    for i, v in enumerate(values.tolist()):  # a power of two: exact in whole numbers too
        top, bottom = v.as_integer_ratio()
        exact[i] = top * SCALE // bottom
    return exact


def _numbers_out(values: np.ndarray) -> bytes:
    if values.dtype == object:
        return b"t" + ",".join(map(str, values.tolist())).encode()
    return b"q" + values.astype("<i8").tobytes()


def _numbers_in(data: bytes) -> np.ndarray:
    if data[:1] == b"q":
        return np.frombuffer(data, dtype="<i8", offset=1)
    return np.array([int(x) for x in data[1:].decode().split(",")], dtype=object)


def _lengths(values: list[bytes]) -> bytes:
    return np.array([len(values), *map(len, values)], dtype="<i8").tobytes() + b"".join(values)


def _parts(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, dtype="<i8", count=1)[0])
    ends = np.cumsum(np.frombuffer(data, dtype="<i8", count=n, offset=8)) + 8 * (n + 1)
    return [data[a:b] for a, b in zip([8 * (n + 1), *ends.tolist()], ends.tolist(), strict=False)]


def _block(dims: int, ids: pa.Array, labels: pa.Array, vectors: np.ndarray) -> pa.RecordBatch:
    n, dictionaries, codes = len(ids), [], []
    for d in range(dims):
        found, places = np.unique(vectors[:, d], return_inverse=True)
        dictionaries.append(_numbers_out(found))
        codes.append(places.astype("<u2").tobytes())  # at most BLOCK_ROWS distinct integers
    pack = zstandard.ZstdCompressor(level=1).compress
    plain = [np.asarray(pc.fill_null(x, 0)).astype("<i8").tobytes() for x in (ids, labels)]
    nulls = [np.asarray(pc.is_null(x)).tobytes() for x in (ids, labels)]
    row = [dims, n, plain[0], nulls[0], plain[1], nulls[1], pack(_lengths(dictionaries)), pack(b"".join(codes))]
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=[x.split()[0] for x in BLOCKS.split(", ")])


def blocks(rows: DataFrame) -> DataFrame:
    """Dictionary-coded blocks of (vec_id, label, vector of doubles); vectors of one length share a block."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                vectors, sizes = piece.column("vector"), np.asarray(pc.list_value_length(piece.column("vector")))
                for dims in np.unique(sizes).tolist():
                    mine = pa.array(sizes == dims)
                    flat = np.asarray(vectors.filter(mine).flatten(), dtype=np.float64)
                    ids, labels = piece.column("vec_id").filter(mine), piece.column("label").filter(mine)
                    yield _block(dims, ids, labels, whole_numbers(flat).reshape(len(ids), dims))

    return rows.mapInArrow(build, BLOCKS)


class Block:
    """A block read again: dictionaries and the matrix of their codes."""

    def __init__(self, row: dict):
        self.dims, self.n = row["dims"], row["n"]
        unpack = zstandard.ZstdDecompressor().decompress
        self.dictionaries = [_numbers_in(x) for x in _parts(unpack(row["dictionaries"]))]
        self.codes = np.frombuffer(unpack(row["codes"]), dtype="<u2").reshape(self.dims, self.n) if self.dims else np.zeros((0, self.n), dtype="<u2")

    def distances(self, books: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """(part, squared distance of each vector's part to each entry): tables of differences, gathered and added."""
        bounds = part_bounds(self.dims, len(books))
        for p, book in enumerate(books):
            total = None
            widest = max([1, *(abs(int(v)) for d in range(bounds[p], bounds[p + 1]) for v in (self.dictionaries[d][0], self.dictionaries[d][-1], *book[:, d - bounds[p]].tolist()))])
            small = 4 * widest * widest * max(1, bounds[p + 1] - bounds[p]) < LONG
            for d in range(bounds[p], bounds[p + 1]):
                values, entries = self.dictionaries[d], book[:, d - bounds[p]]
                kind = np.int64 if small else object
                squares = (values.astype(kind)[:, None] - entries.astype(kind)[None, :]) ** 2
                part = squares[self.codes[d]]
                total = part if total is None else total + part
            yield p, np.zeros((self.n, len(book)), dtype=np.int64) if total is None else total


# ---- codebooks ---------------------------------------------------------------
def _limbs(value: int) -> list[int]:
    """Signed whole number as limbs of 32 bits, the last one signed."""
    out = []
    while not -(1 << (LIMB - 1)) <= value < 1 << (LIMB - 1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _round(stored: DataFrame, books: dict[int, list[np.ndarray]]) -> dict[int, list[np.ndarray]]:
    """Codebooks after one round: every entry becomes the floored mean of the parts nearest to it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, int] = defaultdict(int)
        for batch in batches:
            for row in batch.to_pylist():
                block, mine = Block(row), books[row["dims"]]
                bounds = part_bounds(block.dims, len(mine))
                for p, distance in block.distances(mine):
                    nearest, k = distance.argmin(axis=1), len(mine[p])
                    for e, count in enumerate(np.bincount(nearest, minlength=k).tolist()):
                        if count:
                            sums[block.dims, p, e, -1] += count
                    for d in range(bounds[p], bounds[p + 1]):
                        values = block.dictionaries[d]
                        used = np.bincount(nearest * len(values) + block.codes[d], minlength=k * len(values)).reshape(k, -1)
                        wide = values.dtype == object or max(abs(int(values[0])), abs(int(values[-1]))) >= 1 << 48
                        total = used.astype(object).dot(values.astype(object)) if wide else used @ values
                        for e, t in enumerate(total.tolist()):
                            if t:
                                sums[block.dims, p, e, d - bounds[p]] += t
        rows = [(*key, i, limb) for key, total in sums.items() for i, limb in enumerate(_limbs(total))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] * 5 + [pa.int64()], strict=True)],
                                             names=[x.split()[0] for x in SUMS.split(", ")])

    keys = ["dims", "part", "entry", "place", "limb"]
    totals: dict[tuple, int] = defaultdict(int)
    # One row per entry and component of the codebooks, whatever the number of vectors.
    for r in stored.mapInArrow(add, SUMS).groupBy(*keys).agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        totals[r["dims"], r["part"], r["entry"], r["place"]] += int(r["value"]) << (LIMB * r["limb"])
    out = {}
    for dims, mine in books.items():
        out[dims] = []
        for p, book in enumerate(mine):
            fresh = book.astype(object)
            for e in range(len(book)):
                count = totals.get((dims, p, e, -1), 0)
                if count:
                    fresh[e] = [totals.get((dims, p, e, j), 0) // count for j in range(book.shape[1])]
            out[dims].append(fresh)
    return out


def _fitting(books: dict[int, list[np.ndarray]]) -> dict[int, list[np.ndarray]]:
    """Entries as 64-bit integers where all of a book fit."""
    return {d: [b.astype(np.int64) if not b.size or max(abs(int(x)) for x in b.flat) < LONG >> 1 else b for b in mine] for d, mine in books.items()}


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> dict[int, list[np.ndarray]]:
    """For each length of vectors the parts of those with the least vec_ids."""
    lengths = [r[0] for r in rows.select(F.size("vector")).distinct().collect()]
    books = {}
    for dims in lengths:  # as a rule one length
        least = rows.where(F.size("vector") == dims).orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
        start = whole_numbers(np.array([r[0] for r in least], dtype=np.float64).reshape(-1)).reshape(len(least), dims)
        bounds = part_bounds(dims, parts)
        books[dims] = [start[:, a:b] for a, b in zip(bounds, bounds[1:])]
    return books


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.flat).encode()).hexdigest()


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows whose vector is there and finite throughout."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & ~odd)


def train(stored: DataFrame, books: dict[int, list[np.ndarray]], rounds: int = ROUNDS) -> dict[int, list[np.ndarray]]:
    for _ in range(rounds):
        books = _fitting(_round(stored, _fitting(books)))
    return _fitting(books)


def encode(stored: DataFrame, books: dict[int, list[np.ndarray]]) -> DataFrame:
    """vec_id, label, dims, code (two hex digits a part) and error of every stored vector."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{i:02x}" for i in range(256)], dtype="S2")
        for batch in batches:
            for row in batch.to_pylist():
                block, mine = Block(row), books[row["dims"]]
                codes, error = np.zeros((block.n, len(mine)), dtype="S2"), [0] * block.n
                parts = []
                for p, distance in block.distances(mine):
                    nearest = distance.argmin(axis=1)
                    codes[:, p] = digits[nearest]
                    parts.append(distance[np.arange(block.n), nearest])
                exact = any(x.dtype == object or int(x.max(initial=0)) >= LONG // len(mine) for x in parts)
                error = sum(x.astype(object) if exact else x for x in parts)
                error = [e if e < LONG else None for e in error.tolist()]
                ids, labels = (pa.array(np.frombuffer(row[c], dtype="<i8"), mask=np.frombuffer(row[m], dtype=bool)) for c, m in (("ids", "id_nulls"), ("labels", "label_nulls")))
                code = [c.decode() for c in codes.view(f"S{2 * len(mine)}").reshape(-1).tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([block.dims] * block.n, pa.int32()), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                                                 names=["vec_id", "label", "dims", "code", "error"])

    return stored.mapInArrow(assign, CODES)


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 and label of every vector that takes part."""
    spark = vectors.sparkSession
    rows = kept_vectors(vectors)
    stored = written(blocks(rows), "vector-blocks")
    folder = NAMED[-1]
    books = train(stored, first_books(rows, parts, entries), rounds)
    coded = written(encode(stored, books), "codes")
    drop(spark, [folder])
    # Tables of their own, so that adaptive execution can split the join at a label that many vectors share.
    sums = written(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "label-errors")
    digests = spark.createDataFrame([(d, books_digest(b)) for d, b in sorted(books.items())], "dims int, codebooks_sha256 string")
    named = coded.join(sums.withColumnRenamed("label", "of_label"), F.col("label").eqNullSafe(F.col("of_label")), "left").join(digests, "dims")
    return named.select("vec_id", "code", "error", "label_error", "codebooks_sha256", "label")


def op12_value_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings after six rounds over all of them."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same rounds one after the other, with plain distances; for vectors of one length that 8 divides."""
    def assigned(book: str) -> str:
        distance = "list_sum(list_transform(list_zip(part.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        return (f"SELECT part.vec_id, part.label, part.p, part.v, min({distance}) AS d, arg_min(b.e, {{'d': {distance}, 'e': b.e}}) AS e "
                f"FROM part JOIN {book} b ON part.p = b.p GROUP BY ALL")

    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, embedding AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0)",
        f"part AS MATERIALIZED (SELECT vec_id, label, p, list_transform(x[p * len(x) // {PARTS} + 1 : (p + 1) * len(x) // {PARTS}], lambda y: floor({SCALE}.0 * y::DOUBLE)::BIGINT) AS v FROM kept, range({PARTS}) t(p))",
        f"b0 AS MATERIALIZED (SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM part) WHERE e < {ENTRIES})",
    ]
    for i in range(ROUNDS):
        steps.append(f"a{i} AS MATERIALIZED ({assigned(f'b{i}')})")
        steps.append(
            f"b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j)::BIGINT[] AS v FROM "
            f"(SELECT p, e, j, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY p, e, j) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)")
    steps.append(f"last AS MATERIALIZED ({assigned(f'b{ROUNDS}')})")
    steps.append("digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b%d)" % ROUNDS)
    steps.append("coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM last GROUP BY vec_id, label)")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256, label::BIGINT AS label FROM coded, digest"


QUERIES = {"op12_value_dictionaries": op12_value_dictionaries}
ORACLES = {"op12_value_dictionaries": _sql()}
