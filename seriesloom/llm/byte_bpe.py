"""Byte-level BPE by a global shuffle of distinct words, and decoding through the token-byte table.

Documents are taken in blocks. A block's texts are cut into pre-tokens; its distinct pre-tokens go, once each, to the
task that owns their hash, and the positions stay behind as a sequence of small numbers (rank by frequency in the
block). The owner of a word encodes it once, whatever the number of blocks that hold it, and sends the ids back to each
block, where they take the words' places. A word reaches its owner once per block, so no word is hot. Decoding joins
the bytes of each token id to the words' ids and puts them in the same places.

Words of one block for one owner travel in one row, in rank order, so that neither words nor ids carry positions; the
block keeps the owner of each rank. Null and empty texts have no token; repeated rows are encoded each; null doc_ids
stay null; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import chunks, id_text, table
from .packing import rank_encoding

#: Characters of a block; one longer text is a block by itself.
BLOCK_CHARS = 8_000_000
#: Owners for each shuffle partition.
OWNERS_PER_PARTITION = 4
#: Ranks below this take one byte in a block's sequence.
FREQUENT = 255

PARCELS = "key long, block long, kind int, data binary"
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _packed(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Integer arrays as byte planes, compressed; the planes of small numbers are mostly zero."""
    parts = []
    for a in arrays:
        width = a.dtype.itemsize
        parts += [np.array([len(a), width], dtype="<u8").tobytes(), np.ascontiguousarray(a).view("u1").reshape(-1, width).T.tobytes()]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def _unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for kind in kinds:
        n, width = (int(x) for x in np.frombuffer(raw, dtype="<u8", count=2, offset=at))
        planes = np.frombuffer(raw, dtype="u1", count=n * width, offset=at + 16).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += 16 + n * width
    return out


def _split(sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks below FREQUENT in one byte each, FREQUENT for any other, and the others by themselves: that packs tighter."""
    return np.minimum(sequence, FREQUENT).astype("u1"), (sequence[sequence >= FREQUENT] - FREQUENT).astype("<u4")


def _joined(frequent: np.ndarray, rare: np.ndarray) -> np.ndarray:
    sequence = frequent.astype(np.uint32)
    sequence[frequent == FREQUENT] += rare
    return sequence


def cut(texts: list[str | None], pattern) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct pre-tokens, most frequent first; rank of every pre-token; number of pre-tokens of each text)."""
    lists = [pattern.findall(t) if t else [] for t in texts]
    coded = pa.array([w for x in lists for w in x], pa.string()).dictionary_encode()
    codes = np.asarray(coded.indices, dtype=np.int64)
    order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
    rank = np.empty(len(order), dtype=np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    words = coded.dictionary.take(pa.array(order)).cast(pa.binary()).to_pylist()
    return words, rank[codes], np.array([len(x) for x in lists], dtype=np.uint32)


def _parcel(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "block", "kind", "data"])


def encode_documents(docs: DataFrame, ranks: str, owners: int | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Number of tokens, digest of the ids and digest of the decoded bytes of every document."""
    owners = owners or OWNERS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern, block = regex.compile(public_tokenizers.PATTERN), TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[str | None] = []

        def send() -> pa.RecordBatch:
            words, sequence, lengths = cut(texts, pattern)
            owner = np.array([zlib.crc32(w) % owners for w in words], dtype=np.uint32)
            rows = [(-1 - block, block, 1, _packed(np.array([i or 0 for i in ids], dtype="<i8"), np.array([i is None for i in ids], dtype="u1"), lengths, owner, *_split(sequence), level=9))]
            by_owner = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[by_owner], prepend=-1)) if len(words) else []
            for own in np.split(by_owner, cuts[1:]) if len(words) else []:
                mine = [words[i] for i in own]
                rows.append((int(owner[own[0]]), block, 0, _packed(np.array([len(w) for w in mine], dtype="<u4"), np.frombuffer(b"".join(mine), dtype="u1"))))
            return _parcel(rows)

        held = 0
        for batch in chunks(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "")
                if held >= block_chars:
                    yield send()
                    ids, texts, held, block = [], [], 0, block + 1
        if ids:
            yield send()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, owner = rank_encoding(ranks).encode_ordinary, None
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for key, block, kind, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if key != owner:
                        owner, known = key, {}
                    lengths, raw = _unpacked(data, "<u4", "u1")
                    raw, ends = raw.tobytes(), np.cumsum(lengths, dtype=np.int64).tolist()
                    found = []
                    for a, b in zip([0, *ends], ends, strict=False):
                        word = raw[a:b]
                        ids = known.get(word)
                        if ids is None:
                            ids = known[word] = encode(word.decode())
                        found.append(ids)
                    data = _packed(np.array([len(x) for x in found], dtype="<u4"), np.array([i for x in found for i in x], dtype="<u4"))
                yield _parcel([(key, block, kind, data)])

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoding(ranks)
        token_bytes: dict[int, bytes] = {}  # the token-byte table, as far as it is needed here
        block, by_owner = None, {}
        for batch in batches:
            for key, of, kind, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != block:
                    block, by_owner = of, {}
                if kind == 0:
                    by_owner[key] = data
                    continue
                doc_ids, nulls, lengths, owner, *ranked = _unpacked(data, "<i8", "u1", "<u4", "<u4", "u1", "<u4")
                sequence = _joined(*ranked)
                count, spelled, decoded = np.zeros(len(owner), dtype=np.int64), [b""] * len(owner), [b""] * len(owner)
                places = np.argsort(owner, kind="stable")
                starts = dict(zip(*np.unique(owner[places], return_index=True), strict=True)) if len(owner) else {}
                for key_of, at in starts.items():
                    sizes, ids = _unpacked(by_owner.pop(int(key_of)), "<u4", "<u4")
                    ids, ends = ids.tolist(), np.cumsum(sizes, dtype=np.int64).tolist()
                    mine = places[at : at + len(sizes)]
                    count[mine] = sizes
                    for place, a, b in zip(mine.tolist(), [0, *ends], ends, strict=False):
                        for i in ids[a:b]:
                            if i not in token_bytes:
                                token_bytes[i] = encoding.decode_single_token_bytes(i)
                        spelled[place] = b",".join(b"%d" % i for i in ids[a:b])
                        decoded[place] = b"".join(token_bytes[i] for i in ids[a:b])
                ends = np.cumsum(lengths, dtype=np.int64).tolist()
                n, shown, back = [], [], []
                for a, b in zip([0, *ends], ends, strict=False):
                    ranks_ = sequence[a:b]
                    n.append(int(count[ranks_].sum()))
                    ranks_ = ranks_.tolist()
                    shown.append(hashlib.sha256(b",".join(map(spelled.__getitem__, ranks_))).hexdigest())
                    back.append(hashlib.sha256(b"".join(map(decoded.__getitem__, ranks_))).hexdigest())
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=nulls.astype(bool)), pa.array(n, pa.int64()), pa.array(shown, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    parcels = id_text(docs).mapInArrow(explode, PARCELS)
    encoded = parcels.repartition("key").sortWithinPartitions("key", "block").mapInArrow(own, PARCELS)
    return encoded.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(reassemble, RESULT)


def op7_distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


QUERIES = {"op7_distinct_words": op7_distinct_words}
ORACLES: dict[str, str] = {}
