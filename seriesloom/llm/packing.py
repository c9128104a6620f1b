"""Packing by minimum bin slack: each window takes the multiset of remaining lengths that comes closest to its capacity.

Documents longer than a window give whole windows; what remains of each has a length below the capacity. A window
starts with the longest remaining piece; a subset-sum over a bit set (one bit per sum, lengths with their counts) finds
the fullest filling of the rest, and the sums kept before each length give the counts back. Only if no multiset fills a
window, the shortest remaining piece is cut to close the slack. What is left at the end of a block has no partner: it is
cut into sequences whose lengths are powers of two, which take no padding.

A block is a run of documents inside one partition of the input, so nothing is shuffled and a task holds the ids of one
block. Sequence ids carry the partition in their upper bits and have gaps. A null text is an empty one and holds the
end id alone; repeated rows are packed as often as they occur; an empty table gives no piece; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import chunks, id_text, table

CAPACITY, END_ID = 2048, 1
#: The vocabulary's only special token (fixed value); its string in a text gives its id, as in the tokenizers library.
END_TEXT = "<|endoftext|>"
#: Tokens of a block; a longer document is a block by itself.
BLOCK_TOKENS = 2_000_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def closest(target: int, counts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(length, how many) of the multiset whose sum is as near below `target` as it can be. counts: longest first."""
    full, reach, steps = (1 << (target + 1)) - 1, 1, []
    for length, n in counts:
        if length > target:
            continue
        steps.append((length, reach))
        n, take = min(n, target // length), 1
        while n > 0:  # 1, 2, 4 … copies together give every count up to n
            take = min(take, n)
            reach |= (reach << (take * length)) & full
            n -= take
            take *= 2
        if reach >> target & 1:
            break
    at, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        k = 0
        while not before >> at & 1:
            at -= length
            k += 1
        if k:
            chosen.append((length, k))
    return chosen


def pack(tokens: list[int], capacity: int = CAPACITY) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold each of the documents' tokens once."""
    rest: dict[int, list[tuple[int, int]]] = {}
    for i, n in enumerate(tokens):
        for at in range(0, n - n % capacity, capacity):
            yield [(i, at, capacity)]
        if n % capacity:
            rest.setdefault(n % capacity, []).append((i, n - n % capacity))
    order = sorted(rest, reverse=True)
    left = sum(length * len(x) for length, x in rest.items())

    def take(length: int, k: int) -> list[tuple[int, int, int]]:
        got = [(*rest[length].pop(), length) for _ in range(k)]
        if not rest[length]:
            del rest[length]
            order.remove(length)
        return got

    while left >= capacity:
        sequence = take(order[0], 1)
        for length, k in closest(capacity - sequence[0][2], [(x, len(rest[x])) for x in order]):
            sequence += take(length, k)
        slack = capacity - sum(x[2] for x in sequence)
        if slack:  # every remaining piece is longer than the slack
            doc, at, length = take(order[-1], 1)[0]
            sequence.append((doc, at, slack))
            if length - slack not in rest:
                rest[length - slack] = []
                order.append(length - slack)
                order.sort(reverse=True)
            rest[length - slack].append((doc, at + slack))
        left -= capacity
        yield sequence
    tail = [x for length in list(order) for x in take(length, len(rest[length]))]
    while left:
        size = room = 1 << (left.bit_length() - 1)
        sequence = []
        while room:
            doc, at, length = tail.pop()
            sequence.append((doc, at, min(room, length)))
            if length > room:
                tail.append((doc, at + room, length - room))
            room -= min(room, length)
        left -= size
        yield sequence


_ENCODINGS: dict[str, object] = {}


def rank_encoding(ranks: str):
    """A tiktoken encoding over a rank file, one for each worker process; the id after the last rank ends texts."""
    if ranks not in _ENCODINGS:
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[ranks] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={END_TEXT: len(table)})
    return _ENCODINGS[ranks]


def pack_documents(docs: DataFrame, ranks: str, capacity: int = CAPACITY, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of all documents: where each lies in its document and in its sequence, and the checksum of its ids.

    `ranks` is the rank file of the byte-level vocabulary; its ids are those of the vocabulary's own file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(rank_encoding(ranks).encode, allowed_special={END_TEXT}, disallowed_special=())
        base, ids, arrays, held = TaskContext.get().partitionId() << 36, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base
            rows: list[tuple] = []
            for sequence in pack([len(a) for a in arrays], capacity):
                offset = 0
                for i, at, length in sequence:
                    rows.append((ids[i], at, length, zlib.crc32(arrays[i][at : at + length].tobytes()), len(arrays[i]), base, offset))
                    offset += length
                base += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

        for batch in chunks(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(doc_id)
                arrays.append(np.array([*encode(text or ""), end_id], dtype="<u4"))
                held += len(arrays[-1])
                if held >= block_tokens:
                    yield from flush()
                    ids, arrays, held = [], [], 0
        yield from flush()

    return id_text(docs).mapInArrow(run, PIECES)


def op10_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


QUERIES = {"op10_bin_slack": op10_bin_slack}
ORACLES: dict[str, str] = {}
