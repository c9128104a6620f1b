"""Token ids in binary files: one zstandard frame per document, then a document index and a seek table.

A file is a sequence of independent zstandard frames, one per document in ascending doc_id order, followed by two
skippable frames: the document index (header, then the doc_ids as 64-bit integers and their null flags) and the seek
table of the public zstandard seekable format, which has for every frame its compressed size, its size and the low 32
bits of the XXH64 of its content. A reader that wants some documents reads the tail of the file and only their frames.

Rows: a null text is an empty one and holds the end id alone; a null doc_id comes first; repeated doc_ids keep a frame
each, in the order of their texts. An empty table gives no file. Extra columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, id_text, scratch, table, written

END_ID = 1
LEVEL = 3
#: Distinct words whose ids a worker remembers; beyond it the memory starts anew. It only saves time.
REMEMBERED = 1_400_000
# Fixed values of the zstandard seekable format and of this index frame.
SEEK_MAGIC, SEEK_FOOTER, INDEX_MAGIC = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
CHECKSUMS = 0x80
INDEX_HEAD = "<4sHHQ"

MANIFEST = "part int, file string, n_docs long, n_ids long, n_bytes long, first_doc long, last_doc long"


class WordEncoder:
    """Encodes white-space separated words with the tokenizers library and remembers the ids of each.

    The library's own settings hold: a special token's string in a text gives that token's id.

    The vocabulary's normaliser and splitter never look across white space, so the ids of a text are those of its
    words in a row; tests compare with encoding whole texts.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to str.split, but not to the vocabulary
            import regex

            return regex.findall(r"\S+", text)
        return text.split()

    def learn(self, new: list[str]) -> None:
        """Encode words that are new, many in one text with a digit between them; a digit is always a piece of its own."""
        odd = [w for w in new if "0" in w]
        plain = [w for w in new if "0" not in w]
        kind = np.dtype(f"<u{self.width}")
        (zero,) = self.tokenizer.encode("0", add_special_tokens=False).ids
        texts = [plain[at : at + 256] for at in range(0, len(plain), 256)]
        for words, found in zip(texts, self.tokenizer.encode_batch_fast([" 0 ".join(x) for x in texts], add_special_tokens=False), strict=True):
            raw = np.array(found.ids, dtype=kind).tobytes()
            ids = np.frombuffer(raw, dtype=kind)
            cuts = (np.flatnonzero(ids == zero) * self.width).tolist()
            starts = [0] + [c + self.width for c in cuts]
            self.known.update((w, raw[a:b]) for w, a, b in zip(words, starts, [*cuts, len(raw)], strict=True))
        for w in odd:
            self.known[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, dtype=kind).tobytes()

    def learn_all(self, new: set[str]) -> None:
        """A letter followed by one full stop or comma splits there, so such a word is learnt without it.

        That is asked of the lower-cased letter, since a dotted capital I ends in a mark, which the comma then joins; and
        only below U+0530, where no version of Unicode disagrees on what a letter is.
        """
        ends = {w for w in new if len(w) > 1 and w[-1] in ".," and w[-2] < "\u0530" and w[-2].lower().isalpha()}
        stems = (new - ends) | {w[:-1] for w in ends} | {".", ","} if ends else new
        self.learn([w for w in stems if w not in self.known])
        known = self.known
        known.update((w, known[w[:-1]] + known[w[-1]]) for w in ends)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian integers of `width` bytes."""
        split = [self.words(t) if t else [] for t in texts]
        new = set().union(*(set(w).difference(self.known) for w in split))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set().union(*map(set, split))
        if new:
            self.learn_all(new)
        return [b"".join(map(self.known.__getitem__, w)) for w in split]


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(vocabulary: str) -> WordEncoder:
    """One for each worker process, shared by its tasks."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]


class FrameWriter:
    """Writes one file; close() adds the index and the seek table."""

    def __init__(self, sink, width: int):
        self.sink, self.width = sink, width
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.entries, self.ids, self.nulls, self.n_ids, self.n_bytes = bytearray(), [], bytearray(), 0, 0

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.n_bytes += len(data)

    def add(self, doc_id: int | None, raw: bytes) -> None:
        frame = self.packer.compress(raw)
        self._put(frame)
        self.entries += struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.n_ids += len(raw) // self.width

    def close(self) -> None:
        index = struct.pack(INDEX_HEAD, b"TOKS", 1, self.width, len(self.ids))
        index += np.array(self.ids, dtype="<i8").tobytes() + bytes(self.nulls)
        self._put(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.entries += struct.pack("<III", len(index) + 8, 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF)
        table = bytes(self.entries) + struct.pack("<IBI", len(self.ids) + 1, CHECKSUMS, SEEK_FOOTER)
        self._put(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class FrameReader:
    """Reads a file by its tail; document(i) reads and decompresses one frame."""

    def __init__(self, source):
        self.source, size = source, source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_FOOTER or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums")
        table = self._at(size - 9 - 12 * count, 12 * count)
        self.sizes = np.frombuffer(table, dtype="<u4").reshape(-1, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0], dtype=np.int64)))
        index = self._at(int(self.starts[-2]) + 8, int(self.sizes[-1, 0]) - 8)
        self._check(index, count - 1)
        kind, _, self.width, n = struct.unpack_from(INDEX_HEAD, index)
        if kind != b"TOKS" or n != count - 1:
            raise ValueError("not an index of token ids")
        head = struct.calcsize(INDEX_HEAD)
        self.doc_ids = np.frombuffer(index, dtype="<i8", count=n, offset=head)
        self.nulls = np.frombuffer(index, dtype="u1", count=n, offset=head + 8 * n).astype(bool)
        self.packer = zstandard.ZstdDecompressor()

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def _check(self, raw: bytes, i: int) -> None:
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != int(self.sizes[i, 2]):
            raise ValueError(f"frame {i} has a wrong checksum")

    def __len__(self) -> int:
        return len(self.doc_ids)

    def document(self, i: int) -> np.ndarray:
        frame = self._at(int(self.starts[i]), int(self.sizes[i, 0]))
        raw = self.packer.decompress(frame, max_output_size=max(1, int(self.sizes[i, 1])))
        self._check(raw, i)
        return np.frombuffer(raw, dtype=f"<u{self.width}")


def write_token_files(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Encode and write all documents below `path`; returns the manifest, one row per file in doc_id order.

    A task writes a file named by its partition and attempt; the manifest is itself a table below `path` and names
    the files of the attempts that succeeded, so files of lost attempts are never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out = TaskContext.get(), None
        encoder = word_encoder(vocabulary)
        end = int(end_id).to_bytes(encoder.width, "little")
        store, root = pafs.FileSystem.from_uri(path)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.ids.zst"
        for batch in chunks(batches):
            if out is None:
                store.create_dir(f"{root}/files", recursive=True)
                sink = store.open_output_stream(f"{root}/files/{name}", compression=None)
                out = FrameWriter(sink, encoder.width)
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                out.add(doc_id, raw + end)
        if out is not None:
            out.close()
            sink.close()
            known = [i for i, null in zip(out.ids, out.nulls, strict=True) if not null]
            row = [task.partitionId(), f"{path}/files/{name}", len(out.ids), out.n_ids, out.n_bytes, known[0] if known else None, known[-1] if known else None]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.string()] + [pa.int64()] * 5, strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])

    ordered = id_text(docs).repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _frames(file: str) -> FrameReader:
    store, place = pafs.FileSystem.from_uri(file)
    return FrameReader(store.open_input_file(place))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    Every frame is read through the seek table and its checksum is verified. `start` needs one running sum over the
    manifest, which has a row per file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                frames, lengths, sums = _frames(file), [], []
                for i in range(len(frames)):
                    ids = frames.document(i)
                    lengths.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                lengths = np.array(lengths, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(frames.doc_ids, mask=frames.nulls), pa.array(before + np.cumsum(lengths) - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = manifest.count()
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return manifest.select("file", before.cast("long").alias("before")).repartition(max(1, files)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch_documents(manifest: DataFrame, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of the documents asked for; only their files are opened and only their frames decompressed."""
    wanted = np.unique(np.array(doc_ids, dtype=np.int64))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                frames = _frames(file)
                at = np.flatnonzero(np.isin(frames.doc_ids, wanted) & ~frames.nulls)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(frames.doc_ids[at]), pa.array([frames.document(i).astype(np.int64) for i in at], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    hit = F.lit(False)
    if len(wanted):
        hit = (F.col("last_doc") >= int(wanted[0])) & (F.col("first_doc") <= int(wanted[-1]))
    return manifest.where(hit).select("file").mapInArrow(fetch, "doc_id long, ids array<long>")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents in the file format and reads the files back."""
    path = scratch(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return read_token_files(manifest)


QUERIES = {"op1_token_files": op1_token_files}
ORACLES: dict[str, str] = {}
