"""Token ids in seekable zstandard files.

File format (the public seekable format, with a document index before the seek table):

    frame 0, frame 1, ...   independent zstandard frames with content checksums; each holds the ids
                            of whole consecutive documents, little-endian, 2 or 4 bytes an id
    document index          skippable frame 0x184D2A5D: one byte for the bytes of an id, then for
                            each document: doc_id (-2^63: null), frame, first id in it, number of ids
    seek table              skippable frame 0x184D2A5E: for each frame its size compressed, its size,
                            and the low half of XXH64 of its ids; then the number of frames, the
                            descriptor 0x80 (there are checksums) and the magic number 0x8F92EAB1

A reader takes the two tables from the end of a file and decompresses only the frames of the
documents it was asked for.

Writing.  Rows are dealt out by ranges of doc_id (and of a salt, so that one doc_id of a third
of all rows is split), sorted inside a range, encoded in Arrow batches and written by the task.
A task names its files by attempt and returns them as rows; only the rows of finished
attempts get into the manifest, so a lost executor leaves at most an unlisted file.  Files go
where pyarrow can open a shared folder (file, hdfs, s3, gs).

Encoding is the tokenizer's own.  Where its description shows that white space only parts
words and that text is lower-cased and cut by the pattern below, a word's ids don't depend on its neighbours;
then words are encoded once and remembered (in a table of bounded size), with the library's
model for the words of plain letters and the whole library for all others.

Defined cases: null text is an empty one: only the end id; null doc_ids come first; rows that
repeat a doc_id are documents each; a very long text is one frame; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch

END_ID = 2
FRAME_IDS = 65_536
PART_BYTES = 96 << 20
FILE_BYTES = 256 << 20
LEVEL = 3
WORDS_KEPT = 400_000

# Fixed values of the seekable format, and of the index before it.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUMS = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80
_DOC, _FRAME, _FOOTER, _HEAD = "<qIII", "<III", "<IBI", "<II"
NULL_ID = -(1 << 63)

# The description of tokenizers whose words can be encoded one by one.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STEPS = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """Texts to ids (as little-endian bytes of `width`), by a tokenizers description."""

    def __init__(self, description: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = Tokenizer.from_str(description), np.dtype(f"<u{width}")
        self.by_word = words_stand_alone(description)
        self.model, self.pattern = self.tokenizer.model, regex.compile(WORD_PATTERN)
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _run(self, run: str) -> bytes:
        got = self.runs.get(run)
        if got is None:
            written = run if run.isascii() else "".join(map(self.letters.__getitem__, run.encode()))
            got = self._bytes([t.id for t in self.model.tokenize(written)])
            if len(self.runs) < WORDS_KEPT:
                self.runs[run] = got
        return got

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if max(word) > "\xff" or "<|" in word or not word.isprintable():
            got = self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)
        else:
            low = word.lower()
            got = self._run(low) if low.isascii() and low.isalpha() else b"".join(map(self._run, self.pattern.findall(low)))
        if len(self.words) < WORDS_KEPT:
            self.words[word] = got
        return got

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_word:
            found = self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
            return [self._bytes(e.ids) for e in found]
        known, out = self.words.get, []
        for text in texts:
            words = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            out.append(b"".join([known(w) or self._word(w) for w in words]))
        return out


def words_stand_alone(description: str) -> bool:
    """Whether white space parts words for good: known steps, pattern, and no prefix or tail by context."""
    d = json.loads(description)
    steps = [[s["type"] for s in (d[k] or {}).get(many) or []] for k, many in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
    if tuple(steps) != _STEPS or d["model"]["type"] != "BPE" or d["model"].get("unk_token"):
        return False
    replace, split, level = d["normalizer"]["normalizers"][1], *d["pre_tokenizer"]["pretokenizers"]
    plain = all(not t["normalized"] and not t["lstrip"] and not t["rstrip"] and t["content"].startswith("<|") for t in d["added_tokens"])
    return (replace["pattern"] == {"Regex": r"\s+"} and replace["content"] == " " and split["pattern"] == {"Regex": WORD_PATTERN}
            and split["behavior"] == "Removed" and split["invert"] and not level["add_prefix_space"] and not level["use_regex"] and plain)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a shared folder as Spark names it."""
    if ":/" not in uri:
        return fs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri)


class Writer:
    """Writes one file; documents come in order."""

    def __init__(self, out, width: int, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.out, self.width, self.frame_bytes = out, width, frame_ids * width
        self.press = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.frames, self.docs, self.waiting, self.size, self.ids, self.written = [], [], [], 0, 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.waiting and self.size + len(ids) > self.frame_bytes:
            self._flush()
        self.docs.append(struct.pack(_DOC, NULL_ID if doc_id is None else doc_id, len(self.frames), self.size // self.width, len(ids) // self.width))
        self.waiting.append(ids)
        self.size += len(ids)
        self.ids += len(ids) // self.width

    def _flush(self) -> None:
        whole = b"".join(self.waiting)
        pressed = self.press.compress(whole)
        self.out.write(pressed)
        self.written += len(pressed)
        self.frames.append(struct.pack(_FRAME, len(pressed), len(whole), xxhash.xxh64_intdigest(whole) & 0xFFFFFFFF))
        self.waiting, self.size = [], 0

    def close(self) -> None:
        if self.waiting:
            self._flush()
        index = bytes([self.width]) + b"".join(self.docs)
        table = b"".join(self.frames) + struct.pack(_FOOTER, len(self.frames), CHECKSUMS, SEEK_MAGIC)
        for magic, body in ((SKIPPABLE_INDEX, index), (SKIPPABLE_SEEK, table)):
            self.out.write(struct.pack(_HEAD, magic, len(body)) + body)
        self.out.close()


class Reader:
    """Reads documents of one file, decompressing only the frames they are in."""

    def __init__(self, source, size: int):
        self.source = source
        frames, flags, magic = struct.unpack(_FOOTER, self._at(size - struct.calcsize(_FOOTER), struct.calcsize(_FOOTER)))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        start = size - struct.calcsize(_FOOTER) - frames * struct.calcsize(_FRAME)
        self.frames = list(struct.iter_unpack(_FRAME, self._at(start, frames * struct.calcsize(_FRAME))))
        self.starts = np.concatenate([[0], np.cumsum([f[0] for f in self.frames], dtype=np.int64)])
        head = int(self.starts[-1])
        magic, length = struct.unpack(_HEAD, self._at(head, struct.calcsize(_HEAD)))
        if magic != SKIPPABLE_INDEX or head + struct.calcsize(_HEAD) + length + struct.calcsize(_HEAD) != start:
            raise ValueError("no document index where the frames end")
        index = self._at(head + struct.calcsize(_HEAD), length)
        self.dtype = np.dtype(f"<u{index[0]}")
        self.docs = [(None if d == NULL_ID else d, f, a, n) for d, f, a, n in struct.iter_unpack(_DOC, index[1:])]
        self.decompressed = 0

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def frame(self, number: int) -> np.ndarray:
        pressed, size, check = self.frames[number]
        whole = zstandard.ZstdDecompressor().decompress(self._at(int(self.starts[number]), pressed), max_output_size=size)
        if len(whole) != size or xxhash.xxh64_intdigest(whole) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {number} does not match its checksum")
        self.decompressed += 1
        return np.frombuffer(whole, dtype=self.dtype)

    def read(self, places: list[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of the documents at `places` of the index, or of all."""
        last, ids = None, None
        for k in range(len(self.docs)) if places is None else places:
            doc_id, frame, first, n = self.docs[k]
            if frame != last:
                last, ids = frame, self.frame(frame)
            yield doc_id, ids[first:first + n]


def write_files(docs: DataFrame, description: str, folder: str, end_id: int = END_ID, part_bytes: int = PART_BYTES,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all documents; returns one row a file: part, piece, path, n_docs, n_ids.

    Files ordered by (part, piece) hold the documents in ascending doc_id order.
    """
    vocabulary = json.loads(description)
    top = max([end_id, *vocabulary["model"]["vocab"].values(), *(t["id"] for t in vocabulary["added_tokens"])])
    width = 2 if top < 1 << 16 else 4

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(folder)
        files.create_dir(base, recursive=True)
        encoder, end = Encoder(description, width), np.array([end_id], dtype=f"<u{width}").tobytes()
        part, attempt, piece, writer, path = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, None, ""

        def row() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "piece": pa.array([piece], pa.int32()), "path": pa.array([f"{folder}/{path}"]),
                "n_docs": pa.array([len(writer.docs)], pa.int64()), "n_ids": pa.array([writer.ids], pa.int64())})

        for batch in parts:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist())):
                    if writer is None:
                        path = f"part-{part:06d}-{piece:03d}-{attempt}.zst"
                        writer = Writer(files.open_output_stream(f"{base}/{path}", compression=None), width)
                    writer.add(doc_id, ids + end)
                    if writer.written > FILE_BYTES:
                        yield row()
                        writer, piece = None, piece + 1
        if writer is not None:
            yield row()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(max(1, -(-size // part_bytes)), "id", "salt").sortWithinPartitions("id", "salt")
    return dealt.select("id", "text").mapInArrow(batches, "part int, piece int, path string, n_docs long, n_ids long")


def read_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files of a manifest."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path, before in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                files, base = file_system(path)
                with files.open_input_file(base) as source:
                    reader, rows = Reader(source, source.size()), []
                    for doc_id, ids in reader.read():
                        rows.append((doc_id, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        before += len(ids)
                yield pa.RecordBatch.from_pydict({
                    name: pa.array([r[k] for r in rows], pa.int64()) for k, name in enumerate(("doc_id", "start", "n_tokens", "ids_crc32"))})

    # One row a file.
    order = Window.orderBy("part", "piece")
    placed = manifest.withColumn("before", F.sum("n_ids").over(order) - F.col("n_ids"))
    spread = placed.select("path", "before").repartition(max(1, manifest.count()))
    return spread.mapInArrow(batches, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, description: str, **options) -> DataFrame:
    """Write all documents to files in the shared folder and read them back."""
    scratch = Scratch(docs.sparkSession, "tokens")
    manifest = scratch.write(write_files(docs, description, scratch.path("files"), **options), "manifest")
    return read_files(manifest)
