"""Token files: ids equal the library's, files round-trip, readers decompress only what they need."""

from __future__ import annotations

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from auditlane.llm import tokenfile
from tests.llm.helpers import frame, rows

WORD = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
BYTE = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


class Kept(io.BytesIO):
    def close(self):
        pass


def test_ids_are_the_librarys():
    assert tokenfile.words_stand_alone(WORD) and not tokenfile.words_stand_alone(BYTE)
    library, encoder, draw = Tokenizer.from_str(WORD), tokenfile.Encoder(WORD, 2), random.Random(4)
    parts = ["a", "Bc", "É", "é", "ß", "İ", "Σ", "ς", "'s", "'ll", "’", "1", "²", "½", "ª", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85",
             "\xa0", " ", "​", "é", "́", "<|endoftext|>", "<|", "中文", "ﬁ", "😀", "!?", "...", "don't", "I'M", "\x00", "\x7f"]
    texts = [None, "", " "] + [t for _, t, *_ in rows()] + ["".join(draw.choice(parts) for _ in range(draw.randrange(9))) for _ in range(3_000)]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, dtype="<u2").tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)
    other = tokenfile.Encoder(BYTE, 2).encode(["Two words", None])
    assert np.frombuffer(other[0], dtype="<u2").tolist() == Tokenizer.from_str(BYTE).encode("Two words", add_special_tokens=False).ids


def test_table_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(tokenfile, "WORDS_KEPT", 10)
    encoder = tokenfile.Encoder(WORD, 2)
    text = " ".join(f"word{k}x" for k in range(100))
    assert encoder.encode([text]) == tokenfile.Encoder(WORD, 2).encode([text])
    assert len(encoder.words) <= 10 and len(encoder.runs) <= 10


def test_seeking_reads_only_the_frames_asked_for():
    out, docs = Kept(), [(k if k % 5 else None, (np.arange(k * 3, dtype="<u2") + k).tobytes()) for k in range(40)]
    writer = tokenfile.Writer(out, 2, frame_ids=100)
    for d, ids in docs:
        writer.add(d, ids)
    writer.close()
    reader = tokenfile.Reader(out, len(out.getvalue()))
    assert len(reader.frames) > 10
    assert [(d, ids.tobytes()) for d, ids in reader.read([3, 17])] == [docs[3], docs[17]]
    assert reader.decompressed == 2
    assert [(d, ids.tobytes()) for d, ids in reader.read()] == docs
    broken = bytearray(out.getvalue())
    broken[len(broken) - tokenfile.struct.calcsize(tokenfile._FOOTER) - 1] ^= 1  # a checksum
    with pytest.raises(ValueError, match="checksum"):
        list(tokenfile.Reader(Kept(bytes(broken)), len(broken)).read())
    with pytest.raises(ValueError, match="seekable"):
        tokenfile.Reader(Kept(b"x" * 50), 50)


def test_other_readers_of_the_format_see_plain_frames():
    import zstandard

    out = Kept()
    writer = tokenfile.Writer(out, 2)
    writer.add(1, b"\x01\x00\x02\x00")
    writer.close()
    assert zstandard.ZstdDecompressor().decompressobj().decompress(out.getvalue()) == b"\x01\x00\x02\x00"


def test_awkward_documents(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "FILE_BYTES", 500)  # several files a task
    library = Tokenizer.from_str(WORD)
    got = tokenfile.encode_and_read(frame(spark), WORD, part_bytes=20_000).collect()
    want = [(d, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")) for d, t, *_ in rows()]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), len(x), zlib.crc32(x.tobytes())) for d, x in want)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_empty_table(spark):
    assert tokenfile.encode_and_read(frame(spark, []), WORD).collect() == []
