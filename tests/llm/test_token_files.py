import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from finledger.llm import token_files as tf

from .edge import TEXTS, documents

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_frames_are_independent_and_checked(monkeypatch):
    monkeypatch.setattr(tf, "FRAME_BYTES", 400)
    monkeypatch.setattr(tf, "LONGEST", 1000)
    rng = random.Random(3)
    docs = [(i, rng.randbytes(4 * rng.choice([0, 1, 20, 90, 700]))) for i in range(60)]
    docs += [(None, b"\1\0\0\0"), (7, b"\2\0\0\0")]
    out = io.BytesIO()
    writer = tf.FrameWriter(out)
    for key, ids in docs:
        writer.add(key, ids)
    assert writer.close() == (62, sum(len(i) for _, i in docs) // 4)
    reader = tf.FrameReader(io.BytesIO(out.getvalue()))
    assert len(reader.entries) > 5
    order = list(range(62))
    rng.shuffle(order)
    assert all(reader.document(i) == docs[i][1] for i in order)
    assert reader.places(7) == [7, 61] and reader.null.tolist().index(True) == 60
    # an ordinary decoder reads the frames in front of the seek table one after another
    plain = zstandard.ZstdDecompressor().stream_reader(
        io.BytesIO(out.getvalue()), read_across_frames=True
    ).read()
    assert plain.startswith(b"".join(i for _, i in docs))
    broken = bytearray(out.getvalue())
    broken[int(reader.offsets[1]) + 12] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tf.FrameReader(io.BytesIO(bytes(broken))).frame(1)
    with pytest.raises(ValueError):
        tf.FrameReader(io.BytesIO(bytes(broken[:-1])))


def test_documents_behind_one_of_several_frames(monkeypatch):
    monkeypatch.setattr(tf, "FRAME_BYTES", 400)
    monkeypatch.setattr(tf, "LONGEST", 1000)
    rng = random.Random(4)
    docs = [rng.randbytes(n) for n in (0, 2100, 40, 0, 80, 1004, 1000, 12, 2000, 20)]
    out = io.BytesIO()
    writer = tf.FrameWriter(out)
    for key, ids in enumerate(docs):
        writer.add(key, ids)
    writer.close()
    reader = tf.FrameReader(io.BytesIO(out.getvalue()))
    assert [reader.document(i) for i in range(len(docs))] == docs


def test_only_asked_frames_are_decompressed(monkeypatch):
    monkeypatch.setattr(tf, "FRAME_BYTES", 40)
    out = io.BytesIO()
    writer = tf.FrameWriter(out)
    for i in range(50):
        writer.add(i, bytes([i, 0, 0, 0]) * 10)
    writer.close()
    reader, read = tf.FrameReader(io.BytesIO(out.getvalue())), []
    frame = reader.frame
    monkeypatch.setattr(reader, "frame", lambda n: read.append(n) or frame(n))
    assert reader.document(31) == bytes([31, 0, 0, 0]) * 10
    assert read == [31]


def test_round_trip(spark):
    whole = Tokenizer.from_file(BYTES)
    folder = tf.shared_folder(spark, "test")
    manifest = tf.write_token_files(documents(spark), folder, BYTES)
    got = tf.read_token_files(manifest).collect()
    order = sorted(got, key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in order] == sorted(
        (k is not None, k or 0) for k, _ in TEXTS
    )
    at = 0
    for r in order:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        assert zlib.crc32(r.ids) == r.ids_crc32
        at += r.n_tokens
    for key, text in {k: t for k, t in TEXTS if k not in (5, None)}.items():
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        row = next(r for r in got if r.doc_id == key)
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        path = next(m.path for m in manifest.collect()
                    if key in tf.read_documents(m.path, [key]) and tf.read_documents(m.path, [key])[key])
        assert tf.read_documents(path, [key])[key][0].tolist() == ids


def test_empty_table(spark):
    folder = tf.shared_folder(spark, "test")
    manifest = tf.write_token_files(documents(spark, []), folder, BYTES)
    assert tf.read_token_files(manifest).collect() == []
