import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from pktloom.llm import isomedia as im


@pytest.mark.parametrize("n", [1, 2, 11, 12, 13, 15, 16, 17, 31, 32, 33, 500])
def test_round_trip(n):
    data = random.Random(n).randbytes(64 * n)
    stored = im.still_video(data)
    media = im.read_media(stored)
    assert im.payload(stored, media) == data
    assert (media.codec, media.timescale, media.duration, len(media.sizes)) == ("raw ", 25, n, n)
    assert media.keys.tolist() == list(range(n))
    assert all(stored[o : o + s] == data[64 * i : 64 * i + 64] for i, (o, s) in enumerate(zip(media.offsets, media.sizes)))


def test_boxes_nest():
    paths = [b"/".join(p) for p, _, _ in im.boxes(im.still_video(bytes(64)))]
    assert b"moov/trak/mdia/minf/stbl/stsz" in paths and b"mdat" in paths and paths[0] == b"ftyp"


def test_large_size_and_open_end():
    body = b"abcd"
    data = struct.pack(">I4sQ", 1, b"free", 16 + len(body)) + body + struct.pack(">I4s", 0, b"mdat") + b"rest"
    assert [(p[-1], data[s:e]) for p, s, e in im.boxes(data)] == [(b"free", body), (b"mdat", b"rest")]


def test_broken_files_raise():
    good = im.still_video(bytes(640))
    for data in (b"", b"abc", good[:40], good[:-700], good.replace(b"stsz", b"xxxx"), b"\0\0\0\4ftyp" + good):
        with pytest.raises(im.BrokenMedia):
            im.read_media(data)
    rnd = random.Random(1)
    for _ in range(300):
        broken = bytearray(good)
        broken[rnd.randrange(len(good) - 640)] = rnd.randrange(256)
        try:
            im.read_media(bytes(broken))
        except im.BrokenMedia:
            pass


def test_columns(spark):
    good = im.still_video(bytes(64 * 30))
    df = spark.createDataFrame([(1, good), (2, None), (3, bytearray(b"junk")), (1, good)], "id bigint, media binary")
    got = {r.id: r for r in im.media_columns(df).collect()}
    assert got[1].codec == "raw " and got[1].duration == 30 and [k["sample"] for k in got[1].keyframes] == list(range(30)) and len(got[1].tracks) == 1 and got[1].tracks[0].keyframes == got[1].keyframes
    assert good[got[1].keyframes[1]["start"] : got[1].keyframes[1]["end"]] == bytes(64)
    assert got[2].codec is None and got[2].error and got[3].error and im.media_columns(df).count() == 4
    assert im.media_columns(df.where("false")).count() == 0


def test_documents(spark):
    rows = [(1, None), (2, ""), (3, "é" * 32), (3, "é" * 32), (None, "x" * 300000), (4, "abc\0")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS n_bytes", "'c' AS codec")
    got = im.round_trip(df).collect()
    assert len(got) == 6 and im.round_trip(df.where("false")).count() == 0
    for (i, t), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r.doc_id, r.n_bytes and dict(rows).get(r.doc_id))))):
        raw = (t or "").encode()
        full = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (i, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
    assert np.unique([r.media_sha256 for r in got if r.doc_id in (1, 2)]).size == 1


def box(kind, *parts):
    return struct.pack(">I4s", 8 + sum(map(len, parts)), kind) + b"".join(parts)


def full(kind, *parts, flags=0):
    return box(kind, struct.pack(">I", flags), *parts)


def trak(number, handler, codec, sizes, chunks, keys=None, compact=False):
    """A track of one sample a chunk."""
    n = len(sizes)
    size = full(b"stz2", struct.pack(">II", 8, n), bytes(sizes)) if compact else full(b"stsz", struct.pack(f">II{n}I", 0, n, *sizes))
    stbl = box(
        b"stbl", full(b"stsd", struct.pack(">I", 1), box(codec, bytes(8))), full(b"stts", struct.pack(">III", 1, n, 10)), *([full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys))] if keys else []),
        full(b"stsc", struct.pack(">IIII", 1, 1, 1, 1) if n else struct.pack(">I", 0)), size, full(b"stco", struct.pack(f">I{n}I", n, *chunks)),
    )
    mdia = box(b"mdia", full(b"mdhd", struct.pack(">IIIII", 0, 0, 90, 10 * n, 0)), full(b"hdlr", bytes(4), handler, bytes(13)), box(b"minf", stbl))
    return box(b"trak", full(b"tkhd", struct.pack(">IIIII", 0, 0, number, 0, 0), bytes(60)), mdia)


def test_all_tracks():
    data = b"A1B22A3B444"
    moov = box(b"moov", trak(1, b"soun", b"mp4a", [1, 1], [9, 12], compact=True), trak(2, b"vide", b"avc1", [3, 4], [10, 13], keys=[2]))
    first = 8 + len(moov)
    moov = box(b"moov", trak(1, b"soun", b"mp4a", [2, 2], [first + 8, first + 13], compact=True), trak(2, b"vide", b"avc1", [3, 4], [first + 10, first + 15], keys=[2]))
    stored = box(b"ftyp", b"isom") + moov + box(b"mdat", data)
    shift = len(box(b"ftyp", b"isom")) - 8
    moov = box(b"moov", trak(1, b"soun", b"mp4a", [2, 2], [first + 8 + shift, first + 13 + shift], compact=True), trak(2, b"vide", b"avc1", [3, 4], [first + 10 + shift, first + 15 + shift], keys=[2]))
    stored = box(b"ftyp", b"isom") + moov + box(b"mdat", data)
    sound, video = im.read_tracks(stored)
    assert (sound.codec, sound.handler, sound.track_id, sound.duration) == ("mp4a", "soun", 1, 20)
    assert im.payload(stored, sound) == b"A1A3" and im.payload(stored, video) == b"B22B444" and video.keys.tolist() == [1]
    assert im.read_media(stored).codec == "avc1"
    with pytest.raises(im.BrokenMedia):
        im.read_tracks(stored.replace(b"stco", b"xxxx", 2)[: len(stored)])


def test_fragments():
    moov = box(b"moov", trak(7, b"vide", b"avc1", [], []), box(b"mvex", full(b"trex", struct.pack(">5I", 7, 1, 3, 4, 0x10000))))
    stored = box(b"ftyp", b"iso5") + moov
    for k, payload in enumerate((b"aaaabbbbcccc", b"ddeeeee")):
        def moof(offset, k=k):
            if k == 0:  # sizes by default, and the first sample a key frame
                run = full(b"trun", struct.pack(">IiI", 3, offset, 0), flags=0x5)
            else:
                run = full(b"trun", struct.pack(">Ii6I", 2, offset, 5, 2, 0, 6, 5, 0x10000), flags=0x701)
            return box(b"moof", full(b"mfhd", struct.pack(">I", k)), box(b"traf", full(b"tfhd", struct.pack(">I", 7), flags=0x20000), run))

        stored += moof(len(moof(0)) + 8) + box(b"mdat", payload)
    (track,) = im.read_tracks(stored)
    assert im.payload(stored, track) == b"aaaabbbbccccddeeeee" and track.sizes.tolist() == [4, 4, 4, 2, 5]
    assert track.keys.tolist() == [0, 3] and track.duration == 9 + 11
    with pytest.raises(im.BrokenMedia):
        im.read_tracks(stored[:-3] + b"")
    with pytest.raises(im.BrokenMedia):
        im.read_tracks(stored.replace(struct.pack(">I", 0x20000) + struct.pack(">I", 7), struct.pack(">I", 0x20000) + struct.pack(">I", 8)))


def test_query(spark):
    from pktloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op6_iso_media"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        full = texts[r.doc_id] + bytes(-len(texts[r.doc_id]) % 64)
        assert r.payload_sha256 == hashlib.sha256(full).hexdigest() and r.n_bytes == len(texts[r.doc_id]) and r.media_bytes > len(full)
        # by the file's form: all frames are key frames and stand one after the other at its end
        n, first = len(full) // 64, r.media_bytes - len(full)
        assert [(k["sample"], k["start"], k["end"]) for k in r.keyframes] == [(i, first + 64 * i, first + 64 * i + 64) for i in range(n)]
        digest = hashlib.sha256(b"".join(struct.pack("<qq", first + 64 * i, 64) for i in range(n))).hexdigest()[:16]
        assert r.feature == f"raw;25;{n};{n};{n};{digest}"
        assert r.media_sha256 == hashlib.sha256(im.still_video(full)).hexdigest() and im.still_video(full)[first:] == full
