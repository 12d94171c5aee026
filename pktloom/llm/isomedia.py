"""ISO base media files: boxes, sample tables and media columns, without decoding payloads.

read_tracks() walks the nested boxes of a file and decodes the sample tables of each track, and the runs of samples of its fragments, into
codec, duration and the byte ranges of samples and key frames. still_video() stores a payload losslessly as
uncompressed 8x8 grey frames of 8-bit samples, 64 bytes each; every frame of such a file is a key frame.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_batches, utf8

#: Fixed values of the format: boxes that hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}
SIDE = 8
FRAME = SIDE * SIDE
FRAMES_PER_SECOND = 25
FRAMES_PER_CHUNK = 16
#: Box sizes and chunk offsets below this are 32-bit.
LARGE = 1 << 32


class BrokenMedia(ValueError):
    """The file's boxes or tables contradict its bytes."""


def boxes(data: bytes | memoryview, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, start, end) of the body of every box, outer boxes first."""
    return ((p, s, e) for p, _, s, e in _walk(data, start, end, path))


def _walk(data: bytes | memoryview, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    """(path, start of the box, start and end of its body) of every box, outer boxes first."""
    end = len(data) if end is None else end
    stack = [(start, end, path)]
    while stack:
        at, end, path = stack.pop()
        while at < end:
            if end - at < 8:
                raise BrokenMedia("a box header is cut off")
            size, kind = struct.unpack_from(">I4s", data, at)
            head = 8
            if size == 1:
                if end - at < 16:
                    raise BrokenMedia("a large box header is cut off")
                size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
            elif size == 0:
                size = end - at
            if size < head or size > end - at:
                raise BrokenMedia(f"box {kind!r} does not fit")
            yield (*path, kind), at, at + head, at + size
            if kind in CONTAINERS:
                stack.append((at + size, end, path))
                at, end, path = at + head, at + size, (*path, kind)
            else:
                at += size


@dataclass
class Media:
    """A track."""

    codec: str
    timescale: int
    duration: int
    offsets: np.ndarray  # of samples
    sizes: np.ndarray
    keys: np.ndarray  # 0-based numbers of key samples
    track_id: int = 0
    handler: str = ""


def _table(data: bytes, at: tuple[int, int], head: int, width: int) -> np.ndarray:
    """The rows of a full box: its count is the last of `head` 32-bit fields after the flags."""
    start, end = at
    if end - start < 4 + 4 * head:
        raise BrokenMedia("a table is cut off")
    n = struct.unpack_from(">I", data, start + 4 * head)[0]
    if end - start < 4 + 4 * head + 4 * n * width:
        raise BrokenMedia("a table is shorter than it says")
    return np.frombuffer(data, ">u4", n * width, start + 4 + 4 * head).astype(np.int64).reshape(n, width)


def _sizes(data: bytes, found: dict[bytes, tuple[int, int]]) -> np.ndarray:
    if b"stsz" not in found and b"stz2" in found:
        s, e = found[b"stz2"]
        bits, n = data[s + 7], struct.unpack_from(">I", data, s + 8)[0]
        if bits not in (4, 8, 16) or e - s < 12 + -(-n * bits // 8):
            raise BrokenMedia("the compact sizes can't be read")
        if bits == 16:
            return np.frombuffer(data, ">u2", n, s + 12).astype(np.int64)
        raw = np.frombuffer(data, np.uint8, -(-n * bits // 8), s + 12).astype(np.int64)
        return raw if bits == 8 else np.stack([raw >> 4, raw & 15], axis=1).reshape(-1)[:n]
    s, e = found[b"stsz"]
    same, n = struct.unpack_from(">II", data, s + 4)
    if same * n > len(data):
        raise BrokenMedia("the samples are larger than the file")
    return np.full(n, same, np.int64) if same else _table(data, (s, e), 2, 1)[:, 0]


def _track(data: bytes, found: dict[bytes, tuple[int, int]]) -> Media:
    """A track from the boxes of its trak."""
    s, _ = found[b"mdhd"]
    timescale, duration = struct.unpack_from(">IQ", data, s + 20) if data[s] == 1 else struct.unpack_from(">II", data, s + 12)
    s, _ = found[b"tkhd"]
    track_id = struct.unpack_from(">I", data, s + (20 if data[s] == 1 else 12))[0]
    s, e = found[b"hdlr"]
    handler = data[s + 8 : min(e, s + 12)].decode("latin-1")
    s, _ = found[b"stsd"]
    codec = data[s + 12 : s + 16].decode("latin-1")
    sizes = _sizes(data, found)
    n = len(sizes)
    if b"co64" in found:
        s, _ = found[b"co64"]
        chunks = np.frombuffer(data, ">u8", struct.unpack_from(">I", data, s + 4)[0], s + 8).astype(np.int64)
    else:
        chunks = _table(data, found[b"stco"], 1, 1)[:, 0]
    runs = _table(data, found[b"stsc"], 1, 3)
    times = _table(data, found[b"stts"], 1, 2)
    keys = _table(data, found[b"stss"], 1, 1)[:, 0] - 1 if b"stss" in found else np.arange(n)
    if len(runs):
        first = np.append(runs[:, 0], len(chunks) + 1)
        if first[0] != 1 or (np.diff(first) < 0).any():
            raise BrokenMedia("the runs of chunks are out of order")
        per_chunk = np.repeat(runs[:, 1], np.diff(first))
    else:
        per_chunk = np.zeros(0, np.int64)
    if len(per_chunk) != len(chunks) or per_chunk.sum() != n or (times[:, 0].sum() != n and n):
        raise BrokenMedia("the tables disagree on the number of samples")
    starts = np.cumsum(per_chunk) - per_chunk
    ends = np.cumsum(sizes)
    base = np.repeat(np.where(starts > 0, ends[np.maximum(starts, 1) - 1], 0), per_chunk) if n else np.zeros(0, np.int64)
    offsets = np.repeat(chunks, per_chunk) + (ends - sizes) - base
    if keys.size and (keys.min() < 0 or keys.max() >= n):
        raise BrokenMedia("a key frame is no sample")
    return Media(codec, timescale, duration, offsets, sizes, keys, track_id, handler)


#: Fixed values of the format: flags of tfhd and trun, in the order of their fields, and the sample flag of what is no key frame.
_TFHD = ((0x1, ">Q", "base"), (0x2, ">I", "entry"), (0x8, ">I", "duration"), (0x10, ">I", "size"), (0x20, ">I", "flags"))
_BASE_IS_MOOF, _TRUN_OFFSET, _TRUN_FIRST_FLAGS = 0x20000, 0x1, 0x4
_TRUN_FIELDS = ((0x100, "duration"), (0x200, "size"), (0x400, "flags"), (0x800, "time"))
_NO_KEY = 0x10000


def _flags(data: bytes, start: int) -> int:
    return struct.unpack_from(">I", data, start)[0] & 0xFFFFFF


@dataclass
class _Fragments:
    """The samples of fragments, as they are met."""

    defaults: dict[int, dict[str, int]]  # of tracks
    found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]]  # offsets, sizes, whether key frames, duration
    moof: int = 0
    at: int = 0
    track: int = 0
    own: dict[str, int] | None = None

    def trex(self, data: bytes, start: int) -> None:
        track, _, duration, size, flags = struct.unpack_from(">5I", data, start + 4)
        self.defaults[track] = {"duration": duration, "size": size, "flags": flags}

    def tfhd(self, data: bytes, start: int) -> None:
        flags, self.track = _flags(data, start), struct.unpack_from(">I", data, start + 4)[0]
        self.own, place = dict(self.defaults.get(self.track, {"duration": 0, "size": 0, "flags": 0})), start + 8
        for bit, kind, name in _TFHD:
            if flags & bit:
                self.own[name] = struct.unpack_from(kind, data, place)[0]
                place += struct.calcsize(kind)
        if "base" in self.own:
            self.at = self.own["base"]
        elif flags & _BASE_IS_MOOF:
            self.at = self.moof
        self.own["base"] = self.at  # else the end of the track fragment before it

    def trun(self, data: bytes, start: int, end: int) -> None:
        if self.own is None:
            raise BrokenMedia("a run of samples has no header")
        flags, n = _flags(data, start), struct.unpack_from(">I", data, start + 4)[0]
        place, first_flags = start + 8, None
        if flags & _TRUN_OFFSET:
            self.at = self.own["base"] + struct.unpack_from(">i", data, place)[0]
            place += 4
        if flags & _TRUN_FIRST_FLAGS:
            first_flags = struct.unpack_from(">I", data, place)[0]
            place += 4
        names = [name for bit, name in _TRUN_FIELDS if flags & bit]
        if end - place < 4 * n * len(names):
            raise BrokenMedia("a run of samples is shorter than it says")
        if not names and n > len(data):
            raise BrokenMedia("a run has more samples than the file has bytes")
        table = np.frombuffer(data, ">u4", n * len(names), place).astype(np.int64).reshape(n, len(names))
        of = {name: table[:, names.index(name)] if name in names else np.full(n, self.own[name], np.int64) for name in ("duration", "size", "flags")}
        if n and first_flags is not None:
            of["flags"] = of["flags"].copy()
            of["flags"][0] = first_flags
        ends = self.at + np.cumsum(of["size"])
        self.found.setdefault(self.track, []).append((ends - of["size"], of["size"], of["flags"] & _NO_KEY == 0, int(of["duration"].sum())))
        self.at = int(ends[-1]) if n else self.at


def read_tracks(data: bytes) -> list[Media]:
    """What the boxes say of each track, in the file's order; sample bytes are not looked at.

    A file with a track that can't be read is broken as a whole, so that none is lost without an error.
    """
    traks: list[dict[bytes, tuple[int, int]]] = []
    fragments = _Fragments({}, {})
    try:
        for path, box, s, e in _walk(data):
            kind = path[-1]
            if kind == b"trak":
                traks.append({})
            elif b"trak" in path:
                traks[-1].setdefault(kind, (s, e))
            elif kind == b"trex":
                fragments.trex(data, s)
            elif kind == b"moof":
                fragments.moof = fragments.at = box
            elif kind == b"traf":
                fragments.own = None
            elif kind == b"tfhd":
                fragments.tfhd(data, s)
            elif kind == b"trun":
                fragments.trun(data, s, e)
        tracks = [_track(data, found) for found in traks]
    except BrokenMedia:
        raise
    except (KeyError, struct.error, ValueError, IndexError, OverflowError) as x:
        raise BrokenMedia(f"the tables can't be read: {x!r}") from x
    if not tracks:
        raise BrokenMedia("there is no track")
    if fragments.found.keys() - {t.track_id for t in tracks}:
        raise BrokenMedia("a fragment is of no track")
    for t in tracks:
        if parts := fragments.found.get(t.track_id):
            before = len(t.sizes)
            t.keys = np.concatenate([t.keys, before + np.flatnonzero(np.concatenate([p[2] for p in parts]))])
            t.offsets = np.concatenate([t.offsets, *(p[0] for p in parts)])
            t.sizes = np.concatenate([t.sizes, *(p[1] for p in parts)])
            t.duration += sum(p[3] for p in parts)
        if len(t.sizes) and (t.offsets.min() < 0 or (t.offsets + t.sizes).max() > len(data)):
            raise BrokenMedia("a sample is outside the file")
    return tracks


def read_media(data: bytes) -> Media:
    """The first video track, or the first track of a file without."""
    tracks = read_tracks(data)
    return next((t for t in tracks if t.handler == "vide"), tracks[0])


def payload(data: bytes, media: Media) -> bytes:
    """The bytes of all samples in order."""
    view = memoryview(data)
    ends = media.offsets + media.sizes
    breaks = np.flatnonzero(media.offsets[1:] != ends[:-1]) + 1 if len(ends) else []
    starts = [0, *np.asarray(breaks).tolist()] if len(ends) else []
    return b"".join(view[media.offsets[s] : ends[e - 1]] for s, e in zip(starts, [*starts[1:], len(ends)]))


def _box(kind: bytes, *parts: bytes) -> bytes:
    size = 8 + sum(map(len, parts))
    head = struct.pack(">I4s", size, kind) if size < LARGE else struct.pack(">I4sQ", 1, kind, size + 8)
    return head + b"".join(parts)


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


#: Fixed value of the format: the unit matrix.
_MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def still_video(data: bytes) -> bytes:
    """A file whose samples are the frames of data, whose length is a positive multiple of FRAME."""
    n = len(data) // FRAME
    if not n or len(data) % FRAME:
        raise ValueError(f"a positive multiple of {FRAME} bytes is needed")
    chunks, rest = divmod(n, FRAMES_PER_CHUNK)
    runs = [(1, FRAMES_PER_CHUNK, 1)] * bool(chunks) + [(chunks + 1, rest, 1)] * bool(rest)
    brand = _box(b"ftyp", b"isom", struct.pack(">I", 0x200), b"isomiso2mp41")
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", SIDE, SIDE, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 40, -1))
    wide = len(data) + (1 << 20) + 16 * n >= LARGE

    def moov(first: int) -> bytes:
        at = range(first, first + len(data), FRAME * FRAMES_PER_CHUNK)
        where = _full(b"co64", struct.pack(f">I{len(at)}Q", len(at), *at)) if wide else _full(b"stco", struct.pack(f">I{len(at)}I", len(at), *at))
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, n, 1)),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            _full(b"stsz", struct.pack(">II", FRAME, n)),
            where,
        )
        minf = _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl)
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, FRAMES_PER_SECOND, n, 0x55C4, 0)), _full(b"hdlr", bytes(4), b"vide", bytes(12), b"\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(16), _MATRIX, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3)
        mvhd = _full(b"mvhd", struct.pack(">IIII", 0, 0, FRAMES_PER_SECOND, n), struct.pack(">IH", 0x10000, 0x100), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    head = 16 if 8 + len(data) >= LARGE else 8
    first = len(brand) + len(moov(0)) + head
    return brand + moov(first) + _box(b"mdat", data)


def feature(media: Media) -> str:
    """codec, time scale, duration, samples, key frames, and a digest of the key frames' byte ranges."""
    ranges = np.stack([media.offsets[media.keys], media.sizes[media.keys]], axis=1).astype("<i8")
    digest = hashlib.sha256(ranges.tobytes()).hexdigest()[:16]
    return f"{media.codec.strip()};{media.timescale};{media.duration};{len(media.sizes)};{len(media.keys)};{digest}"


_KEYFRAMES = "array<struct<sample:bigint,start:bigint,end:bigint>>"
_TRACK = f"codec:string,timescale:bigint,duration:bigint,n_samples:bigint,keyframes:{_KEYFRAMES},track_id:bigint,handler:string"
_COLUMNS = f"codec string, timescale bigint, duration bigint, n_samples bigint, keyframes {_KEYFRAMES}, tracks array<struct<{_TRACK}>>, error string"


def key_ranges(media: list[Media]) -> pa.ListArray:
    """A list for each track: the byte ranges of its key frames."""
    ends = np.cumsum([0, *(len(m.keys) for m in media)]).astype(np.int32)
    number = np.concatenate([m.keys for m in media]) if media else np.zeros(0, np.int64)
    start = np.concatenate([m.offsets[m.keys] for m in media]) if media else number
    size = np.concatenate([m.sizes[m.keys] for m in media]) if media else number
    rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (number, start, start + size)], names=["sample", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends), rows)


def _described(m: Media) -> dict:
    at, size = m.offsets[m.keys].tolist(), m.sizes[m.keys].tolist()
    keys = [{"sample": k, "start": s, "end": s + z} for k, s, z in zip(m.keys.tolist(), at, size)]
    return {"codec": m.codec, "timescale": m.timescale, "duration": m.duration, "n_samples": len(m.sizes), "keyframes": keys, "track_id": m.track_id, "handler": m.handler}


def media_columns(files: DataFrame, data_col: str = "media") -> DataFrame:
    """files' other columns with codec, timescale, duration, n_samples and keyframes (byte ranges) of the first video track, or else of the first;
    the same of all tracks; and error.

    A file that is null or can't be read has nulls and an error, and does not stop the others. Column names
    of files that clash with these are an error of the caller.
    """
    names = ["codec", "timescale", "duration", "n_samples", "keyframes", "tracks", "error"]
    others = [c for c in files.columns if c != data_col]
    if clash := {*names} & {*others}:
        raise ValueError(f"columns clash: {sorted(clash)}")
    text_batches(files.sparkSession)
    kind = pa.list_(pa.struct([("sample", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
    track = [("codec", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("n_samples", pa.int64()), ("keyframes", kind), ("track_id", pa.int64()), ("handler", pa.string())]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for data in b.column("__data").to_pylist():
                try:
                    if data is None:
                        raise BrokenMedia("no file")
                    tracks = read_tracks(data)
                    main = _described(next((t for t in tracks if t.handler == "vide"), tracks[0]))
                    out.append((*(main[c] for c in names[:5]), [_described(t) for t in tracks], None))
                except BrokenMedia as x:
                    out.append((None, None, None, None, None, None, str(x)))
            cols = list(zip(*out)) or [()] * len(names)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), kind, pa.list_(pa.struct(track)), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(list(c), t) for c, t in zip(cols, types))], names=["row", *names])

    rows = files.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(data_col).alias("__data"))
    made = rows.mapInArrow(scan, f"row {rows.schema['row'].dataType.simpleString()}, {_COLUMNS}")
    return made.select("row.*", *names)


def padded(text: str | None) -> bytes:
    """UTF-8 with bytes 0 up to a positive multiple of FRAME."""
    data = utf8(text)
    return data + bytes(-len(data) % FRAME if data else FRAME)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, keyframes) for each row.

    Each whole text (null: empty) is stored as a media file, and everything but n_bytes comes from reading that
    file's tables and samples back. The file depends on the text alone, so equal texts have
    equal values. Repeated rows stay; an empty table gives an empty one; nothing is shuffled.
    """
    text_batches(docs.sparkSession)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 16):
            out, tracks = [], []
            for text in b.column(1).to_pylist():
                n = len(utf8(text))
                stored = still_video(padded(text))
                media = read_media(stored)
                back = payload(stored, media)
                tracks.append(media)
                out.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-FRAME:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(media)))
            cols = list(zip(*out)) or [()] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), t) for c, t in zip(cols, types)), key_ranges(tracks)], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "keyframes"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, keyframes " + _KEYFRAMES)
