"""Byte-level BPE by a monoid tree reduction.

The element of the monoid is a canonical token sequence. A piece of text is encoded by halves, and two
neighbours are joined by re-encoding a window around their boundary that grows until the tokens outside
it are provably stable:

A sequence of tokens is the encoding of its bytes if and only if each two neighbours are the encoding of
their own bytes. (Rank-ordered merging acts on a token's bytes independently of the rest until the first
merge across one of the sequence's boundaries; that merge would be the first one across the boundary when the two neighbours are
encoded on their own, too.) So it suffices that the window's first and last new tokens form such pairs
with the tokens next to the window; else the window grows on the failing side.

Matches of the splitting pattern are encoded separately, so sequences of different matches join by plain concatenation,
and decoding concatenates the tokens' bytes up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_batches

#: Bytes that are merged directly.
LEAF = 16
#: Entries that a worker remembers of each kind before it starts anew.
REMEMBERED = 150_000
#: The rank of a pair that is no token.
NONE = 1 << 62
#: Matches that are held at once.
MATCHES = 1 << 16


class Bpe:
    """A rank table with its tree encoder; ranks maps a token's bytes to its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern)
        self._pairs: dict[tuple[int, int], bool] = {}
        self._known = _Known(self)

    def merged(self, piece: bytes) -> list[int]:
        """The encoding by direct merging, lowest rank first and leftmost among equals."""
        if not piece:
            return []
        get = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        next_rank = [get(piece[i : i + 2], NONE) for i in range(len(piece) - 1)]
        next_rank.append(NONE)
        while (least := min(next_rank)) != NONE:
            i = next_rank.index(least)
            both = parts[i] = parts[i] + parts.pop(i + 1)
            del next_rank[i]
            if i + 1 < len(parts):
                next_rank[i] = get(both + parts[i + 1], NONE)
            else:
                next_rank[i] = NONE
            if i:
                next_rank[i - 1] = get(parts[i - 1] + both, NONE)
        return list(map(self.ranks.__getitem__, parts))

    def stable(self, a: int, b: int) -> bool:
        """Whether two tokens are the encoding of their own bytes."""
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            found = self._pairs[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's operation: the encoding of left's and right's bytes from their encodings."""
        if not left or not right:
            return left or right
        if self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i :] + right[:j])))
            ok_left = i == len(left) or self.stable(left[-i - 1], window[0])
            ok_right = j == len(right) or self.stable(window[-1], right[j])
            if ok_left and ok_right:
                return left[: len(left) - i] + window + right[j:]
            i, j = i if ok_left else i + i, j if ok_right else j + j

    def tree(self, piece: bytes) -> list[int]:
        """The encoding of one match by halves."""
        if len(piece) <= LEAF:
            return self.merged(piece)
        # bottom-up: the levels of the tree, without a call for each
        level = [self.merged(piece[i : i + LEAF]) for i in range(0, len(piece), LEAF)]
        while len(level) > 1:
            level = [self.joined(level[i], level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    def match(self, piece: bytes) -> list[int]:
        """The encoding of one match; one that is a token itself is that token."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.tree(piece)

    def packed(self, text: str) -> Iterator[bytes]:
        """The ids of a text as little-endian unsigned 32-bit integers, in parts."""
        if len(text) <= MATCHES:
            yield b"".join(map(self._known.__getitem__, self.split.findall(text)))
            return
        found = (m.group() for m in self.split.finditer(text))
        while part := list(islice(found, MATCHES)):
            yield b"".join(map(self._known.__getitem__, part))

    def encode(self, text: str) -> list[int]:
        return [i for part in self.packed(text) for (i,) in struct.iter_unpack("<I", part)]

    def decoded(self, packed: bytes) -> bytes:
        return self.decode(np.frombuffer(packed, "<u4").tolist())

    def decode(self, ids: list[int]) -> bytes:
        """The tokens' bytes, concatenated by neighbours up the tree from leaves of LEAF tokens."""
        of, join = self.bytes_of.__getitem__, b"".join
        level = [join(map(of, ids[i : i + LEAF])) for i in range(0, len(ids), LEAF)]
        while len(level) > 1:
            level = [join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


class _Known(dict):
    """Packed encodings of matches; those that are missing are made.

    When it is full, what it holds becomes the older half, from which matches that are met again return.
    """

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe = bpe
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            ids = self.bpe.match(piece.encode("utf-8", "replace"))
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) > 64:
                return found
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found


def parsed_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


@lru_cache(maxsize=2)
def _bpe(data: bytes, pattern: str) -> Bpe:
    return Bpe(parsed_ranks(data), pattern)


def load(path: str, pattern: str) -> Bpe:
    with open(path, "rb") as f:
        return _bpe(f.read(), pattern)


def _over(docs: DataFrame, vocabulary: str, pattern: str):
    """The vocabulary is read on the driver and broadcast: it is one file of about a megabyte, whatever the corpus."""
    with open(vocabulary, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())
    text_batches(docs.sparkSession)
    return lambda: _bpe(data.value, pattern)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for each row: every whole text encoded, and its ids decoded.

    A null text is an empty one, without tokens. Repeated rows give repeated rows; other
    columns are not read; an empty table gives an empty one. The digests follow the parts of a long
    text. Work is in proportion to the text, and nothing is shuffled.
    """
    bpe = _over(docs, vocabulary, pattern)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe()
        for b in slices(batches):
            counts, ids, texts, held = [], [], [], []
            for text in b.column(1).to_pylist():
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for part in coder.packed(text or ""):
                    n += len(part) // 4
                    of_ids.update(part)
                    of_text.update(coder.decoded(part))
                    if with_ids:
                        held.append(part)
                counts.append(n)
                ids.append(of_ids.hexdigest())
                texts.append(of_text.hexdigest())
            made = [b.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
            if with_ids:
                ends = pa.array([0, *np.cumsum(counts, dtype=np.int32).tolist()], pa.int32())
                made.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(held), "<i4"))))
            yield pa.RecordBatch.from_arrays(made, names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
