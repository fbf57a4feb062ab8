"""Byte-level BPE by a rank queue: buckets of positions under a hierarchical bitmap of ranks.

The parts of a pre-token are a linked list.  Each adjacent pair whose bytes are a token waits
in the bucket of that token's rank; a bitmap of two levels, in words of 256 bits, says which
buckets hold something, so the lowest rank is found by two find-first-set steps.  Entries
whose pair has since changed are skipped.  A pre-token of n bytes costs n merges at most, whatever its
length, with no scan of the parts between them.

The vocabulary is read on the driver and broadcast: its size is that of the rank file,
whatever the corpus.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .names import free_name

#: Pre-tokens that a worker remembers, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 800_000, 48
#: Characters of a text that are split into pre-tokens at once.
PIECE_CHARS = 1 << 20
_CUT = regex.compile(r"\S(?=\s)")
#: The bits of a word of the bitmap.
_BIT = [1 << k for k in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """{token: rank} of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class _Known(dict):
    """The ids of pre-tokens as bytes; of those met before, the short ones are looked up."""

    def __init__(self, coder: Encoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        ids = self.coder.merge(piece.encode())
        packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Encodes and decodes by one vocabulary; remembers short pre-tokens, up to a stated number."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.find = regex.compile(pattern).findall
        self.leaf = [0] * ((max(ranks.values()) >> 8) + 1)  # all clear between pre-tokens
        self.one = [ranks[bytes([b])] for b in range(256)]
        self.two = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.known = _Known(self)

    def merge(self, piece: bytes) -> list[int]:
        """The ranks of a pre-token's parts when no adjacent pair is a token any more.

        Of pairs of the lowest rank the leftmost goes first.  The queue is written out here:
        ``leaf`` has a bit for each rank whose bucket holds a position, ``top`` one for each
        word of ``leaf`` that has a bit.
        """
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        n, longest, leaf, top = len(piece), self.longest, self.leaf, 0
        after = list(range(1, n + 1))  # of the part that starts at i: where it ends, which is where the next one starts
        before = list(range(-1, n))
        one, two = self.one, self.two
        part = [one[b] for b in piece]
        waits = [two[a << 8 | b] for a, b in zip(piece, piece[1:])]  # the rank of the pair that starts at i
        waits.append(-1)
        buckets: dict[int, list[int]] = {}
        for i, r in enumerate(waits):
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    w = r >> 8
                    leaf[w] |= _BIT[r & 255]
                    top |= 1 << w
        while top:
            w = (top & -top).bit_length() - 1
            word = leaf[w]
            low = word & -word
            r = w << 8 | low.bit_length() - 1
            bucket = buckets[r]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[r]
                leaf[w] = word = word ^ low
                if not word:
                    top ^= 1 << w
            if waits[i] != r:  # stale: the pair has changed, or its part was swallowed
                continue
            j = after[i]
            k = after[i] = after[j]
            part[i] = r
            waits[j] = -1
            if k < n:
                before[k] = i
                end = after[k]
                r = waits[i] = get(piece[i:end], -1) if end - i <= longest else -1
                if r >= 0:
                    if r in buckets:
                        heappush(buckets[r], i)
                    else:
                        buckets[r] = [i]
                        w = r >> 8
                        leaf[w] |= _BIT[r & 255]
                        top |= 1 << w
            else:
                waits[i] = -1
            if i:
                h = before[i]
                r = waits[h] = get(piece[h:k], -1) if k - h <= longest else -1
                if r >= 0:
                    if r in buckets:
                        heappush(buckets[r], h)
                    else:
                        buckets[r] = [h]
                        w = r >> 8
                        leaf[w] |= _BIT[r & 255]
                        top |= 1 << w
        out, i = [], 0
        while i < n:
            out.append(part[i])
            i = after[i]
        return out

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids as little-endian 32-bit integers, in pieces."""
        known = self.known.__getitem__
        i = 0
        while i < len(text):
            j = len(text)
            if j - i > PIECE_CHARS:
                # a pre-token never goes from a character on to white space after it, unless it is white space
                cut = _CUT.search(text, i + PIECE_CHARS)
                j = cut.end() if cut else j
            yield b"".join(map(known, self.find(text[i:j])))
            i = j

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_encoders: dict[str, Encoder] = {}


def _encoder(name: str, ranks: dict[bytes, int], pattern: str) -> Encoder:
    """This worker's encoder for a vocabulary; what it remembers serves the worker's later tasks."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(ranks, pattern)
    return _encoders[name]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document row: the id, n_tokens, ids_sha256, decoded_sha256[, ids array<int>].

    Each match of ``pattern`` is encoded for itself by the ranks in ``ranks_path``, with no
    special tokens; ids are then decoded again.  Bytes outside all matches are left out.  A
    null or empty text has no tokens.  Rows are encoded one by one, so repeated ids or texts
    are nothing special; bytes that are not UTF-8 are read as the replacement character.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    ranks = read_ranks(ranks_path)
    name = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    held = docs.sparkSession.sparkContext.broadcast(ranks)
    out_id = free_name("id", ["n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(name, held.value, pattern)
        for b in batches:
            count, ids_hash, back_hash, lists = [], [], [], []
            for raw in b.column(1).cast(pa.binary()).to_pylist():
                digest, back, n, kept = hashlib.sha256(), hashlib.sha256(), 0, []
                for ids in coder.encode(raw.decode("utf-8", "replace")) if raw else ():
                    digest.update(ids)
                    numbers = np.frombuffer(ids, "<u4")
                    back.update(coder.decode(numbers))
                    n += len(numbers)
                    if with_ids:
                        kept.append(numbers.astype(np.int32))
                count.append(n)
                ids_hash.append(digest.hexdigest())
                back_hash.append(back.hexdigest())
                lists.append(np.concatenate(kept) if kept else np.zeros(0, np.int32))
            cols = [b.column(0), pa.array(count, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(back_hash, pa.string())]
            if with_ids:
                cols.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, [out_id, "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(cols)])

    fields = f"{out_id} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias(out_id), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, fields).withColumnRenamed(out_id, id_col)


def decode_documents(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): lists of ids as the texts they stand for.

    A null or empty list is an empty text; bytes that are not UTF-8 become the replacement
    character.  An id outside the vocabulary is an error.
    """
    ship(encoded.sparkSession)
    kind = encoded.schema[id_col].dataType.simpleString()
    held = encoded.sparkSession.sparkContext.broadcast({r: t for t, r in read_ranks(ranks_path).items()})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = held.value
        for b in batches:
            texts = [b"".join(tokens[i] for i in ids or ()).decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(scan, f"id {kind}, text string").withColumnsRenamed({"id": id_col})
