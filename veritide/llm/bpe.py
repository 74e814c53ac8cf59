"""Byte-level BPE encoding and decoding.

The symbols of a piece form a doubly linked list; a priority queue holds the merges that can be made,
by rank, then from the left. A merge joins two neighbours and queues the pairs that this makes;
entries whose symbols have changed since are stale and skipped. Decoding concatenates the vocabulary
strings of the ids.

Texts are cut where any context cuts them, at a space before other text; what a task has seen lately it
remembers in two generations bounded by bytes, which end with the task unless a worker is to keep them for its
other tasks. Ids travel as little-endian unsigned 32-bit numbers in a binary column, a quarter of what an array of longs takes. Results are handed on every
``SLICE`` bytes of text, and texts that are only compared or hashed don't leave the Python worker.

Edge cases: a null text counts as empty and gives no ids; null ids decode to an empty text; an id
that the vocabulary doesn't hold fails; invalid UTF-8 is decoded with replacement marks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.llm.common import col, fresh
from veritide.llm.vocabulary import PIECE, Recent, Spec, byte_letters, per_worker, plain_pieces, stretches

#: Bytes that one generation of what a task remembers takes.
CHUNKS_KEPT = 8 << 20
PIECES_KEPT = 32 << 20
#: The same for a worker that keeps it for its next tasks.
WORKER_CHUNKS = 16 << 20
WORKER_PIECES = 48 << 20
#: Bytes of text after which results are handed on.
SLICE = 4 << 20

#: Fields that can be made of a text.
FIELDS = {
    "ids": ("binary", pa.binary()),
    "n_tokens": ("long", pa.int64()),
    "decoded": ("string", pa.string()),
    "same_text": ("boolean", pa.bool_()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


class Encoder:
    def __init__(self, spec: Spec, chunks: int | None = None, pieces: int | None = None):
        parsed = spec.parsed()
        vocab, letters = parsed["model"]["vocab"], byte_letters()
        self.symbol = [vocab[x] for x in letters]
        self.shift = max(vocab.values()).bit_length()
        self.rank: dict[int, int] = {}
        self.joined: list[int] = []
        for pair in parsed["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[a] << self.shift | vocab[b], len(self.joined))
            self.joined.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        self.by_piece = Recent(self._piece, pieces or PIECES_KEPT)
        self.by_chunk = Recent(self._chunk, chunks or CHUNKS_KEPT)

    def merged(self, data: bytes) -> list[int]:
        """The ids of one piece. Entries of the queue are rank and place in one number; one is stale
        if the pair at its place has another rank by now. A symbol merged away is -1."""
        ids = [self.symbol[b] for b in data]
        n, find, shift, joined = len(ids), self.rank.get, self.shift, self.joined
        queue = []
        for i in range(n - 1):
            rank = find(ids[i] << shift | ids[i + 1])
            if rank is not None:
                queue.append(rank << 32 | i)
        if not queue:
            return ids
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            left, j = ids[i], after[i]
            if left < 0 or j >= n or find(left << shift | ids[j]) != rank:
                continue
            new = ids[i] = joined[rank]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = find(new << shift | ids[k])
                if rank is not None:
                    heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = find(ids[h] << shift | new)
                if rank is not None:
                    heappush(queue, rank << 32 | h)
        return [x for x in ids if x >= 0]

    def _piece(self, piece: str) -> bytes:
        ids = self.merged(piece.encode())
        return pack(f"<{len(ids)}I", *ids)

    def _first(self, text: str) -> bytes:
        return b"".join(map(self.by_piece.__getitem__, PIECE.findall(text)))

    def _chunk(self, chunk: str) -> bytes:
        pieces = plain_pieces(chunk) or PIECE.findall(" " + chunk)
        return b"".join(map(self.by_piece.__getitem__, pieces))

    def _plain(self, text: str) -> bytes:
        return stretches(text, self._first, self.by_chunk)

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers. Strings of added tokens are
        those tokens; the leftmost counts, and of two at one place the longer."""
        text = text or ""
        out, at = [], 0
        while True:
            found = [(p, -len(t), t) for t in self.added if (p := text.find(t, at)) >= 0]
            if not found:
                return b"".join([*out, self._plain(text[at:])])
            place, _, token = min(found)
            out += [self._plain(text[at:place]), pack("<I", self.added[token])]
            at = place + len(token)


class Decoder:
    def __init__(self, spec: Spec):
        parsed = spec.parsed()
        byte_of = {x: b for b, x in enumerate(byte_letters())}
        known = {i: t for t, i in parsed["model"]["vocab"].items()}
        known |= {t["id"]: t["content"] for t in parsed.get("added_tokens", [])}
        self.string = [b""] * (max(known) + 1)
        for i, t in known.items():
            inside = all(c in byte_of for c in t)
            self.string[i] = bytes(byte_of[c] for c in t) if inside else t.encode()

    def text(self, packed: bytes | None) -> str:
        ids = np.frombuffer(packed or b"", "<u4").tolist()
        return b"".join(map(self.string.__getitem__, ids)).decode("utf-8", "replace")


def _in_slices(values: Iterator[pa.Array], make, kind: pa.DataType) -> Iterator[pa.Array]:
    """What ``make`` makes of each value, in arrays of about ``SLICE`` bytes of the values."""
    for batch in values:
        out, held = [], 0
        for value in batch:
            plain = value.as_py()
            out.append(make(plain))
            held += len(plain or "")
            if held >= SLICE:
                yield pa.array(out, kind)
                out, held = [], 0
        yield pa.array(out, kind)


def encoded(text: Column, spec: Spec) -> Column:
    """The ids of a text, packed."""

    @F.arrow_udf("binary")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _in_slices(texts, Encoder(spec).packed, pa.binary())

    return run(text)


def decoded(ids: Column, spec: Spec) -> Column:
    """The text of packed ids."""

    @F.arrow_udf("string")
    def run(packed: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _in_slices(packed, Decoder(spec).text, pa.string())

    return run(ids)


def tokens(text: Column, spec: Spec, *fields: str, keep: bool = False) -> Column:
    """A struct of the named ``FIELDS`` of a text, encoded and decoded in one pass.

    ``keep`` leaves what is remembered (two generations of ``WORKER_CHUNKS`` and ``WORKER_PIECES`` bytes) to a worker's next tasks:
    less work, and memory that stays taken.

    ``decoded`` is the text that decoding the ids gives, ``same_text`` whether that is the text, and the hashes
    are SHA-256 in hex of ``ids`` and of ``decoded`` in UTF-8.
    """
    names = list(fields)
    arrow = pa.struct([(name, FIELDS[name][1]) for name in names])

    @F.arrow_udf("struct<" + ", ".join(f"{name}: {FIELDS[name][0]}" for name in names) + ">")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = lambda s: Encoder(s, WORKER_CHUNKS, WORKER_PIECES)
        encoder = per_worker("encoder", spec, own) if keep else Encoder(spec)
        decoder = Decoder(spec)

        def made(text: str | None) -> dict:
            ids = encoder.packed(text)
            back = decoder.text(ids)
            whole = {"ids": ids, "n_tokens": len(ids) // 4, "decoded": back, "same_text": back == (text or "")}
            if "ids_sha256" in names:
                whole["ids_sha256"] = sha256(ids).hexdigest()
            if "decoded_sha256" in names:
                whole["decoded_sha256"] = sha256(back.encode()).hexdigest()
            return {name: whole[name] for name in names}

        yield from _in_slices(texts, made, arrow)

    return run(text)


def round_trip(documents: DataFrame, spec: Spec, *fields: str, text: str = "text") -> DataFrame:
    """The documents with the named ``FIELDS``, ``ids``, ``n_tokens`` and ``decoded`` if none is named.

    Where the documents have a column of such a name, underscores are added to the new one.
    """
    names = list(fields or ("ids", "n_tokens", "decoded"))
    held = fresh(documents, "tokens")
    made = documents.withColumn(held, tokens(col(text), spec, *names))
    return made.select(
        *[col(c) for c in documents.columns], *[col(held).getField(n).alias(fresh(documents, n)) for n in names]
    )


def digests(documents: DataFrame, spec: Spec, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and the SHA-256 of ids and decoded text of a round trip."""
    made = tokens(col(text), spec, "n_tokens", "ids_sha256", "decoded_sha256", keep=True)
    return documents.select(col(doc_id).alias("doc_id"), made.alias("made")).select("doc_id", "made.*")
