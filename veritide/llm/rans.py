"""Token ids in compressed files: range asymmetric numeral systems over static tables.

Documents are put in order of their ids by ranges, one range for each task. A task tokenizes its
texts, and writes segments of whole documents and about ``SEGMENT`` tokens, a row of Parquet each. A
segment has one table of frequencies, made of its own tokens, which all its blocks share; a block of
``BLOCK`` tokens has its own states and stands alone. Its tokens are dealt to ``lanes`` coders that
interleave their words in one stream, so numpy takes a step of all lanes at once.

Bytes of a segment: a header, the table, the checkpoints (for each block its tokens, the place and
number of its words, and the crc32 of its ids), the index of documents, the states, the words.
``Segment.block`` decodes one block from its checkpoint; a checksum that differs fails. ``first`` of a segment counts
the ids before it in its range, so global positions need only the sums of the ranges.

Edge cases: a null text counts as empty and has its end id only; documents without an id come first;
rows of one id are ordered by a hash of their text, equal rows as they are read; an empty table gives no files' rows.
"""

from __future__ import annotations

import struct
import sys
import types
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritide.llm.common import col
from veritide.llm.vocabulary import CUT, PIECE, Recent, Spec, byte_letters, plain_pieces, stretches

SEGMENT = 1 << 21
BLOCK = 1 << 18
LANES = 1024
END = 0
#: Bytes that one generation of what a task remembers takes.
CHUNKS_KEPT = 40 << 20
PIECES_KEPT = 8 << 20
#: Bytes of text that are encoded together, chunks given to the library at once, and chunks in one of its inputs.
SLICE = 1 << 24
GROUP = 50_000
WORDS = 1000
#: Fixed value: a space before white space or at the end, where not every space is a cut.
WIDE = r" (?:[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"
LOW = np.uint64(1 << 31)
ID = attrgetter("id")
MAGIC = b"VTRANS1\n"
HEADER = "<8sIIIIIII"  # documents, alphabet, bits, lanes, blocks, table and index bytes
CHECKPOINT = np.dtype([("tokens", "<u4"), ("word", "<u8"), ("words", "<u4"), ("crc32", "<u4")])
INDEX = np.dtype([("id", "<i8"), ("known", "u1"), ("tokens", "<u8")])


def frequencies(counts: np.ndarray, bits: int) -> np.ndarray:
    """Counts scaled to a sum of 2^bits, each at least 1."""
    total = 1 << bits
    scaled = np.maximum(1, counts.astype(np.float64) * total / counts.sum()).astype(np.int64)
    over = int(scaled.sum()) - total
    order = np.argsort(-scaled, kind="stable")
    if over < 0:
        scaled[order[0]] -= over
    while over > 0:  # rare symbols were raised to 1; common ones give way
        for i in order:
            take = min(over, int(scaled[i]) // 2)
            scaled[i] -= take
            over -= take
            if not over:
                break
    return scaled


class Table:
    def __init__(self, alphabet: np.ndarray, frequency: np.ndarray, bits: int):
        self.alphabet, self.bits = alphabet, np.uint64(bits)
        self.frequency = frequency.astype(np.uint64)
        self.start = (np.cumsum(frequency) - frequency).astype(np.uint64)
        self.most = self.frequency << (np.uint64(63) - self.bits)
        self.symbol = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency)

    def encoded(self, symbols: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """States that decoding starts from, and the words, in the order of reading."""
        state = np.full(lanes, LOW, np.uint64)
        chunks = []
        for at in range((len(symbols) - 1) // lanes * lanes, -1, -lanes):
            s = symbols[at : at + lanes]
            x, f = state[: len(s)], self.frequency[s]
            full = x >= self.most[s]
            chunks.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
            whole = x // f
            state[: len(s)] = (whole << self.bits) + (x - whole * f) + self.start[s]
        return state, np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")

    def decoded(self, state: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        lanes, state = len(state), state.copy()
        out, at = np.empty(n, np.uint32), 0
        mask = np.uint64((1 << int(self.bits)) - 1)
        for place in range(0, n, lanes):
            x = state[: min(lanes, n - place)]
            low = x & mask
            s = self.symbol[low.astype(np.int64)]
            out[place : place + len(x)] = s
            x = self.frequency[s] * (x >> self.bits) + low - self.start[s]
            short = np.flatnonzero(x < LOW)
            x[short] = (x[short] << np.uint64(32)) | words[at : at + len(short)].astype(np.uint64)
            at += len(short)
            state[: len(x)] = x
        if at != len(words) or (state != LOW).any():  # where encoding began
            raise ValueError("a block's words differ from what was written")
        return out


def _alphabet(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, the number of each token's id among them, and how often each occurs."""
    if int(flat.max()) >= 1 << 22:
        return np.unique(flat, return_inverse=True, return_counts=True)
    counts = np.bincount(flat)
    alphabet = np.flatnonzero(counts)
    number = np.zeros(len(counts), np.int64)
    number[alphabet] = np.arange(len(alphabet))
    return alphabet, number[flat], counts[alphabet]


def packed(ids: list[int | None], tokens: list[np.ndarray]) -> bytes:
    """The bytes of a segment from its documents' ids and tokens (at least one in all)."""
    flat = np.concatenate(tokens).astype("<u4")
    alphabet, symbols, counts = _alphabet(flat)
    bits = min(24, max(12, len(alphabet).bit_length() + 4))
    frequency = frequencies(counts, bits)
    table = Table(alphabet, frequency, bits)
    lanes = min(LANES, max(1, len(flat) // 256))
    states, words, checkpoints, word = [], [], [], 0
    for at in range(0, len(flat), BLOCK):
        state, own = table.encoded(symbols[at : at + BLOCK], lanes)
        part = flat[at : at + BLOCK]
        checkpoints.append((len(part), word, len(own), zlib.crc32(part.tobytes())))
        states.append(state.astype("<u8"))
        words.append(own)
        word += len(own)
    index = np.array([(i or 0, i is not None, len(t)) for i, t in zip(ids, tokens, strict=True)], INDEX)
    static = np.stack([np.diff(alphabet, prepend=0), frequency]).astype("<u4")
    table_bytes, index_bytes = zlib.compress(static.tobytes(), 6), zlib.compress(index.tobytes(), 6)
    header = struct.pack(
        HEADER,
        MAGIC, len(ids), len(alphabet), bits, lanes, len(states), len(table_bytes), len(index_bytes)
    )
    tail = np.array(checkpoints, CHECKPOINT).tobytes()
    return b"".join(
        [header, table_bytes, tail, index_bytes, *(s.tobytes() for s in states), *(w.tobytes() for w in words)]
    )


@dataclass(frozen=True)
class Segment:
    """A segment's head: its table, and where its blocks and its index of documents are."""

    body: bytes
    documents: int
    table: Table
    checkpoints: np.ndarray
    index: np.ndarray
    states: int  # where they begin
    lanes: int

    @staticmethod
    def opened(body: bytes) -> Segment:
        magic, documents, size, bits, lanes, blocks, table_size, index_size = struct.unpack_from(HEADER, body)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        at = struct.calcsize(HEADER)
        static = np.frombuffer(zlib.decompress(body[at : at + table_size]), "<u4").reshape(2, size)
        table = Table(np.cumsum(static[0]).astype("<u4"), static[1].astype(np.int64), bits)
        at += table_size
        checkpoints = np.frombuffer(body, CHECKPOINT, blocks, at)
        at += checkpoints.nbytes
        index = np.frombuffer(zlib.decompress(body[at : at + index_size]), INDEX)
        return Segment(body, documents, table, checkpoints, index, at + index_size, lanes)

    def block(self, number: int) -> np.ndarray:
        """The ids of one block, from its checkpoint, states and words alone; fails if its checksum differs."""
        point = self.checkpoints[number]
        state = np.frombuffer(self.body, "<u8", self.lanes, self.states + 8 * self.lanes * number)
        words = self.states + 8 * self.lanes * len(self.checkpoints) + 4 * int(point["word"])
        own = np.frombuffer(self.body, "<u4", int(point["words"]), words)
        part = self.table.alphabet[self.table.decoded(state.astype(np.uint64), own, int(point["tokens"]))]
        if zlib.crc32(part.tobytes()) != point["crc32"]:
            raise ValueError("a block's checksum differs")
        return part


def unpacked(body: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """Ids and tokens of a segment's documents; fails if a block's checksum differs."""
    segment = Segment.opened(body)
    flat = np.concatenate([segment.block(i) for i in range(len(segment.checkpoints))])
    bounds = np.concatenate([[0], np.cumsum(segment.index["tokens"].astype(np.int64))])
    ids = [int(r["id"]) if r["known"] else None for r in segment.index]
    if len(ids) != segment.documents or bounds[-1] != len(flat):
        raise ValueError("a segment's index differs from its blocks")
    return ids, [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def _models(spec: Spec) -> tuple:
    """The library's tokenizer, its BPE model, a tokenizer that gives the model what stands between spaces, the added
    tokens, and which ids start with a space. Made once for a Python worker; their size is the vocabulary's."""
    kept = sys.modules.setdefault("_veritide_models", types.ModuleType("_veritide_models")).__dict__
    if kept.get("content") != spec.content:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        tokenizer, parsed = Tokenizer.from_str(spec.content), spec.parsed()
        tokenizer.no_truncation()
        tokenizer.no_padding()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parsed["model"]["merges"]]
        vocab = parsed["model"]["vocab"]
        # The library's own memory of pieces would be asked in vain: pieces come here once.
        model = models.BPE(vocab, merges, cache_capacity=0)
        words = Tokenizer(model)
        words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        added = [t["content"] for t in parsed.get("added_tokens", [])]
        starts = np.zeros(max([*vocab.values(), *(t["id"] for t in parsed.get("added_tokens", []))]) + 1, bool)
        space = byte_letters()[ord(" ")]
        starts[[i for x, i in vocab.items() if x.startswith(space)]] = True
        kept.update(content=spec.content, models=(tokenizer, model, words, added, starts))
    return kept["models"]


class Library:
    """Ids by the tokenizers library; what it made of a chunk lately is remembered. Pieces go to its
    BPE model; the start of a text and what holds an added token go through the whole tokenizer. The
    chunks of a slice of texts are given to it together."""

    def __init__(self, spec: Spec):
        self.tokenizer, self.model, self.words, self.added, self.starts = _models(spec)
        self.letter = np.array([ord(x) for x in byte_letters()], "<u4")
        self.letter[ord(" ")] = ord(" ")  # here a space only parts words
        self.letters = {b: ord(x) for b, x in enumerate(byte_letters())}
        self.space = byte_letters()[ord(" ")]
        self.by_chunk = Recent(self._chunk, CHUNKS_KEPT)
        self.by_piece = Recent(self._piece, PIECES_KEPT)
        self.by_line = Recent(self._line, PIECES_KEPT)

    def _model(self, letters: str) -> bytes:
        ids = list(map(ID, self.model.tokenize(letters)))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        return self._model(piece.encode().decode("latin-1").translate(self.letters))

    def _first(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _line(self, part: str) -> bytes:
        """The ids of what stands between line breaks, or a line break and a space; no white space at its edges."""
        if any(token in part for token in self.added):
            return self._first(part)
        return b"".join(map(self.by_piece.__getitem__, PIECE.findall(part)))

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._model(self.space + chunk) if chunk.isascii() else self._piece(" " + chunk)
        pieces = plain_pieces(chunk)
        if pieces is None:
            head, *lines = chunk.split("\n")
            if lines and not any(not x or x[0].isspace() or x[-1].isspace() for x in (head, *lines)):
                # A line break alone between other text is a piece, whatever stands around it.
                found = [self.by_chunk[head]]
                for line in lines:
                    found += [self.by_piece["\n"], self.by_line[line]]
                return b"".join(found)
            if any(token in chunk for token in self.added):
                return self._first(" " + chunk)
            pieces = PIECE.findall(" " + chunk)
        word, *rest = pieces  # a word that stands alone elsewhere, and what follows it
        first = self.by_chunk[word[1:]] if word[1:].isalpha() else self.by_piece[word]
        return first + b"".join(map(self.by_piece.__getitem__, rest))

    def packed(self, text: str | None) -> bytes:
        return stretches(text or "", self._first, self.by_chunk)

    def _lettered(self, words: list[str]) -> str:
        letters = self.letter[np.frombuffer(" ".join(words).encode(), np.uint8)].tobytes().decode("utf-32-le")
        return self.space + letters.replace(" ", " " + self.space)

    def _together(self, chunks: list[str], letters: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of chunks without a space, each with one before it, and how many of each. Only that space starts an id
        with one. Chunks of letters alone need no more than the model."""
        ids, sizes = [], []
        for at in range(0, len(chunks), GROUP):
            group = chunks[at : at + GROUP]
            parts = [group[i : i + WORDS] for i in range(0, len(group), WORDS)]
            if letters:
                found = self.words.encode_batch_fast([self._lettered(p) for p in parts], add_special_tokens=False)
            else:
                found = self.tokenizer.encode_batch_fast([" " + " ".join(p) for p in parts], add_special_tokens=False)
            flat = np.concatenate([np.array(e.ids, "<u4") for e in found])
            starts = np.flatnonzero(self.starts[flat])
            if len(starts) == len(group):
                ids.append(flat)
                sizes.append(np.diff(starts, append=len(flat)))
            else:  # a vocabulary without the space
                alone = [np.array(self.tokenizer.encode(" " + c, add_special_tokens=False).ids, "<u4") for c in group]
                ids += alone
                sizes += self._counted(alone)[1]
        return ids, sizes

    @staticmethod
    def _counted(ids: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        return ids, [np.array([len(x) for x in ids], np.int64)]

    def all_packed(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text. Chunks are numbered, each of them is encoded once, and their ids are put in
        the order of the texts."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        wide = np.asarray(pc.match_substring_regex(texts, WIDE))
        cut = pa.array([CUT.split(t) for t in texts.filter(pa.array(wide)).to_pylist()], pa.list_(pa.large_string()))
        parts = pa.concat_arrays([pc.split_pattern(texts.filter(pa.array(~wide)), " "), cut])
        bounds = np.asarray(parts.offsets)
        first = np.zeros(len(parts.values), bool)
        first[bounds[:-1]] = True
        numbered = parts.values.filter(pa.array(~first)).dictionary_encode()
        chunks = numbered.dictionary
        # Letters alone, a space inside, and the rest.
        kind = np.where(np.asarray(pc.match_substring(chunks, " ")), 1, 2)
        kind[np.asarray(pc.match_substring_regex(chunks, r"^\p{L}+$"))] = 0
        words, spaced, others = (chunks.filter(pa.array(kind == k)).to_pylist() for k in range(3))
        heads = self.tokenizer.encode_batch_fast(parts.values.filter(pa.array(first)).to_pylist(), add_special_tokens=False)
        ids, sizes = [], []
        for found in (
            self._together(words, True),
            self._counted([np.frombuffer(self._chunk(c), "<u4") for c in spaced]),
            self._together(others, False),
            self._counted([np.array(e.ids, "<u4") for e in heads]),
        ):
            ids += found[0]
            sizes += found[1]
        entry = np.empty(len(chunks), np.int64)
        entry[np.argsort(kind, kind="stable")] = np.arange(len(chunks))
        entries = np.empty(len(first), np.int64)
        entries[~first] = entry[np.asarray(numbered.indices)]
        entries[first] = len(chunks) + np.arange(len(heads))
        ends = np.concatenate([[0], np.cumsum(4 * np.concatenate(sizes).astype(np.int64))])
        data = np.concatenate(ids)
        table = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]
        )
        taken = table.take(pa.array(entries))
        offsets, flat = (np.frombuffer(b, kind) for b, kind in zip(taken.buffers()[1:], ("<i8", "<u4"), strict=True))
        at = offsets[bounds] // 4
        place = np.empty(len(wide), np.int64)  # texts with wide spaces came last
        place[np.argsort(wide, kind="stable")] = np.arange(len(wide))
        return [flat[at[i] : at[i + 1]] for i in place]


FILE = "part int, first long, n_docs long, n_tokens long, body binary"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of about ``SLICE`` bytes of text at a time."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0)), dtype=np.int64)
        at = 0
        while at < len(batch):
            past = SLICE + (int(ends[at - 1]) if at else 0)
            n = max(1, int(np.searchsorted(ends, past, "right")) - at)
            yield batch.slice(at, n)
            at += n


def _segments(spec: Spec):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, library = TaskContext.get().partitionId(), Library(spec)
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        first = held = 0

        def row() -> pa.RecordBatch:
            values = part, first, len(ids), held, packed(ids, tokens)
            kinds = pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
            arrays = [pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "first", "n_docs", "n_tokens", "body"])

        for batch in _slices(batches):
            own = (batch.column(c).to_pylist() for c in ("doc_id", "known"))
            for doc_id, is_id, found in zip(*own, library.all_packed(batch.column("text")), strict=True):
                ids.append(doc_id if is_id else None)
                tokens.append(np.append(found, np.uint32(END)))
                held += len(tokens[-1])
                if held >= SEGMENT:
                    yield row()
                    first, held, ids, tokens = first + held, 0, [], []
        if ids:
            yield row()

    return write


def write_tokens(
    documents: DataFrame, spec: Spec, folder: str, *, ranges: int | None = None, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Writes the ids of all texts, an end id after each, in ascending order of the integer ids."""
    spark = documents.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(
        F.coalesce(col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        col(doc_id).isNotNull().alias("known"),
        col(text).alias("text"),
        F.xxhash64(col(text)).alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Rows of one id and text are interchangeable; their places part them, so many of them fill no range.
    order = ["known", "doc_id", "tie", "place"]
    ordered = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    ordered.drop("tie", "place").mapInArrow(_segments(spec), FILE).write.parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids before the document), ``n_tokens`` (with the end id) and ``ids`` (packed) of
    each document in the files. Segments are decoded where they are read."""
    files = spark.read.schema(FILE).parquet(folder)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = sums.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, first, body in zip(frame["part"], frame["first"], frame["body"], strict=True):
                ids, tokens = unpacked(body)
                n = np.array([len(t) for t in tokens])
                yield pd.DataFrame(
                    {
                        "part": part,
                        "doc_id": pd.array(ids, dtype="Int64"),
                        "start": first + np.cumsum(n) - n,
                        "n_tokens": n,
                        "ids": [t.tobytes() for t in tokens],
                    }
                )

    found = files.select("part", "first", "body").mapInPandas(
        read, "part int, doc_id long, start long, n_tokens long, ids binary"
    )
    # A row for each range: sent to where documents are, so their ids are not shuffled.
    return found.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids"
    )
