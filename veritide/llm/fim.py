"""Fill-in-middle: a document's prefix, suffix and middle around sentinels, cut between tokens.

A token is a run of the letters A to Z in either case, or any other single character. Its cuts are drawn
from a hash of the id, so where they fall takes the number of tokens and the places of two of them. Both
come from chunks: a rolling hash of the text's bytes cuts it where the content says so, hence passages
that texts share give the same chunks wherever they stand. A task remembers the boundary summary of
each chunk by its content (equal bytes, not an equal hash, are a hit): tokens, characters, and whether it
starts and ends inside a run of letters. Summaries add up to running counts, in which a binary search
finds the chunk of a cut; only that chunk is looked at token by token.

The memory of a task is bounded by ``REMEMBERED`` bytes of chunks; a chunk has ``LONGEST`` bytes at most, so a
text of one character repeated is cut as well. Nothing is shuffled.

Edge cases: a null text counts as empty and is plain; a null id draws as the empty string; repeated rows
give repeated results; a column called like the result is kept, and the result takes another name.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.llm.common import col, fresh

#: The sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SEED = 1

CUT_BELOW = 1 << 22  # of 2^32: a cut every 1,024 bytes or so
LONGEST = 8192
REMEMBERED = 64 << 20
#: Results are handed on in blocks of about so many bytes of text.
BLOCK = 4 << 20

GEAR = np.array([int.from_bytes(sha256(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CONTINUED = bytes(range(0x80, 0xC0))
KINDS = bytes(ord("a") if b in LETTERS else ord(".") for b in range(256))
TOKEN = re.compile(rb"[A-Za-z]+|[^A-Za-z][\x80-\xBF]*")
START = re.compile(rb"[A-Za-z]+")

RESULT = "struct<n: long, form: string, prefix_chars: long, middle_chars: long, output: string>"


def cuts(data: bytes) -> list[int]:
    """Where the chunks of a UTF-8 text end. A gear hash of the last 32 bytes decides; a cut never parts the
    bytes of a character."""
    rolled = GEAR[np.frombuffer(data, np.uint8)]
    for span in (1, 2, 4, 8, 16):  # the hash of 2 * span bytes from two of span bytes
        longer = rolled.copy()
        longer[span:] += rolled[:-span] << np.uint32(span)
        rolled = longer
    found = (np.flatnonzero(rolled < CUT_BELOW) + 1).tolist()
    ends, last = [], 0
    for end in [*found, len(data)]:
        while end - last > LONGEST:
            forced = last + LONGEST
            while data[forced] & 0xC0 == 0x80:
                forced -= 1
            ends.append(forced)
            last = forced
        if end > last and (end == len(data) or data[end] & 0xC0 != 0x80):
            ends.append(end)
            last = end
    return ends


@dataclass(frozen=True, slots=True)
class Summary:
    """What a chunk adds to a text: its tokens if it stood alone, its characters, and its edges."""

    tokens: int
    chars: int
    opens: bool
    closes: bool


def summary(chunk: bytes) -> Summary:
    kinds = chunk.translate(KINDS, CONTINUED)
    opens = kinds[:1] == b"a"
    return Summary(kinds.count(b".") + kinds.count(b".a") + opens, len(kinds), opens, kinds[-1:] == b"a")


class Chunks:
    """Summaries of chunks by content; of two generations the older goes when the newer is full."""

    def __init__(self, remembered: int = REMEMBERED):
        self.limit, self.held = remembered // 2, 0
        self.newer: dict[bytes, Summary] = {}
        self.older: dict[bytes, Summary] = {}

    def summary(self, chunk: bytes) -> Summary:
        found = self.newer.get(chunk)
        if found is None:
            found = self.older.get(chunk) or summary(chunk)
            if self.held > self.limit:
                self.older, self.newer, self.held = self.newer, {}, 0
            self.newer[chunk] = found
            self.held += len(chunk) + 200
        return found


class Counted:
    """A text with the running counts of its chunks."""

    def __init__(self, data: bytes, memory: Chunks):
        self.data = data
        self.ends = cuts(data) if data else []
        starts = [0, *self.ends]
        self.found = [memory.summary(data[a:b]) for a, b in zip(starts, self.ends, strict=False)]
        # A run of letters that goes on over a border is one token, which the chunk of its start counts.
        self.joined = [False, *[a.closes and b.opens for a, b in zip(self.found, self.found[1:], strict=False)]]
        own = [s.tokens - j for s, j in zip(self.found, self.joined, strict=False)]
        self.tokens = [0, *accumulate(own)]
        self.chars = [0, *accumulate(s.chars for s in self.found)]

    @property
    def n(self) -> int:
        return self.tokens[-1]

    def after(self, units: int) -> tuple[int, int]:
        """The byte and the character at which the first ``units`` tokens end."""
        if units == self.n:
            return len(self.data), self.chars[-1]
        at = bisect_right(self.tokens, units) - 1  # the chunk in which the next token starts
        start = self.ends[at - 1] if at else 0
        chunk = self.data[start : self.ends[at]]
        place = START.match(chunk).end() if self.joined[at] else 0
        for _ in range(units - self.tokens[at]):
            place = TOKEN.match(chunk, place).end()
        inside = len(chunk[:place].translate(None, CONTINUED))
        return start + place, self.chars[at] + inside


def transformed_text(doc_id: str, data: bytes, memory: Chunks) -> tuple[int, str, int | None, int | None, bytes]:
    """``n``, ``form``, the characters of prefix and middle, and the output of a text."""
    text = Counted(data, memory)
    drawn = sha256(f"{SEED}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in range(0, 32, 8))
    if not data or h3 % 100 >= 100 - PLAIN_PERCENT or any(s.encode() in data for s in (PREFIX, SUFFIX, MIDDLE)):
        return text.n, "plain", None, None, data
    first, last = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
    (a, a_chars), (b, b_chars) = text.after(first), text.after(last)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if h4 % 100 < SPM_PERCENT:
        form, output = "spm", b"".join([s, suffix, p, prefix, m, middle])
    else:
        form, output = "psm", b"".join([p, prefix, s, suffix, m, middle])
    return text.n, form, a_chars, b_chars - a_chars, output


def _structs(rows: list[tuple]) -> pa.Array:
    kinds = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.binary()}
    fields = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    arrays = [pa.array(f, k) for f, k in zip(fields, kinds.values(), strict=True)]
    arrays[-1] = arrays[-1].cast(pa.string())
    return pa.StructArray.from_arrays(arrays, names=list(kinds))


def transformed(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", into: str = "fim") -> DataFrame:
    """The documents with the struct ``into``: ``n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (null if plain) and ``output``. Where the documents have a column ``into``, underscores are added
    to the new name."""

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        memory, rows, held = Chunks(), [], 0  # of one task, gone with it
        for ids, texts in batches:
            for i, t in zip(ids, texts.cast(pa.large_binary()), strict=True):
                data = t.as_py() or b""
                rows.append(transformed_text(i.as_py() or "", data, memory))
                held += len(data)
                if held >= BLOCK:
                    yield _structs(rows)
                    rows, held = [], 0
            yield _structs(rows)
            rows, held = [], 0

    return documents.withColumn(fresh(documents, into), run(col(doc_id).cast("string"), col(text)))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A text that holds a sentinel is plain, so each is there once."""
    middle = F.substring_index(output, MIDDLE, -1)
    head = F.substring_index(output, MIDDLE, 1)
    psm = F.concat(F.substring(F.substring_index(head, SUFFIX, 1), 4, 1 << 30), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, F.substring(F.substring_index(head, PREFIX, 1), 4, 1 << 30))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, what ``transformed`` says of each document, and the SHA-256 of output and restored text."""
    narrow = documents.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    made = transformed(narrow, into="fim").select("doc_id", "fim.*")
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
