"""A byte-level BPE vocabulary file and the pieces that its pre-tokenizer cuts text into."""

from __future__ import annotations

import json
import re
import sys
import types
from dataclasses import dataclass

import regex

#: Fixed value: the pattern of byte-level pre-tokenizers. White space is Unicode's.
PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: A space before other text is a piece's start wherever it stands, so texts can be cut there.
CUT = re.compile(r" (?=\S)")


@dataclass(frozen=True)
class Spec:
    """The contents of a tokenizer file. The driver reads it; it goes along with the functions."""

    content: str

    @staticmethod
    def read(path: str) -> Spec:
        with open(path, encoding="utf-8") as file:
            spec = Spec(file.read())
        spec.checked()
        return spec

    def parsed(self) -> dict:
        return json.loads(self.content)

    def checked(self) -> None:
        """Refuses what the byte-level operators would get wrong."""
        spec = self.parsed()
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        plain = plain and model.get("type", "BPE") == "BPE" and not spec.get("normalizer")
        plain = plain and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        )
        for token in spec.get("added_tokens", []):
            plain = plain and not any(token.get(k) for k in ("lstrip", "rstrip", "single_word"))
            plain = plain and not re.search(r"\s", token["content"])
        if not plain:
            raise ValueError("only plain byte-level BPE files are supported")


#: Longer keys are found anew each time, so a long stretch takes no memory once its text is done.
LONGEST_KEY = 64
ENTRY = 200  # bytes that an entry takes besides its key's characters, four bytes each at most, and its value's


class Recent(dict):
    """Remembers what ``find`` made of a key; of two generations the older is forgotten when the
    newer has ``limit`` bytes, so frequent keys stay and memory is bounded whatever the keys are."""

    def __init__(self, find, limit: int):
        self.find, self.limit, self.older, self.held = find, limit, {}, 0

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
        if len(key) <= LONGEST_KEY:
            self.held += 4 * len(key) + len(value) + ENTRY
            if self.held > self.limit:
                self.older, self.held = dict(self), 0
                self.clear()
            self[key] = value
        return value


def stretches(text: str, of_first, by_chunk: Recent) -> bytes:
    """The packed ids of a text, stretch by stretch: what stands before its first space, then the
    parts that follow a space (without it) and are cut off in any context."""
    first, *rest = text.split(" ")
    try:
        return of_first(first) + b"".join(map(by_chunk.__getitem__, rest))
    except KeyError:  # white space after a space: not every space is a cut
        first, *rest = CUT.split(text)
        return of_first(first) + b"".join(map(by_chunk.__getitem__, rest))


def plain_pieces(chunk: str) -> list[str] | None:
    """The pieces of a part after a space if it is a word, or one with a stop; else None. A part that
    starts with white space is none: KeyError."""
    if chunk.isalpha():
        return [" " + chunk]
    if not chunk or chunk[0].isspace():
        raise KeyError(chunk)
    if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
        return [" " + chunk[:-1], chunk[-1]]
    return None


def per_worker(name: str, spec: Spec, make):
    """One object for all tasks of a Python worker; what it remembers must be bounded by bytes."""
    kept = sys.modules.setdefault("_veritide_worker", types.ModuleType("_veritide_worker")).__dict__
    if name not in kept or kept[name][0] != spec.content:
        kept[name] = (spec.content, make(spec))
    return kept[name][1]


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]
