"""Whole texts to token ids with a public tokenizer file, the same ids as encoding each text at once.

Texts are cut where the tokenizer cuts them anyway, and the ids of the pieces are kept in a bounded
store per Python worker, as words repeat. A text whose white space leaves any doubt about the
cuts is given to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LATIN, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
# Letters up to white space or a mark, marks up to white space, else all up to white space.
BYTE_PIECES = re.compile(rf" ?[{LATIN}]+(?![^ \n{MARKS}])|[{MARKS}]+(?![^ \n])| ?[^ \n]+|[ \n]")
WORD_PIECES = re.compile(rf"[{LATIN}]+(?![^\s{MARKS}])|[{MARKS}]+(?!\S)|\S+")
PLAIN = re.compile(rf" ?[{LATIN}]+|[{MARKS}]+")
DOUBTFUL = re.compile(r"\s\s")
SEPARATORS = re.compile(r"[\x1c-\x1f]")
MOST_PIECES = 600_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class Kept(dict):
    """Ids of pieces already seen; others are looked up in the older half, else made."""

    def __init__(self, older: dict[str, bytes], make):
        self.older, self.make = older, make

    def __missing__(self, piece: str) -> bytes:
        got = self[piece] = self.older.get(piece) or self.make(piece)
        return got


class Encoder:
    """ids(text) gives little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str, most: int = MOST_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model, self.most = self.tokenizer.model, most
        self.four = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.letters = byte_letters()
        self.pieces = Kept({}, self.piece)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        first = (made["pre_tokenizer"] or {}).get("pretokenizers", [made["pre_tokenizer"] or {}])[0]
        lower = any(n["type"] == "Lowercase" for n in (made["normalizer"] or {}).get("normalizers", []))
        self.kind = "whole"
        if lower and first.get("behavior") == "Removed" and first.get("invert"):
            self.kind = "words"
        elif made["normalizer"] is None and first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space"):
            self.kind = "bytes"

    def whole(self, text: str) -> bytes:
        return self.join(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def join(self, ids: list[int]) -> bytes:
        return b"".join([self.four[i] for i in ids])

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.kind == "words" and not SEPARATORS.search(text):
            chunks = WORD_PIECES.findall(text)
        elif self.kind == "bytes" and not DOUBTFUL.search(text):
            chunks = BYTE_PIECES.findall(text)
        else:
            return self.whole(text)
        if len(self.pieces) > self.most:  # pieces in use come back from the older half
            self.pieces = Kept(dict(self.pieces), self.piece)
        return b"".join(map(self.pieces.__getitem__, chunks))

    def piece(self, chunk: str) -> bytes:
        """Letters or marks alone are one pre-token, which the merges take directly."""
        if not PLAIN.fullmatch(chunk):
            return self.whole(chunk)
        if self.kind == "words":
            chunk = chunk.lower()
        if chunk.isascii():
            mapped = chunk.replace(" ", self.letters[32])
        else:
            mapped = "".join([self.letters[b] for b in chunk.encode()])
        return self.join([t.id for t in self.model.tokenize(mapped)])


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
