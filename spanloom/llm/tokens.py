"""Exact tokenisation of whole texts with a bounded cache of chunks in each worker.

A text is cut where the tokenizer itself can never join two sides, so the ids of
the text are the ids of its chunks in order.  Most chunks repeat, so a worker
encodes each of them once and keeps the bytes.  Texts that the cheap cut does
not suit (odd white space) are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

ODD_SPACE = re.compile(r"[^\S \n]")
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
#: A full stop or comma that begins a pre-token, as a letter or digit stands before it.
STOP, LATE_STOP = re.compile(f"[.,](?<=[{LETTERS}0-9][.,])"), re.compile(f"[.,](?<![{LETTERS}0-9][.,])")
#: A chunk that is one pre-token: Latin letters, perhaps after a blank.
PLAIN = re.compile(f" ?[{LETTERS}]+")
#: Entries of one cache; workers live on from stage to stage with theirs.
CACHE_LIMIT = 350_000
#: Longer chunks are rare and are not kept, so that entries bound a cache's bytes.
LONG = 64


class Chunks(dict):
    """chunk -> what is kept for it; emptied when it holds ``limit`` entries.  Chunks
    longer than LONG are forgotten with the next texts."""

    def __init__(self, encode, limit: int = CACHE_LIMIT, first=()):
        super().__init__(first)
        self.encode, self.limit, self.first, self.long = encode, limit, dict(first), []

    def learn(self, chunks: set) -> None:
        for c in self.long:
            self.pop(c, None)
        # Not chunks.difference(self): for a subclass of dict that walks the whole cache.
        new = [c for c in chunks if c not in self]
        if new:
            if len(self) + len(new) > self.limit:
                self.clear()
                self.update(self.first)
                new = [c for c in chunks if c not in self]
            self.update(zip(new, self.encode(new)))
        self.long = [c for c in new if len(c) > LONG]


def groups(texts: list, size: int = 1 << 19) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters together; null counts as empty."""
    out, held = [], 0
    for text in texts:
        out.append(text or "")
        held += len(out[-1])
        if held >= size:
            yield out
            out, held = [], 0
    if out:
        yield out


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def id_bytes(path: str, texts: list[str]) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit integers, by the library alone."""
    return [array("I", x.ids).tobytes() for x in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def stops(text: str, mark: str) -> str:
    """The text with a mark before each full stop or comma after a letter or digit."""
    if LATE_STOP.search(text):
        return STOP.sub(mark + "\\g<0>", text)
    return text.replace(".", mark + ".").replace(",", mark + ",")


def cut_words(text: str) -> list[str] | None:
    """For tokenizers that drop white space: chunks between blanks and line ends,
    a full stop or comma after a letter or digit begins another."""
    return stops(text.replace("\n", " "), " ").split(" ")


def cut_bytes(text: str) -> list[str] | None:
    """For byte-level pre-tokens that take one blank before a word: chunks are a
    single blank with the word after it, a line end, or begin with a full stop or
    comma after a letter or digit.  None: the text has white space for which this
    cut could be wrong."""
    flat = text.replace("\n", " ")
    if "  " in flat or flat[:1] == " " or flat[-1:] == " " or not flat.isprintable() and ("\0" in flat or ODD_SPACE.search(flat)):
        return None
    return stops(text.replace(" ", "\0 ").replace("\n", "\0\n\0"), "\0").split("\0")


CUTS = {"word": cut_words, "byte": cut_bytes}


@lru_cache(maxsize=1)
def byte_signs() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable sign: itself, or 256 and up in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(other)}


class Ids(dict):
    """chunk -> its ids as little-endian unsigned 32-bit bytes: a chunk that is one
    pre-token through the library's BPE model alone, others as whole texts.  Two
    generations of at most ``limit`` entries; what the elder is asked for again
    moves to the younger."""

    def __init__(self, path: str, kind: str, limit: int = CACHE_LIMIT):
        super().__init__()
        self.path, self.kind, self.limit, self.elder, self.tokenize = path, kind, limit, {}, tokenizer(path).model.tokenize

    def piece(self, text: str) -> bytes:
        if self.kind == "word":
            text = text.lower()
        signs = text.replace(" ", "\u0120") if text.isascii() else text.encode().decode("latin-1").translate(byte_signs())
        return array("I", [t.id for t in self.tokenize(signs)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.elder.get(chunk)
        if ids is None:
            ids = self.piece(chunk) if PLAIN.fullmatch(chunk) else id_bytes(self.path, [chunk])[0]
            if len(chunk) > LONG:
                return ids
        if len(self) >= self.limit:
            self.elder = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


@lru_cache(maxsize=4)
def ids_of(path: str, kind: str) -> Ids:
    return Ids(path, kind)


def encode_texts(path: str, kind: str, texts: list) -> Iterator[bytes]:
    """Ids of each whole text (null: none) as little-endian unsigned 32-bit bytes."""
    cut, get = CUTS[kind], ids_of(path, kind).__getitem__
    for text in texts:
        parts = cut(text or "")
        yield id_bytes(path, [text])[0] if parts is None else b"".join(map(get, parts))
