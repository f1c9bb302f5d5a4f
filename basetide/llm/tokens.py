"""Tokenizers inside tasks: loaded once per Python worker, whole texts in, id arrays out."""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import regex

#: An ASCII capital with a mark behind it.
MARKED = regex.compile(r"[A-Z]\p{M}")
#: Entries of a worker's word table; when full it is emptied and filled again, which changes no result.
TABLE_ENTRIES = 800_000

#: Bytes as they are cut: capitals lower-cased, line ends and tabs as spaces.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b"\n\t\r" else c for c in range(256))
#: Kinds of bytes: 1 letters, 2 punctuation marks, 6 the apostrophe, 0 others.
_KINDS = bytes(1 if 97 <= c <= 122 else 6 if c == 39 else 2 if 33 <= c < 127 and not chr(c).isalnum() else 0 for c in range(256))


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def json_tokenizer(path: str, added: bool = False):
    """The tokenizer of a file; strings of its added tokens in a text are ordinary text unless ``added`` is set."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = not added
    return tok


@lru_cache(maxsize=4)
def _added_strings(path: str):
    """Pattern of the strings of the added tokens, or None."""
    with open(path, encoding="utf-8") as f:
        found = [t["content"] for t in json.load(f).get("added_tokens") or []]
    return re.compile("|".join(map(re.escape, found))) if found else None


#: A digit is always an id of its own; pieces without the first one are encoded in one text that has it between them.
SEPARATORS = ("7", "3")
#: Pieces that are encoded in one text.
JOINED = 4096


class _Table(dict):
    """chunk of bytes -> row of ``starts`` / ``lengths``. A missing chunk gets the next row at once; ``fill`` has the library encode
    all that are new, many in one text: white space and a digit between two chunks keep them apart."""

    def __init__(self, tok):
        super().__init__()
        self.tok, self.starts, self.lengths, self.flat, self.new = tok, array("q"), array("q"), array("I"), []
        self.separators = [(d, e.ids[0]) for d in SEPARATORS for e in [tok.encode(d, add_special_tokens=False)] if len(e.ids) == 1]

    def __missing__(self, chunk: bytes) -> int:
        row = self[chunk] = len(self.starts) + len(self.new)
        self.new.append(chunk)
        return row

    def fill(self) -> None:
        for lo in range(0, len(self.new), JOINED):
            pieces = [c.decode("utf-8", "replace") for c in self.new[lo:lo + JOINED]]
            found: list = [None] * len(pieces)
            left = range(len(pieces))
            for digit, mark in self.separators:
                some, left = [k for k in left if digit not in pieces[k]], [k for k in left if digit in pieces[k]]
                if not some:
                    continue
                joined = f" {digit} ".join(pieces[k] for k in some)
                ids = np.array(self.tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
                cuts = np.flatnonzero(ids == mark)
                if len(cuts) != len(some) - 1:  # not a digit of its own in this file
                    left = [*some, *left]
                    continue
                for k, a, b in zip(some, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]):
                    found[k] = ids[a:b].tobytes()
            for k in left:
                found[k] = np.array(self.tok.encode(pieces[k], add_special_tokens=False).ids, np.uint32).tobytes()
            for raw in found:
                self.starts.append(len(self.flat))
                self.lengths.append(len(raw) // 4)
                self.flat.frombytes(raw)
        self.new.clear()


class WordEncoder:
    """Ids of whole texts under a lower-casing tokenizer that drops white space and never joins a letter
    with a following ASCII punctuation mark (or a mark other than the apostrophe with a following letter).

    The text is cut at such places and at white space, each distinct piece is encoded once by the
    library, and the ids of a batch are gathered with array operations. The ids equal those of
    encoding the text in one call. Texts with a mark on an ASCII capital (which composes before it is
    lower-cased, or not at all) and, where ``added`` is set, with the string of an added token go to the
    library whole.
    """

    def __init__(self, path: str, added: bool = False):
        self.tok = json_tokenizer(path, added)
        self.added = _added_strings(path) if added else None
        self.release()

    def release(self) -> None:
        """Empty the word table, which is filled again as texts come."""
        self.table = _Table(self.tok)

    def _whole(self, text: str) -> bool:
        if self.added is not None and self.added.search(text):
            return True
        return not text.isascii() and MARKED.search(text) is not None

    def encode(self, texts: list[str], entries: int | None = None) -> list[np.ndarray]:
        if len(self.table) > (TABLE_ENTRIES if entries is None else entries):
            self.release()
        rows, counts, whole = [], [], {}
        for k, text in enumerate(texts):
            if self._whole(text):
                ids = self.tok.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids
                whole[k] = np.array(ids, np.uint32)
                rows.append(np.zeros(0, np.int64))
                continue
            chunks = _chunks(text)
            rows.append(np.fromiter(map(self.table.__getitem__, chunks), np.int64, len(chunks)))
        self.table.fill()
        starts, lengths = np.array(self.table.starts, np.int64), np.array(self.table.lengths, np.int64)
        flat = np.array(self.table.flat, np.uint32)
        out = []
        for k, row in enumerate(rows):
            if k in whole:
                out.append(whole[k])
                continue
            n = lengths[row]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            counts.append(total)
            out.append(flat[np.repeat(starts[row] - (ends - n), n) + np.arange(total)])
        return out


def _chunks(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "replace").translate(_PLAIN)
    kind = np.frombuffer(raw.translate(_KINDS), np.uint8)
    left, right = kind[:-1], kind[1:]
    # a letter and a mark (1 and 2 or 6), a mark but the apostrophe and a letter (2 and 1): the sums 3 and 7 of different kinds,
    # but not 6 and 1
    both = left + right
    at = np.flatnonzero((both == 3) | ((both == 7) & (left == 1)))
    if len(at):
        raw = np.insert(np.frombuffer(raw, np.uint8), at + 1, 32).tobytes()
    return raw.split(b" ")


@lru_cache(maxsize=4)
def word_encoder(path: str, added: bool = False) -> WordEncoder:
    return WordEncoder(path, added)


@lru_cache(maxsize=4)
def rank_table(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def rank_encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=rank_table(path), special_tokens={})


@lru_cache(maxsize=4)
def rank_bytes(path: str) -> list[bytes]:
    """id -> bytes"""
    ranks = rank_table(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


def narrow(ids: np.ndarray) -> bytes:
    """Ids as little-endian 16-bit integers where all fit, else 32-bit; the first byte tells which."""
    if len(ids) == 0 or ids.max() < 1 << 16:
        return b"\x02" + ids.astype("<u2").tobytes()
    return b"\x04" + ids.astype("<u4").tobytes()


def widen(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1).astype("<u4")
