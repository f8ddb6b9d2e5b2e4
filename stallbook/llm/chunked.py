"""Exact encoding of space-separated pieces with a bounded cache.

A tokenizer that splits words before its merges gives each piece between spaces the same ids wherever it stands, so
a piece is encoded once per worker and looked up after that. A group of texts is cut, and its distinct pieces are
numbered, by Arrow: Python sees a piece once in each group, however often the group's texts have it.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_PIECES = 600_000   # per generation; a worker holds two, and as many words, some 350 MB at most
GROUP = 1 << 22           # characters of text that are cut at once, and whose unknown pieces are encoded in one call


@cache
def tokenizer(path: str):
    """One tokenizer per worker process, in one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


# Characters that every version of Unicode splits, normalises and lower-cases alike: ASCII and precomposed letters.
_PLAIN = re.compile(r"[ -~\t\n\rÀ-ÖØ-öø-įıĲ-ɏ]*")
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-įıĲ-ɏ]+")


class Words:
    """Ids of a piece's words straight from the tokenizer's merges, where the way to split the piece is plain.

    The library spends most of its time on splitting and on offsets. A piece of plain characters is split here, by
    the pattern that the tokenizer's file names, and each word goes to the library's BPE model once.
    """

    def __init__(self, path: str, cached: int = CACHED_PIECES) -> None:
        import regex

        self.cached = cached

        saved = json.loads(tokenizer(path).to_str())
        self.model = tokenizer(path).model
        self.model._resize_cache(0)     # words are remembered here
        steps = saved["pre_tokenizer"].get("pretokenizers", [saved["pre_tokenizer"]])
        pattern = steps[0]["pattern"]["Regex"] if steps[0]["type"] == "Split" else _BYTE_LEVEL
        self.split = regex.compile(pattern).findall
        self.lower = bool(saved["normalizer"])      # such a file lower-cases, and leaves plain characters else
        self.added = [token["content"] for token in saved["added_tokens"]]
        self.known: dict[str, bytes] = {}

    def encode(self, piece: str, space: str) -> bytes | None:
        """The ids of a piece and the space before it, or None if the library has to see it."""
        core = piece.rstrip(_STOPS)
        if core.isalpha() and (core.isascii() or _LETTERS.fullmatch(core)):
            # Most pieces: one word, and perhaps a run of signs after it.
            word = space + (core.lower() if self.lower else core)
            ids = self.known.get(word) or self._word(word)
            if len(core) < len(piece):
                signs = piece[len(core):]
                ids += self.known.get(signs) or self._word(signs)
            return ids
        if space and not _cut_holds(piece) or not _PLAIN.fullmatch(piece) \
                or "<" in piece and any(token in piece.lower() for token in self.added):
            return None
        words = self.split(space + (piece.lower() if self.lower else piece))
        return b"".join([self.known.get(word) or self._word(word) for word in words])

    def _word(self, word: str) -> bytes:
        if len(self.known) >= self.cached:
            self.known.clear()
        symbols = word.replace(" ", "Ġ") if word.isascii() and word.isprintable() \
            else word.encode().decode("latin-1").translate(_SYMBOLS)
        ids = array("I", map(_ID, self.model.tokenize(symbols))).tobytes()
        self.known[word] = ids
        return ids


_ID = attrgetter("id")
_STOPS = ".,!?;:"     # signs that often follow a word and are split from it, one run whatever their number
# Fixed value: how byte-level tokenizers split text if their file names no pattern.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_symbols() -> dict[int, int]:
    """Byte-level tokenizers write a byte that doesn't print as the next free character from 256 on."""
    odd = [byte for byte in range(256) if not (33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255)]
    return {byte: 256 + place for place, byte in enumerate(odd)}


_SYMBOLS = _byte_symbols()


class Pieces:
    """Ids of texts that are cut at plain spaces.

    With ``lead``, a space belongs to the piece after it; without, the tokenizer drops white space. Known pieces are
    kept in two generations: when the younger is full, it becomes the older, and what is still used moves back.
    """

    def __init__(self, path: str, lead: bool, cached: int = CACHED_PIECES) -> None:
        self.tokenizer, self.lead, self.cached = tokenizer(path), lead, cached
        self.words = Words(path, cached)
        self.space = " " if lead else ""
        self.known: dict[str, bytes | None] = {}     # pieces after a space; None if they can't be encoded alone
        self.older: dict[str, bytes | None] = {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", encoding.ids).tobytes() for encoding in found]

    def _learn(self, pieces: list[str]) -> None:
        known, older, encode, space = self.known, self.older, self.words.encode, self.space
        unknown = []
        for piece in pieces:
            ids = older.get(piece)
            if ids is None:
                ids = encode(piece, space)
                if ids is None and not (self.lead and not _cut_holds(piece)):
                    unknown.append(piece)
            known[piece] = ids
        if unknown:
            known.update(zip(unknown, self._raw([space + piece for piece in unknown])))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """All ids of each text as unsigned 32-bit integers."""
        first = size = 0
        for last, text in enumerate(texts, 1):
            size += len(text)
            if size > GROUP or last == len(texts):
                yield from self._group(texts[first:last])
                first, size = last, 0

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > self.cached:
            self.older, self.known = self.known, {}
        known = self.known
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        numbered = cut.values.dictionary_encode()
        del cut
        pieces = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(known.get, pieces))
        new = [n for n, ids in enumerate(found) if ids is None]
        self._learn([pieces[n] for n in new if pieces[n] not in known])
        for n in new:
            found[n] = known[pieces[n]]
        ids = pa.array(found, pa.large_binary())
        # With a lead, a text's first piece has no space before it and is encoded by itself.
        places = numbered.indices.to_numpy()
        first = bounds[:-1] + self.lead
        odd = np.r_[0, np.cumsum(~np.asarray(ids.is_valid())[places])]
        found = ids.take(numbered.indices)
        ends, data = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1), memoryview(found.buffers()[2] or b"")
        heads = [text.partition(" ")[0] for text in texts] if self.lead else []
        starts = self._raw(heads) if self.lead else [b""] * len(texts)
        for n, (a, b) in enumerate(zip(first.tolist(), bounds[1:].tolist())):
            if odd[b] > odd[a] or self.lead and a < b and not _cut_holds(heads[n]):
                yield b"".join(self._around_white_space([heads[n], *(" " + piece for piece in texts[n].split(" ")[1:])]))
            else:
                yield starts[n] + bytes(data[ends[a]:ends[b]])

    def _around_white_space(self, pieces: list[str]) -> list[bytes]:
        """Pieces with white space at an end are encoded together with their neighbours."""
        regions, glued = [], False
        for piece in pieces:
            odd = not _cut_holds(piece.removeprefix(" "))
            if regions and (odd or glued):
                regions[-1] += piece
            else:
                regions.append(piece)
            glued = odd
        return self._raw(regions)

    def encode(self, text: str) -> bytes:
        return next(self._group([text]))


@cache
def pieces_of_worker(path: str, lead: bool) -> Pieces:
    """One cache per worker process, which the tasks that run there one after another share."""
    return Pieces(path, lead)


def _cut_holds(piece: str) -> bool:
    """Whether a piece between two spaces can be encoded alone: neither of its ends is white space."""
    if not piece:
        return False
    first, last = piece[0], piece[-1]
    return (first.isalnum() or "!" <= first <= "~") and (last.isalnum() or "!" <= last <= "~")
