"""Encoding and decoding with a BPE tokenizer, long texts in parallel pieces that are joined as a tree.

For tokenizers that drop white space and mark word ends, such as ``word_bpe_49k.json``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.chunked import Pieces, tokenizer
from stallbook.llm.common import map_rows, text_hash
from stallbook.sources.shared import pinned

PIECE = 32_768     # characters; texts beyond it are cut into pieces of about this length
WINDOW = 4         # tokens re-encoded on either side of a join at first
MARGIN = 16        # characters of one kind on both sides of a cut inside a word
FAN = 8            # neighbours that one exchange of the tree brings together
CACHED = 300_000   # pieces a worker remembers per generation

# Characters that Unicode normalisation and lower-casing keep apart from what stands before them, all letters.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿА-яぁ-ゖァ-ヺ一-龥가-힣"
_SIGN = "!-/:-@\\[-`{-~"
_BETWEEN = re.compile(r"(?= )|(?<=[0-9])(?=[0-9])")
_INSIDE = re.compile("|".join(f"(?<=[{kind}]{{{MARGIN}}})(?=[{kind}]{{{MARGIN}}})" for kind in (_LETTER, _SIGN)))


def pieces_of(text: str, size: int = PIECE) -> list[tuple[str, bool]]:
    """Cut a text into pieces of about ``size`` characters: (piece, whether its last word goes on in the next).

    A cut lies before a space or between digits, where no token spans it, or else well inside a run of letters or
    of signs, which is certainly one word. A text that has no such place stays longer.
    """
    found, start = [], 0
    while len(text) - start > size:
        half = start + size // 2
        cut = _BETWEEN.search(text, half, start + size)
        inside = None
        if not cut:
            cut = inside = _INSIDE.search(text, half)
            later = _BETWEEN.search(text, start + size, cut.start() if cut else len(text))
            if later:
                cut, inside = later, None
        if not cut:
            break
        found.append((text[start:cut.start()], inside is not None))
        start = cut.start()
    return [*found, (text[start:], False)]


class WordModel:
    """The merges of one word or of a part of it, and which tokens end a word."""

    def __init__(self, path: str) -> None:
        from tokenizers import models

        self.whole = tokenizer(path)
        saved = json.loads(self.whole.to_str())
        self.suffix = saved["model"]["end_of_word_suffix"] or ""
        merges = [tuple(merge) if isinstance(merge, list) else tuple(merge.split(" "))
                  for merge in saved["model"]["merges"]]
        self.open = models.BPE(vocab=saved["model"]["vocab"], merges=merges)
        names = {id_: name for name, id_ in self.whole.get_vocab(with_added_tokens=True).items()}
        self.added = set(self.whole.get_added_tokens_decoder())
        self.names = names
        self.ends = np.zeros(max(names) + 1, bool)
        for id_, name in names.items():
            self.ends[id_] = name.endswith(self.suffix) or id_ in self.added

    def letters(self, ids: list[int]) -> str:
        """The ids' symbols, without the mark of the word's end."""
        return "".join(self.names[id_].removesuffix(self.suffix) for id_ in ids)

    def part(self, symbols: str, final: bool) -> list[int]:
        return [token.id for token in (self.whole.model if final else self.open).tokenize(symbols)]


@cache
def word_model(path: str) -> WordModel:
    return WordModel(path)


def encode_piece(pieces: Pieces, model: WordModel, text: str, opened: bool) -> np.ndarray:
    """Ids of a piece; if its last word goes on in the next piece, that part gets no word end."""
    ids = np.frombuffer(pieces.encode(text), "<u4")
    if not opened:
        return ids
    earlier = np.flatnonzero(model.ends[ids[:-1]])
    start = earlier[-1] + 1 if len(earlier) else 0
    tail = model.part(model.letters(ids[start:].tolist()), False)
    return np.concatenate([ids[:start], np.array(tail, "<u4")])


def joined(model: WordModel, left: np.ndarray, right: np.ndarray, opened: bool) -> np.ndarray:
    """The ids of two neighbouring pieces as one.

    Across an open word the tokens around the join are encoded again, in a window that grows until its first token
    is the one that the left side has there and its last the one that the right side has. Every two neighbouring
    tokens of the result then stand next to each other in an encoding of their own, which for merges in a fixed
    order makes the whole sequence the encoding of the whole.
    """
    if not opened:
        return np.concatenate([left, right])
    ends = np.flatnonzero(model.ends[left])
    start = ends[-1] + 1 if len(ends) else 0            # where the open word begins on the left
    ends = np.flatnonzero(model.ends[right])
    stop = ends[0] + 1 if len(ends) else len(right)     # where it ends on the right, unless it goes on
    a, b = left[start:].tolist(), right[:stop].tolist()
    width = WINDOW
    while True:
        i, j = max(0, len(a) - width), min(len(b), width)
        window = model.part(model.letters(a[i:] + b[:j]), j == len(b) and len(ends) > 0)
        if (i == 0 or window[0] == a[i]) and (j == len(b) or window[-1] == b[j - 1]):
            return np.concatenate([left[:start + i], np.array(window, "<u4"), right[j:]])
        width *= 2


def encode(documents: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
           size: int = PIECE) -> DataFrame:
    """(id, ids) per row: the ids of the whole text, as the tokenizers library gives them without special tokens.

    Null text is encoded as empty, to no ids; rows are never dropped and a repeated row repeats its result; an empty
    table gives an empty result. Texts over ``size`` characters are cut into pieces, which tasks encode in parallel,
    each distinct text once; neighbours are then joined two and two as a tree, ``FAN`` of them for each exchange.
    """
    return _encoded(documents, tokenizer_path, id_column, text_column, size, False)


def encode_and_decode(documents: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
                      size: int = PIECE) -> DataFrame:
    """(id, ids, decoded) per row, the rows of ``decode`` over those of ``encode``.

    Ids are decoded where they are made, so no task feeds one Python worker from another: an executor keeps as many
    workers as it has cores rather than twice as many, and ids don't travel between the two.
    """
    return _encoded(documents, tokenizer_path, id_column, text_column, size, True)


def _encoded(documents: DataFrame, tokenizer_path: str, id_column: str, text_column: str, size: int,
             decoded: bool) -> DataFrame:
    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    is_long = F.length("text") > size

    def short(pieces: Pieces, ids: list, texts: list) -> Iterator[tuple]:
        for key, found in zip(ids, pieces.encode_all(texts)):
            numbers = np.frombuffer(found, "<i4")
            yield (key, numbers, _decoded(tokenizer_path, numbers.tolist())) if decoded else (key, numbers)

    result = "ids array<int>" + ", decoded string" * decoded
    setup = partial(Pieces, tokenizer_path, lead=False, cached=CACHED)
    encoded = map_rows(rows.where(~is_long), f"id {kind}, {result}", short, setup=setup)
    h1, h2 = text_hash("text")
    long = pinned(rows.where(is_long).withColumns({"h1": h1, "h2": h2}))
    longest = long.agg(F.max(F.length("text"))).first()[0]
    if longest is None:
        return encoded

    def cut(h1s: list, h2s: list, texts: list) -> Iterator[tuple]:
        for a, b, text in zip(h1s, h2s, texts):
            for n, (piece, opened) in enumerate(pieces_of(text, size)):
                yield a, b, n, piece, opened

    parts = map_rows(long.select("h1", "h2", "text"), "h1 long, h2 long, n int, piece string, opened boolean", cut, 64)
    # One exchange both deals the pieces out to all tasks and leaves one of those that repeat.
    parts = parts.groupBy("h1", "h2", "n").agg(F.first("piece").alias("piece"), F.first("opened").alias("opened"))

    def piecewise(pieces: Pieces, h1s: list, h2s: list, ns: list, flags: list, texts: list) -> Iterator[tuple]:
        for a, b, n, opened, text in zip(h1s, h2s, ns, flags, texts):
            yield a, b, n, opened, encode_piece(pieces, word_model(tokenizer_path), text, opened).view("<i4")

    node = "h1 long, h2 long, n int, opened boolean, ids array<int>"
    nodes = map_rows(parts.select("h1", "h2", "n", "opened", "piece"), node, piecewise, 64, setup)

    def merged(key: tuple, group: pd.DataFrame) -> dict:
        """Neighbours, two and two until one is left."""
        group = group.sort_values("n")
        parts = [(ids.view("u4"), bool(opened)) for ids, opened in zip(group.ids, group.opened)]
        del group
        while len(parts) > 1:
            pairs = [(joined(word_model(tokenizer_path), parts[k][0], parts[k + 1][0], parts[k][1]), parts[k + 1][1])
                     for k in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[2 * len(pairs):]
        (ids, opened), = parts
        return {"h1": [key[0]], "h2": [key[1]], "n": [key[2]], "opened": [opened], "ids": [ids.view("i4")]}

    def together(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(merged(key, group))

    def whole(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """The last step, which has all ids of a text."""
        found = merged(key, group)
        return pd.DataFrame(found | {"decoded": [_decoded(tokenizer_path, found["ids"][0].tolist())]})

    # A piece is longer than half the size.
    most = 2 * longest // size + 1
    while most > 1:
        most = -(-most // FAN)
        groups = nodes.groupBy("h1", "h2", (F.col("n") / FAN).cast("int").alias("n"))
        nodes = groups.applyInPandas(whole, f"{node}, decoded string") if decoded and most == 1 else \
            groups.applyInPandas(together, node)
    return encoded.unionAll(long.select("id", "h1", "h2").join(nodes, ["h1", "h2"]).select(encoded.columns))


def _decoded(tokenizer_path: str, ids: list[int]) -> str:
    return tokenizer(tokenizer_path).decode(ids, skip_special_tokens=False)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(id, ids, decoded): the library's own decoding of the whole sequence, special tokens kept; null ids as none."""
    kind = encoded.schema["id"].dataType.simpleString()

    def rows(keys: list, sequences: list) -> Iterator[tuple]:
        for key, ids in zip(keys, sequences):
            yield key, ids or [], _decoded(tokenizer_path, ids or [])

    return map_rows(encoded.select("id", "ids"), f"id {kind}, ids array<int>, decoded string", rows, 256)
