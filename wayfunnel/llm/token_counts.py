"""Token counts of whole texts for a SentencePiece BPE model.

The model's own scores give the order in which pairs merge. No piece has a space after another
character, so merging never crosses the start of a word: words are merged apart from each other,
each distinct word once per batch, and a bounded number of them is remembered.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfunnel.llm.bpe import Merges, merge
from wayfunnel.llm.common import map_texts
from wayfunnel.llm.words import WordTable, spans

SPACE = "▁"


class PieceModel:
    """Pieces, merges and the counts of single symbols of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        special = [
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
            for i in range(size)
        ]
        scores = {model.id_to_piece(i): model.get_score(i) for i in range(size) if not special[i]}
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in scores):
            raise ValueError("the model has pieces that cross the start of a word")
        if [model.encode(" "), model.encode("a  b", out_type=str)[:1]] != [
            model.encode(SPACE),
            [f"{SPACE}a"],
        ]:
            raise ValueError("the model does not put a space before a text")
        alphabet = sorted({character for piece in scores for character in piece})
        self.ids = {piece: i for i, piece in enumerate(scores)}
        for character in alphabet:
            self.ids.setdefault(character, len(self.ids))
        # 0 for a character that no piece has; it never merges
        self.symbol = np.zeros(0x110000, np.int64)
        codes = np.array([ord(c) for c in alphabet])
        self.symbol[codes] = np.array([self.ids[c] for c in alphabet]) + 1
        rank = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rows = [
            (self.ids[piece[:cut]] + 1, self.ids[piece[cut:]] + 1, rank[score], self.ids[piece] + 1)
            for piece, score in scores.items()
            for cut in range(1, len(piece))
            if piece[:cut] in self.ids and piece[cut:] in self.ids
        ]
        self.merges = Merges(*np.array(rows, np.int64).T)
        # of a character that is left unmerged: one token if it is a piece, else one for each byte
        size = np.ones(0x110000, np.int64)
        size[0x80:], size[0x800:], size[0x10000:] = 2, 3, 4
        size[[ord(p) for p in scores if len(p) == 1]] = 1
        self.size = size
        self.cost = np.ones(len(self.ids) + 1, np.int64)
        for character in alphabet:
            if character not in scores:  # such a character left alone falls back to bytes
                self.cost[self.ids[character] + 1] = len(character.encode())
        # whether some piece has the two characters next to each other
        self.joins = np.zeros((256, 256), bool)
        for piece in scores:
            for a, b in zip(piece, piece[1:], strict=False):
                if ord(a) < 256 and ord(b) < 256:
                    self.joins[ord(a), ord(b)] = True

    def counts(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each word, given as symbols one after another."""
        merged, sizes = merge(symbols, lengths, self.merges)
        return np.add.reduceat(self.cost[merged], np.cumsum(sizes) - sizes)


@dataclass(frozen=True)
class Counter:
    """Counts tokens of lists of whole texts."""

    path: str
    kept_words: int = 300_000

    def counter(self):
        model = PieceModel(self.path)
        table = WordTable(self.kept_words)
        known = np.zeros(0, np.int64)
        space = ord(SPACE)

        def count(texts: list[str | None]) -> np.ndarray:
            nonlocal known
            totals = np.zeros(len(texts), np.int64)
            spaced = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
            codes = np.frombuffer("".join(spaced).encode("utf-32-le"), np.uint32)
            if not len(codes):
                return totals
            ends = np.cumsum([len(t) for t in spaced])
            symbols = model.symbol[codes]
            owner = np.searchsorted(ends, np.flatnonzero(symbols == 0), side="right")
            alone = model.size[codes[symbols == 0]]
            totals += np.bincount(owner, alone, minlength=len(texts)).astype(np.int64)
            # a word starts where no piece can reach over from the character before
            start = symbols != 0
            small = np.minimum(codes, 255).astype(np.uint8)
            apart = ~model.joins[small[:-1], small[1:]] & (codes[:-1] < 255) & (codes[1:] < 255)
            apart |= (symbols[:-1] == 0) | ((codes[1:] == space) & (codes[:-1] != space))
            start[1:] &= apart
            start[ends[:-1][ends[:-1] < len(codes)]] = True
            starts = np.flatnonzero(start)
            stop = np.flatnonzero(start | (symbols == 0))
            lengths = np.append(stop, len(codes))[np.searchsorted(stop, starts) + 1] - starts
            number, new_starts, new_lengths = table.find(codes, starts, lengths)
            fresh = np.zeros(0, np.int64)
            if len(new_starts):
                fresh = model.counts(symbols[spans(new_starts, new_lengths)], new_lengths)
            tokens = np.append(known, fresh)[number]
            owner = np.searchsorted(ends, starts, side="right")
            known = np.append(known, fresh[table.keep()])
            return totals + np.bincount(owner, tokens, minlength=len(texts)).astype(np.int64)

        return count


def count_tokens(
    documents: DataFrame,
    counter: Counter,
    *,
    text: str = "text",
    carry: list[str],
    limit: int = 4096,
) -> DataFrame:
    """The carried columns, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens).

    Tokens are those of the library without begin and end; null counts as empty, with 0 tokens.
    Repeated rows are counted each. Carried columns must not be called n_bytes, n_tokens or
    over_limit; others are neither read nor returned.
    """
    state: list = []

    def work(texts: list[str | None]) -> list[pa.Array]:
        if not state:
            state.append(counter.counter())
        sizes = [len(t.encode()) if t else 0 for t in texts]
        return [pa.array(sizes, pa.int64()), pa.array(state[0](texts), pa.int64())]

    counted = map_texts(documents, text, carry, "n_bytes long, n_tokens long", work)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
