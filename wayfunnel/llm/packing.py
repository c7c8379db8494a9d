"""Packing token sequences into windows of fixed length.

A document's ids are cut into full windows and one rest. The rests' lengths form a histogram, which
is all that planning needs: shallow combinations of length classes that fill a window get repeat
counts by non-negative least squares, rounded down; what remains is packed greedily, longest first.
Every pattern is applied to as many sequences as its repeat count says, by the rank of each piece
among those of its length. Planning works on at most `window` counts, whatever the number of pieces.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfunnel.llm.bpe import Merges, merge
from wayfunnel.llm.common import fresh, map_texts, written
from wayfunnel.llm.words import WordTable, spans

PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


SPACE, LETTER, DIGIT, MARK = range(4)


def _latin_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and class of the characters below 256; all of them are in composed form, and none
    but the letters changes in lower case."""
    lower = np.arange(256, dtype=np.uint8)
    kind = np.full(256, MARK, np.uint8)
    for code in range(256):
        character = chr(code)
        if character.isalpha() and len(character.lower()) == 1:
            lower[code] = ord(character.lower())
            kind[code] = LETTER
        elif character.isnumeric():
            kind[code] = DIGIT
        elif character.isspace() and not 0x1C <= code <= 0x1F:
            kind[code] = SPACE
    return lower, kind


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is visible, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte if byte in visible else next(spare)) for byte in range(256)]


class WordPieces:
    """Ids for a BPE file whose tokens mark the end of a word and drop white space.

    Texts of characters below 256 are cut into pre-tokens and merged here, many at a time. Other
    texts, and those with the string of a special token, go to the library.
    """

    def __init__(self, path: str, kept_words: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, suffix = content["model"]["vocab"], content["model"]["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        rows = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        left, right, merged = np.array(rows, np.int64).T
        self.merges = Merges(left, right, np.arange(len(rows)), merged)
        characters = _byte_characters()
        self.inside = np.array([vocabulary[c] for c in characters], np.int64)
        self.closing = np.array([vocabulary[c + suffix] for c in characters], np.int64)
        self.special = [t["content"] for t in content["added_tokens"]]
        self.lower, self.kind = _latin_tables()
        self.table = WordTable(kept_words)
        self.ids = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)

    def _pre_tokens(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the pre-tokens of lower-case data that begins with a space: runs of
        letters, single digits, runs of marks; 's 't 're 've 'm 'll 'd where no mark goes before."""
        kind = self.kind[data]
        border = np.ones(len(data), bool)
        border[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        quotes = np.flatnonzero((data == ord("'")) & border)
        quotes = quotes[quotes + 1 < len(data)]
        padded = np.append(data, [0, 0])
        one, two = padded[quotes + 1], padded[quotes + 2]
        single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        double = (
            ((one == ord("r")) & (two == ord("e")))
            | ((one == ord("v")) & (two == ord("e")))
            | ((one == ord("l")) & (two == ord("l")))
        )
        border[quotes[single | double] + 1] = False
        after = np.concatenate([quotes[single] + 2, quotes[double] + 3])
        border[after[after < len(data)]] = True
        borders = np.flatnonzero(border)
        lengths = np.diff(np.append(borders, len(data)))
        used = kind[borders] != SPACE
        return borders[used], lengths[used]

    def _merged(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """Ids of words, one after another, and how many each has. Characters from 128 on are two
        bytes in UTF-8."""
        codes = data[spans(starts, lengths)]
        wide = codes >= 128
        width = 1 + wide.astype(np.int64)
        place = np.cumsum(width) - width
        utf8 = np.zeros(width.sum(), np.uint8)
        utf8[place] = np.where(wide, 0xC0 | (codes >> 6), codes)
        utf8[place[wide] + 1] = 0x80 | (codes[wide] & 0x3F)
        sizes = np.add.reduceat(width, np.cumsum(lengths) - lengths)
        symbols = self.inside[utf8]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.closing[utf8[last]]
        return merge(symbols, sizes, self.merges)

    def latin(self, texts: list[bytes]) -> list[bytes]:
        data = self.lower[np.frombuffer(b" " + b" ".join(texts), np.uint8)]
        ends = np.cumsum([len(t) + 1 for t in texts])
        starts, lengths = self._pre_tokens(data)
        if not len(starts):
            return [b""] * len(texts)
        number, new_starts, new_lengths = self.table.find(data, starts, lengths)
        ids, sizes = self.ids, self.sizes
        if len(new_starts):
            new_ids, new_sizes = self._merged(data, new_starts, new_lengths)
            ids = np.append(ids, new_ids.astype(np.uint32))
            sizes = np.append(sizes, new_sizes)
        first = np.cumsum(sizes) - sizes
        size = sizes[number]
        flat = ids[spans(first[number], size)].astype("<u4").tobytes()
        total = np.bincount(np.searchsorted(ends, starts, side="right"), size, minlength=len(texts))
        stops = (np.cumsum(total.astype(np.int64)) * 4).tolist()
        kept = self.table.keep() + len(self.sizes)
        self.ids = np.append(self.ids, ids[spans(first[kept], sizes[kept])])
        self.sizes = np.append(self.sizes, sizes[kept])
        return [flat[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        latin, other = [], []
        for i, text in enumerate(texts):
            try:
                if any(s in text for s in self.special):
                    raise UnicodeError
                latin.append((i, text.encode("latin-1")))
            except UnicodeError:
                other.append((i, text))
        result = [b""] * len(texts)
        if latin:
            for (i, _), ids in zip(latin, self.latin([t for _, t in latin]), strict=True):
                result[i] = ids
        if other:
            found = self.library.encode_batch([t for _, t in other], add_special_tokens=False)
            for (i, _), one in zip(other, found, strict=True):
                result[i] = np.array(one.ids, "<u4").tobytes()
        return result


@dataclass(frozen=True)
class Tokens:
    """Ids of whole texts as the `tokenizers` file gives them, each text ended by one id."""

    path: str
    end: int | None = 2
    kept_words: int = 300_000

    def encoder(self):
        pieces = WordPieces(self.path, self.kept_words)
        closing = b"" if self.end is None else np.array([self.end], "<u4").tobytes()

        def encode(texts: list[str | None]) -> list[bytes]:
            return [ids + closing for ids in pieces.encode([t or "" for t in texts])]

        return encode


def cut(
    documents: DataFrame,
    tokens: Tokens,
    *,
    window: int = 4096,
    text: str = "text",
    carry: list[str],
    ids: bool = False,
) -> DataFrame:
    """One row per piece: the carried columns, start, length, ids_crc32, doc_tokens and, if asked
    for, the ids. Full windows first, then the rest. Null and empty texts have the end id only;
    without an end id they have no piece."""
    kind = "struct<start:long,length:long,ids_crc32:long,doc_tokens:long"
    kind += ",ids:array<int>>" if ids else ">"
    holder = fresh("pieces", carry)
    state: list = []

    def work(texts: list[str | None]) -> list[pa.Array]:
        if not state:
            state.append(tokens.encoder())
        rows = []
        for data in state[0](texts):
            total = len(data) // 4
            pieces = []
            for start in range(0, total, window):
                part = data[4 * start : 4 * (start + window)]
                piece = {
                    "start": start,
                    "length": len(part) // 4,
                    "ids_crc32": zlib.crc32(part),
                    "doc_tokens": total,
                }
                if ids:
                    piece["ids"] = np.frombuffer(part, "<i4")
                pieces.append(piece)
            rows.append(pieces)
        fields = [pa.field(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
        fields += [pa.field("ids", pa.list_(pa.int32()))] if ids else []
        return [pa.array(rows, pa.list_(pa.struct(fields)))]

    found = map_texts(documents, text, carry, f"`{holder}` array<{kind}>", work)
    return found.select(*carry, F.inline(holder))


@dataclass(frozen=True)
class Plan:
    """Where the pieces go: rows sorted by (length, first rank). The pieces with ranks first to
    first + repeats * times - 1 of a length lie `times` to a sequence, from `offset` on, in the
    sequences from `sequence` on."""

    length: np.ndarray
    first: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def combinations_filling(classes: int) -> np.ndarray:
    """All multisets of one to three classes 1..classes that add up to `classes`, as a matrix of
    how often each class occurs in each combination."""
    found = [(classes,)]
    found += [(a, classes - a) for a in range(1, classes // 2 + 1)]
    for a in range(1, classes // 3 + 1):
        found += [(a, b, classes - a - b) for b in range(a, (classes - a) // 2 + 1)]
    matrix = np.zeros((classes + 1, len(found)))
    for column, combination in enumerate(found):
        for one in combination:
            matrix[one, column] += 1
    return matrix[1:]


def least_squares(matrix: np.ndarray, target: np.ndarray, most_steps: int = 3000) -> np.ndarray:
    """x >= 0 with the smallest |matrix x - target|, by the active-set method."""
    x = np.zeros(matrix.shape[1])
    active = np.zeros(len(x), bool)
    tolerance = 1e-9 * max(1.0, np.abs(target).max(initial=0))
    for _ in range(most_steps):
        slope = matrix.T @ (target - matrix @ x)
        slope[active] = -np.inf
        entering = int(slope.argmax())
        if slope[entering] <= tolerance:
            break
        active[entering] = True
        while True:
            where = np.flatnonzero(active)
            solved = np.linalg.lstsq(matrix[:, where], target, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[where] = solved
                break
            falling = solved <= 0
            step = (x[where][falling] / (x[where][falling] - solved[falling] + 1e-300)).min()
            x[where] += step * (solved - x[where])
            x[where[x[where] <= 1e-12]] = 0
            before = active.sum()
            active &= x > 1e-12
            if active.sum() == before or not active.any():
                break
    return x


class _Counts:
    """Counts by length, with the longest available length up to a limit."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.available = np.flatnonzero(self.left).tolist()

    def longest(self, limit: int) -> int:
        place = bisect_right(self.available, limit)
        return self.available[place - 1] if place else 0

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            self.available.pop(bisect_right(self.available, length) - 1)


def plan(histogram: np.ndarray, window: int, classes: int = 256) -> Plan:
    """Patterns for pieces counted by length (index 0 unused) and the ranks they apply to.

    Each greedy pattern uses up at least one length, so there are no more of them than lengths.
    """
    counts = histogram.astype(np.int64)
    patterns: list[tuple[list[tuple[int, int]], int]] = []  # [(length, times)], repeats
    if counts[window]:
        patterns.append(([(window, 1)], int(counts[window])))
    rest = counts.copy()
    rest[window] = 0
    width = -(-window // classes)
    slots = window // width
    class_of = -(-np.arange(window + 1) // width)
    by_class = np.bincount(class_of, rest, minlength=classes + 1)[1 : slots + 1]
    matrix = combinations_filling(slots)
    usable = (matrix[by_class == 0] == 0).all(axis=0)
    matrix = matrix[:, usable]
    filled: list[tuple[list[int], int]] = []
    if matrix.shape[1] and by_class.any():
        repeats = np.floor(least_squares(matrix, by_class) + 1e-6).astype(np.int64)
        left_in_class = by_class.astype(np.int64).copy()
        for column in np.argsort(-repeats, kind="stable"):
            needed = matrix[:, column].astype(np.int64)
            use = needed > 0
            n = min(int(repeats[column]), int((left_in_class[use] // needed[use]).min()))
            if n > 0:
                left_in_class -= n * needed
                filled.append((np.repeat(np.arange(1, slots + 1), needed).tolist(), n))
    stock = _Counts(rest)
    drawn: list[tuple[list[int], int]] = []
    for combination, n in filled:
        # longest of each class first; a run lasts while all its lengths last
        while n:
            lengths = [stock.longest(one * width) for one in combination]
            runs = n
            for length in set(lengths):
                runs = min(runs, int(stock.left[length]) // lengths.count(length))
            if not runs:
                # the last piece of a length serves only some of the combination's slots
                lengths, runs = [], 1
                for one in combination:
                    lengths.append(stock.longest(one * width))
                    stock.take(lengths[-1], 1)
                for length in lengths:
                    _give_back(stock, length)
            for length in lengths:
                stock.take(length, runs)
            drawn.append((lengths, runs))
            n -= runs
    for lengths, n in drawn:
        _fill(stock, lengths, n, window, patterns)
    while stock.available:
        length = stock.longest(window)
        times = min(window // length, int(stock.left[length]))
        n = int(stock.left[length]) // times
        stock.take(length, n * times)
        _fill(stock, [length] * times, n, window, patterns)
    return _lay_out(patterns, window)


def _give_back(stock: _Counts, length: int) -> None:
    if not stock.left[length]:
        stock.available.insert(bisect_right(stock.available, length), length)
    stock.left[length] += 1


def _fill(
    stock: _Counts, lengths: list[int], repeats: int, window: int, patterns: list
) -> None:
    """Adds the longest pieces that fit, one length at a time. Where a length does not last for all
    repeats, it goes to as many as it does and the others are filled with what else there is."""
    waiting = [([(length, lengths.count(length)) for length in dict.fromkeys(lengths)], repeats)]
    while waiting:
        pattern, n = waiting.pop()
        free = window - sum(length * times for length, times in pattern)
        while free and (length := stock.longest(free)):
            times = min(free // length, max(1, int(stock.left[length]) // n))
            served = min(n, int(stock.left[length]) // times)
            if served < n:
                waiting.append((list(pattern), n - served))
                n = served
            stock.take(length, times * n)
            pattern.append((length, times))
            free -= length * times
        patterns.append((pattern, n))


def _lay_out(patterns: list, window: int) -> Plan:
    ranks = np.zeros(window + 1, np.int64)
    rows, sequence = [], 0
    for pattern, repeats in patterns:
        offset = 0
        for length, times in pattern:
            rows.append((length, ranks[length], times, sequence, offset))
            ranks[length] += times * repeats
            offset += length * times
        sequence += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*table.T)


def ranked(pieces: DataFrame, length: str = "length") -> tuple[DataFrame, DataFrame]:
    """Written pieces with their rank (from 0) among those of the same length, and the counts by
    length. Pieces are numbered within their file and files by their counts, so that a length
    that most pieces have is not gathered anywhere."""
    file, rank = F.col("_metadata.file_path"), fresh("rank", pieces.columns)
    inside = Window.partitionBy("_file", length).orderBy("_row")
    numbered = pieces.withColumns({"_file": file, "_row": F.col("_metadata.row_index")})
    counts = numbered.groupBy("_file", length).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_l").orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_file").alias("_f"), F.col(length).alias("_l"), "_n").withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))
    )
    placed = numbered.withColumn("_inside", F.row_number().over(inside) - 1).join(
        offsets, (F.col("_file") == F.col("_f")) & (F.col(length) == F.col("_l"))
    )
    placed = placed.withColumn(rank, F.col("_inside") + F.col("_before"))
    return placed.select(*pieces.columns, rank), counts.groupBy(length).agg(F.sum("_n").alias("n"))


def pack(pieces: DataFrame, *, window: int = 4096, classes: int = 256) -> DataFrame:
    """Pieces with sequence_id and offset added, from rows with a length of 1 to window.

    At most `window` counts come to the driver; the plan, at most a few rows per length, goes to
    the tasks. No pieces: no rows. Equal pieces are told apart by their place in the written files.
    """
    pieces = written(pieces, "pieces")
    with_rank, counts = ranked(pieces)
    histogram = np.zeros(window + 1, np.int64)
    for row in counts.collect():
        histogram[row["length"]] = row["n"]
    found = plan(histogram, window, classes)
    # one increasing key for (length, rank); ranks stay below 2 ** 48
    key = (found.length << 48) + found.first

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wanted = (length.to_numpy(np.int64) << 48) + rank.to_numpy(np.int64)
        row = np.searchsorted(key, wanted, side="right") - 1
        number = rank.to_numpy(np.int64) - found.first[row]
        times = found.times[row]
        return pd.DataFrame(
            {
                "sequence_id": found.sequence[row] + number // times,
                "offset": found.offset[row] + found.length[row] * (number % times),
            }
        )

    where = F.pandas_udf(place, "sequence_id long, offset long")
    rank = with_rank.columns[-1]
    spot = fresh("spot", with_rank.columns)
    return with_rank.withColumn(spot, where("length", rank)).select(*pieces.columns, f"{spot}.*")


def pack_documents(
    documents: DataFrame, tokens: Tokens, *, window: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(cut(documents, tokens, window=window, text=text, carry=[key]), window=window)
