"""Packing tokenised documents into sequences: linear grouping, configurations, then best fit."""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import mapped, ready, slices, staged, text_or_empty
from opsloom.llm.tokens import joined, runs, SPACE, utf8
from opsloom.operators.scale import positions

CAPACITY = 2048
GROUPS = 32  # equal-cardinality groups of large lengths, hence sizes of the configuration problem
TIGHT = 256  # a configuration is used if its rounded sizes leave at most a TIGHT-th of the capacity free
SMALL = 8  # lengths up to a SMALL-th of the capacity are small
CACHED = 600_000  # text pieces whose ids a Python worker remembers; it starts anew beyond

# ---------------------------------------------------------------- tokens

_LETTER, _OTHER, _REST, _BLANK = 1, 2, 3, 0


def _byte_classes() -> np.ndarray:
    classes = np.full(256, _REST, np.int8)
    classes[:128] = _OTHER
    classes[SPACE] = _BLANK
    classes[np.r_[65:91, 97:123]] = _LETTER
    classes[ord("'")] = classes[ord("<")] = _REST  # contractions and special tokens are left whole
    return classes


_CLASSES = _byte_classes()


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write each byte: printable ones as themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b if b in plain else 256 + others.index(b)) for b in range(256)]


class _Pieces(dict):
    """Number of every text piece met so far; `ids` from `starts[k]`, `sizes[k]` long, are piece k's."""

    LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.letters = Tokenizer.from_file(path), _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.starts, self.sizes, self.ids = array("q"), array("q"), array("I")

    def __missing__(self, piece: bytes) -> int:
        if self.LETTERS.fullmatch(piece):  # already in lower case and composed, one word for the model
            new = [t.id for t in self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, piece)))]
        else:
            new = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
        number = self[piece] = len(self)
        self.starts.append(len(self.ids))
        self.sizes.append(len(new))
        self.ids.extend(new)
        return number


@cache
def _pieces(path: str) -> _Pieces:
    return _Pieces(path)


def token_ids(texts: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the number of ids of each text.

    Equal to encoding each whole text: white space never joins tokens, nor do letters and other ASCII
    characters, so texts are cut there and each different piece is encoded once. Words with
    anything else (other scripts, apostrophes, a possible special token) stay whole.
    """
    store = _pieces(path)
    buffer, text_starts = joined(texts)
    classes = _CLASSES[buffer]
    # Latin-1 letters, two bytes from 0xC3 on, count as letters; the signs among them don't.
    lead = np.flatnonzero(buffer[:-1] == 0xC3)
    lead = lead[(buffer[lead + 1] != 0x97) & (buffer[lead + 1] != 0xB7)]
    classes[lead] = classes[lead + 1] = _LETTER
    lower = buffer.copy()
    upper = (buffer >= 65) & (buffer <= 90)
    lower[upper] += 32
    wide = lead[(buffer[lead + 1] >= 0x80) & (buffer[lead + 1] <= 0x9E)] + 1
    lower[wide] += 32
    starts, ends = runs(classes != _BLANK)
    odd = np.logical_or.reduceat(classes == _REST, starts) if len(starts) else np.zeros(0, bool)
    if odd.any():
        # Such a word is one piece, and its bytes stay as they are.
        odd[-1:] &= (classes[starts[-1] : ends[-1]] == _REST).any()
        flags = np.zeros(len(buffer) + 1, np.int64)
        flags[starts[odd]] += 1
        flags[ends[odd]] -= 1
        whole = np.cumsum(flags)[:-1] > 0
        classes[whole] = _REST
        lower[whole] = buffer[whole]
    # A blank between pieces that touch; then the pieces are what stands between blanks.
    edge = np.flatnonzero(classes[1:] != classes[:-1]) + 1
    begins = edge[classes[edge] != _BLANK]
    touching = begins[classes[begins - 1] != _BLANK]
    if len(classes) and classes[0] != _BLANK:
        begins = np.concatenate([[0], begins])
    counts = np.diff(np.append(np.searchsorted(begins, text_starts), len(begins)))
    if len(store) > CACHED:
        store.forget()
    found = np.insert(lower, touching, ord(" ")).tobytes().split()
    number = np.fromiter(map(store.__getitem__, found), np.int64, len(found))
    sizes = np.array(store.sizes)[number]
    shift = np.array(store.starts)[number] - (np.cumsum(sizes) - sizes)
    flat = np.array(store.ids)[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]
    owner = np.repeat(np.arange(len(texts)), counts)
    return flat, np.bincount(owner, sizes, minlength=len(texts)).astype(np.int64)


def _cut(path: str, capacity: int, id_name: str, id_type: pa.DataType):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("text"))
        rows, piece, start, length, crc = [], [], [], [], []
        for i, j in slices(texts):
            flat, counts = token_ids(texts[i:j], path)
            ends = np.cumsum(counts)
            zero = np.zeros(1, np.uint32)
            for k, (stop, n) in enumerate(zip(ends.tolist(), counts.tolist())):
                ids = np.concatenate([flat[stop - n : stop], zero]).astype("<u4")
                for number, at in enumerate(range(0, n + 1, capacity)):
                    part = ids[at : at + capacity]
                    rows.append(i + k)
                    piece.append(number)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
        return pa.RecordBatch.from_arrays(
            [batch.column(id_name).take(pa.array(rows, pa.int64())).cast(id_type), pa.array(piece, pa.int32()),
             pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            [id_name, "piece", "start", "length", "ids_crc32"],
        )

    return run


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Per piece of each document: id, piece, start, length, ids_crc32. A document's ids end with a 0."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    return mapped(
        docs.select(F.col(id_col), text_or_empty(text_col).alias("text")),
        _cut(path, capacity, id_col, to_arrow_type(kind)),
        f"`{id_col}` {kind.simpleString()}, piece int, start long, length long, ids_crc32 long",
    )


# ---------------------------------------------------------------- the plan


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    sizes_up, values_up = sizes[order], values[order]
    for w in range(int(sizes_up[0]), capacity + 1):
        n = np.searchsorted(sizes_up, w, side="right")
        gains = best[w - sizes_up[:n]] + values_up[:n]
        k = int(np.argmax(gains))
        if gains[k] > best[w - 1] + 1e-12:
            best[w], choice[w] = gains[k], k
        else:
            best[w] = best[w - 1]
    pattern, w = np.zeros(len(sizes), np.int64), capacity
    while w > 0:
        if choice[w] < 0:
            w -= 1
            continue
        pattern[order[choice[w]]] += 1
        w -= int(sizes_up[choice[w]])
    return float(best[capacity]), pattern


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, turns: int = 3000) -> list[tuple[np.ndarray, int]]:
    """Patterns of sizes and how many sequences use each, by column generation, rounded down."""
    n = len(sizes)
    base = np.diag(capacity // sizes).astype(float)
    inverse = np.linalg.inv(base)
    for _ in range(turns):
        prices = np.ones(n) @ inverse
        value, pattern = _best_pattern(sizes, np.maximum(prices, 0), capacity)
        if value <= 1 + 1e-7:
            break
        amounts, direction = inverse @ demand, inverse @ pattern
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-9, np.maximum(amounts, 0) / direction, np.inf)
        base[:, int(np.argmin(ratio))] = pattern
        inverse = np.linalg.inv(base)
    amounts = np.floor(np.maximum(inverse @ demand, 0) + 1e-6).astype(np.int64)
    patterns = base.astype(np.int64).T
    return [(p, int(x)) for p, x in zip(patterns, amounts) if x and capacity - int(p @ sizes) <= capacity // TIGHT]


class _Plan:
    """Where each place of the order by length goes, as runs of equal lengths.

    A lot is a run of sequences with equal free space. Both runs and lots are as many as the lengths
    and configurations make them (some thousands), whatever the number of documents.
    """

    def __init__(self, capacity: int):
        self.capacity, self.used = capacity, 0
        self.lots: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by free space
        self.rows: list[tuple[int, int, int, int]] = []

    def new(self, n: int) -> tuple[int, int]:
        self.used += n
        return self.used - n, n

    def put(self, place: int, n: int, sequence: int, free: int) -> None:
        self.rows.append((place, n, sequence, self.capacity - free))

    def best_fit(self, length: int, place: int, n: int) -> None:
        """n documents of one length into the fullest sequences that hold them, else into new ones."""
        for free in sorted(f for f in self.lots if f >= length):
            while n and self.lots[free]:
                sequence, count = self.lots[free].pop()
                place, n = self._fill(length, place, n, sequence, count, free)
            if not self.lots[free]:
                del self.lots[free]
            if not n:
                return
        each = self.capacity // length
        sequence, count = self.new(-(-n // each))
        self._fill(length, place, n, sequence, count, self.capacity)

    def _fill(self, length: int, place: int, n: int, sequence: int, count: int, free: int) -> tuple[int, int]:
        each = free // length
        some = min(count, -(-n // each))
        if some < count:
            self.lots[free].append((sequence + some, count - some))
        reached = some
        for _ in range(each):
            now = min(n, some)
            if now < reached:
                self.lots[free].append((sequence + now, reached - now))
            if not now:
                return place, n
            self.put(place, now, sequence, free)
            place, n, free, reached = place + now, n - now, free - length, now
        self.lots[free].append((sequence, reached))
        return place, n


class _Stock:
    """The documents not yet placed, per length: how many, and their first place in the order."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.tolist()
        self.place = (np.cumsum(counts) - counts).tolist()

    def take(self, length: int, n: int) -> tuple[int, int]:
        n = min(n, self.left[length])
        self.left[length] -= n
        self.place[length] += n
        return self.place[length] - n, n

    def longest(self, most: int, least: int) -> int:
        while most >= least and not self.left[most]:
            most -= 1
        return most if most >= least else 0


def plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[np.ndarray, int]:
    """Runs (place, n, sequence, offset) for documents ordered by length, and the number of sequences.

    counts[l] is the number of documents of length l. Large lengths, in `groups` groups of equal
    cardinality, are rounded up to their group's largest; configurations of these few sizes are
    optimised, and those that fill a sequence are used. Then documents take the slots: each slot gets the longest one that leaves the later
    slots their rounded sizes, so the room that rounding added is passed on and not lost. What
    rounding the amounts or a looser configuration leaves over, and the small lengths, are best-fitted, the longest first.
    """
    out, stock = _Plan(capacity), _Stock(counts)
    if stock.left[capacity]:
        place, n = stock.take(capacity, stock.left[capacity])
        out.put(place, n, out.new(n)[0], capacity)
    ends = np.cumsum(counts)
    least = capacity // SMALL + 1
    low, high = int(ends[least - 1]), int(ends[capacity - 1])
    if high > low:
        bounds = np.unique(np.linspace(low, high, min(groups, high - low) + 1).round().astype(np.int64))
        tops = np.searchsorted(ends, bounds[1:] - 1, side="right")
        # Groups that round up to one size are one.
        bounds = bounds[1:][np.append(tops[1:] != tops[:-1], True)]
        sizes = np.unique(tops)
        demand = np.diff(np.concatenate([[low], bounds])).astype(float)
        for pattern, amount in configurations(sizes, demand, capacity):
            slots = np.repeat(sizes, pattern)[::-1].tolist()
            lots = [(*out.new(amount), capacity)]
            for k in range(len(slots)):
                lots = _slot(out, stock, lots, sum(slots[k + 1 :]), least)
            for sequence, count, free in lots:
                out.lots[free].append((sequence, count))
    for length in range(capacity, 0, -1):
        place, n = stock.take(length, stock.left[length])
        if n:
            out.best_fit(length, place, n)
    return np.array(sorted(out.rows), np.int64).reshape(-1, 4), out.used


def _slot(
    out: _Plan, stock: _Stock, lots: list[tuple[int, int, int]], later: int, least: int
) -> list[tuple[int, int, int]]:
    """One large document for each sequence of the lots, as long as the later slots allow."""
    after = []
    for sequence, count, free in lots:
        while count and (length := stock.longest(free - later, least)):
            place, some = stock.take(length, count)
            out.put(place, some, sequence, free)
            after.append((sequence, some, free - length))
            sequence, count = sequence + some, count - some
        if count:
            after.append((sequence, count, free))
    return after


# ---------------------------------------------------------------- the operator


def pack(
    docs: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    `path` is a vocabulary file of the tokenizers library. Only the counts per length (`capacity`
    numbers) reach the driver, which plans on them; documents get their place in the order by length from a
    distributed sort and look their sequence up in the plan, a few thousand rows at any input size.
    Null texts are empty (one token, the final 0); repeated ids and rows are packed one by one; an
    empty table gives no rows; other columns are ignored.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    ready(docs.sparkSession)
    cut = staged(pieces(docs, path, id_col, text_col, capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():
        counts[length] = n
    runs_of, _ = plan(counts, capacity)
    placed = positions(cut, [F.col("length"), F.col(id_col), F.col("piece"), F.col("ids_crc32")])
    columns = cut.columns

    def look_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.column("position").to_numpy(zero_copy_only=False)
        row = runs_of[np.searchsorted(runs_of[:, 0], place, side="right") - 1]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in columns], pa.array(row[:, 2] + place - row[:, 0]), pa.array(row[:, 3])],
            [*columns, "sequence_id", "offset"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return mapped(placed, look_up, schema)
