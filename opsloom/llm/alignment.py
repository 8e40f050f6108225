"""Alignment of two tokenizers: tokens grouped at the byte offsets where both end, id pairs counted over the corpus."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import mapped, ready, slices, staged
from opsloom.llm.tokens import utf8

# Groups up to this many links are paired token by token; larger ones by their different ids, with counts.
SMALL_GROUP = 64
# A table of pair counts up to this many rows (some 24 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 4_000_000
SEPARATORS = (",", "|", ";")
# Parts of texts whose alignment a Python worker remembers: it starts anew beyond so many bytes of them.
REMEMBERED_BYTES = 8_000_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
KEPT = (*COUNTS, "groups_sha256")
# A blank between characters that are not white space: no token of either kind holds what is on both sides.
BORDER = re.compile(r"(?<=\S) (?=\S)")


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class _Bytes:
    """The decoded bytes of every id of a vocabulary, in one buffer."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.size = np.fromiter(map(len, entries), np.int64, len(entries))
        self.start = np.cumsum(self.size) - self.size
        self.written = [np.array([f"{i}{s}" for i in range(len(entries))], object) for s in SEPARATORS]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        shift = self.start[ids] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


class _Tokenizers:
    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of, words = _byte_of(), {i: w for w, i in self.a.get_vocab(with_added_tokens=False).items()}
        special = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        entries = [b""] * (max([*words, *special]) + 1)
        for i, word in words.items():
            entries[i] = bytes(byte_of[c] for c in word) if all(c in byte_of for c in word) else word.encode()
        for i, word in special.items():
            entries[i] = word.encode()
        self.bytes_a = _Bytes(entries)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # Entries that go on with a blank after something else would join what BORDER parts.
        self.parted = not any(re.search(r"\S ", e.decode(errors="replace")) for e in entries) and not any(
            re.search("[^\u2581]\u2581", n) for n in names
        )
        self.store = _Store(self)
        single = [self.b.is_byte(i) for i in range(len(names))]
        self.bytes_b = _Bytes([
            bytes([int(n[3:5], 16)]) if one else n.replace("\u2581", " ").encode() for n, one in zip(names, single)
        ])

    def spans_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, character spans (begin, end) and tokens per text."""
        found = self.a.encode_batch(texts, add_special_tokens=False)
        counts = np.fromiter((len(x) for x in found), np.int64, len(found))
        n = int(counts.sum())
        ids = np.fromiter(chain.from_iterable(x.ids for x in found), np.int64, n)
        spans = chain.from_iterable(chain.from_iterable(x.offsets for x in found))
        return ids, np.fromiter(spans, np.int64, 2 * n).reshape(-1, 2), counts

    def spans_b(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, byte spans and tokens per text."""
        found = self.b.encode(texts, return_type="offset_mapping", num_threads=1)
        counts = np.fromiter((len(x["ids"]) for x in found), np.int64, len(found))
        n = int(counts.sum())
        ids = np.fromiter(chain.from_iterable(x["ids"] for x in found), np.int64, n)
        spans = chain.from_iterable(chain.from_iterable(x["offsets"] for x in found))
        return ids, np.fromiter(spans, np.int64, 2 * n).reshape(-1, 2), counts


class _Store:
    """The alignment of every part of a text met so far, by the part: counts, written groups, id pairs."""

    def __init__(self, tools: _Tokenizers):
        self.tools = tools
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.bytes = 0
        self.written: list[str] = []
        self.known = {c: array("q") for c in (*COUNTS, "good", "first", "size", "pairs", "links")}

    def learn(self, parts: list[str]) -> None:
        texts = [p.encode() for p in parts]
        for i, j in slices(texts):
            found = Aligned(texts[i:j], self.tools)
            text, pair, links = found.pairs(len(self.tools.bytes_b.size))
            size = np.bincount(text, minlength=j - i)
            first = len(self.known["pairs"]) + _first(size)
            new = {**{c: getattr(found, c) for c in COUNTS}, "good": found.n_a > 0, "first": first, "size": size, "pairs": pair, "links": links}
            for name, values in new.items():
                self.known[name].frombytes(values.astype(np.int64).tobytes())
            self.written += found.written(self.tools)
        self.number.update(zip(parts, range(len(self.number), len(self.number) + len(parts))))
        self.bytes += sum(map(len, texts))

    def look_up(self, texts: list[str]) -> tuple[dict[str, np.ndarray], list[str], tuple[np.ndarray, ...]]:
        """Per text the counts and the hash of its groups; and text, pair, links of all, as in `Aligned.pairs`."""
        if self.bytes > REMEMBERED_BYTES:
            self.clear()
        split = BORDER.split if self.tools.parted else lambda text: [text]
        parts = [split(t) if t else [] for t in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        every = [*chain.from_iterable(parts)]
        self.learn([p for p in dict.fromkeys(every) if p not in self.number])
        number = np.fromiter(map(self.number.__getitem__, every), np.int64, len(every))
        known = {c: np.frombuffer(v, np.int64) if v else np.zeros(0, np.int64) for c, v in self.known.items()}
        owner = np.repeat(np.arange(len(texts)), sizes)
        good = np.bincount(owner, known["good"][number] == 0, len(texts)) == 0
        ends = np.cumsum(sizes)
        counts = {}
        for c in COUNTS:
            total = np.concatenate([[0], np.cumsum(known[c][number])])
            counts[c] = np.where(good, total[ends] - total[ends - sizes], 0)
        digests = [
            hashlib.sha256(";".join(map(self.written.__getitem__, number[i : i + n].tolist())).encode()).hexdigest() if g and n else ""
            for i, n, g in zip(_first(sizes).tolist(), sizes.tolist(), good.tolist())
        ]
        kept = good[owner]
        both, times = np.unique(owner[kept] * len(self.written) + number[kept], return_counts=True)
        text, part = both // max(1, len(self.written)), both % max(1, len(self.written))
        each = known["size"][part]
        at = np.repeat(known["first"][part] - _first(each), each) + np.arange(int(each.sum()))
        return counts, digests, _summed(np.repeat(text, each), known["pairs"][at], known["links"][at] * np.repeat(times, each))


@cache
def _tokenizers(path_a: str, path_b: str) -> _Tokenizers:
    return _Tokenizers(path_a, path_b)


def _first(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _summed(text: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every different (text, pair) once, in order, with all its links."""
    if not len(pair):
        return text, pair, links
    most = int(pair.max()) + 1
    key = text * most + pair
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    return key[new] // most, key[new] % most, np.add.reduceat(links[order], new)


def refined(coarse: np.ndarray, exact: np.ndarray, sizes: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from coarse cuts.

    Where a token's span ends with a whole character (`exact`), its end is the span's. Several tokens
    of one character share a span; their ends go on from the last exact cut (or the text's start) by
    the length of their decoded bytes.
    """
    if not len(coarse):
        return coarse
    total = np.cumsum(sizes)
    first = np.repeat(_first(counts), counts)
    last = np.maximum.accumulate(np.where(exact, np.arange(len(coarse)), -1))
    begun = np.repeat(starts, counts) - (total[first] - sizes[first])
    return total + np.where(last >= first, coarse[last] - total[last], begun)


class Aligned:
    """Tokens of some texts under both tokenizers, with byte ends in `source` and their groups.

    A text whose tokens do not spell a blank and the text has none of either kind.
    """

    def __init__(self, texts: list[bytes], tools: _Tokenizers):
        sources = [b" " + t if t else b"" for t in texts]
        sizes = np.fromiter(map(len, sources), np.int64, len(sources))
        starts = _first(sizes)
        buffer = np.frombuffer(b"".join(sources), np.uint8)
        ids_a, spans, self.n_a = tools.spans_a([s.decode() for s in sources])
        chars = np.append(np.flatnonzero((buffer & 0xC0) != 0x80), len(buffer))  # where characters begin
        base = np.repeat(np.searchsorted(chars, starts), self.n_a)
        follows = np.append(spans[1:, 0], 0)
        exact = follows >= spans[:, 1]
        exact[np.cumsum(self.n_a)[self.n_a > 0] - 1] = True
        coarse = chars[np.minimum(base + spans[:, 1], len(chars) - 1)]
        ends_a = refined(coarse, exact, tools.bytes_a.size[ids_a], self.n_a, starts)
        ids_b, spans, self.n_b = tools.spans_b(texts)
        # The blank in front of the text has no place in the spans of B, hence one more; it may be a token itself.
        exact = spans[:, 1] > spans[:, 0]
        begun = _first(self.n_b)[self.n_b > 0]
        exact[begun] |= spans[begun, 1] == 0
        coarse = spans[:, 1] + np.repeat(starts, self.n_b) + 1
        ends_b = refined(coarse, exact, tools.bytes_b.size[ids_b], self.n_b, starts)
        good = self._spelled(sources, ids_a, self.n_a, tools.bytes_a) & self._spelled(sources, ids_b, self.n_b, tools.bytes_b)
        self.ids_a, self.ends_a = (x[np.repeat(good, self.n_a)] for x in (ids_a, ends_a))
        self.ids_b, self.ends_b = (x[np.repeat(good, self.n_b)] for x in (ids_b, ends_b))
        self.n_a, self.n_b = np.where(good, self.n_a, 0), np.where(good, self.n_b, 0)
        self.starts = starts
        self.cuts = np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)
        self.group_a, self.group_b = (np.searchsorted(self.cuts, x) for x in (self.ends_a, self.ends_b))
        self.size_a, self.size_b = (np.bincount(g, minlength=len(self.cuts)) for g in (self.group_a, self.group_b))
        self.text = np.searchsorted(starts + sizes, self.cuts)  # of each group
        self.n_groups = np.bincount(self.text, minlength=len(texts))
        self.n_links = np.zeros(len(texts), np.int64)
        np.add.at(self.n_links, self.text, self.size_a * self.size_b)

    @staticmethod
    def _spelled(sources: list[bytes], ids: np.ndarray, counts: np.ndarray, entries: _Bytes) -> np.ndarray:
        raw = entries.joined(ids).tobytes()
        total = np.concatenate([[0], np.cumsum(entries.size[ids])])
        ends = total[np.cumsum(counts)].tolist()
        begins = [0, *ends[:-1]]
        return np.fromiter((raw[i:j] == s and s != b"" for i, j, s in zip(begins, ends, sources)), bool, len(sources))

    def written(self, tools: _Tokenizers) -> list[str]:
        """Per text its groups, written as a1,a2|b1;a3|b2,b3."""
        before_a, before_b = _first(self.size_a), _first(self.size_b)
        out = np.empty(len(self.ids_a) + len(self.ids_b), object)
        at_a = np.arange(len(self.ids_a)) + before_b[self.group_a]
        at_b = np.arange(len(self.ids_b)) + (before_a + self.size_a)[self.group_b]
        for at, ids, group, entries, sign in (
            (at_a, self.ids_a, self.group_a, tools.bytes_a, 1), (at_b, self.ids_b, self.group_b, tools.bytes_b, 2),
        ):
            out[at] = entries.written[0][ids]
            last = np.flatnonzero(np.diff(group, append=-1))
            out[at[last]] = entries.written[sign][ids[last]]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        found, begin = [], 0
        for end in ends:
            found.append("".join(out[begin:end].tolist())[:-1])
            begin = end
        return found

    def pairs(self, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different linked id pairs (a * size_b + b) per text, with their links: text, pair, links."""
        linked = self.size_a * self.size_b
        small = linked <= SMALL_GROUP
        begin_b = _first(self.size_b)
        of_a = small[self.group_a]
        group = self.group_a[of_a]
        each = self.size_b[group]
        a = np.repeat(self.ids_a[of_a], each)
        b = self.ids_b[np.repeat(begin_b[group] - _first(each), each) + np.arange(int(each.sum()))]
        text = np.repeat(self.text[group], each)
        parts = [(text, a * size_b + b, np.ones(len(a), np.int64))]
        begin_a = _first(self.size_a)
        for g in np.flatnonzero(~small).tolist():
            one, n_one = np.unique(self.ids_a[begin_a[g] : begin_a[g] + self.size_a[g]], return_counts=True)
            two, n_two = np.unique(self.ids_b[begin_b[g] : begin_b[g] + self.size_b[g]], return_counts=True)
            both = (one[:, None] * size_b + two).ravel()
            parts.append((np.full(len(both), self.text[g]), both, (n_one[:, None] * n_two).ravel()))
        return _summed(*(np.concatenate(x) for x in zip(*parts)))


def _lists(values: np.ndarray, text: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), pa.array(values))


LISTS = ("pairs", "links")
SPANS = ("a_ids", "a_ends", "b_ids", "b_ends", "cuts")


def tokens_aligned(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = False
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, groups_sha256, and `pairs` with their `links`.

    With `spans` also the ids of both tokenizers, the byte offsets where each token ends (in a blank
    and the text) and the offsets that end a group. See `align` for the cases.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    extra = SPANS if spans else ()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tools, texts = _tokenizers(path_a, path_b), utf8(batch.column(1))
        columns: dict[str, list] = {c: [] for c in (*KEPT, *LISTS, *extra)}
        for i, j in slices(texts):
            counts, digests, (text, pair, links) = tools.store.look_up([t.decode() for t in texts[i:j]])
            for name, values in counts.items():
                columns[name].append(pa.array(values, pa.int64()))
            columns["groups_sha256"].append(pa.array(digests, pa.string()))
            columns["pairs"].append(_lists(pair, text, j - i))
            columns["links"].append(_lists(links, text, j - i))
            if spans:
                found = Aligned(texts[i:j], tools)
                of_a, of_b = (np.repeat(np.arange(j - i), n) for n in (found.n_a, found.n_b))
                for name, values, of in (
                    ("a_ids", found.ids_a, of_a), ("a_ends", found.ends_a - found.starts[of_a], of_a),
                    ("b_ids", found.ids_b, of_b), ("b_ends", found.ends_b - found.starts[of_b], of_b),
                    ("cuts", found.cuts - found.starts[found.text], found.text),
                ):
                    columns[name].append(_lists(values, of, j - i))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(id_type), *map(pa.concat_arrays, columns.values())], [id_col, *columns]
        )

    lists = ", ".join(f"{c} array<long>" for c in (*LISTS, *extra))
    schema = f"`{id_col}` {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, {lists}"
    return mapped(docs.select(F.col(id_col), F.col(text_col)), run, schema)


def align(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A blank and the text are encoded by a byte-level vocabulary (`path_a`, library tokenizers) and the
    text by a sentencepiece model (`path_b`), which adds the blank itself. Where tokens of both end at
    one byte, a group ends; all tokens of a group are linked. A pair of ids counts the rows that hold
    it linked, in the whole corpus. `count_sum` adds the counts of a row's links, `n_best` is how many
    of them have the highest count of their A id, ties included.

    Texts are parted at single blanks between words, where neither vocabulary has an entry that goes
    on; a worker aligns each different part once. A row's different pairs are stored beside it as two lists. Counting them
    is one partial sum per task and pair. The counts, a row per different pair, come back to the rows
    by a broadcast behind a check of their number, else by a shuffle join.

    Texts that are null or empty, or that the tokens do not spell (B may normalise), have zeros and an
    empty hash. Repeated rows count as rows, null ids stay, an empty table gives no rows, other columns
    are ignored.
    """
    ready(docs.sparkSession)
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    size_b = len(_tokenizers(path_a, path_b).bytes_b.size)
    rows = staged(
        tokens_aligned(docs, path_a, path_b, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()), "aligned"
    )
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counts.withColumn("a", F.call_function("div", F.col("pair"), F.lit(size_b).cast("long"))), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    judged = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    if counts.count() <= broadcast_rows:
        judged = F.broadcast(judged)
    each = rows.select("_row", F.inline(F.arrays_zip("pairs", "links"))).withColumnRenamed("pairs", "pair")
    sums = (
        each.join(judged, "pair")
        .groupBy("_row")
        .agg(F.sum(F.col("links") * F.col("best")).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))
    )
    zero = F.lit(0).cast("long")
    return rows.select("_row", id_col, *KEPT).join(sums, "_row", "left").select(
        id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
