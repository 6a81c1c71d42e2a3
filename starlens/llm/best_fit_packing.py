"""Best-fit packing of tokenised documents with certified bin counts.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt evenly
over partitions of bounded size; each partition packs its pieces by best-fit
decreasing and computes a lower bound on its bins from dual-feasible functions.
While the total is above the bound of all pieces together, bins with room left
(all bins of partitions with a gap, the open ones of certified partitions) give
up their pieces, which are exchanged among new partitions and packed again. A
round that doesn't save a bin is not used, and ends the exchange.

Defined results: a null text counts as empty and, as any empty text, is one piece
of the end token alone; repeated rows are packed each; a null id is passed
through; an empty table gives an empty result; other columns are ignored. Only
texts above the capacity are cut.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache, partial
from unicodedata import normalize, ucd_3_2_0
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import values, written

#: Most tokens and pieces a packing partition gets on average.
PARTITION_TOKENS = 16_000_000
PARTITION_PIECES = 100_000
#: Entries of a Python worker's two caches, about 200 bytes each.
CACHE_ENTRIES = 300_000
WORD_ENTRIES = 400_000
#: Code points of texts that are encoded together.
GROUP_CHARACTERS = 400_000


class ChunkEncoder:
    """Token ids as little-endian 32-bit bytes, by the ``tokenizers`` library.

    White space never reaches a token of this kind of vocabulary, so texts are cut
    there and each distinct chunk is encoded once. A chunk of letters and trailing
    marks is a word and a run of marks to the pre-tokenizer, which are encoded
    once each too. New words of many texts go through the library together; as
    every word's last token carries the word-end mark, its ids are found again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.missed = 0

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _new_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """ids of distinct words, all letters, by one call of the library."""
        ids = np.array(self.tokenizer.encode(" ".join([w.decode() for w in words]), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) != len(words):  # some letter became more than one word when normalised
            return {w: self._ids(w.decode()) for w in words}
        data, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        return {w: data[a:b] for w, a, b in zip(words, bounds, bounds[1:], strict=False)}

    def _new_chunks(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        found, parts, words = {}, [], self.words
        unknown: dict[bytes, None] = {}
        for chunk in chunks:
            word = chunk.rstrip(_MARKS)
            lower = word.lower() if word.isalpha() else _lower_letters(word)
            if not lower:
                found[chunk] = self._ids(chunk.decode())
                continue
            marks = chunk[len(word) :]
            if marks and marks not in words:
                words[marks] = self._ids(marks.decode())
            ids = words.get(lower)
            if ids is None:
                unknown[lower] = None
                parts.append((chunk, lower, marks))
            else:
                found[chunk] = ids + words[marks] if marks else ids
        if unknown:
            new = self._new_words(list(unknown))
            for chunk, lower, marks in parts:
                found[chunk] = new[lower] + words[marks] if marks else new[lower]
            if len(words) + len(new) <= WORD_ENTRIES:
                words.update(new)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.encode().split() for t in texts]
        get = self.chunks.get
        found = [list(map(get, chunks)) for chunks in split]
        gaps = [_gaps(ids) for ids in found]
        missing = list({chunks[i] for chunks, places in zip(split, gaps, strict=True) for i in places})
        if missing:
            new = self._new_chunks(missing)
            for chunks, ids, places in zip(split, found, gaps, strict=True):
                for i in places:
                    ids[i] = new[chunks[i]]
            # The most frequent chunks come early, so a full cache is kept, until the texts have changed so much
            # that four times as many chunks were missed since.
            if len(self.chunks) + len(missing) <= CACHE_ENTRIES:
                self.chunks.update((c, ids) for c, ids in new.items() if len(c) <= 64)
            else:
                self.missed += len(missing)
                if self.missed > 4 * CACHE_ENTRIES:
                    self.missed, self.chunks, self.words = 0, {}, {}
        return [b"".join(ids) for ids in found]


def _gaps(ids: list) -> list[int]:
    """Places of None."""
    places, i = [], -1
    try:
        while True:
            i = ids.index(None, i + 1)
            places.append(i)
    except ValueError:
        return places


#: Marks that may follow a word; the pre-tokenizer makes them a run of their own.
_MARKS = b'.,!?;:|*$%&#()"-'


def _lower_letters(word: bytes) -> bytes:
    """The word lower-cased if it is letters only to any version of the character tables, before and after; else nothing.

    Normalisation comes first, as in the library: some letters of Indic, Hebrew and
    other scripts decompose into a letter and a mark, which is no letter.
    """
    if word.isascii():
        return b""
    text = normalize("NFC", word.decode())
    lower = text.lower()
    if not text.isalpha() or not lower.isalpha() or "\u03a3" in text:
        return b""
    return lower.encode() if all(ucd_3_2_0.category(c)[0] == "L" for c in lower) else b""


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def _grouped(texts: Iterator[str | None]) -> Iterator[list[str]]:
    """Runs of texts of about ``GROUP_CHARACTERS`` together."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= GROUP_CHARACTERS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _piece_batches(path: str, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode
    end = end_id.to_bytes(4, "little")
    for batch in batches:
        row, piece, start, length, crc = [], [], [], [], []
        documents = (ids for group in _grouped(values(batch.column(1))) for ids in encode(group))
        for i, document in enumerate(documents):
            ids = document + end
            for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[a : a + 4 * capacity]
                row.append(i)
                piece.append(k)
                start.append(a // 4)
                length.append(len(part) // 4)
                crc.append(crc32(part))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            + [pa.array(x, pa.int64()) for x in (start, length, crc)],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, the end token after each."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_piece_batches, vocabulary, end_id, capacity),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long",
    )


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each length and the number of bins.

    ``room`` has bit r set while some open bin has r tokens left, so the best
    bin for a length is the lowest set bit from it on.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    room, count = 0, 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = room >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = by_room[left].pop()
            if not by_room[left]:
                room &= ~(1 << left)
        else:
            left, b = capacity, count
            count += 1
        bins[i], offsets[i] = b, capacity - left
        rest = left - size
        if rest:
            by_room[rest].append(b)
            room |= 1 << rest
    return bins, offsets, count


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; ``counts[n]`` pieces have n tokens.

    The largest of three families of dual-feasible functions f on [0, 1]: the
    sum of f over the pieces never exceeds the number of bins.
    """
    counts = np.asarray(counts, np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((counts * x).sum()) // capacity)
    many, mass = np.cumsum(counts), np.cumsum(counts * x)
    # pieces above capacity - e count whole, those from e on by size, smaller ones not at all
    e = np.arange(1, capacity // 2 + 1)
    large = many[-1] - many[capacity - e]
    middle = mass[capacity - e] - mass[e - 1]
    best = max(best, int((large - (-middle // capacity)).max(initial=0)))
    # rounding: x stays when x (k + 1) is whole, else it is floor((k + 1) x) / k
    for k in range(1, 65):
        scaled = (k + 1) * x
        whole = scaled % capacity == 0
        value = np.where(whole, scaled * k, (scaled // capacity) * capacity * (k + 1))  # over k (k + 1) capacity
        total = int((counts * value).sum())
        best = max(best, -(-total // (k * (k + 1) * capacity)))
    # above half: the rest of a bin holds floor((1 - x) / e) pieces of e; up to half: one in floor(1 / e)
    for size in np.unique(np.linspace(1, capacity // 2, 64).astype(int)).tolist():
        per = capacity // size
        value = np.where(2 * x > capacity, per - (capacity - x) // size, np.where(x >= size, 1, 0))
        best = max(best, -(-int((counts * value).sum()) // per))
    return best


def _pack_batches(capacity: int, first: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A whole partition: its pieces with sequence, offset, that bin's room, and whether the partition is certified."""
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    lengths = rows.column("length").to_numpy()
    bins, offsets, count = best_fit_decreasing(lengths, capacity)
    certified = count == lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    room = capacity - np.bincount(bins, lengths, count).astype(np.int64)
    base = (first + TaskContext.get().partitionId()) << 32
    out = rows.select(["doc_id", "piece", "start", "length", "ids_crc32"])
    for name, column in (("sequence_id", base + bins), ("offset", offsets), ("room", room[bins])):
        out = out.append_column(name, pa.array(column, pa.int64()))
    yield from out.append_column("certified", pa.array(np.full(len(bins), certified))).to_batches()


def _pack(rows: DataFrame, capacity: int, first: int, partitions: int) -> DataFrame:
    """``rows`` dealt evenly over partitions, numbered from ``first``, and packed in each; written, so that sequences never change afterwards."""
    dealt = rows.select("doc_id", "piece", "start", "length", "ids_crc32").repartition(partitions)
    kind = rows.schema["doc_id"].dataType.simpleString()
    packed = dealt.mapInArrow(
        partial(_pack_batches, capacity, first),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, room long, certified boolean",
    )
    return written(packed, "packed")


def _width(tokens: int, many: int) -> int:
    return max(1, -(-tokens // PARTITION_TOKENS), -(-many // PARTITION_PIECES))


def _bins(rows: DataFrame) -> int:
    """Each bin has exactly one piece at offset 0."""
    return rows.where("offset = 0").count()


def packed(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, room, certified) of every piece."""
    found = written(pieces(docs, vocabulary, end_id, capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in found.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    bound = lower_bound(counts, capacity)
    used = _width(int((counts * np.arange(capacity + 1)).sum()), int(counts.sum()))
    current = _pack(found, capacity, 0, used)
    total = _bins(current)
    closed = None
    while total > bound:  # each round saves a sequence or is the last
        # Bins with room give up their pieces; a certified partition can only gain across partitions, a few
        # tokens of room in a bin gain nothing there.
        spare = F.col("room") >= F.when(F.col("certified"), capacity // 16).otherwise(1)
        released = current.where(spare)
        size = released.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
        before = _bins(released)
        if before < 2:
            break
        width = _width(*map(int, size))
        again = _pack(released, capacity, used, width)
        used += width
        after = _bins(again)
        kept = current.where(~spare)
        if after >= before:
            break
        closed = kept if closed is None else closed.unionByName(kept)
        current, total = again, total - before + after
    return current if closed is None else closed.unionByName(current)
