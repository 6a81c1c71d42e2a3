"""Phrase collocations by prefix-free parsing.

A text's pieces (runs between sentence marks) are cut into chunks at trigger
windows: two neighbouring words of which the bits ``MASK`` of a hash are zero. A chunk reaches
from one trigger window to the end of the next, so neighbouring chunks share a
window, and no 3-word phrase falls between two chunks. As triggers depend on
content alone, equal passages give equal chunks wherever they occur: the corpus
becomes a dictionary of distinct chunks with their frequencies, and everything
after is counted inside distinct chunks, weighted. A phrase that lies wholly in
the window a chunk shares with its predecessor is counted there and not again.

Phrases are counted exactly in three rounds, each leaving out only what can't reach
``least``: words, with the parse; over the dictionary, hashes of word pairs (both
words frequent), then pairs and triples of which every pair's hash is frequent.
Between rounds, what is frequent travels as a bitmap of hash slots of at most
``BITMAP_BITS`` bits, whose collisions let more phrases be counted, never fewer.
Chunks of a language are laid end to end, so tokens are found, hashed and cut out by
operations on whole arrays; words and phrases themselves are counted by their bytes.

Defined results: a null text counts as empty, a null language as ``und``; texts
without words add nothing; very long texts are parsed whole (a piece without a
trigger is one chunk); repeated rows and copies count each; ties in score go by
frequency, then by the phrase's bytes; an empty table gives an empty result;
other columns are ignored. Frequencies up to 10^16 are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from starlens.llm.common import values, written

#: A window of two words is a trigger when these bits of its hash are 0: one in 16.
MASK = 15
#: Rows and bytes of a task's table of chunks, words or phrases, and entries of its array of hashes; a full one is handed on and emptied.
ENTRIES = 1_000_000
ENTRY_BYTES = 40_000_000
HASHES = 2_000_000
#: Bits of a bitmap of frequent hashes: 16 for each, 32 MB in all at most.
BITMAP_BITS = 28
BITS_EACH = 16
#: Bits of one block of a bitmap, as Spark's bitmap functions make them.
BLOCK = 32768
#: Pair hashes are summed in groups by their first bits (2048 groups).
GROUP_BITS = 11
#: Parts of a language's phrases that are ranked on their own before all are.
RANKED = 16
#: Rows of a batch that is handed on, bytes of texts or chunks and of phrases that are worked on together.
TOGETHER = 20_000
TOGETHER_BYTES = 2_000_000
#: Bytes of a word that are hashed eight by eight; what follows them enters by its crc.
HASHED_BYTES = 64

#: Tokens of a chunk that no word can be: between pieces, and before a window shared with the chunk before.
GAP, SHARED = b".", b","
#: The marks that end pieces become gaps, tabs blanks.
_MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b".........." + b" ")
_SEPARATOR = b" . "
_BYTES_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _normal(text: bytes) -> bytes:
    """Words and gaps of a lower-cased text, joined by single blanks."""
    text = text.translate(_MARKS).replace(GAP, _SEPARATOR)  # no other white space is left
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text.strip(b" ")


class Tokens:
    """Tokens of texts or chunks (each joined by single blanks, none empty) that are laid end to end, a gap between neighbours."""

    def __init__(self, parts: list[bytes]):
        self.data = _SEPARATOR.join(parts)
        self.bytes = np.frombuffer(self.data + b" " * 8, np.uint8)
        self.ends = np.flatnonzero(self.bytes[: len(self.data) + 1] == 32)
        self.starts = np.append(0, self.ends[:-1] + 1)
        first, single = self.bytes[self.starts], self.ends - self.starts == 1
        self.shared = single & (first == SHARED[0])
        self.word = ~(single & (first == GAP[0]) | self.shared)
        sizes = np.array([len(p) for p in parts[:-1]], np.int64)
        #: The places of the gaps between neighbours.
        self.between = np.searchsorted(self.starts, np.cumsum(sizes + len(_SEPARATOR)) - 2)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64 bits for each token, by its bytes."""
        lengths = self.ends - self.starts
        blocks = np.ndarray(len(self.bytes) - 7, "<u8", self.bytes, strides=(1,))
        h = (lengths.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        at = np.arange(len(lengths))
        for k in range(0, HASHED_BYTES, 8):
            x = h[at] ^ (blocks[self.starts[at] + k] & _BYTES_KEPT[np.minimum(lengths[at] - k, 8)])
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            h[at] = x ^ (x >> np.uint64(32))
            at = at[lengths[at] > k + 8]
            if not len(at):
                return h
        for i in at.tolist():
            rest = crc32(self.data[self.starts[i] + HASHED_BYTES : self.ends[i]])
            h[i] ^= np.uint64(rest * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return h

    def cut(self) -> Iterator[tuple[bytes, int]]:
        """(chunk, number of words that it counts); none reaches over a gap between neighbours.

        Besides trigger windows, a trigger word at a piece's end ends a chunk, which needs no shared window there.
        """
        many, word, h = len(self), self.word, self.hashes()
        places, words = np.flatnonzero(word), np.append(0, np.cumsum(word))
        trigger = 31 * h[:-1] + h[1:] & np.uint64(MASK) == 0
        windows = np.flatnonzero(word[:-1] & word[1:] & trigger) + 1
        last = np.flatnonzero(word & np.append(~word[1:], True) & (h & np.uint64(MASK) == 0))
        # where chunks end, in order: a window's second word before a piece's last word at the same place
        cuts = np.sort(np.concatenate([2 * windows, 2 * last + 1, 2 * self.between - 1, [2 * many - 1]]))
        end = (cuts >> 1) + 1
        # a shared window that ends its piece is followed by nothing that could need it
        goes_on = ((cuts & 1 == 0) & np.append(word, False)[end])[:-1]
        shared, begin = np.append(False, goes_on), np.append(0, end[:-1] - 2 * goes_on)
        counted = words[end] - words[begin] - 2 * shared
        some = counted > 0
        begin, end, shared = begin[some], end[some], shared[some].tolist()
        begin = self.starts[places[np.searchsorted(places, begin)]].tolist()
        end = self.ends[places[np.searchsorted(places, end) - 1]].tolist()
        for i, j, after, n in zip(begin, end, shared, counted[some].tolist(), strict=True):
            yield b", " + self.data[i:j] if after else self.data[i:j], n

    def words(self) -> pa.Table:
        """(word, how often) of the distinct words."""
        # each token with the blank after it lies between two neighbouring offsets
        offsets = pa.py_buffer(np.append(self.starts, len(self.data) + 1).astype(np.int32))
        tokens = pa.Array.from_buffers(pa.binary(), len(self), [None, offsets, pa.py_buffer(self.bytes)])
        found = tokens.value_counts()
        some = pc.and_(pc.not_equal(found.field(0), GAP + b" "), pc.not_equal(found.field(0), SHARED + b" "))
        return pa.table([pc.binary_slice(found.field(0), 0, -1), found.field(1)], ["item", "n"]).filter(some)

    def phrases(self, at: np.ndarray, words: int) -> Iterator[tuple[slice, pa.Array]]:
        """Phrases of ``words`` tokens from the places ``at`` on, ``TOGETHER_BYTES`` at once unless one is longer."""
        begin = self.starts[at]
        lengths = self.ends[at + words - 1] - begin
        to = np.cumsum(lengths)
        parts = np.flatnonzero(np.diff((to - 1) // TOGETHER_BYTES)) + 1 if len(at) else []
        for i, j in zip([0, *parts], [*parts, len(at)], strict=True):
            offsets = np.append(0, np.cumsum(lengths[i:j]))
            from_ = np.repeat(begin[i:j] - offsets[:-1], lengths[i:j]) + np.arange(offsets[-1])
            buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.bytes[from_])]
            yield slice(i, j), pa.Array.from_buffers(pa.binary(), j - i, buffers)


def chunks_of(text: bytes) -> Iterator[tuple[bytes, int]]:
    """(chunk, number of words that it counts) of a lower-cased text; a chunk is words, ``GAP`` and ``SHARED`` joined by blanks."""
    text = _normal(text)
    if text:
        yield from Tokens([text]).cut()


def _by_language(rows: Iterable[tuple[str, bytes, int]]) -> Iterator[tuple[str, list[bytes], list[int]]]:
    """(language, its texts or chunks, how often each is there) of about ``TOGETHER_BYTES`` together."""
    held: dict[str, tuple[list[bytes], list[int]]] = {}
    size = 0
    for lang, part, times in rows:
        parts, many = held.setdefault(lang, ([], []))
        parts.append(part)
        many.append(times)
        size += len(part)
        if size >= TOGETHER_BYTES:
            yield from ((lang, *of) for lang, of in held.items())
            held, size = {}, 0
    yield from ((lang, *of) for lang, of in held.items())


def _summed(tables: Iterable[pa.Table]) -> Iterator[pa.RecordBatch]:
    """The last column's sums by the other columns, for as many rows as a task may hold."""
    held, rows, size = [], 0, 0

    def sums() -> pa.Table:
        *keys, number = held[0].column_names
        grouped = pa.concat_tables(held).group_by(keys, use_threads=False).aggregate([(number, "sum")])
        return grouped.select([*keys, f"{number}_sum"]).rename_columns([*keys, number])

    for table in tables:
        held.append(table)
        rows, size = rows + table.num_rows, size + table.nbytes
        if rows >= ENTRIES or size >= ENTRY_BYTES:
            held = [sums()]
            rows, size = held[0].num_rows, held[0].nbytes
            if rows >= ENTRIES // 2 or size >= ENTRY_BYTES // 2:
                yield from held[0].to_batches(max_chunksize=TOGETHER)
                held, rows, size = [], 0, 0
    if held:
        yield from sums().to_batches(max_chunksize=TOGETHER)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, int]]:
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), values(batch.column(1)), strict=True):
            normal = _normal(text.encode().lower()) if text else b""
            if normal:
                yield lang, normal, 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, int]]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "chunk", "counted", "times"]

    def tables() -> Iterator[pa.Table]:
        for lang, texts, _ in _by_language(_texts(batches)):
            tokens = Tokens(texts)
            chunks = list(tokens.cut())
            if chunks:
                chunk, counted = zip(*chunks, strict=True)
                many, lang = len(chunk), pa.scalar(lang, pa.string())
                ones = pa.array(np.ones(many, np.int64))
                yield pa.table([pa.repeat(lang, many), pa.array(chunk, pa.binary()), pa.array(counted, pa.int32()), ones], names)
                words = tokens.words()
                zeros = pa.array(np.zeros(len(words), np.int32))
                yield pa.table([pa.repeat(lang, len(words)), words.column(0), zeros, words.column(1)], names)

    return _summed(tables())


def parsed(docs: DataFrame, least: int) -> DataFrame:
    """(lang, chunk, counted, times): each language's distinct chunks with how many words each counts and how often the parse has it.

    With them, as rows that count no words, the words found ``least`` times or more.
    """
    narrow = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    parts = narrow.mapInArrow(_parse_batches, "lang string, chunk binary, counted int, times long")
    rows = parts.groupBy("lang", "chunk", "counted").agg(F.sum("times").alias("times"))
    return rows.where((F.col("counted") > 0) | (F.col("times") >= least))


def _after(marked: np.ndarray, steps: int) -> np.ndarray:
    """Whether the place ``steps`` before is marked."""
    out = np.zeros(len(marked), bool)
    out[steps:] = marked[: len(marked) - steps]
    return out


def _seed(lang: str) -> int:
    return xxh3_64_intdigest(lang.encode()) >> 1


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of word pairs from their words' (unsigned 64-bit)."""
    x = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x632BE59BD9B4E019))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Bitmap:
    """Which hash slots are taken; ``bits`` is the power of two of its size."""

    def __init__(self, bits: int, blocks: list[tuple[int, bytes]]):
        self.shift = 64 - bits
        self.data = np.zeros(max(1 << bits, BLOCK) // 8, np.uint8)
        for number, block in blocks:
            part = np.frombuffer(bytes(block), np.uint8)
            self.data[number * BLOCK // 8 :][: len(part)] = part

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes >> np.uint64(self.shift)).astype(np.int64)
        return (self.data[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def bitmap(hashes: DataFrame) -> Bitmap:
    """The slots of the signed column ``h``; its size follows the number of hashes up to its bound."""
    many = max(1, hashes.count())
    bits = min(BITMAP_BITS, max(15, (many * BITS_EACH - 1).bit_length()))
    slot = F.shiftrightunsigned("h", 64 - bits) + 1  # from 1 on, block and place are plain quotient and remainder
    blocks = hashes.groupBy((F.bitmap_bucket_number(slot) - 1).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    return Bitmap(bits, [(r["block"], r["bits"]) for r in blocks.collect()])  # 2^28 bits, 32 MB, at most


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((lang, word, 1) for batch in batches for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    for lang, words, _ in _by_language(rows):
        tokens = Tokens(words)
        hashes = tokens.hashes(_seed(lang))[tokens.word]
        for i in range(0, len(hashes), TOGETHER):
            yield pa.RecordBatch.from_arrays([pa.array(hashes[i : i + TOGETHER].view(np.int64))], ["h"])


def _pairs(batches: Iterator[pa.RecordBatch], frequent: Bitmap):
    """(language, tokens, weights, hash of the pair at each place, whether it is one of frequent words, whether it is a shared window)."""
    for lang, chunks, times in _by_language(_chunks(batches)):
        tokens = Tokens(chunks)
        weights = np.repeat(np.array(times, np.int64), np.diff(np.concatenate([[0], tokens.between + 1, [len(tokens)]])))
        h = tokens.hashes(_seed(lang))
        often = tokens.word & frequent.has(h)
        valid = np.append(often[:-1] & often[1:], False)
        yield lang, tokens, weights, pair_hashes(h, np.append(h[1:], np.uint64(0))), valid, _after(tokens.shared, 1)


def _sums_of(hashes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and the sum of each one's times."""
    order = np.argsort(hashes)
    hashes, times = hashes[order], times[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
    return hashes[first], np.add.reduceat(times, first) if len(hashes) else times


def _hash_pairs(frequent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first bits, hashes, times of each) of pairs of frequent words, summed within a task."""
    held, size = [], 0

    def rows(hashes: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = (hashes >> np.uint64(64 - GROUP_BITS)).astype(np.int32)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.empty(0, np.int64)
        to = np.append(first[1:], len(group))
        for i in range(0, len(first), 256):
            spans = list(zip(first[i : i + 256].tolist(), to[i : i + 256].tolist(), strict=True))
            columns = [pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (hashes, times)]
            yield pa.RecordBatch.from_arrays([pa.array(group[first[i : i + 256]]), *columns], ["part", "hashes", "times"])

    for _, _, weights, h, valid, shared in _pairs(batches, frequent.value):
        chosen = valid & ~shared
        held.append((h[chosen], weights[chosen]))
        size += len(held[-1][0])
        if size >= HASHES:
            held = [_sums_of(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            size = len(held[0][0])
            if size >= HASHES // 2:
                yield from rows(*held[0])
                held, size = [], 0
    if held:
        yield from rows(*_sums_of(*(np.concatenate(x) for x in zip(*held, strict=True))))


def _frequent_hashes(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes that are there ``least`` times or more; rows of one group follow each other."""
    group, held = None, []

    def often() -> pa.RecordBatch:
        hashes, times = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*held, strict=True), ("<u8", "<i8"), strict=True))
        hashes, times = _sums_of(hashes, times)
        return pa.RecordBatch.from_arrays([pa.array(hashes[times >= least].view(np.int64))], ["h"])

    for batch in batches:
        for part, hashes, times in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if held and part != group:
                yield often()
                held = []
            group = part
            held.append((hashes, times))
    if held:
        yield often()


def _count_phrases(tables, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, n) of pairs whose hash is frequent, and of triples of two such pairs."""
    frequent, pairs = tables.value

    def found() -> Iterator[pa.Table]:
        for lang, tokens, weights, h, valid, shared in _pairs(batches, frequent):
            often = valid & pairs.has(h)
            for words, chosen in ((2, often & ~shared), (3, often & np.append(often[1:], False))):
                at = np.flatnonzero(chosen)
                for part, phrases in tokens.phrases(at, words):
                    many = len(phrases)
                    columns = [pa.repeat(pa.scalar(lang, pa.string()), many), phrases]
                    columns += [pa.repeat(pa.scalar(words, pa.int32()), many), pa.array(weights[at[part]])]
                    yield pa.table(columns, ["lang", "phrase", "words", "n"])

    return _summed(found())


def frequencies(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """((lang, n) of all words, (lang, phrase, words, n) of every phrase of 1 to 3 words found ``least`` times or more)."""
    spark = docs.sparkSession
    parse = written(parsed(docs, least), "parse")
    totals = parse.groupBy("lang").agg(F.sum(F.col("counted") * F.col("times")).alias("n"))
    chunks = parse.where("counted > 0").select("lang", "chunk", "times")
    often = F.col("n") >= least

    words = written(parse.where("counted = 0").select("lang", F.col("chunk").alias("phrase"), F.col("times").alias("n")), "words")
    frequent = bitmap(words.mapInArrow(_hash_batches, "h long"))

    sent = spark.sparkContext.broadcast(frequent)
    hashed = chunks.mapInArrow(partial(_hash_pairs, sent), "part int, hashes binary, times binary")
    hashed = hashed.repartition("part").sortWithinPartitions("part").mapInArrow(partial(_frequent_hashes, least), "h long")
    sent = spark.sparkContext.broadcast((frequent, bitmap(written(hashed, "pair-hashes"))))

    phrases = chunks.mapInArrow(partial(_count_phrases, sent), "lang string, phrase binary, words int, n long")
    longer = phrases.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(often)
    both = words.withColumn("words", F.lit(1)).unionByName(longer)
    return totals, written(both.select("lang", F.col("phrase").cast("string").alias("phrase"), "words", "n"), "phrases")


def _decimal(name: str):
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, inside_percent: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases of two and three words."""
    totals, phrases = frequencies(docs, least)
    candidates = phrases.where("words > 1").withColumnRenamed("n", "a").withColumn("_w", F.split("phrase", " "))

    # Every cut's two parts, each with its frequency; parts of a frequent phrase are frequent, so no part is missing.
    left = F.array_join(F.slice("_w", 1, F.col("k")), " ")
    right = F.array_join(F.slice("_w", F.col("k") + 1, F.col("words") - F.col("k")), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("_left"), right.alias("_right"))
    known = phrases.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), "n")
    for part, count in (("_left", "l"), ("_right", "r")):
        side = known.withColumnRenamed("n", count)
        cuts = cuts.join(side, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))).drop("_lang", "_part")
    cuts = cuts.withColumn("_num", _decimal("a") * _decimal("a") * F.lit(1000000).cast("decimal(7,0)"))
    cuts = cuts.withColumn("_den", _decimal("l") * _decimal("r")).withColumn("score", F.expr("_num div _den"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("_cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "_cut.score", "_cut.l", "_cut.r")

    # A phrase goes when one of the longer ones that hold it is nearly as frequent.
    inner = candidates.where("words = 3").withColumn("_i", F.explode(F.array(F.lit(1), F.lit(2))))
    inner = inner.select("lang", F.array_join(F.slice("_w", F.col("_i"), 2), " ").alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        F.coalesce(100 * _decimal("_longer") < inside_percent * _decimal("a"), F.lit(True))
    )
    # The first of each language are among the first of its RANKED parts, so one task ranks RANKED * top rows at most.
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKED)).alias("_part")
    among = Window.partitionBy("lang", "_part").orderBy(*best)
    kept = kept.select("*", part).withColumn("_place", F.row_number().over(among)).where(F.col("_place") <= top)
    order = Window.partitionBy("lang").orderBy(*best)
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
