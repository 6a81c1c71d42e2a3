"""Alignment of two tokenizers' tokens over the same bytes, by whitespace-token anchors.

Every text is tokenised whole by both vocabularies. Token bytes are laid out from
offset 0; an anchor is an offset where a token of each ends and the next token of
each begins with a blank. Anchors split a document into windows of token ids,
which recur far more often than documents do, so a window's groups and links are
worked out once per worker. Where each blank is an anchor, windows are the chunks
between blanks and found again by their text, else by their two id tuples.

- A group is a run of tokens between neighbouring offsets where both sides end.
- A link is a pair of token occurrences whose byte ranges overlap.
- An id pair's count is the number of links of the whole corpus that hold it.

One pass writes each document's figures with its distinct pairs and their numbers;
pair counts are summed from that table, never from the texts again. Counts of the
``HOT_PAIRS`` most frequent pairs at most are sent to the tasks (a bound in
bytes); documents that hold other pairs get the rest of their sums by a join.

Defined results: texts that are null, empty, or whose bytes either vocabulary
doesn't give back (such as texts with U+2581) have no tokens, so all figures
are zero and the groups an empty text; very long texts are aligned whole, texts
without blanks as one window; repeated rows and rows without an id count each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import values, written

#: Ids of the second vocabulary take the lower bits of a pair.
B_BITS = 20
#: Entries of a worker's caches (about 400 and 500 bytes each).
CHUNK_ENTRIES = 400_000
WINDOW_ENTRIES = 100_000
#: Longest chunk in code points, and longest window in tokens, that are remembered.
CHUNK_LENGTH = 64
WINDOW_TOKENS = 64
#: Most pairs whose counts are sent to every task, 16 bytes each.
HOT_PAIRS = 500_000
#: Code points of texts that are tokenised together.
GROUP_CHARACTERS = 400_000

#: White space (to any Unicode version) besides blanks and line feeds.
_ODD_ASCII = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_ODD_OTHER = re.compile("[\x85\xa0 ᠎ -‏    ⁠▁　﻿]")


def _odd_space(text: str) -> bool:
    """Whether the text has white space besides single blanks between visible characters and line feeds: such texts go through the libraries whole."""
    if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " ":
        return True
    return any(c in text for c in _ODD_ASCII) or (not text.isascii() and _ODD_OTHER.search(text) is not None)



def byte_alphabet() -> dict[str, int]:
    """The byte that each printable character of a byte-level vocabulary stands for."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Ids of a text by both vocabularies, and their tokens' bytes.

    A blank between two visible characters always starts a token in both, so
    chunks of texts with no other white space than such blanks and line feeds can
    be tokenised on their own; other texts go through whole.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_alphabet()
        vocabulary = self.a.get_vocab()
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        size = self.b.get_piece_size()
        pieces = self.b.id_to_piece(list(range(size)))
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        if size > 1 << B_BITS:
            raise ValueError(f"{path_b} has more than {1 << B_BITS} pieces")
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path_b} has pieces that go on after a blank, so texts can't be tokenised chunk by chunk")
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_length = np.array([len(t) for t in a_bytes], np.int64)
        self.b_length = np.array([len(t) for t in b_bytes], np.int64)
        self.a_blank = np.array([t.startswith(b" ") for t in a_bytes])
        self.b_blank = np.array([t.startswith(b" ") for t in b_bytes])

    def _faithful(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether both sides' tokens are the bytes of a blank and the text."""
        whole = b" " + text.encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == whole and b"".join(map(self.b_bytes.__getitem__, b)) == whole

    def _ids(self, text: str) -> tuple[list[int], list[int]]:
        return self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)

    def whole(self, text: str) -> tuple[bytes, bytes]:
        """(ids by A of a blank and the text, ids by B of the text), as little-endian 32-bit ids.

        Both empty for an empty text and unless both sides give the bytes of a blank and the text back.
        """
        a, b = self._ids(text) if text else ([], [])
        return (np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()) if text and self._faithful(text, a, b) else (b"", b"")

    def together(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """(ids, number of ids of each chunk) by A and by B of chunks without blanks, by one call of each library.

        A chunk's first token, and no other, begins with a blank; None if that isn't so or bytes aren't given back.
        """
        text = " ".join(chunks)
        sides, both = [], self._ids(text)
        if not self._faithful(text, *both):
            return None
        for ids, blank in zip(both, (self.a_blank, self.b_blank), strict=True):
            ids = np.array(ids, np.int64)
            starts = np.flatnonzero(blank[ids])
            if len(starts) != len(chunks):
                return None
            sides.append((ids, np.diff(np.append(starts, len(ids)))))
        return sides


class Aligner:
    """A worker's vocabularies and the alignments it has met: of chunks by their text, of other windows by their two id tuples (as bytes)."""

    def __init__(self, path_a: str, path_b: str):
        self.words = v = Vocabularies(path_a, path_b)
        #: (A tokens, B tokens, groups, links, groups as text); no tokens where the chunk's bytes aren't given back.
        self.chunks: dict[str, tuple[int, int, int, bytes, str]] = {}
        self.windows: dict[tuple[bytes, bytes], tuple[int, bytes, str]] = {}
        self.missed_chunks = self.missed = 0
        # An id's text with what follows it: A inside and at the end of a group's left side, B inside and at the end of its right side.
        self.parts = [f"{i}{mark}" for size, marks in ((len(v.a_bytes), ",|"), (len(v.b_bytes), ",;")) for mark in marks for i in range(size)]

    def cuts(self, a_data: bytes, b_data: bytes) -> list[tuple[bytes, bytes]]:
        """A text's windows: its ids of A and of B between anchors."""
        v = self.words
        a, b = np.frombuffer(a_data, "<u4"), np.frombuffer(b_data, "<u4")
        a_ends, b_ends = np.cumsum(v.a_length[a]), np.cumsum(v.b_length[b])
        # Ends before a token that begins with a blank on either side, and the text's end.
        a_cut = np.flatnonzero(np.append(v.a_blank[a[1:]], True)) + 1
        b_cut = np.flatnonzero(np.append(v.b_blank[b[1:]], True)) + 1
        _, i, k = np.intersect1d(a_ends[a_cut - 1], b_ends[b_cut - 1], assume_unique=True, return_indices=True)
        i, k = (4 * a_cut[i]).tolist(), (4 * b_cut[k]).tolist()
        return [
            (a_data[i0:i1], b_data[k0:k1]) for i0, i1, k0, k1 in zip([0, *i], i, [0, *k], k, strict=False)
        ]

    def new_windows(self, keys: list[tuple[bytes, bytes]]) -> list[tuple[int, bytes, str]]:
        """(number of groups, links as little-endian 64-bit pairs, groups as text) of each window."""
        sides = [(np.frombuffer(b"".join([k[side] for k in keys]), "<u4"), np.array([len(k[side]) // 4 for k in keys])) for side in (0, 1)]
        return self.laid(*sides)

    def laid(self, a_side: tuple[np.ndarray, np.ndarray], b_side: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, bytes, str]]:
        """The same of windows laid end to end, by their (ids, number of ids of each window) of A and of B."""
        v = self.words
        (a, a_many), (b, b_many) = a_side, b_side
        a_ends, b_ends = np.cumsum(v.a_length[a]), np.cumsum(v.b_length[b])
        edges = a_ends[np.cumsum(a_many) - 1]
        # Each stretch between neighbouring ends lies in one token of each side, which makes it a link.
        ends = np.union1d(a_ends, b_ends)
        pairs = a[np.searchsorted(a_ends, ends)].astype("<i8") << B_BITS | b[np.searchsorted(b_ends, ends)]
        data, to = pairs.astype("<i8").tobytes(), (8 * (np.searchsorted(ends, edges) + 1)).tolist()
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        groups = np.diff(np.searchsorted(shared, edges), prepend=-1).tolist()
        size = len(v.a_bytes)
        codes = np.concatenate([
            a.astype(np.int64) + size * (a_ends == shared[a_group]),
            2 * size + b.astype(np.int64) + len(v.b_bytes) * (b_ends == shared[b_group]),
        ])
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        texts = list(map(self.parts.__getitem__, codes[order].tolist()))
        bounds = np.cumsum(a_many + b_many).tolist()
        return [
            (n, data[p0:p1], "".join(texts[s0:s1])[:-1])
            for s0, s1, n, p0, p1 in zip([0, *bounds], bounds, groups, [0, *to], to, strict=False)
        ]

    def new_chunks(self, chunks: list[str]) -> dict[str, tuple[int, int, int, bytes, str]]:
        """What ``chunks`` keeps, of chunks without blanks; as no token inside begins with a blank, each is one window."""
        sides = self.words.together(chunks)
        if sides is None:
            ids = {c: self.words.whole(c) for c in chunks}
            kept = [k for k in ids.values() if k[0]]
            found = iter(self.new_windows(kept) if kept else [])
            return {c: (len(a) // 4, len(b) // 4, *next(found)) if a else (0, 0, 0, b"", "") for c, (a, b) in ids.items()}
        (_, a_many), (_, b_many) = sides
        rows = zip(chunks, a_many.tolist(), b_many.tolist(), self.laid(*sides), strict=True)
        return {c: (n_a, n_b, *window) for c, n_a, n_b, window in rows}

    def align(self, texts: list[str]) -> list[tuple[int, int, int, bytes, str]]:
        """(A tokens, B tokens, groups, links, digest of the groups) of each text; zeros where the bytes aren't given back."""
        known = self.chunks
        split = [None if not t or _odd_space(t) else t.split(" ") for t in texts]
        looked = [list(map(known.get, chunks)) if chunks else [] for chunks in split]
        missing = list({c for chunks, found in zip(split, looked, strict=True) if None in found for c, e in zip(chunks, found, strict=True) if e is None})
        new = self.new_chunks(missing) if missing else {}
        if len(known) + len(new) <= CHUNK_ENTRIES:
            known.update((c, e) for c, e in new.items() if len(c) <= CHUNK_LENGTH)
        else:  # frequent chunks came early: a full cache is kept, until the texts have changed a lot
            self.missed_chunks += len(new)
            if self.missed_chunks > 4 * CHUNK_ENTRIES:
                self.missed_chunks, self.chunks = 0, {}
        out: list = [None] * len(texts)
        others = []
        for i, (chunks, found) in enumerate(zip(split, looked, strict=True)):
            if chunks:
                if None in found:
                    found = [new[c] if e is None else e for c, e in zip(chunks, found, strict=True)]
                n_a, n_b, n_groups, links, groups = zip(*found, strict=True)
                if 0 not in n_a:
                    digest = sha256(";".join(groups).encode()).hexdigest()
                    out[i] = sum(n_a), sum(n_b), sum(n_groups), b"".join(links), digest
                    continue
            others.append(i)
        if others:
            for i, row in zip(others, self._align_whole([texts[i] for i in others]), strict=True):
                out[i] = row
        return out

    def _align_whole(self, texts: list[str]) -> list[tuple[int, int, int, bytes, str]]:
        """The same of texts that go through the libraries whole."""
        ids = [self.words.whole(t) for t in texts]
        keys = [self.cuts(a, b) if a else [] for a, b in ids]
        known = self.windows
        looked = [list(map(known.get, row)) for row in keys]
        missing = list(dict.fromkeys(k for row, found in zip(keys, looked, strict=True) if None in found for k, w in zip(row, found, strict=True) if w is None))
        new = dict(zip(missing, self.new_windows(missing), strict=True)) if missing else {}
        if len(known) + len(new) <= WINDOW_ENTRIES:
            known.update((k, w) for k, w in new.items() if len(k[0]) + len(k[1]) <= 4 * WINDOW_TOKENS)
        else:  # frequent windows came early: a full memo is kept, until the texts have changed a lot
            self.missed += len(new)
            if self.missed > 4 * WINDOW_ENTRIES:
                self.missed, self.windows = 0, {}
        out = []
        for (a, b), row, found in zip(ids, keys, looked, strict=True):
            if not row:
                out.append((0, 0, 0, b"", ""))
                continue
            if None in found:
                found = [new[k] if w is None else w for k, w in zip(row, found, strict=True)]
            n_groups, links, groups = zip(*found, strict=True)
            out.append((len(a) // 4, len(b) // 4, sum(n_groups), b"".join(links), sha256(";".join(groups).encode()).hexdigest()))
        return out


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


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


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<int>"


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _align_batches(path_a: str, path_b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker = aligner(path_a, path_b)
    for batch in batches:
        at = 0
        for group in _grouped(values(batch.column(1))):
            rows, pairs, links = [], [], []
            for n_a, n_b, n_groups, data, digest in worker.align(group):
                distinct, times = np.unique(np.frombuffer(data, "<i8"), return_counts=True)
                rows.append((n_a, n_b, n_groups, len(data) // 8, digest))
                pairs.append(distinct)
                links.append(times)
            columns = [batch.column(0).slice(at, len(group))]
            at += len(group)
            for values_, kind in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()], strict=True):
                columns.append(pa.array(values_, kind))
            columns += [_lists(pairs, pa.int64()), _lists(links, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f.split()[0] for f in _ALIGNED.split(", "))])


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document its figures, its distinct id pairs and the number of links of each."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_align_batches, path_a, path_b), f"doc_id {kind}, {_ALIGNED}")


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each distinct pair of a batch."""
    for batch in batches:
        pairs, place = np.unique(batch.column(0).flatten().to_numpy(), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, place, batch.column(1).flatten().to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(total)], ["pair", "links"])


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, links) of the whole corpus from a table of ``aligned`` rows."""
    parts = documents.select("pairs", "links").mapInArrow(_sum_batches, "pair long, links long")
    return parts.groupBy("pair").agg(F.sum("links").alias("links"))


def _best(counts: DataFrame, b_size: int) -> np.ndarray:
    """The highest count among the pairs of each B id; one row per B id is collected."""
    b_id = (F.col("pair").bitwiseAND((1 << B_BITS) - 1)).cast("int")
    best = np.zeros(b_size, np.int64)
    for row in counts.groupBy(b_id.alias("b")).agg(F.max("links").alias("links")).collect():
        best[row["b"]] = row["links"]
    return best


def _hot(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(pairs in order, their counts, whether that is all) of the most frequent pairs, at most ``most``.

    Pairs are chosen by the power of two their count reaches: at most 64 rows tell how many each power has.
    """
    power = F.floor(F.log2("links")).cast("int")
    rows = sorted(((r["p"], r["count"]) for r in counts.groupBy(power.alias("p")).count().collect()), reverse=True)
    least, taken, complete = None, 0, True
    for p, many in rows:
        if taken + many > most:
            complete = False
            break
        least, taken = p, taken + many
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), complete
    chosen = counts.where(power >= least).toArrow()
    pairs, links = chosen.column("pair").to_numpy(), chosen.column("links").to_numpy()
    order = np.argsort(pairs)
    return pairs[order], links[order], complete


def _score_batches(tables, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the pairs whose counts were sent, and the other pairs with their links."""
    hot, hot_links, best = tables.value
    for batch in batches:
        pairs_of = batch.column(batch.schema.get_field_index("pairs"))
        pairs, links = pairs_of.flatten().to_numpy(), batch.column(batch.schema.get_field_index("links")).flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(pairs_of.offsets.to_numpy()))
        place = np.minimum(np.searchsorted(hot, pairs), max(len(hot) - 1, 0))
        known = hot[place] == pairs if len(hot) else np.zeros(len(pairs), bool)
        count = hot_links[place] if len(hot) else np.zeros(len(pairs), np.int64)
        total, top = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        np.add.at(total, row[known], count[known] * links[known])
        is_best = known & (count == best[pairs & ((1 << B_BITS) - 1)])
        np.add.at(top, row[is_best], links[is_best])
        rest = [pairs[(row == r) & ~known] for r in range(batch.num_rows)] if not known.all() else [pairs[:0]] * batch.num_rows
        rest_links = [links[(row == r) & ~known] for r in range(batch.num_rows)] if not known.all() else [links[:0]] * batch.num_rows
        kept = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] not in ("pairs", "links")]
        names = [n for n in batch.schema.names if n not in ("pairs", "links")]
        kept += [pa.array(top), pa.array(total), _lists(rest, pa.int64()), _lists(rest_links, pa.int32())]
        yield pa.RecordBatch.from_arrays(kept, [*names, "n_best", "count_sum", "pairs", "links"])


def alignments(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    spark = docs.sparkSession
    documents = written(aligned(docs, path_a, path_b), "aligned")
    counts = written(pair_counts(documents), "pair-counts")
    hot, hot_links, complete = _hot(counts, hot_pairs)
    best = _best(counts, aligner(path_a, path_b).words.b_length.size)
    tables = spark.sparkContext.broadcast((hot, hot_links, best))  # hot_pairs * 16 bytes and one long per B id at most
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = documents.mapInArrow(
        partial(_score_batches, tables),
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long,"
        " pairs array<long>, links array<int>",
    )
    result = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if complete:
        return scored.select(*result)
    # Pairs that were not sent: their counts are joined, summed per row, and added.
    scored = written(scored.withColumn("_row", F.expr("uuid()")), "aligned-scored")
    b_id = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    tops = spark.createDataFrame([(i, n) for i, n in enumerate(best.tolist())], "b long, top long")
    rest = (
        scored.select("_row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("links").alias("times"))))
        .join(counts.withColumnRenamed("links", "n"), "pair")
        .join(F.broadcast(tops), b_id == F.col("b"))  # one row per B id
        .groupBy("_row")
        .agg(
            F.sum(F.col("n") * F.col("times")).alias("_sum"),
            F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).cast("long").alias("_best"),
        )
    )
    whole = scored.join(rest, "_row", "left")
    added = {"n_best": "_best", "count_sum": "_sum"}
    return whole.select(*((F.col(c) + F.coalesce(added[c], F.lit(0))).alias(c) if c in added else c for c in result))
