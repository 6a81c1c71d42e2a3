"""Token counts by heap-and-linked-list byte-pair merging.

The count of a pre-token is its number of byte symbols minus the number of
merges: the symbols form a doubly linked list, a heap holds the adjacent pairs
that have a rank, and the lowest rank (leftmost first) is merged until no
ranked pair is left. Token ids are never built.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted each; a null id is passed through; an empty table gives an empty
result; columns besides the named ones are ignored. Whole texts are counted,
however long.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import values

#: The white space of the pre-tokenizer's pattern (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def pretoken_pattern(space: str = f"[{SPACE}]", letter: str = r"\p{L}", number: str = r"\p{N}") -> str:
    """Fixed pre-token pattern of byte-level vocabularies of this kind, over three classes of characters."""
    return (
        rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+"
        rf"| ?[^{space}{letter}{number}]+|{space}+(?![^{space}])|{space}+"
    )


#: White space besides single blanks and line feeds inside the text sends a document through the pattern as a whole.
ODD_SPACE = regex.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Entries per cache of a Python worker (about 100 bytes each); a full cache is emptied.
CACHE_ENTRIES = 400_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _library_kinds(split, characters: str) -> list[str]:
    """L, N, S or O (other) of each character to the library's own pre-tokenizer ``split``."""
    if len(split(f"a{characters}a")) == 1:
        return ["L"] * len(characters)
    if len(split(f"!{characters}!")) == 1:
        return ["O"] * len(characters)
    kinds = []
    for c in characters:
        whole = [k for k, edge in (("L", "a"), ("N", "1"), ("O", "!")) if len(split(f"{edge}{c}{edge}")) == 1]
        kinds.append(whole[0] if whole else "S")
    return kinds


@lru_cache(maxsize=4)
def class_differences(path: str) -> dict[str, str]:
    """Characters that the library and ``regex`` class differently, as the inside of a set; by the library's class.

    The two may know different versions of the character tables. Blocks that are all
    letters or all other characters take one probe; every character of the rest takes its own.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    tests = [(k, regex.compile(p)) for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", f"[{SPACE}]"))]
    found: dict[str, list[int]] = {}
    for block in range(0, 0x110000, 256):
        if 0xD800 <= block < 0xE000:
            continue  # no text holds surrogates
        characters = "".join(map(chr, range(block, block + 256)))
        kinds = _library_kinds(split, characters)
        if kinds == ["O"] * 256 and not any(test.search(characters) for _, test in tests):
            continue
        for c, kind in zip(characters, kinds, strict=True):
            if kind != next((k for k, test in tests if test.fullmatch(c)), "O"):
                found.setdefault(kind, []).append(ord(c))
    return {kind: _ranges(points) for kind, points in found.items()}


def _ranges(points: list[int]) -> str:
    """The inside of a set with the ascending code points, neighbours as ranges."""
    out, first = [], points[0]
    for a, b in zip(points, [*points[1:], -1], strict=True):
        if b != a + 1:
            out.append(f"\\U{first:08x}-\\U{a:08x}")
            first = b
    return "".join(out)


class _Cache(dict):
    """Counts by text piece; a missing piece is counted, and a full cache starts anew."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, piece):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[piece] = n = self.count(piece)
        return n


class PairMerger:
    """Counts tokens under the merges of one ``tokenizers`` JSON file (byte-level BPE)."""

    def __init__(self, path: str, differences: dict[str, str] | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") or spec.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.byte_ids = [vocab[c] for c in byte_alphabet()]
        # (left id, right id) -> rank and merged id, packed into one int each
        self.pairs: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        added = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.markers = added
        self.pattern = self.library_pattern = regex.compile(pretoken_pattern())
        differences = class_differences(path) if differences is None else differences
        self.differing = regex.compile("(?V1)[" + "".join(differences.values()) + "]") if differences else None
        if differences:
            plain = {"S": f"[{SPACE}]", "L": r"\p{L}", "N": r"\p{N}"}
            sets = {}
            for kind, plain_set in plain.items():
                others = "".join(cs for k, cs in differences.items() if k != kind)
                less = f"[{plain_set}--[{others}]]" if others else plain_set
                sets[kind] = f"[{less}||[{differences[kind]}]]" if kind in differences else less
            self.library_pattern = regex.compile(pretoken_pattern(sets["S"], sets["L"], sets["N"]))
        self.pretokens = _Cache(self.count_pretoken)
        self.chunks = _Cache(self.count_chunk)

    def count_pretoken(self, pretoken: str) -> int:
        """Initial symbols minus merges."""
        symbols = [self.byte_ids[b] for b in pretoken.encode()]
        n, pairs = len(symbols), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = pairs.get(symbols[i] << 20 | symbols[i + 1])
            if found is not None:
                heap.append((found >> 20) << 40 | i)
        heapify(heap)
        merges = 0
        while heap:
            key = heappop(heap)
            i = key & 0xFFFFFFFFFF
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = pairs.get(symbols[i] << 20 | symbols[j])
            if found is None or found >> 20 != key >> 40:
                continue  # an entry of a pair that is gone
            symbols[i], symbols[j] = found & 0xFFFFF, -1
            merges += 1
            after[i] = right = after[j]
            if right < n:
                before[right] = i
                found = pairs.get(symbols[i] << 20 | symbols[right])
                if found is not None:
                    heappush(heap, (found >> 20) << 40 | i)
            left = before[i]
            if left >= 0:
                found = pairs.get(symbols[left] << 20 | symbols[i])
                if found is not None:
                    heappush(heap, (found >> 20) << 40 | left)
        return n - merges

    def count_plain(self, text: str) -> int:
        """Tokens of a text without special strings, split by the pattern."""
        short, total = self.pretokens, 0
        for piece in self.pattern.findall(text):
            total += short[piece] if len(piece) <= 64 else self.count_pretoken(piece)
        return total

    def count_differing(self, text: str) -> int:
        """Tokens of a text with characters that the library and ``regex`` class differently."""
        return sum(self.count_pretoken(piece) for piece in self.library_pattern.findall(text))

    def count_chunk(self, chunk: str) -> int:
        """Tokens of a blank and the chunk after it."""
        return self.count_plain(" " + chunk)

    def count_segment(self, text: str) -> int:
        if self.differing is not None and not text.isascii() and self.differing.search(text):
            return self.count_differing(text)
        # A blank between two visible characters always starts a pre-token, so the
        # text may be cut there and the parts counted on their own.
        if "  " in text or " \n" in text or "\n " in text or ODD_SPACE.search(text):
            return self.count_plain(text)
        chunks = text.split(" ")
        if chunks[-1] == "":
            return self.count_plain(text)
        counts = self.chunks
        total = self.count_plain(chunks[0])
        for chunk in chunks[1:]:
            total += counts[chunk] if len(chunk) <= 64 else self.count_chunk(chunk)
        return total

    def count(self, text: str) -> int:
        if self.special is None or not any(m in text for m in self.markers):
            return self.count_segment(text)
        total, at = 0, 0
        for hit in self.special.finditer(text):
            total += self.count_segment(text[at : hit.start()]) + 1
            at = hit.end()
        return total + self.count_segment(text[at:])


@lru_cache(maxsize=4)
def merger(path: str, differences: tuple[tuple[str, str], ...]) -> PairMerger:
    return PairMerger(path, dict(differences))


def _count_batches(path: str, differences, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = merger(path, differences)
    for batch in batches:
        counts = [counter.count(t) if t else 0 for t in values(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
        )


def token_counts(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document; ``vocabulary`` is a path all workers can read."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    differences = tuple(sorted(class_differences(vocabulary).items()))
    narrow = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("n_bytes"),
    )
    counted = narrow.mapInArrow(partial(_count_batches, vocabulary, differences), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
