"""Alignment, collocations and quality rules: awkward rows, brute force, and bounds of their tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from starlens.llm import collocations as col
from starlens.llm import quality_rules as rules
from starlens.llm import token_alignment as align
from starlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.odd import ROWS, odd_documents

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ALPHABET = [*" \t\n\r\x0b\x00.,'sdlvem019aAéß中🙂▁ ​　ﬁ́क़\x85\x1c<>|_/è ﻿", *" " * 12, "<s>", "</s>", "<|endoftext|>", "<0x41>", "<unk>", "'s "]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 40))) for _ in range(n)]


# --- alignment --------------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def brute_alignment(text, libraries):
    """(n_a, n_b, n_groups, links as a list of id pairs, digest)."""
    words = align.aligner(A, B).words
    if not text:
        return 0, 0, 0, [], ""
    a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    whole = b" " + text.encode()
    sides = []
    for ids, table in ((a, words.a_bytes), (b, words.b_bytes)):
        if b"".join(table[i] for i in ids) != whole:
            return 0, 0, 0, [], ""
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(table[i])))
            at += len(table[i])
        sides.append(spans)
    links = [(x, y) for x, s, e in sides[0] for y, t, f in sides[1] if t < e and s < f]
    ends = sorted({e for _, _, e in sides[0]} & {e for _, _, e in sides[1]})
    groups, before = [], 0
    for end in ends:
        groups.append("|".join(",".join(str(i) for i, _, e in side if before < e <= end) for side in sides))
        before = end
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def test_alignment_of_random_texts_equals_brute_force(libraries):
    texts = random_texts(4000, 1)
    got = align.Aligner(A, B).align(texts)
    some = 0
    for text, (n_a, n_b, n_groups, data, digest) in zip(texts, got, strict=True):
        want = brute_alignment(text, libraries)
        assert (n_a, n_b, n_groups, digest) == (*want[:3], want[4]), text
        assert len(data) // 8 == len(want[3])
        some += n_a > 0
    assert some > 1000


@pytest.mark.parametrize("hot_pairs", [10**6, 40, 0])
def test_alignments_equal_brute_force(spark, libraries, hot_pairs):
    """Also where the counts that are sent are not all, or none."""
    rows = [(r[0], r[1]) for r in ROWS if r[1] is None or len(r[1]) < 1000]
    rows += [(100 + i, t) for i, t in enumerate(random_texts(60, 2))]
    rows += [(200, "x" * 3000), (201, "中文" * 400), (202, "the cat sat on the mat")]
    extra = odd_documents(spark, [(d, t, "s") for d, t in rows])
    found = [brute_alignment(t, libraries) for _, t in rows]
    counts = Counter(link for f in found for link in f[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    want = [
        (d, f[0], f[1], f[2], len(f[3]), sum(counts[x] == best[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[4])
        for (d, _), f in zip(rows, found, strict=True)
    ]
    got = align.alignments(extra, A, B, hot_pairs=hot_pairs)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_alignment_of_an_empty_table(spark):
    assert align.alignments(odd_documents(spark, []), A, B).collect() == []


def test_full_caches_change_nothing(monkeypatch, libraries):
    texts = [t for t in random_texts(300, 3)] * 2
    want = align.Aligner(A, B).align(texts)
    monkeypatch.setattr(align, "CHUNK_ENTRIES", 20)
    monkeypatch.setattr(align, "WINDOW_ENTRIES", 20)
    small = align.Aligner(A, B)
    assert [r for t in texts for r in small.align([t])] == want


def test_chunks_met_before_need_neither_library_nor_windows(monkeypatch, libraries):
    texts = ["the cat sat,\non the mat", "on the mat sat\nthe cat sat,\non", "中文 the é🙂 x <s> <0x41>"]
    worker = align.Aligner(A, B)
    worker.align([" ".join(t.split(" ")[::-1]) for t in texts[:2]] + texts)
    want = [brute_alignment(t, libraries) for t in texts]

    def never(*_):
        raise AssertionError("worked out again")

    for owner, names in ((align.Vocabularies, ("_ids",)), (align.Aligner, ("cuts", "new_windows", "laid"))):
        for name in names:
            monkeypatch.setattr(owner, name, never)
    for text, (n_a, n_b, n_groups, data, digest) in zip(texts, worker.align(texts), strict=True):
        brute = want[texts.index(text)]
        assert (n_a, n_b, n_groups, digest) == (*brute[:3], brute[4])
        assert n_a and Counter((int(x) >> align.B_BITS, int(x) & (1 << align.B_BITS) - 1) for x in np.frombuffer(data, "<i8")) == Counter(brute[3])


def test_a_text_with_a_chunk_whose_bytes_are_not_given_back(libraries):
    texts = ["a ▁b c", "a b", "ﬁ x", "x a", "한 a b", "한 a\u0301 x"]
    got = align.Aligner(A, B).align(texts)
    for text, row in zip(texts, got, strict=True):
        want = brute_alignment(text, libraries)
        assert (*row[:3], len(row[3]) // 8, row[4]) == (*want[:3], len(want[3]), want[4]), text


# --- collocations --------------------------------------------------------------------

def brute_collocations(rows, least=10, top=2000, inside=50):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    f = Counter()
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in (1, 2, 3):
                f.update((lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [n for (g, q), n in f.items() if g == lang and len(q) == 3 and n >= least and len(p) == 2 and p in (q[:2], q[1:])]
        if not any(100 * n >= inside * a for n in longer):
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]], score))
    return {
        (lang, r + 1, c[2].decode(), c[3], c[4], c[5], total[lang], c[6])
        for lang, cs in out.items()
        for r, c in enumerate(sorted(cs)[:top])
    }


def spoken(n, seed):
    """Texts of few words, so that phrases recur and trigger windows are frequent; copies, long runs and odd white space."""
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "times", "a b", "ÉTÉ", "x", "\x1fy"]
    texts = []
    for _ in range(n):
        run = rng.choices(words, weights=[9, 3, 6, 3, 3, 2, 1, 1, 1, 1], k=rng.randint(1, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "!?", "\x0b"]) for w in run)
        texts += [text] * rng.choice([1, 1, 1, 5])
    return [*texts, "again " * 500, "one. " * 300, "", None, " \t\n"]


def test_collocations_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["en", "en", "en", "de", None, "und"]), t) for t in spoken(150, 4)]
    docs = spark.createDataFrame([(i, t, g, "extra", "extra") for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, k string, phrase string")
    for least, top in ((10, 2000), (3, 5)):
        got = {tuple(r) for r in col.collocations(docs, least=least, top=top).collect()}
        assert got == brute_collocations(rows, least, top)
    assert got


def test_small_tables_and_colliding_bitmaps_change_nothing(spark, monkeypatch):
    rows = [("en", t) for t in spoken(60, 5)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(col, "BITMAP_BITS", 15)
    monkeypatch.setattr(col, "BITS_EACH", 1)
    got = {tuple(r) for r in col.collocations(docs, least=4).collect()}
    assert got == brute_collocations(rows, 4)


def test_chunks_cover_every_phrase_once():
    lower = [t.encode().lower() for t in spoken(200, 6) if t]
    for text in lower:
        pieces = [p.split() for p in re.split(rb"[.,;:!?\n\x0b\x0c\r]", text)]
        want = Counter(tuple(p[i : i + n]) for p in pieces for n in (1, 2, 3) for i in range(len(p) - n + 1))
        got, words = Counter(), 0
        for chunk, counted in col.chunks_of(text):
            words += counted
            tokens = chunk.split(b" ")
            shared = tokens[0] == col.SHARED
            tokens = tokens[1:] if shared else tokens
            for n in (1, 2, 3):
                for i in range(len(tokens) - n + 1):
                    phrase = tuple(tokens[i : i + n])
                    if col.GAP not in phrase and not (shared and i + n <= 2):
                        got[phrase] += 1
        assert got == want
        assert words == sum(map(len, pieces))


def test_collocations_of_an_empty_table(spark):
    assert col.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert col.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).collect() == []


def test_texts_laid_end_to_end_are_cut_counted_and_hashed_one_by_one(monkeypatch):
    monkeypatch.setattr(col, "TOGETHER_BYTES", 40)
    long = [b"x" * 64 + b"y" * n for n in (0, 1, 2)] + [b"x" * 70 + b"z"]
    texts = [t for t in (col._normal(t.encode().lower()) for t in spoken(120, 7) if t) if t] + [b" ".join(long), b". .", b"."]
    tokens = col.Tokens(texts)
    assert list(tokens.cut()) == [c for t in texts for c in col.chunks_of(t)]
    laid = b" . ".join(texts).split(b" ")
    found = tokens.words()
    assert dict(zip(found["item"].to_pylist(), found["n"].to_pylist())) == Counter(t for t in laid if t != col.GAP)
    by_hash = {}
    for word, h in zip(laid, tokens.hashes(5).tolist()):
        by_hash.setdefault(h, set()).add(word)
    assert len(by_hash) == len(set(laid)) and all(len(w) == 1 for w in by_hash.values())
    for words in (2, 3):
        at = np.arange(0, len(laid) - words, 2)
        parts = list(tokens.phrases(at, words))
        assert [p for _, a in parts for p in a.to_pylist()] == [b" ".join(laid[i : i + words]) for i in at]
        assert len(parts) > 1 and np.array_equal(np.concatenate([at[s] for s, _ in parts]), at)


def test_full_tables_are_handed_on_without_loss(monkeypatch):
    for name, size in (("ENTRIES", 40), ("HASHES", 30), ("TOGETHER", 7), ("TOGETHER_BYTES", 200)):
        monkeypatch.setattr(col, name, size)
    rows = [(g, t) for g in ("en", "de") for t in spoken(60, 8)]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], ["lang", "text"])
    parse, words = Counter(), Counter()
    for lang, chunk, counted, times in (r for b in col._parse_batches(iter([batch])) for r in zip(*b.to_pydict().values())):
        (parse if counted else words)[lang, chunk] += times
    want = Counter((g, c) for g, t in rows if t for c, _ in col.chunks_of(t.encode().lower()))
    assert parse == want
    phrases = Counter()
    for lang, text in rows:
        for piece in re.split(rb"[.,;:!?\n\x0b\x0c\r]", (text or "").encode().lower()):
            w = piece.split()
            phrases.update((lang, tuple(w[i : i + n])) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    assert words == {(g, p[0]): n for (g, p), n in phrases.items() if len(p) == 1}

    every = col.Bitmap(15, [(0, b"\xff" * 4096)])
    sent = type("Sent", (), {"value": every})
    langs, chunks = zip(*parse)
    batch = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(chunks, pa.binary()), pa.array(list(parse.values()), pa.int64())], ["lang", "chunk", "times"])
    counted = Counter()
    for b in col._count_phrases(type("Sent", (), {"value": (every, every)}), iter([batch])):
        for lang, phrase, n, times in zip(*b.to_pydict().values()):
            counted[lang, tuple(phrase.split(b" "))] += times
            assert phrase.count(b" ") == n - 1
    assert counted == {k: n for k, n in phrases.items() if len(k[1]) > 1}
    parts = sorted((r for b in col._hash_pairs(sent, iter([batch])) for r in zip(*b.to_pydict().values())), key=lambda r: r[0])
    parts = pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*parts)], ["part", "hashes", "times"])
    for least in (1, 10):
        often = [h for b in col._frequent_hashes(least, iter([parts])) for h in b.column(0).to_pylist()]
        assert len(often) == len(set(often)) == sum(len(k[1]) == 2 and n >= least for k, n in phrases.items())


# --- quality rules --------------------------------------------------------------------

def brute_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {p for i, x in enumerate(windows) if times[x] > 1 for p in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    rng = random.Random(7)
    texts = [t for _, t, *_ in ROWS] + random_texts(200, 8)
    texts += [" ".join(rng.choices("ab", k=rng.randint(1, 60))) for _ in range(200)]
    texts += ["a b c d e f g h " * 3, "a b c d e f g h", "x " * 5000, "a\n\na\n \nb\r\na\n"]
    docs = odd_documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    judged = rules.judged(docs, into="key")  # a name the table has
    assert judged.columns[:-1] == docs.columns and judged.columns[-1] not in docs.columns
    for r in judged.select("doc_id", "text", F.col(judged.columns[-1]).alias("q")).collect():
        m = r.q.measures
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute_measures(r.text), r.text
        assert r.q.base_failed == (m.n_words < 20 or 100 * m.n_repeat_words > 30 * m.n_words)
        assert r.q.kept == (not r.q.failed) and not (r.q.base_failed and r.q.kept)


def test_rules_are_rows_of_a_table(spark):
    docs = spark.createDataFrame([("one two three",), ("one",), (None,)], "text string")
    table = (rules.Rule("few", "n_words", least=2, base=True), rules.Rule("long", "word_chars", "n_words", most=300))
    got = [tuple(r.quality_rules)[1:] for r in rules.judged(docs, rules=table).collect()]
    assert got == [(["long"], False, False), (["few"], True, False), (["few"], True, False)]
    assert all(r.quality_rules.kept for r in rules.judged(docs, rules=()).collect())
    assert rules.judged(docs.limit(0)).collect() == []


def test_clean_documents_are_kept(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1")
    kept = QUERIES["op13_quality_rules"](spark, SF_SMALL).join(labels, "doc_id").where("NOT base_failed")
    assert kept.where("NOT kept").count() == 0 < kept.count()
