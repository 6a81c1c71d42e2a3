"""Token counts, personal data, winnowing: against the library, the patterns and brute force."""

import hashlib
import random
import re
from functools import partial

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starlens.llm import pii_semicrf as pii
from starlens.llm import winnowing
from starlens.llm.queries import QUERIES
from starlens.llm.token_counts import PairMerger, token_counts
from tests.conftest import SF_SMALL
from tests.llm.odd import LONG, ROWS, odd_documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")


# --- token counts -----------------------------------------------------------

def test_counts_equal_the_library_on_random_text():
    mine, theirs, rng = PairMerger(BYTE_BPE), Tokenizer.from_file(BYTE_BPE), random.Random(3)
    alphabet = " \t\n\r\x0b\x1c\x1f\x85\xa0 　ab's'llé中🙂Ⅷ²٣.,!?$<|endoftext|>"
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.3:
            text = text[:9] + "<|endoftext|>" + text[9:]
        assert mine.count(text) == len(theirs.encode(text, add_special_tokens=False).ids), repr(text)
    assert mine.count("a" * 20_000) == len(theirs.encode("a" * 20_000).ids)


def test_counts_equal_the_library_for_every_code_point():
    """Between letters, digits and marks, whatever version of the character tables either side has."""
    mine, theirs = PairMerger(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    points = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 512):
        text = "".join(f"a{chr(c)}1{chr(c)}! {chr(c)}." for c in points[i : i + 512])
        assert mine.count(text) == len(theirs.encode(text, add_special_tokens=False).ids), hex(points[i])
    for text in ("\U000191c6x", "a\U00011de0 b", "1\U00012475\U00012550."):
        assert mine.count(text) == len(theirs.encode(text, add_special_tokens=False).ids)


def test_counts_of_documents_and_awkward_rows(spark):
    theirs = Tokenizer.from_file(BYTE_BPE)
    for docs in (documents(spark), odd_documents(spark)):
        texts = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["text"] or "") for r in docs.collect())
        got = sorted(
            (r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"], r["over_limit"])
            for r in token_counts(docs, BYTE_BPE, 512).collect()
        )
        want = sorted((d, len(t.encode()), n := len(theirs.encode(t, add_special_tokens=False).ids), n > 512) for d, t in texts)
        assert got == want
    assert token_counts(odd_documents(spark).limit(0), BYTE_BPE, 512).count() == 0


# --- personal data ------------------------------------------------------------

PATTERNS = [
    re.compile(p)
    for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def by_patterns(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if k == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for _ in range(15000):
        alphabet = rng.choice(["0123.45 -+()", "ab@.-1_ é", "0.1.25", "+0 1-2()", "4 1-@a.+"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
        assert pii.base_spans(text) == by_patterns(text), text
    for long in ("1" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "+1" * 50_000, "@" * 100_000):
        pii.base_spans(long)  # linear: no backtracking


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(documents(spark, SF_SMALL.replace("sf0.001", "sf0.01")))


def test_query_columns(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}
    for r in QUERIES["op4_pii"](spark, SF_SMALL).collect():
        base = by_patterns(texts[r["doc_id"]])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(s[2] == k for s in base) for k in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("call 1 (555) 123-4567 now", ["1 (555) 123-4567"]),
        ("card 4111.1111.1111.1111 ok", ["4111.1111.1111.1111"]),
        ("on 2024-05-06 at 10:30 we paid 12 345 euro", []),
        ("version 1.2.3 of 10, number 1234567890123456", []),
        ("plain words only", []),
    ],
)
def test_model_adds_what_the_patterns_miss(model, text, found):
    base = pii.base_spans(text)
    assert [text[a:b] for a, b, _ in pii.all_spans(text, base, model)] == found


def test_best_segmentation_is_the_best_of_all(model):
    text = "to 12 (212) 555-0199 or x"
    for a, b in pii.regions(text):
        for piece in pii.tokens(text, a, b):
            segments = model.segments(text, piece, [])

            def value(chosen, segments=segments):
                score = {(i, j): max(s) for i, j, _, s in segments}
                return sum(score[c] for c in chosen)

            def every(at, spans):
                yield []
                for n, (i, j) in enumerate(spans):
                    if i >= at:
                        for rest in every(j, spans[n + 1 :]):
                            yield [(i, j), *rest]

            spans = sorted((i, j) for i, j, _, _ in segments)[:14]
            segments = [s for s in segments if (s[0], s[1]) in spans]
            best = max(value(c) for c in every(0, spans))
            assert value([(i, j) for i, j, _ in model.best(len(piece), segments)]) == pytest.approx(max(best, 0))
            assert all(0 <= p <= 1 + 1e-9 for p in model.marginals(len(piece), segments).values())


@pytest.mark.parametrize(("span", "fill"), [("1 (555) 123-4567", "7;"), ("1 (555) 123-4567", "a1"), ("4111.1111.1111.1111", "a1")])
def test_spans_at_any_place_of_a_long_region(model, span, fill):
    for before in range(27, 37):
        for lead in ("", "1 ", "1  ", "1 a "):  # the span's blanks fall on the 96th token and around it
            text = lead + " ".join([fill] * before + [span, ";"] + [fill] * 40)
            assert len(pii.regions(text)) == 1
            assert span in [text[a:b] for a, b, _ in pii.all_spans(text, pii.base_spans(text), model)], text


def test_pieces_are_cut_where_no_candidate_crosses():
    text = "\n".join(f"{i} 12 (212) 555-0199 x\t{i}.5" for i in range(60)) + " 3" * 300
    pieces = pii.tokens(text, 0, len(text))
    assert len(pieces) > 5 and [t for p in pieces for t in p] == [m.span() for m in pii._TOKEN.finditer(text)]
    whole = list(pii.candidates(text, [t for p in pieces for t in p]))
    assert len(whole) == sum(len(list(pii.candidates(text, p))) for p in pieces)


def test_added_equals_best_and_marginals(model):
    rng = random.Random(9)
    parts = ["7", " ", "(212) 555-0199", "4111.1111.1111.1111", "+1 212 555 0199", "a@b.co", "1.2.3.4", "x", ".", "-", "12", " at "]
    several = 0
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))
        base = pii.base_spans(text)
        piece = [m.span() for m in pii._TOKEN.finditer(text)]
        segments = model.segments(text, piece, base)
        sure = model.marginals(len(piece), segments)
        own = {(a, b) for a, b, _ in base}
        want = [(piece[i][0], piece[j - 1][1], k) for i, j, k in model.best(len(piece), segments) if sure[i, j, k] >= pii.SURE]
        want = [s for s in want if s[:2] not in own]
        several += len(want) > 1
        assert model.added(text, piece, pii.Fixed(base)) == want, text
        for i, j in pii.candidates(text, piece):
            a, b = piece[i][0], piece[j - 1][1]
            crosses = any(s < b and a < e and (s, e) != (a, b) for s, e, _ in base)
            assert crosses == (not any((x, y) == (i, j) for x, y, _, _ in segments)), text
    assert several


@pytest.mark.parametrize("at", ["[at]", "[At]", "[aT]", "[AT]", "(at)", "(At)", "(AT)", "[ at ]", "( AT )", "[ At]", "(aT )"])
def test_written_at_signs_in_any_case_and_with_inner_blanks(model, at):
    text = f"write to bob {at} example.org now"
    assert [text[a:b] for a, b in pii.regions(text)] == [f"bob {at} example.org"]
    assert pii.regions(text.replace(at, "at")) == []
    same = text.replace(at, "[at]")
    if len(text) == len(same) and at.startswith("["):  # the case of letters is no feature
        assert pii.all_spans(text, [], model) == pii.all_spans(same, [], model) == [(9, 9 + len(f"bob {at} example.org"), 0)]


def test_redaction_and_awkward_rows(spark, model):
    docs = odd_documents(spark)
    out = pii.redacted(docs, model)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[9] == "mail <EMAIL> or call <PHONE> from <IP>, card <CARD>"
    assert texts[3] is None and texts[4] == "" and texts[6] == LONG
    rows = pii.found_spans(docs, model).collect()
    assert len(rows) == len(ROWS)
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (3, 4, 7))
    empty = docs.limit(0)
    assert pii.found_spans(empty, pii.fit(empty)).count() == 0


def test_training_regions_of_every_kind(spark):
    """A kind that one document in thousands holds is trained on; each kind's number is bounded, for any partitioning."""
    rows = [(f"In {1000 + i} there were {i} of {i * 7} on page {i}.",) for i in range(3000)]
    rows += [(f"call +1 555 010 {1000 + i} now",) for i in range(40)] + [("host 10.0.0.7 is up",)]
    docs = spark.createDataFrame(rows, "text string")

    def drawn(parts, most):
        out = docs.repartition(parts).mapInArrow(partial(pii._region_batches, most), "kind int, mark long, text string, spans string")
        return {k: out.where(F.col("kind") == k).select("mark", "text").distinct().orderBy("mark", "text").limit(pii._most(k, most)).collect() for k in range(5)}

    found = drawn(3, 10)
    assert found == drawn(8, 10)
    assert {k: len(rows) for k, rows in found.items()} == {0: 0, 1: 1, 2: 0, 3: 10, 4: 30}


# --- winnowing ----------------------------------------------------------------

def selected(text, k, w):
    """Brute force: (hash, position) of each window's least hash, rightmost on ties."""
    if not text:
        return set()
    grams = [text[i : i + k] for i in range(max(1, len(text) - k + 1))]
    drop = winnowing.POSITION_BITS
    hashes = []
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode("utf-32-be"), 42)
        hashes.append((h - (1 << 64) if h >> 63 else h) >> drop)
    out = set()
    for a in range(max(1, len(hashes) - w + 1)):
        window = hashes[a : a + w]
        least = min(window)
        out.add((least, a + max(i for i, h in enumerate(window) if h == least)))
    return out


TEXTS = ["", "a", "abcdefgh", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ab" * 700, "x中🙂é" * 400, *(t for _, t, _ in ROWS if t and len(t) < 1000)]


@pytest.mark.parametrize(("k", "w"), [(16, 16), (5, 7), (3, 1)])
def test_selection_equals_brute_force(spark, k, w):
    rng = random.Random(k)
    texts = TEXTS + ["".join(rng.choice("abc ") for _ in range(n)) for n in (15, 16, 17, 31, 32, 527, 528, 1040, 1600)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("s", winnowing.winnow("text", k, w))
    rows = df.select("i", winnowing.positions(F.col("s")).alias("p"), winnowing.hashes(F.col("s")).alias("h")).collect()
    for r in rows:
        want = selected(texts[r["i"]], k, w)
        assert {(p["hash"], p["position"]) for p in r["p"]} == want, r["i"]
        assert set(r["h"]) == {h for h, _ in want}


def check_edited(rows, k=16, w=16):
    """rows: (doc_id, text) in order; the query's columns from brute force."""
    jaccard = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    hashes = lambda t: {h for h, _ in selected(t, k, w)}
    out = []
    for i, (d, text) in enumerate(rows):
        nxt, cut = rows[(i + 1) % len(rows)][1], len(text) // 4
        edited = text[: len(text) - cut] + nxt[:cut]
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(hashes(text), hashes(edited)), jaccard(hashes(text), hashes(nxt))))
    return out


def test_query_equals_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in documents(spark).collect())
    got = QUERIES["op7_winnowing"](spark, SF_SMALL).collect()
    want = {r[0]: r for r in check_edited(docs)}
    for r in got:
        d, n, sha, near_edited, near_next = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert r["near_edited"] == pytest.approx(near_edited) and r["near_next"] == pytest.approx(near_next)
    texts = dict(docs)
    prints = {}
    for r in got:
        assert prints.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    assert len(set(prints.values())) == len(prints)


@pytest.mark.parametrize("bucket", [1, 3, 4096])
def test_next_document_across_buckets_gaps_and_awkward_rows(spark, monkeypatch, bucket):
    monkeypatch.setattr(winnowing, "BUCKET_ROWS", bucket)
    more = [(None, f"another text without an id, number {i}, of its own", "c") for i in range(9)]
    docs = odd_documents(spark, [*ROWS, *more]).withColumn("doc_id", F.col("doc_id") * F.when(F.col("doc_id") > 5, 1000).otherwise(1))
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    mark = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (h >> 63 << 64)
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, mark(r[1]), r[1].encode()))
    got = winnowing.edited_fingerprints(docs, 16, 16).withColumn("sha", F.sha2("edited", 256)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want = sorted(check_edited(rows), key=key)
    have = sorted(((r["doc_id"], r["n_chars"], r["sha"], r["near_edited"], r["near_next"]) for r in got), key=key)
    assert [x[:3] for x in have] == [x[:3] for x in want]
    for x, y in zip(have, want, strict=True):
        assert x[3:] == pytest.approx(y[3:])
    assert winnowing.edited_fingerprints(docs.limit(0), 16, 16).count() == 0
    one = winnowing.edited_fingerprints(docs.where("doc_id = 1"), 16, 16).first()  # its own next
    assert one["near_next"] == 1.0


def test_edited_text_that_ends_with_a_segment(spark):
    rng, rows = random.Random(6), []
    for n in [left + left // 3 for j in (1, 2) for left in (512 * j + 29, 512 * j + 30, 512 * j + 31)] * 20:
        rows += [(len(rows), "".join(rng.choice("abcdefgh ") for _ in range(n))), (len(rows) + 1, rng.choice(["", None]))]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    wrong = 0
    for r in winnowing.edited_fingerprints(df, 16, 16).withColumn("p", winnowing.positions(F.col("edited_selected"))).collect():
        wrong += {(p["hash"], p["position"]) for p in r["p"]} != selected(r["edited"], 16, 16)
    assert wrong == 0


def test_no_python_in_the_plan(spark):
    from starlens.plans.explain import PYTHON_NODES, plan_text

    text = plan_text(QUERIES["op7_winnowing"](spark, SF_SMALL))
    assert not any(n in text for n in PYTHON_NODES)


def test_written_addresses_of_any_length_are_in_a_region():
    import time

    from starlens.llm.pii_semicrf import regions, span_features

    local, domain = "b" * 300, "d" * 400 + ".example.org"
    for at in ("(at)", " [ AT ] ", " (At) "):
        text = f"see {local}{at}{domain} now"
        start = text.index(local)
        assert any(a <= start and start + len(local + at + domain) <= b for a, b in regions(text))
    assert regions("(at) x (at)") == regions("a ( at") == []
    began = time.time()
    regions("w" * 300_000 + " (at " + "(at)" * 50_000)
    assert time.time() - began < 10
    # features take the whole span
    long = "1-2(3)4.5/6:7;8,9|0" * 4
    assert span_features(long + "-1", "", "") != span_features(long + "(1", "", "")
