"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

``MEASURES`` are SQL expressions over one text; a ``Rule`` bounds the ratio of two
of them, in hundredths, so that it compares whole numbers exactly. ``judged``
compiles the table into a single projection: all measures as a struct, the names of
the rules a text fails, and the verdict. Adding a rule is adding a row to the table.

Words are maximal runs of characters other than blank and U+0009 to U+000D; lines
end at line feeds. A repeated window is one of 8 words found twice or more in the
text; its words count once however many such windows hold them. Windows are first
compared by hash, and only texts in which a hash repeats compare the windows
themselves, in sorted order, so the count is exact and takes n log n time.

Defined results: a null text counts as empty; an empty text has all measures zero
and fails the length rule; ratios with a zero denominator fail no rule; very long
texts are measured whole (arrays of their words and windows are the largest
things held, per row); texts that are equal get equal results; repeated rows and
null ids get a row each; an empty table gives an empty result; other columns
pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import free_name

#: Words of a repeated window, a power of two.
WINDOW = 8
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = {
    "en": "a an and are as at be by for from has he in is it its of on or that the this to was were will with not but they you we his her which",
    "de": "der die das und ist im in von zu den mit ein eine einer nicht für auf dem des als auch es sich werden",
    "fr": "le la les de des du et en un une est que qui dans pour pas sur avec ce il elle au par plus",
    "es": "el la los las de del que y en un una es para por con no se su al como más lo",
}


@dataclass(frozen=True)
class Rule:
    """A text fails when 100 * ``part`` / ``whole`` is below ``least`` or above ``most``; without ``whole``, ``part`` itself is bounded."""

    name: str
    part: str
    whole: str | None = None
    least: int | None = None
    most: int | None = None
    #: Rules of the contract's base, besides the method's own.
    base: bool = False


#: The threshold table.
RULES = (
    Rule("too_short", "n_words", least=20, base=True),
    Rule("repeated_words", "n_repeat_words", "n_words", most=30, base=True),
    Rule("word_length", "word_chars", "n_words", least=200, most=1200),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("shouting", "n_marks", "n_words", most=50),
    Rule("stop_words", "n_stop_words", "n_words", least=3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=50),
)

# Blank and U+0009 to U+000D, each written as a Spark SQL escape.
_SPACES = r"' \t\n\u000B\u000C\r'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "\\'") + "'" for w in words)


def _repeated(words: str) -> str:
    """Words covered by windows that occur twice or more: each covers WINDOW words from its start, less what the next one covers."""
    covered = f"aggregate(transform(starts, (p, i) -> least({WINDOW}, coalesce(get(starts, i + 1) - p, {WINDOW}))), 0, (n, x) -> n + x)"
    starts = "array_sort(transform(filter(sorted, (x, i) -> x.t <=> get(sorted, i - 1).t OR x.t <=> get(sorted, i + 1).t), x -> x.p))"
    places = f"sequence(1, size({words}) - {WINDOW - 1})"
    windows = f"array_sort(transform({places}, p -> named_struct('t', array_join(slice({words}, p, {WINDOW}), ' '), 'p', p)))"
    exact = _let("sorted", windows, _let("starts", starts, covered))
    # hashes of 1, 2, 4 and 8 neighbouring words, each from two of the ones before
    hashes = f"transform({words}, w -> xxhash64(w))"
    step = 1
    while step < WINDOW:
        later = f"slice(h, {step + 1}, size(h) - {step})"
        hashes = _let("h", hashes, f"slice(zip_with(h, {later}, (x, y) -> xxhash64(x, y)), 1, size(h) - {step})")
        step *= 2
    found = _let("hashes", hashes, f"CASE WHEN size(array_distinct(hashes)) = size(hashes) THEN 0 ELSE {exact} END")
    return f"CASE WHEN size({words}) <= {WINDOW} THEN 0 ELSE {found} END"


def _measures(text: str, stop_words) -> str:
    """SQL of the struct of all measures of ``text``, a bound name that is never null."""
    by_word = {
        "n_words": "size(words)",
        "word_chars": "length(array_join(words, ''))",
        "n_stop_words": f"size(filter(words, w -> trim(TRAILING '.,;:!?' FROM lower(w)) IN ({_quoted(stop_words)})))",
        "n_repeat_words": _repeated("words"),
    }
    by_text = {
        "n_symbols": f"regexp_count({text}, '[#*$%&|<>]')",
        "n_marks": f"regexp_count({text}, '[!?]')",
    }
    by_line = {"n_lines": "size(lines)", "n_dup_lines": "size(lines) - size(array_distinct(lines))"}

    def struct(values: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(f"'{k}', CAST({v} AS BIGINT)" for k, v in values.items()) + ")"

    words = _let("words", f"array_remove(split({text}, '[ \\t-\\r]+'), '')", struct(by_word))
    lines = _let("lines", f"filter(split({text}, '\\n'), l -> trim(BOTH {_SPACES} FROM l) <> '')", struct(by_line))
    parts = (("by_word", by_word, words), ("by_text", by_text, struct(by_text)), ("by_line", by_line, lines))
    body = "named_struct(" + ", ".join(f"'{k}', {part}.{k}" for part, names, _ in parts for k in names) + ")"
    for part, _, value in parts:
        body = _let(part, value, body)
    return body


def measures(text: str = "text", stop_words=None) -> str:
    """SQL of a struct of all measures of a text expression; a null text counts as empty."""
    chosen = sorted({w for group in STOP_WORDS.values() for w in group.split()} if stop_words is None else stop_words)
    return _let("whole", f"coalesce({text}, '')", _measures("whole", chosen))


def _fails(rule: Rule, m: str) -> str:
    """SQL: whether the measures in struct ``m`` break the rule."""
    part, whole = f"{m}.{rule.part}", f"{m}.{rule.whole}" if rule.whole else "1"
    scale = 100 if rule.whole else 1
    bounds = [f"{scale} * {part} < {rule.least} * {whole}"] if rule.least is not None else []
    bounds += [f"{scale} * {part} > {rule.most} * {whole}"] if rule.most is not None else []
    return " OR ".join(bounds)


def compiled(text: str = "text", rules=RULES, stop_words=None) -> Column:
    """The table as one expression: struct(measures, failed: names of the rules not met, base_failed, kept)."""
    names = ", ".join(f"CASE WHEN {_fails(r, 'm')} THEN '{r.name}' END" for r in rules)
    base = " OR ".join(f"array_contains(failed, '{r.name}')" for r in rules if r.base) or "false"
    verdict = f"named_struct('measures', m, 'failed', failed, 'base_failed', {base}, 'kept', size(failed) = 0)"
    failed = f"array_compact(array({names}))" if names else "array()"
    return F.expr(_let("m", measures(text, stop_words), _let("failed", failed, verdict)))


def judged(docs: DataFrame, text: str = "text", rules=RULES, stop_words=None, into: str = "quality_rules") -> DataFrame:
    """``docs`` with one more column, the compiled table's struct; its name is ``into``, lengthened while taken."""
    return docs.select("*", compiled(f"`{text}`", rules, stop_words).alias(free_name(docs, into)))
