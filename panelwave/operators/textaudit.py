"""Claim phrases that are not negated, and pattern counts, over whole texts."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwave.operators.shape import rows_from, struct

# Phrases that claim cause or national reach, words that negate
# them, context widths, and hygiene patterns.
CLAIM_PATTERNS = (
    r"\bcausa(n)?\b",
    r"\bprovoca(n)?\b",
    r"\bocasiona(n)?\b",
    r"\befecto causal\b",
    r"\ba nivel nacional\b",
    r"\btodo el pa[ií]s\b",
    r"\btoda guatemala\b",
    r"\bpoblaci[oó]n guatemalteca\b",
    r"\blos guatemaltecos\b",
    r"\brepresentativ[oa]s? de guatemala\b",
)
NEGATORS = ("no", "ni", "sin")
CONTEXT_BEFORE = 60
CONTEXT_AFTER = 20
HYGIENE_RULES = {
    "absolute_path": r"(?i)(?<![\w/])[a-z]:[\\/](?=\w)|/Users/|/home/|/opt/app|/tmp/",
    "pending_marker": r"\b(PENDIENTE|Pendiente|pendiente|TODO|TBD|FIXME|Interprete|Use esta tabla)\b",
    "synthetic": r"(?i)sint[eé]tic",
}

# Word classes and case rules follow Unicode, as the patterns expect.
CASELESS = "(?iuU)"
UNICODE = "(?U)"


# Characters outside ASCII that a caseless pattern takes for an ASCII letter.
FOLDED = (("\u0130", "i"), ("\u0131", "i"), ("\u017f", "s"), ("\u212a", "k"))


def folded(text: str) -> str:
    """Lower case, of the same length, in which every ASCII letter that a caseless pattern sees is that letter."""
    for char, letter in FOLDED:
        text = text.replace(char, letter)
    return text.lower()


def literal_start(pattern: str) -> str:
    """The folded plain text with which every match begins; empty where the pattern does not show one."""
    # Alternatives outside groups begin in different ways.
    rest, before = re.sub(r"\\.|\[[^\]]*\]", "", pattern), None
    while rest != before:
        rest, before = re.sub(r"\([^()]*\)", "", rest), rest
    plain = re.match(r"(?:\\b)?([A-Za-z0-9 ]+)", pattern)
    if "|" in rest or not plain:
        return ""
    optional = pattern[plain.end() : plain.end() + 1] in ("?", "*", "{")
    return folded(plain[1][:-1] if optional else plain[1])


class Phrases:
    """All matches of many caseless patterns: one automaton finds where any may begin, each pattern is tried only there.

    A pattern without a literal start is searched through the whole text.
    """

    def __init__(self, patterns: Sequence[str]):
        import ahocorasick

        self.patterns = [(p, re.compile(p, re.IGNORECASE)) for p in patterns]
        starts: dict[str, list[int]] = {}
        for i, p in enumerate(patterns):
            starts.setdefault(literal_start(p), []).append(i)
        self.anywhere = starts.pop("", [])
        self.automaton = ahocorasick.Automaton()
        for start, at in starts.items():
            self.automaton.add_word(start, (len(start), at))
        if starts:
            self.automaton.make_automaton()
        self.any = bool(starts)

    def matches(self, text: str) -> Iterator[tuple[str, re.Match]]:
        """Of every pattern the leftmost matches that do not overlap."""
        for i in self.anywhere:
            name, phrase = self.patterns[i]
            yield from ((name, m) for m in phrase.finditer(text))
        if not self.any:
            return
        free: dict[int, int] = {}
        for last, (length, at) in self.automaton.iter(folded(text)):
            begin = last + 1 - length
            for i in at:
                if begin >= free.get(i, 0):
                    name, phrase = self.patterns[i]
                    m = phrase.match(text, begin)
                    if m:
                        free[i] = m.end()
                        yield name, m


def claims(
    df: DataFrame,
    key: str,
    text: str,
    patterns: Sequence[str] = CLAIM_PATTERNS,
    negators: Sequence[str] = NEGATORS,
    before: int = CONTEXT_BEFORE,
    after: int = CONTEXT_AFTER,
) -> DataFrame:
    """``(key, pattern, start, phrase, context)`` of every claim that is not negated.

    ``negators`` are plain words. A claim is negated if one stands between the last ``.``, ``;`` or line
    end and the claim. Texts go through one Arrow scan, because a claim's sentence is a running state
    that column expressions can only carry by copying it. One automaton finds the phrases, however many there are.
    Texts that hold one have their sentence ends and negators placed once, looked up by bisection, so a text with
    many claims costs little more than its length. NULL texts claim nothing.
    """
    negator = re.compile(rf"\b(?:{'|'.join(negators)})\b", re.IGNORECASE)
    sentence_end = re.compile(r"[.;\n]")
    longest = max(map(len, negators), default=0)
    at_once = 50_000
    names = [key, "pattern", "start", "phrase", "context"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(patterns)
        kind = None
        for batch in batches:
            kind, rows = batch.schema.types[0], []
            for name, cell in zip(batch.column(0), batch.column(1), strict=True):
                body, ends = cell.as_py(), None
                for pattern, m in phrases.matches(body):
                    if ends is None:
                        ends = [e.end() for e in sentence_end.finditer(body)]
                        denials = [d.span() for d in negator.finditer(body)]
                        begins = [b for b, _ in denials]
                    sentence = bisect_right(ends, m.start())
                    begin = ends[sentence - 1] if sentence else 0
                    first = bisect_left(begins, begin)
                    if first < len(denials) and denials[first][1] <= m.start():
                        continue
                    # A phrase may begin inside a word, right after the letters of a negator.
                    if negator.search(body, max(begin, m.start() - longest), m.start()):
                        continue
                    context = body[max(0, m.start() - before) : m.end() + after].replace("\n", " ")
                    rows.append((name.as_py(), pattern, m.start(), m[0], context))
                    if len(rows) == at_once:
                        yield table(kind, rows)
                        rows = []
            yield table(kind, rows)

    def table(kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        kinds = [kind, pa.string(), pa.int32(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    fields = f"`{key}` {df.schema[key].dataType.simpleString()}, pattern string, start int, phrase string, context string"
    return df.where(F.col(text).isNotNull()).select(key, text).mapInArrow(scan, fields)


def pattern_counts(df: DataFrame, key: str, text: str, rules: Mapping[str, str] = HYGIENE_RULES) -> DataFrame:
    """Hits of every rule per text, as ``(key, rule, hits)``."""
    cells = [struct(rule=name, hits=F.regexp_count(F.col(text), F.lit(UNICODE + rx))) for name, rx in rules.items()]
    return rows_from(df, [key], cells)
