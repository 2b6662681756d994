"""Ordered quality gates: metric columns once, then a verdict and its reason."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_any

# Patterns and thresholds that must be as they are for equal verdicts.
SPECIFIC = r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\b|\$[\d,.]+[BMK]?|\d+\.?\d*\s*%|\d+\.?\d*[BMK]\b|\d{4}\b"
UNITS = r"|\d+\.?\d*\s*(?:GB|TB|MB|VRAM|tok/s|tokens?|params?|layers?|heads?)"
STRUCTURE = r"(?:^|\n)(?:#{1,3}\s|(?:\d+\.|\*|\-)\s)"
FIRST_LENGTHS = {"briefing": 600, "trends": 1000, "company": 600, "culture": 500, "market": 500, "journal": 1500}
FIRST_SPECIFICS = {"briefing": 10, "trends": 8, "company": 6, "culture": 4, "market": 8, "journal": 15}
SECOND_LENGTHS = {"infra": 800, "industry": 600, "curation": 800, "sovereign": 600, "culture": 500}
SECOND_SPECIFICS = {"infra": 12, "industry": 10, "curation": 10, "sovereign": 8, "culture": 6}
# End of fixed values.

#: Default vocabularies; parameters, to be replaced by those of a deployment.
BANNED = ("boundless synergy", "quantum leap forward", "seamlessly empower", "next[- ]level value")
GENERIC = ("now more than ever", "let us explore", "in the world of today")


@dataclass(frozen=True)
class GateProfile:
    """Thresholds of one gate; ``None`` switches a check off."""

    lengths: Mapping[str, int]
    length: int
    specifics: Mapping[str, int]
    specific: int
    banned_most: int
    structure: int
    generic_most: int | None = None
    structured: Sequence[str] | None = None  #: categories that need structure; all if None
    pattern: str = SPECIFIC
    banned: Sequence[str] = BANNED
    generic: Sequence[str] = GENERIC
    degenerate: bool = True


FIRST = GateProfile(FIRST_LENGTHS, 500, FIRST_SPECIFICS, 5, banned_most=2, structure=3, structured=("briefing", "journal"))
SECOND = GateProfile(SECOND_LENGTHS, 600, SECOND_SPECIFICS, 8, banned_most=1, structure=2, generic_most=0, pattern=SPECIFIC + UNITS)


def lookup(values: Mapping[str, int], key: Column, default: int) -> Column:
    """A small fixed table as an expression, with a default for other keys."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(default)).cast("long")


def specifics(text: Column, pattern: str = SPECIFIC) -> Column:
    return F.regexp_count(text, F.lit("(?mU)" + pattern)).cast("long")


def structure(text: Column) -> Column:
    return F.regexp_count(text, F.lit("(?U)" + STRUCTURE)).cast("long")


def has_headers(text: Column, headers: Sequence[str]) -> Column:
    out = F.lit(True)
    for header in headers:
        out = out & F.contains(text, F.lit(header))
    return out


# Degeneration: a unit of at least 40 characters, three times in a row in one line.

UNIT, TIMES = 40, 3


def _windows(code: np.ndarray, n: int) -> np.ndarray:
    """A hash of each window of n characters, by doubling."""
    base = 0x9E3779B97F4A7C15
    power, size, h = base, 1, _spread(code)
    total: np.ndarray | None = None
    covered = 0
    while n:
        if n & 1:
            part = h[covered:] if total is not None else h
            if total is None:
                total, covered = part, size
            else:
                m = min(len(total), len(part))
                total = total[:m] * np.uint64(power) + part[:m]
                covered += size
        n >>= 1
        if n:
            m = len(h) - size
            if m <= 0:
                return np.zeros(0, np.uint64)
            h = h[:m] * np.uint64(power) + h[size:]
            power = power * power % (1 << 64)
            size *= 2
    return total if total is not None else h


def _spread(code: np.ndarray) -> np.ndarray:
    h = code.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def degenerate_line(line: str) -> bool:
    """Whether ``UNIT`` or more characters repeat ``TIMES`` times without a gap.

    Such a stretch has a smallest period d, and a window of d characters or more recurs
    in it after d characters, no sooner. So for windows of 40, 80, 160, ... characters,
    the distance to the next equal window gives every period that a window covers, and
    positions in a row with one distance give the stretch's length: a sort for each
    window size, in place of a comparison for each period.
    """
    n = len(line)
    if n < UNIT * TIMES:
        return False
    code = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")
    size = UNIT
    while size < n:
        h = _windows(code, size)
        order = np.argsort(h, kind="stable")
        equal = np.flatnonzero(h[order[1:]] == h[order[:-1]])
        if not len(equal):
            return False
        after = np.zeros(len(h), np.int64)
        after[order[equal]] = order[equal + 1] - order[equal]
        starts = np.flatnonzero(np.diff(after, prepend=-1))
        lag, row = after[starts], np.diff(starts, append=len(after))
        unit = lag * -(-UNIT // np.maximum(lag, 1))
        if ((lag > 0) & (lag <= size) & (row + size - 1 + lag >= TIMES * unit)).any():
            return True
        size *= 2
    return False


def _recurring(texts: list[str]) -> list[list[str]]:
    """Lines of each text in which a window of ``UNIT`` characters occurs twice, the
    first time at a place that ``UNIT`` divides; no other line can be degenerate, as of
    ``UNIT`` places in a row one is such, and its window comes again a unit later.

    All texts are hashed at once. The windows at those places mark a table, and only
    windows that meet a mark are sorted.
    """
    joined = "\n".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(code) < UNIT * TIMES:
        return [[] for _ in texts]
    breaks = np.flatnonzero(code == 10)
    line = np.cumsum(code == 10)  # a break counts to the line that follows
    whole = line[: len(code) - UNIT + 1] == line[UNIT - 1 :]
    whole &= code[: len(whole)] != 10
    h = _windows(code, UNIT) + _spread(line[: len(whole)] + 1)  # equal windows of two lines differ
    key = h * np.uint64(0x9E3779B97F4A7C15)
    anchors = np.arange(0, len(whole), UNIT)
    bits = max(int(64 * len(anchors)).bit_length(), 8)
    key >>= np.uint64(64 - bits)
    marked = np.zeros(1 << bits, bool)
    marked[key[anchors[whole[anchors]]]] = True
    met = np.flatnonzero(marked[key] & whole)
    met = met[np.argsort(h[met], kind="stable")]
    twice = np.unique(line[met[1:][h[met[1:]] == h[met[:-1]]]])
    out: list[list[str]] = [[] for _ in texts]
    firsts = np.cumsum([0] + [t.count("\n") + 1 for t in texts])  # each text's first line
    for n in twice:
        begin, end = (breaks[n - 1] + 1 if n else 0), (breaks[n] if n < len(breaks) else len(code))
        out[int(np.searchsorted(firsts, n, "right")) - 1].append(joined[begin:end])
    return out


#: Characters that are hashed at once; a longer text goes alone.
AT_ONCE = 1 << 20


def degenerate_texts(texts: Sequence[str | None]) -> list[bool]:
    out: list[bool] = []
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= AT_ONCE or i + 1 == len(texts):
            part = [t or "" for t in texts[begin : i + 1]]
            out += [any(map(degenerate_line, lines)) for lines in _recurring(part)]
            begin, size = i + 1, 0
    return out


def _degenerate(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(degenerate_texts(batch.astype(object).where(batch.notna(), None).tolist()), dtype=bool)


def degenerate(text: Column) -> Column:
    """An Arrow UDF: a regular expression with a back-reference takes the square of
    a line's length, this one a hash of every place and sorts of the few that recur."""
    return F.pandas_udf(_degenerate, "boolean")(F.when(F.length(text) >= UNIT * TIMES, text))


def measures(text: Column, category: Column, profile: GateProfile) -> dict[str, Column]:
    """The counts a verdict needs, by name; a null text counts as empty. The degeneration
    test only sees texts that pass the length check."""
    text = F.coalesce(text, F.lit(""))
    least = lookup(profile.lengths, category, profile.length)
    long_enough = F.length(text) >= least
    return {
        "n_chars_": F.length(text).cast("long"),
        "need_chars": least,
        "n_banned": count_any(text, profile.banned),
        "n_generic": count_any(text, profile.generic) if profile.generic_most is not None else F.lit(0).cast("long"),
        "n_specifics": specifics(text, profile.pattern),
        "need_specifics": lookup(profile.specifics, category, profile.specific),
        "n_structure": structure(text),
        "needs_structure": F.lit(True) if profile.structured is None else category.isin(*profile.structured),
        "is_degenerate": F.coalesce(degenerate(F.when(long_enough, text)), F.lit(False)) if profile.degenerate else F.lit(False),
    }


def _reason(of: Mapping[str, Column], profile: GateProfile) -> Column:
    """``pass`` or the first failing check, in the gate's order."""
    said = lambda name, n, need=None: F.concat(F.lit(f"{name}_"), of[n].cast("string"), *([F.lit("/"), of[need].cast("string")] if need else []))
    out = F.when(of["n_chars_"] < of["need_chars"], said("too_short", "n_chars_", "need_chars"))
    out = out.when(of["is_degenerate"], F.lit("degenerate"))
    out = out.when(of["n_banned"] > profile.banned_most, said("corporate_speak", "n_banned"))
    if profile.generic_most is not None:
        out = out.when(of["n_generic"] > profile.generic_most, said("generic_blog", "n_generic"))
    out = out.when(of["n_specifics"] < of["need_specifics"], said("vague", "n_specifics", "need_specifics"))
    out = out.when(of["needs_structure"] & (of["n_structure"] < profile.structure), said("no_structure", "n_structure"))
    return out.otherwise(F.lit("pass"))


def gated(df: DataFrame, text: Column, category: Column, profile: GateProfile) -> DataFrame:
    """``df`` with passed and reason. Each count is a column of its own, computed once and
    only for rows that no earlier check has rejected."""
    counts = measures(text, category, profile)
    late = ["n_banned", "n_generic", "n_specifics", "n_structure"]
    measured = df.withColumns({name: count for name, count in counts.items() if name not in late})
    left = (F.col("n_chars_") >= F.col("need_chars")) & ~F.col("is_degenerate")
    holds = [
        F.col("n_banned") <= profile.banned_most, F.col("n_generic") <= (profile.generic_most or 0), F.col("n_specifics") >= F.col("need_specifics"),
    ]
    for name, passed in zip(late, [*holds, None]):
        if name == "n_generic" and profile.generic_most is None:
            continue
        wanted = left & F.col("needs_structure") if name == "n_structure" else left
        measured = measured.withColumn(name, F.when(wanted, counts[name]))
        left = passed  # null, and so no, where the count wasn't made
    counts = {name: F.col(name) for name in counts if name in measured.columns}
    measured = measured.withColumn("reason", _reason(counts, profile))
    return measured.select(*df.columns, (F.col("reason") == "pass").alias("passed"), "reason")


def passing(text: Column, category: Column, profile: GateProfile) -> Column:
    """Whether a text passes, as one expression."""
    return _reason(measures(text, category, profile), profile) == "pass"


@dataclass(frozen=True)
class HeaderGate:
    """A format's minimum length and the headers its text must hold."""

    least: int
    headers: Sequence[str] = field(default_factory=tuple)

    def passes(self, text: Column) -> Column:
        return (F.length(text) >= self.least) & has_headers(text, self.headers)


# The headers each structured format must show.
HEADER_GATES = {
    "SIGNAL_EXTRACTION": HeaderGate(300, ("SIGNAL:", "WHY IT MATTERS:", "DATA OPPORTUNITY:", "CURATION SCORE:")),
    "GAP_DETECTION": HeaderGate(500, ("CURRENT CAPABILITIES:", "KNOWN WEAKNESSES:", "DATA GAP:", "CURATION OBJECT:")),
    "TREND_SYNTHESIS": HeaderGate(800, ("NAME:", "DESCRIPTION:", "WHY NOW:", "TARGET PAIRS:", "EXPECTED MODEL IMPACT:")),
}
# End of fixed values.


def header_verdict(text: Column, kind: Column, gates: Mapping[str, HeaderGate] | None = None) -> Column:
    """Whether a text passes its format's gate; other formats need no headers."""
    out = None
    for name, gate in (gates or HEADER_GATES).items():
        out = F.when(kind == name, gate.passes(text)) if out is None else out.when(kind == name, gate.passes(text))
    return out.otherwise(F.lit(True))


def draft_accepted(text: Column, min_len: Column) -> Column:
    """More characters than half the format's minimum."""
    return F.length(text) > F.floor(min_len / 2)
