"""Scenario prompts: branch rows filled from pools, as many as wanted, by hash.

A branch is a row of a template table; a scenario's number picks the branch in turn and,
with the seed, every choice. So any scenario can be made alone, on any executor, and is
the same each time. Wording and pools are data: pass other branches, pools or formats.

Slots of a template, pools by name:

    {a}        one of the pool                {a:3}     three of it, after each other
    {a+b}      one of both pools              {a*3}     three of it, a line for each
    {a=b*3}    three of either, side by side, a line for each pair (the shorter one counts)
    {1..28}    a whole number                 {outline} the outline of the chosen format
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .split import round_robin, seeded

# Formats, the least characters of a text and the most tokens to ask for.
FORMAT_LIMITS = {
    "TREND_ANALYSIS": (1000, 3072),
    "BRIEFING": (600, 2048),
    "MARKET_BRIEF": (500, 1536),
    "COMPANY_PROFILE": (600, 2048),
    "DEEP_DIVE": (1200, 4096),
    "CULTURE_REPORT": (500, 1536),
    "JOURNAL": (1500, 4096),
    "SIGNAL_EXTRACTION": (300, 1536),
    "GAP_DETECTION": (500, 2048),
    "TREND_SYNTHESIS": (800, 2560),
}
# End of fixed values.

#: What a format asks for, from its purpose; the structured ones name the headers of their gate.
OUTLINES = {
    "TREND_ANALYSIS": "Form: state the change, date its start, show who gains and loses, say what would prove you wrong.",
    "BRIEFING": "Form: numbered items, each a fact with its source and one line on its use; end with what to check tomorrow.",
    "MARKET_BRIEF": "Form: a table of sums and parties, then one paragraph on the price of being wrong.",
    "COMPANY_PROFILE": "Form: product, customer, cost, dependence on others, next twelve months.",
    "DEEP_DIVE": "Form: a worked example first, the general rule after it, figures with units, known failures.",
    "CULTURE_REPORT": "Form: three voices in their own words, what they agree on, what none of them says.",
    "JOURNAL": "Form: entries by day, links between them, one mistake of the week owned up to.",
    "SIGNAL_EXTRACTION": "Answer under SIGNAL:, WHY IT MATTERS:, DATA OPPORTUNITY:, CURATION SCORE:",
    "GAP_DETECTION": "Answer under CURRENT CAPABILITIES:, KNOWN WEAKNESSES:, DATA GAP:, CURATION OBJECT:",
    "TREND_SYNTHESIS": "Answer under NAME:, DESCRIPTION:, WHY NOW:, TARGET PAIRS:, EXPECTED MODEL IMPACT:",
}


def crossed(*parts: Sequence[str], form: str = "{} {}") -> tuple[str, ...]:
    """Every combination of the parts, in order."""
    return tuple(form.format(*words) for words in product(*parts))


_FIRMS = ("Alderney", "Basalt", "Corvid", "Dunlin", "Estuary", "Fallow")
#: Own pools, most of them made from a few words.
POOLS: dict[str, tuple[str, ...]] = {
    "months": tuple("January February March April May June July August September October November December".split()),
    "days": tuple("Monday Tuesday Wednesday Thursday Friday".split()),
    "cities": ("Accra", "Bergen", "Cork", "Dakar", "Essen", "Fukuoka"),
    "firms": crossed(_FIRMS, ("Compute", "Instruments", "Robotics", "Speech", "Studio")),
    "events": crossed(("opens", "doubles", "sells", "delays", "prices"), ("its plant", "its model line", "its service", "its licence")),
    "deals": crossed(("raises", "lends", "buys for", "writes off"), ("8 million", "45 million", "210 million", "1.2 billion")),
    "domains": crossed(("speech", "vision", "planning", "search", "coding", "forecasting"), ("for clinics", "for farms", "for courts", "for ports")),
    "themes": crossed(("smaller", "slower", "cheaper", "open", "local"), ("models", "clusters", "benchmarks", "interfaces")),
    "moods": crossed(("tired of", "proud of", "uneasy about", "waiting for"), ("demos", "layoffs", "agents", "paper deadlines")),
    "machines": crossed(("one card", "four cards", "a rack", "a borrowed cluster"), ("with 24 GB each", "with 80 GB each", "without fast links")),
    "releases": crossed(_FIRMS, ("3B", "9B", "70B"), ("base", "chat"), form="{}-{}-{}"),
    "architectures": crossed(("sparse", "linear", "sliding", "looped"), ("attention", "experts", "memory")),
    "methods": crossed(("low-rank", "full", "staged", "preference"), ("tuning", "distillation", "merging")),
    "serving": crossed(("paged", "batched", "quantised", "split"), ("decoding", "prefill", "caching")),
    "measures": crossed(("long-context", "arithmetic", "tool", "factual"), ("recall", "agreement", "error rates")),
    "policies": crossed(("export", "copyright", "energy", "procurement"), ("rules", "rulings", "drafts")),
    "investors": crossed(("public", "pension", "family", "chip-maker"), ("funds", "loans", "stakes")),
    "datasets": crossed(("court", "sensor", "dialect", "repair", "lab"), ("logs", "archives", "transcripts")),
    "cleaning": crossed(("duplicate", "toxic", "leaked", "stale"), ("passages", "labels", "pages")),
    "sharing": crossed(("national", "campus", "household", "hospital"), ("servers", "weights", "keys")),
    "makers": crossed(("a baker", "two nurses", "a night shift", "a school club"), ("who built a search tool", "who tuned a model", "who label at home")),
    "debates": crossed(("credit for", "consent to", "pay for", "access to"), ("training text", "voices", "compute")),
    "signals": crossed(("a rise in", "a ban on", "a fork of", "a shortage of"), crossed(("agent", "speech", "code", "map"), ("traces", "weights"))),
    "gaps": crossed(("reading", "counting", "citing", "refusing", "translating"), ("tables", "contracts", "old law", "dialects")),
    "contexts": crossed(("With budgets flat,", "After the outage,", "Before the new rules,"), ("teams hoard", "firms rent", "labs share", "schools ask for", "ports buy"), ("small models",), form="{} {} {}"),
}


@dataclass(frozen=True)
class Branch:
    """One way to ask: its set and category, its turn, the formats to choose from."""

    family: str
    category: str
    sub: int
    formats: tuple[str, ...]
    template: str


#: Own branches, as rows: set, category, the formats to choose from, what is asked. A
#: category's branches take turns in the order of their rows. One for each category of the
#: daily set, several of the themed set, one for each kind of the cascade.
_ROWS: tuple[tuple[str, str, tuple[str, ...], str], ...] = (
    ("daily", "briefing", ("BRIEFING",), "Brief us for {days}, {months} {1..28}.\n\nSeeds:\n{firms=events*3}\n{themes*2}\n{domains*2}"),
    ("daily", "trends", ("TREND_ANALYSIS",), "Where are {themes} heading in {cities}?\n\nSeen in: {domains:2}"),
    ("daily", "company", ("COMPANY_PROFILE",), "Profile {firms}, which {events}.\n\nRivals: {firms:2}\nField: {domains}"),
    ("daily", "culture", ("CULTURE_REPORT",), "People are {moods}. Report from {cities}.\n\nIn the air: {themes:2}"),
    ("daily", "market", ("MARKET_BRIEF",), "Read the week's money.\n\nDeals:\n{firms=deals*3}\n\nMachines: {machines}"),
    ("daily", "journal", ("JOURNAL",), "Journal of week {1..4} of {months}.\n\nWeek:\n{firms=events*3}\n{themes*2}\n\nTalk: {moods:2}"),
    ("themed", "infra", ("DEEP_DIVE",), "A port town of {cities} wants {serving}. What must it buy?\n\nOffered: {machines:3}"),
    ("themed", "infra", ("BRIEFING", "DEEP_DIVE"), "List what broke when {policies} met {serving}.\n\nReported by: {firms:2}"),
    ("themed", "infra", ("MARKET_BRIEF",), "Rent or own {machines} for a year of {methods}?\n\nLenders: {investors:2}"),
    ("themed", "infra", ("TREND_ANALYSIS",), "Will {architectures} outlive {architectures}?\n\nTried in: {domains:2}"),
    ("themed", "infra", ("DEEP_DIVE", "JOURNAL"), "Keep a log of moving {releases} to {machines}."),
    ("themed", "infra", ("CULTURE_REPORT",), "Operators on call are {moods}. Hear them out.\n\nOn call for: {serving}"),
    ("themed", "infra", ("BRIEFING",), "Three outages in {cities}, one cause?\n\nRunning: {releases:3}"),
    ("themed", "infra", ("COMPANY_PROFILE", "DEEP_DIVE"), "{firms} sells {serving}. Take it apart.\n\nClaims: {measures:2}"),
    ("themed", "industry", ("BRIEFING",), "What will {domains} buy next spring?\n\nSellers:\n{firms=events*2}"),
    ("themed", "industry", ("COMPANY_PROFILE",), "{firms} and {firms} share a floor in {cities}. Who needs whom?"),
    ("themed", "industry", ("TREND_ANALYSIS", "BRIEFING"), "Count the jobs that {themes} change.\n\nWhere: {domains:3}"),
    ("themed", "industry", ("DEEP_DIVE",), "Follow one invoice for {machines} from order to scrap."),
    ("themed", "industry", ("MARKET_BRIEF", "JOURNAL"), "A quarter in figures.\n\n{firms=deals*5}\n\nUnder: {policies}"),
    ("themed", "industry", ("COMPANY_PROFILE", "MARKET_BRIEF"), "Would you lend to {firms}? It {events}.\n\nAlso asked: {investors}"),
    ("themed", "industry", ("CULTURE_REPORT",), "A trade fair in {cities}: everyone is {moods}.\n\nStands: {firms:4}"),
    ("themed", "curation", ("GAP_DETECTION",), "A reader fails at {gaps}. What should it have read?\n\nOn the shelf: {datasets:2}"),
    ("themed", "curation", ("BRIEFING",), "Write the handover note for {datasets}.\n\nStill open: {cleaning:2}"),
    ("themed", "curation", ("SIGNAL_EXTRACTION",), "Is there anything in {signals}, or is it noise?"),
    ("themed", "curation", ("DEEP_DIVE",), "Find {cleaning} without reading everything.\n\nSizes: {1..900} million rows of {datasets}"),
    ("themed", "curation", ("TREND_SYNTHESIS",), "{contexts} Which {datasets} should be gathered first?"),
    ("themed", "curation", ("JOURNAL", "CULTURE_REPORT"), "A week of labelling {datasets} with {makers}."),
    # The first branch has three of six turns.
    *(("themed", "sovereign", ("BRIEFING", "COMPANY_PROFILE"), "Who holds the keys to {sharing} in {cities}?\n\nWritten down in: {policies:2}"),) * 3,
    ("themed", "sovereign", ("MARKET_BRIEF",), "Cost out {sharing} for {1..40} schools."),
    ("themed", "sovereign", ("CULTURE_REPORT",), "Neighbours argue about {sharing}. Write it down.\n\nTheir quarrel: {debates}"),
    ("themed", "sovereign", ("DEEP_DIVE", "TREND_ANALYSIS"), "Can {releases} run on {machines} when the line is cut?"),
    ("themed", "culture", ("CULTURE_REPORT",), "Dinner with {makers}, who are {moods}."),
    ("themed", "culture", ("TREND_ANALYSIS",), "How did {debates} become a subject in {cities}?"),
    ("themed", "culture", ("JOURNAL",), "Diary of {makers} in {months}.\n\nAt hand: {datasets+sharing}"),
    ("themed", "culture", ("BRIEFING", "CULTURE_REPORT"), "Five letters to the editor on {debates}.\n\nOccasion: {themes}"),
    ("themed", "culture", ("DEEP_DIVE",), "Explain {architectures} to {makers}."),
    ("cascade", "signal_extraction", ("SIGNAL_EXTRACTION",), "Read this for what it foretells:\n{signals}"),
    ("cascade", "gap_detection", ("GAP_DETECTION",), "Say where models fail at this:\n{gaps}"),
    ("cascade", "trend_synthesis", ("TREND_SYNTHESIS",), "Draw the plan from this:\n{contexts}"),
)


def branches_of(rows: Iterable[tuple[str, str, tuple[str, ...], str]]) -> list[Branch]:
    """Branches whose turns within their category are the order of their rows; each ends
    with its format's outline."""
    turns: dict[tuple[str, str], int] = {}
    out = []
    for family, category, formats, text in rows:
        turn = turns[family, category] = turns.get((family, category), -1) + 1
        out.append(Branch(family, category, turn, formats, f"{text}\n\n{{outline}}"))
    return out


BRANCHES = branches_of(_ROWS)

_SLOT = re.compile(r"\{(?:(?P<low>\d+)\.\.(?P<high>\d+)|(?P<pool>\w+)(?:(?P<join>[+=])(?P<also>\w+))?(?:(?P<mark>[:*])(?P<n>\d+))?)\}")


@dataclass(frozen=True)
class Slot:
    kind: str  #: one, row, lines, pairs, number or outline
    pool: str = ""
    also: str = ""
    n: int = 1  #: how many; of a number, how many there are
    low: int = 0


def cut(template: str) -> tuple[list[str], list[Slot]]:
    """The literal parts of a template, and the slots between them."""
    parts, slots, at = [], [], 0
    for found in _SLOT.finditer(template):
        parts.append(template[at : found.start()])
        at = found.end()
        if found["low"]:
            slots.append(Slot("number", n=int(found["high"]) - int(found["low"]) + 1, low=int(found["low"])))
        elif found["pool"] == "outline":
            slots.append(Slot("outline"))
        else:
            kind = "pairs" if found["join"] == "=" else {":": "row", "*": "lines", None: "one"}[found["mark"]]
            slots.append(Slot(kind, found["pool"], found["also"] or "", int(found["n"] or 1)))
    return [*parts, template[at:]], slots


def template_rows(spark: SparkSession, branches: Iterable[Branch]) -> DataFrame:
    rows = [(b.family, b.category, b.sub, list(b.formats), *cut(b.template)) for b in branches]
    return spark.createDataFrame(
        [(*row[:5], [(s.kind, s.pool, s.also, s.n, s.low) for s in row[5]]) for row in rows],
        "family string, category string, sub long, formats array<string>, parts array<string>, "
        "slots array<struct<kind:string,pool:string,also:string,n:int,low:int>>",
    )


def _number(*key: Column, seed: int) -> Column:
    return F.conv(F.substring(seeded(seed, *key), 1, 8), 16, 10).cast("long")


def _one(members: Column, number: Column) -> Column:
    return F.try_element_at(members, (F.pmod(number, F.greatest(F.size(members), F.lit(1))) + 1).cast("int"))


def _some(members: Column, n: Column, seed: int, *key: Column) -> Column:
    hashed = F.transform(members, lambda x: F.struct(seeded(seed, *key, x).alias("h"), x.alias("x")))
    return F.slice(F.transform(F.array_sort(hashed), lambda s: s["x"]), F.lit(1), n)


def _value(slot: Column, place: Column, pools: Column, outline: Column, seed: int, key: Sequence[Column]) -> Column:
    """What goes into a slot."""
    none = F.array().cast("array<string>")
    own, also = (F.coalesce(F.try_element_at(pools, slot[c]), none) for c in ("pool", "also"))
    left, right = _some(own, slot["n"], seed, *key, place), _some(also, slot["n"], seed, *key, place, F.lit("also"))
    lines = lambda x: F.concat(F.lit("- "), F.array_join(x, "\n- "))
    both = F.zip_with(left, right, lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.concat(a, F.lit(": "), b)))
    return (
        F.when(slot["kind"] == "outline", outline)
        .when(slot["kind"] == "number", (slot["low"] + F.pmod(_number(*key, place, seed=seed), slot["n"])).cast("string"))
        .when(slot["kind"] == "one", _one(F.concat(own, also), _number(*key, place, seed=seed)))
        .when(slot["kind"] == "row", F.array_join(left, "; "))
        .when(slot["kind"] == "lines", lines(left))
        .otherwise(lines(F.array_compact(both)))
    )


def chosen_branches(branches: Iterable[Branch] = BRANCHES, families: Sequence[str] | None = None, categories: Sequence[str] | None = None) -> list[Branch]:
    return [b for b in branches if (families is None or b.family in families) and (categories is None or b.category in categories)]


def turns_of(branches: Iterable[Branch]) -> dict[tuple[str, str], int]:
    """How many branches take turns in each (family, category)."""
    turns: dict[tuple[str, str], int] = {}
    for b in branches:
        turns[b.family, b.category] = max(turns.get((b.family, b.category), 0), b.sub + 1)
    return turns


def dealt(rows: DataFrame, key: Column, branches: Iterable[Branch]) -> DataFrame:
    """A work list of one scenario for each row: keys are dealt to the categories in turn,
    and what a category gets is numbered by the rounds. A null key gets no number; equal
    keys get equal scenarios. Nothing is shuffled."""
    names = sorted(turns_of(branches))
    if not names:
        raise ValueError("no branches to deal to")
    stock = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(c).alias("category")) for f, c in names])
    place = F.pmod(key, F.lit(len(names)))
    own = F.when(key.isNotNull(), F.element_at(stock, (place + 1).cast("int")))
    return rows.select(own["family"].alias("family"), own["category"].alias("category"), F.call_function("div", key - place, F.lit(len(names))).alias("idx"))


def scenarios(
    spark: SparkSession, n: int | DataFrame, seed: int = 42, branches: Sequence[Branch] = BRANCHES, pools: Mapping[str, Sequence[str]] = POOLS,
    limits: Mapping[str, tuple[int, int]] = FORMAT_LIMITS, outlines: Mapping[str, str] = OUTLINES,
    families: Sequence[str] | None = None, categories: Sequence[str] | None = None,
) -> DataFrame:
    """Numbered scenarios: family, category, idx, sub, format, prompt, min_len, max_tokens.
    ``n`` of every category, or one for each row (family, category, idx) of a work list,
    such as ``dealt`` makes of a table's keys; rows of an unknown category or without a
    number make none. Branches take turns; a pool that is missing leaves its slot empty."""
    chosen = chosen_branches(branches, families, categories)
    turns = turns_of(chosen)
    rows = template_rows(spark, chosen)
    counts = spark.createDataFrame([(*k, v) for k, v in turns.items()], "family string, category string, turns long")
    specs = spark.createDataFrame([(f, outlines.get(f, ""), *limits[f]) for f in limits], "format string, outline string, min_len int, max_tokens int")
    stock = F.create_map(*[x for name, members in pools.items() for x in (F.lit(name), F.array(*map(F.lit, members)))])
    key = [F.col("family"), F.col("category"), F.col("idx")]
    # The three small tables have a row for each category, branch and format.
    if isinstance(n, int):
        wanted = spark.range(n).withColumnRenamed("id", "idx").join(F.broadcast(counts))
    else:
        wanted = n.where("idx IS NOT NULL").select("family", "category", "idx").join(F.broadcast(counts), ["family", "category"])
    numbered = wanted.withColumn("sub", round_robin(F.col("idx"), F.col("turns")))
    told = numbered.join(F.broadcast(rows), ["family", "category", "sub"]).withColumn("format", _one(F.col("formats"), _number(*key, F.lit("format"), seed=seed)))
    told = told.join(F.broadcast(specs), "format")
    values = F.transform("slots", lambda slot, place: F.coalesce(_value(slot, place, stock, F.col("outline"), seed, key), F.lit("")))
    filled = F.zip_with("parts", values, lambda part, value: F.concat(part, F.coalesce(value, F.lit(""))))
    return told.select("family", "category", "idx", "sub", "format", F.array_join(filled, "").alias("prompt"), "min_len", "max_tokens")


def head(rows: DataFrame, most: int | None = None, dry_run: int | None = None, order: Sequence[str] = ("family", "category", "idx")) -> DataFrame:
    """The first rows in order: ``dry_run`` of them, if given, else ``most``, else all."""
    n = dry_run if dry_run is not None else most
    return rows if n is None else rows.orderBy(*order).limit(n)
