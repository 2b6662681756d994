"""The engine's ways in, end to end, as a catalogue of transforms.

``collect`` turns feed items into signals, ``cook`` prompts into gated texts,
``assemble`` chat records into training and evaluation sets, ``factory`` contract lines
into sets and a manifest, ``evaluate`` pairs into scores. Each has its parameters bound
by ``built_in``; the catalogue's transforms take DataFrames alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.text import fingerprint, title_key
from .operators.contracts import good_pair, validated
from .operators.dedup import first_wins
from .operators.evaluate import averaged, predicted, results
from .operators.gates import FIRST, GateProfile, passing
from .operators.generate import Echo, Generator, generate, two_tier
from .operators.profile import count_by, length_stats, manifest
from .operators.split import EVAL_SHARE, assembler_split, factory_split
from .operators.waves import in_waves
from .runtime import Catalogue, Frames, Step, catalogue, step
from .sources.feeds import TOPIC, on_topic
from .sources.jsonl import write_hashed, write_jsonl

# What the assembler asks of a record.
LEAST_MESSAGES, LEAST_ANSWER = 3, 300
# End of fixed values.


def collecting(allowed: Sequence[str] = (), topic: Sequence[str] = TOPIC) -> Step:
    """Items on topic, the first of each title key in order of feed and place."""

    @step("collect", items="source_ord int, place bigint, source string, title string, summary string")
    def collect(items: DataFrame) -> Frames:
        order = [F.col("source_ord"), F.col("place")]
        signals = first_wins(on_topic(items, allowed, topic), [title_key(F.col("title"))], order)
        return {"signals": signals, "sources": count_by(signals, F.col("source"), "source")}

    return collect


def cooking(first: Generator = Echo(), second: Generator = Echo(tier="rewrite"), profile: GateProfile = FIRST, target: int = 1000, recheck: bool = False, store: str | None = None) -> Step:
    """Texts for scenarios in two tiers behind a gate, in waves up to a quota for each
    category, so that a full category asks for no more. With ``store``, a shared folder,
    a run that a fatal answer ended goes on where it was."""

    @step("cook", scenarios="category string, idx bigint, prompt string, min_len int, max_tokens int")
    def cook(scenarios: DataFrame) -> Frames:
        passes = passing(F.col("text"), F.col("category"), profile)
        tier = lambda generator, name: lambda df: generate(df, generator, store=store and f"{store}/{name}")
        make = lambda df: two_tier(df, tier(first, "first"), tier(second, "second"), passes, recheck)
        names = [r[0] for r in scenarios.select("category").distinct().collect() if r[0] is not None]  # the quotas' names
        kept, quotas = in_waves(scenarios, make, F.col("tier") != "failed", dict.fromkeys(sorted(names), target))
        told = [(name, q.target, q.asked, q.sent, q.passed) for name, q in quotas.items()]
        told = scenarios.sparkSession.createDataFrame(told, "category string, target long, asked long, sent long, passed long")
        return {"texts": kept, "tiers": count_by(kept, F.col("tier"), "tier"), "quotas": told}

    return cook


def assembling(seed: int = 42, share: float = EVAL_SHARE) -> Step:
    """First of each fingerprint, then the checks of messages and answers, then the split
    whose head is the evaluation set, and a profile. Duplicates go before checks."""

    @step("assemble", records="ordinal bigint, given string, category string, messages array<struct<role:string,content:string>>")
    def assemble(records: DataFrame) -> Frames:
        answer = F.try_element_at("messages", F.lit(-1))["content"]
        first = first_wins(records, [fingerprint(F.col("given"), answer)], [F.col("ordinal")])
        whole = first.where((F.size("messages") >= LEAST_MESSAGES) & (F.length(answer) >= LEAST_ANSWER))
        cut = assembler_split(whole, "ordinal", seed, share)
        side = lambda name: cut.where(F.col("split") == name).drop("split")
        return {
            "train": side("train"), "eval": side("eval"), "lengths": length_stats(whole, answer),
            "categories": count_by(whole, F.col("category"), "category"), "eval_categories": count_by(side("eval"), F.col("category"), "category", ""),
        }

    return assemble


def manufacturing(name: str = "pairs", seed: int = 42, share: float = EVAL_SHARE, paths: dict[str, str] | None = None) -> Step:
    """Lines that hold to the pair contract and its limits, split with the training set
    at the head, and a manifest whose digests are those of the sets' files; with
    ``paths`` the files are written there. Nothing is deduplicated."""

    @step("factory", lines="ordinal bigint, line string")
    def factory(lines: DataFrame) -> Frames:
        record = F.from_json("line", "instruction string, response string, score double")
        judged = validated(lines.withColumn("r", record), "line")
        good = F.coalesce(good_pair(F.col("r.instruction"), F.col("r.response"), F.col("r.score"), F.col("errors")), F.lit(False))
        judged = judged.select("ordinal", "line", "errors", good.alias("good"))
        cut = factory_split(judged.where("good").select("ordinal", "line"), "ordinal", seed, share)
        head = F.greatest(F.lit(1), F.floor(F.col("total") * F.lit(1 - share)))
        placed = cut.withColumn("place", F.col("rank") - F.when(F.col("split") == "eval", head).otherwise(0))
        side = lambda split: placed.where(F.col("split") == split).select("place", "ordinal", "line")
        files = [(split, write_hashed(side(split), path, "place", F.col("line"))) for split, path in (paths or {}).items()]  # hashed as they are written
        digests = lines.sparkSession.createDataFrame([(split, f.n, f.sha256) for split, f in files], "split string, n long, sha256 string") if files else None
        told = manifest(placed, F.col("line"), name, ~F.col("good"), judged, paths, digests)
        return {"train": side("train"), "eval": side("eval"), "rejected": judged.where("NOT good").drop("good"), "manifest": told}

    return factory


def evaluating(predict: Callable[[str], str] | None = None, run_id: str = "run", model: str = "model", path: str | None = None, keep: Sequence[str] = ()) -> Step:
    """Scores of predictions, a row for each pair and metric; with ``path`` appended
    there as JSONL, as a log of runs."""

    @step("evaluate", pairs="instruction string, response string")
    def evaluate(pairs: DataFrame) -> Frames:
        now = datetime.now(timezone.utc).isoformat(timespec="seconds")
        rows = results(predicted(pairs, predict, "instruction"), F.col("prediction"), F.col("response"), run_id, model, now, keep=list(keep))
        if path is not None:
            write_jsonl(rows, path, mode="append")
        return {"results": rows, "averages": averaged(rows)}

    return evaluate


def built_in(**steps: Step) -> Catalogue:
    """The engine's transforms under their own names; any may be given in its place."""
    own = {"collect": collecting, "cook": cooking, "assemble": assembling, "factory": manufacturing, "evaluate": evaluating}
    return catalogue(*(steps.get(name) or make() for name, make in own.items()))
