"""Scoring predictions against references, and expectations about outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.score import exact_match, length_ratio
from ..functions.text import count_any
from .gates import BANNED

Metric = Callable[[Column, Column], Column]
#: The metrics by default; a caller may pass others.
METRICS: dict[str, Metric] = {"length_ratio": length_ratio, "exact_match": exact_match}


def predicted(df: DataFrame, predict: Callable | None, instruction: str, out: str = "prediction", batched: bool = False) -> DataFrame:
    """Adds predictions: by a Python function over Arrow batches, or empty ones. The
    function takes a text, or, if ``batched``, a Series of them, as a model would."""
    if predict is None:
        return df.withColumn(out, F.lit(""))

    @F.pandas_udf("string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield predict(batch) if batched else batch.map(predict)

    return df.withColumn(out, apply(F.col(instruction)))


def results(df: DataFrame, prediction: Column, reference: Column, run_id: str, model: str, timestamp: str, metrics: Mapping[str, Metric] | Scorer | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per input row and metric; nothing is averaged. ``metrics`` are columns by
    name, or a scorer of whole batches."""
    if metrics is not None and not isinstance(metrics, Mapping):
        rows = scored(df.withColumns({"_said": prediction, "_wanted": reference}), metrics, "_said", "_wanted", keep or [])
        return rows.select(*(keep or []), F.lit(run_id).alias("run_id"), F.lit(model).alias("model"), "metric", "score", F.lit(1).cast("long").alias("samples"), F.lit(timestamp).alias("timestamp"))
    scores = F.create_map(*[x for name, m in (metrics or METRICS).items() for x in (F.lit(name), m(prediction, reference))])
    return df.select(*(keep or []), F.explode(scores).alias("metric", "score")).select(
        *(keep or []), F.lit(run_id).alias("run_id"), F.lit(model).alias("model"), "metric", "score",
        F.lit(1).cast("long").alias("samples"), F.lit(timestamp).alias("timestamp"),
    )


class Scorer(Protocol):
    """Scores batches by any rule: a dict of metric names and values for each pair. Pairs
    may have different metrics, or none; a value may be None."""

    def score(self, predictions: list[str | None], references: list[str | None]) -> Iterable[Mapping[str, float | None]]: ...


def scored(df: DataFrame, scorer: Scorer, prediction: str, reference: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per input row and metric that ``scorer`` gives for it: the ``keep`` columns,
    metric and score. An Arrow table function scores a batch at a time, where its rows
    lie; pairs that the scorer has nothing to say of have no rows."""
    kept = T.StructType([df.schema[c] for c in keep])
    schema = T.StructType([*kept, T.StructField("metric", T.StringType()), T.StructField("score", T.DoubleType())])
    size = len(kept)

    @F.arrow_udtf(returnType=schema)
    class Scores:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            told = list(scorer.score(*(batch.column(size + i).to_pylist() for i in range(2))))
            if len(told) != batch.num_rows:
                raise ValueError(f"the scorer gave {len(told)} results for {batch.num_rows} pairs")
            row = pa.array([i for i, scores in enumerate(told) for _ in scores], pa.int64())
            columns = [batch.column(i).take(row) for i in range(size)]
            metric = pa.array([name for scores in told for name in scores], pa.string())
            score = pa.array([None if x is None else float(x) for scores in told for x in scores.values()], pa.float64())
            yield pa.table([*columns, metric, score], names=schema.names)

    return Scores(df.select(*keep, F.col(prediction).alias("_prediction"), F.col(reference).alias("_reference")).asTable())


def averaged(rows: DataFrame) -> DataFrame:
    """Mean score and samples by run, model and metric; an addition."""
    return rows.groupBy("run_id", "model", "metric").agg(F.avg("score").alias("score"), F.sum("samples").alias("samples"))


# Least characters of a sanity answer by kind, and the headers of the
# structured kinds. Answers off the subject are described in words, not tested.
SANITY_LENGTHS = {
    "BRIEFING": 600, "CULTURE_REPORT": 500, "TREND_ANALYSIS": 1000, "COMPANY_PROFILE": 600, "MARKET_BRIEF": 500, "JOURNAL": 1500,
    "SIGNAL_EXTRACTION": 300, "GAP_DETECTION": 500, "TREND_SYNTHESIS": 800, "OFF_DOMAIN": None,
}
SANITY_HEADERS = {
    "SIGNAL_EXTRACTION": ("SIGNAL:", "WHY IT MATTERS:", "DATA OPPORTUNITY:", "CURATION SCORE:"),
    "GAP_DETECTION": ("CURRENT CAPABILITIES:", "KNOWN WEAKNESSES:", "DATA GAP:", "CURATION OBJECT:"),
    "TREND_SYNTHESIS": ("NAME:", "WHY NOW:", "TARGET PAIRS:", "EXPECTED MODEL IMPACT:"),
}
# End of fixed values.
#: What the other kinds must mention, by default; a caller may name other words.
SANITY_WORDS = {"BRIEFING": ("today",), "CULTURE_REPORT": ("people",), "TREND_ANALYSIS": ("because",), "COMPANY_PROFILE": ("customers",), "MARKET_BRIEF": ("price",), "JOURNAL": ("week",)}


def expected(spark: SparkSession, words: Mapping[str, Sequence[str]] = SANITY_WORDS, headers: Mapping[str, Sequence[str]] = SANITY_HEADERS, lengths: Mapping[str, int | None] = SANITY_LENGTHS) -> DataFrame:
    """A row for each kind: kind, min_length, must_contain, no_banned; nulls where a kind
    expects nothing."""
    rows = [(kind, least, [*headers.get(kind, ()), *words.get(kind, ())] or None, None if least is None else True) for kind, least in lengths.items()]
    return spark.createDataFrame(rows, "kind string, min_length int, must_contain array<string>, no_banned boolean")


def expectations(outputs: DataFrame, expected: DataFrame, text: str, kind: str) -> DataFrame:
    """Check outputs against (kind, min_length, must_contain, no_banned) rows, a table
    with a row per kind: which of them hold. What a kind doesn't expect holds; a null
    text is an empty one; outputs of unknown kinds are left out."""
    joined = outputs.join(F.broadcast(expected.withColumnRenamed("kind", kind)), kind)  # one row a kind
    x = F.coalesce(F.col(text), F.lit(""))
    holds = lambda check: F.coalesce(check, F.lit(True))
    return joined.withColumns({
        "long_enough": holds(F.length(x) >= F.col("min_length")),
        "contains_all": holds(F.forall("must_contain", lambda s: F.contains(x, s))),
        "clean": ~F.coalesce("no_banned", F.lit(False)) | (count_any(x, BANNED) == 0),
    }).drop("min_length", "must_contain", "no_banned")
