"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the average of the embeddings of its letter 1- to 4-grams (with word
marks, hashed to ``buckets``); a softmax layer over that average gives the
languages. Both are trained by stochastic gradient descent in numpy on at most
``Settings.sample`` labelled rows (by default 800 a language, fewer for each where
there are more than 256 languages, but never none; chosen by a hash of key and text,
exact copies once). Rows are learned from whole; where they are so long that their
subwords exceed ``Settings.room``, fewer are drawn. Part of that sample, never all rows
of a language, is held back to fit the temperature that calibrates the probabilities and the threshold
below which a prediction is rejected.

As the layers are linear, embeddings and softmax weights fold into one score
table of buckets x languages, which is broadcast, and a worker sums each distinct
word's scores once. Beyond ``Settings.folded`` languages they stay apart, and the
sums are of embeddings, so that the table doesn't grow with the languages.

Rows, defined: a null text or one without letters is ``und`` with score 0 and is
rejected; without any labelled row all texts are; repeated rows are predicted one
by one; whole texts count, however long; empty tables give no rows. Rows with a
null key are predicted, never learned from. Only key, text and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reclaim
from .bpe import once
from .common import bounded_batches, mix, small_batches

UNKNOWN = "und"
_RUN = regex.compile(r"\p{L}+")
#: Places that hashed keys fall into.
STEPS = 1 << 30


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    dims: int = 16
    longest: int = 4
    per_label: int = 800  #: labelled rows to learn from, for each label
    sample: int = 800 * 256  #: labelled rows to learn from in all, or one for each label
    room: int = 1 << 26  #: distinct subwords of the rows drawn, in all; a label's share holds one row at least
    labels: int | None = None  #: more distinct labels than this raise an error, if given
    folded: int = 256  #: labels up to which the layers are folded
    cells: int = 1 << 22  #: rows times labels scored at once
    epochs: int = 12
    rate: float = 4.0
    held_back: int = 5  #: one in so many sampled rows calibrates
    rejected: float = 0.002  #: share of right calibration predictions that may be rejected
    surest: float = 0.5  #: the threshold is never above this
    seed: int = 7


@dataclass
class Model:
    labels: list[str]
    scores: np.ndarray  #: buckets x labels, embeddings times weights; embeddings if there is a layer
    bias: np.ndarray
    temperature: float
    threshold: float
    settings: Settings
    layer: np.ndarray | None = None  #: weights that aren't folded into the scores

    def logits(self, means: np.ndarray) -> np.ndarray:
        """Of rows of averaged scores."""
        return (means if self.layer is None else means @ self.layer) + self.bias

    def blocks(self, rows: int) -> list[slice]:
        """Rows cut so that their logits stay small."""
        each = max(1, self.settings.cells // max(1, len(self.labels)))
        return [slice(at, at + each) for at in range(0, rows, each)]


def subwords(pieces: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and piece index of every subword of the pieces' letter runs."""
    marked = ["".join(f"<{run}>" for run in _RUN.findall(piece.lower())) for piece in pieces]
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    piece = np.repeat(np.arange(len(pieces)), [len(m) for m in marked])
    closed = np.concatenate([[0], np.cumsum(code == ord(">"))])
    buckets, owners = [], []
    h = np.zeros(len(code), np.uint64)
    for n in range(1, settings.longest + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(1_000_003) + code[n - 1 :]
        at = np.flatnonzero((closed[n - 1 : n - 1 + m] == closed[:m]) & (piece[n - 1 :] == piece[:m]))
        if n == 1:
            at = at[(code[at] != ord("<")) & (code[at] != ord(">"))]
        buckets.append((mix(h[at] + np.uint64(n)) % np.uint64(settings.buckets)).astype(np.int64))
        owners.append(piece[at])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def _bags(labelled: DataFrame, settings: Settings, room: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Label, distinct buckets and their weights of each row, whole; of a label's rows, by
    place, the first that have ``room`` for their buckets, and one at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 200):
            found, n, size = [], [], []
            for text in batch.column(1).to_pylist():
                own, count = np.unique(subwords(text.split(), settings)[0], return_counts=True)
                found.append(own.astype("<i4").tobytes())
                n.append(count.astype("<i4").tobytes())
                size.append(len(own))
            made = [pa.array(found, pa.binary()), pa.array(n, pa.binary()), pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, batch.column(2)], ["label", "found", "n", "size", "place"])

    rows = labelled.select("label", "text", "place").mapInArrow(run, "label string, found binary, n binary, size long, place long").where("size > 0")
    order = Window.partitionBy("label").orderBy("place", "found", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drawn = rows.withColumn("held", F.sum("size").over(order)).where(F.col("held") <= F.greatest(F.lit(room), F.col("size")))
    return [(r.label, np.frombuffer(r.found, "<i4"), np.frombuffer(r.n, "<i4")) for r in sorted(drawn.collect(), key=lambda r: (r.label, r.found, r.n))]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", settings: Settings = Settings(), usable: Column | None = None) -> Model | None:
    """Learn from a bounded sample of the ``usable`` labelled rows."""
    rows = bounded_batches(docs).where(F.col(key).isNotNull() & F.col(text).isNotNull() & F.col(label).isNotNull())
    rows = rows if usable is None else rows.where(usable)
    rows = rows.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"), F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text)), F.lit(STEPS)).alias("place"))
    many = settings.sample // settings.per_label
    found = rows.groupBy("label").count()
    counts = found.orderBy("label").limit(1 + (many if settings.labels is None else max(many, settings.labels))).collect()
    if settings.labels is not None and len(counts) > settings.labels:
        raise ValueError(f"more than {settings.labels} distinct labels")
    if not counts:
        return None
    if len(counts) <= many:
        # Half as many again as wanted, so that the limit is met by nearly every label.
        share = F.create_map(*[x for r in counts for x in (F.lit(r.label), F.lit(min(STEPS, STEPS * 3 * settings.per_label // (2 * r["count"]) + 1)))])
        bags = _learned(rows.where(F.col("place") < share[F.col("label")]), settings.per_label, len(counts), settings)
        # A label whose copies the hash has all passed over is drawn from all its rows.
        left = {r.label for r in counts} - {b[0] for b in bags}
        if left:
            bags += _learned(rows.where(F.col("label").isin(*left)), settings.per_label, len(counts), settings)
    else:
        labels = found.count()
        bags = _learned(rows, max(1, settings.sample // labels), labels, settings)
    if not bags:
        return None
    bags.sort(key=lambda b: (b[0], b[1].tobytes(), b[2].tobytes()))
    reclaim(docs.sparkSession)  # the JVM's copies, before the training needs memory
    model = train(bags, settings)
    bags.clear()
    reclaim(docs.sparkSession)
    return model


def _learned(rows: DataFrame, each: int, labels: int, settings: Settings) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """At most ``each`` distinct lettered rows of every label, as bags."""
    lettered = rows.where(F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("label").orderBy("place", "text")
    picked = lettered.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= each).select("label", "text", "place")
    picked = picked.groupBy("label", "text").agg(F.min("place").alias("place"))
    return _bags(picked, settings, settings.room // labels)


def train(bags: list[tuple[str, np.ndarray, np.ndarray]], settings: Settings) -> Model:
    labels = sorted({b[0] for b in bags})
    number = {x: i for i, x in enumerate(labels)}
    random = np.random.default_rng(settings.seed)
    order = random.permutation(len(bags))
    held = set(order[:: settings.held_back].tolist()) if len(bags) >= 10 * settings.held_back else set()
    weights = lambda i: bags[i][2] / bags[i][2].sum()  # noqa: E731  twice the memory of the counts, if kept
    target = [number[b[0]] for b in bags]
    taught = {target[i] for i in order.tolist() if i not in held}
    for i in sorted(held):  # a label that would be held back as a whole
        if target[i] not in taught:
            held.discard(i)
            taught.add(target[i])
    vectors = random.uniform(-1, 1, (settings.buckets, settings.dims)) / settings.dims
    layer = np.zeros((settings.dims, len(labels)))
    bias = np.zeros(len(labels))
    learned = [i for i in order.tolist() if i not in held]
    total, done = settings.epochs * len(learned), 0
    for _ in range(settings.epochs):
        for i in random.permutation(learned).tolist():
            rate = settings.rate * (1 - done / total)
            done += 1
            weight = weights(i)
            x = weight @ vectors[bags[i][1]]
            gradient = _softmax(x @ layer + bias)
            gradient[target[i]] -= 1
            back = layer @ gradient
            layer -= rate * np.outer(x, gradient)
            bias -= 0.1 * rate * gradient
            vectors[bags[i][1]] -= rate * weight[:, None] * back
    apart = len(labels) > settings.folded
    scores = vectors if apart else vectors @ layer
    judged = sorted(held) or learned
    model = Model(labels, scores, bias, 1.0, 0.0, settings, layer if apart else None)
    means = np.array([weights(i) @ scores[bags[i][1]] for i in judged])
    truth = np.array([target[i] for i in judged])
    cuts = model.blocks(len(judged))

    def loss(t: float) -> float:
        return sum(-np.log(_softmax(model.logits(means[c]) / t)[np.arange(len(truth[c])), truth[c]] + 1e-12).sum() for c in cuts) / len(truth)

    model.temperature = min(np.geomspace(0.1, 10, 61).tolist(), key=loss)
    right = []
    for c in cuts:
        sure = _softmax(model.logits(means[c]) / model.temperature)
        right.append(sure.max(axis=1)[sure.argmax(axis=1) == truth[c]])
    right = np.concatenate(right)
    model.threshold = min(settings.surest, float(np.quantile(right, settings.rejected))) if len(right) else 0.0
    model.scores = scores.astype(np.float32)
    return model


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Scorer:
    """Sums score-table rows over texts; remembers each distinct word's sum."""

    MEMORY = 200_000

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}
        self.table = np.zeros((0, self.model.scores.shape[1] + 1))

    def _learn(self, new: list[str]) -> None:
        m = self.model
        bucket, owner = subwords(new, m.settings)
        sums = [np.bincount(owner, m.scores[bucket, k], len(new)) for k in range(m.scores.shape[1])]
        rows = np.stack([*sums, np.bincount(owner, minlength=len(new))], axis=1)
        self.row.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
        self.table = np.concatenate([self.table, rows])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Label, calibrated probability and whether it is rejected."""
        m = self.model
        split = [t.split() if t else [] for t in texts]
        wanted: set[str] = set()
        for pieces in split:
            wanted.update(pieces)
        if len(self.row) > self.MEMORY:
            self.forget()
        new = sorted(wanted.difference(self.row))
        if new:
            self._learn(new)
        sums = np.zeros((len(texts), m.scores.shape[1] + 1))
        for i, pieces in enumerate(split):
            at = np.fromiter(map(self.row.__getitem__, pieces), np.int64, len(pieces))
            sums[i] = self.table[at].sum(axis=0)
        letters = sums[:, -1] > 0
        means = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for c in m.blocks(len(texts)):
            sure = _softmax(m.logits(means[c]) / m.temperature)
            best[c], score[c] = sure.argmax(axis=1), sure.max(axis=1)
        score[~letters] = 0
        return [m.labels[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters, strict=True)], score, ~letters | (score < m.threshold)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected; same-named columns are replaced."""
    names = ["lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c not in names]
    docs = bounded_batches(docs).select(*kept)
    if model is None:
        return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = once(shared, Scorer)
        for batch in small_batches(batches, 250):
            label, score, rejected = scorer.predict(batch.column(text).to_pylist())
            made = [pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], schema.names)

    return docs.mapInArrow(run, schema)
