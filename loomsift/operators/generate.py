"""Text generation behind a small protocol, in two tiers, with retries.

A generator is any picklable object with ``complete(prompt, max_tokens)``; ``Http`` asks
a server. Calls run in ``mapInArrow``, a few at a time in each task. Each distinct prompt
is asked for once: answers go to files of a store, keyed by the prompt's hash, while the
job runs, and a later run, or a task that is run again, asks for what the store lacks.

A fatal answer (a bad key, no credit) ends the run: the task that gets it leaves a mark,
the others stop at their next prompts and keep what they have, the driver interrupts what
is left of the job by its tag, and ``Stopped`` tells how far it came.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import threading
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path, written
from ..sources.hashed import file_system


class GenerationError(Exception):
    def __init__(self, status: int, message: str = ""):
        super().__init__(message or str(status))
        self.status = status


class Generator(Protocol):
    def complete(self, prompt: str, max_tokens: int) -> str: ...


@dataclass(frozen=True)
class Echo:
    """A deterministic stub: words drawn by a hash of the prompt."""

    words: tuple[str, ...] = ("Signal", "rises", "by", "40%", "in", "March", "near", "Oslo", "and", "Lima")
    tier: str = "gen"

    def complete(self, prompt: str, max_tokens: int) -> str:
        seed = hashlib.sha256(f"{self.tier}:{prompt}".encode()).digest()
        size = min(max_tokens, 40 + seed[0])
        return " ".join(self.words[seed[i % 32] % len(self.words)] for i in range(size))


@dataclass(frozen=True)
class Wire:
    """How one kind of server is asked: the names it has for things, and where the text
    lies in its answer."""

    answer: tuple[str | int, ...]
    limit: str = "max_tokens"
    options: str | None = None  #: the field that holds limit and sampling; the top level if None
    extra: Mapping[str, Any] = field(default_factory=dict)

    def payload(self, model: str, messages: list[dict[str, str]], max_tokens: int, sampling: Mapping[str, float]) -> dict[str, Any]:
        settings = {self.limit: max_tokens, **sampling}
        return {"model": model, "messages": messages, **self.extra, **(settings if self.options is None else {self.options: settings})}

    def text(self, reply: Any) -> str:
        for place in self.answer:
            reply = reply[place]
        return reply.strip()


# The public shapes of the two chat interfaces.
CHAT_COMPLETIONS = Wire(answer=("choices", 0, "message", "content"))
OLLAMA_CHAT = Wire(answer=("message", "content"), limit="num_predict", options="options", extra={"stream": False})
# End of fixed values.


@dataclass(frozen=True)
class Http:
    """A chat model behind a URL. ``key_variable`` names the environment variable of the
    workers that holds the key, so that no key travels with a plan."""

    url: str
    model: str
    wire: Wire = CHAT_COMPLETIONS
    system: str | None = None
    sampling: Mapping[str, float] = field(default_factory=lambda: {"temperature": 0.7})
    key_variable: str | None = None
    timeout: float = 120

    def complete(self, prompt: str, max_tokens: int) -> str:
        said = [{"role": "system", "content": self.system}] if self.system is not None else []
        payload = self.wire.payload(self.model, [*said, {"role": "user", "content": prompt}], max_tokens, self.sampling)
        headers = {"Content-Type": "application/json"}
        if self.key_variable and (key := os.environ.get(self.key_variable)):
            headers["Authorization"] = f"Bearer {key}"
        request = urllib.request.Request(self.url, json.dumps(payload).encode(), headers)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                return self.wire.text(json.load(reply))
        except urllib.error.HTTPError as error:
            raise GenerationError(error.code, f"{error.code} {error.reason}") from error
        except (OSError, ValueError, LookupError, TypeError, AttributeError) as error:  # no connection, or no such answer
            raise GenerationError(0, f"{type(error).__name__}: {error}") from error


# Which statuses end retrying, and the added seconds of the others.
FATAL = {403}
FATAL_WHEN_LAST = {402}
EXTRA_WAIT = {402: 2}
WAIT = 1
RETRIES = 4
# End of fixed values.


_THOUGHT = re.compile(r"<think>.*?</think>\s*", re.DOTALL)


def attempt(call: Callable[[], str], least: int, retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, int, str | None]:
    """Text (or None) without its thinking, attempts, and error. Waits 2 ** attempt plus
    a bit after an error; a text of ``least`` characters or fewer, once its thinking is
    dropped, is asked for again at once."""
    error = None
    for n in range(retries):
        try:
            text = _THOUGHT.sub("", call())
        except GenerationError as e:
            error = str(e)
            if e.status in FATAL or (e.status in FATAL_WHEN_LAST and n + 1 == retries):
                return None, n + 1, f"fatal: {error}"
            if n + 1 < retries:
                sleep(2**n + EXTRA_WAIT.get(e.status, WAIT))
            continue
        if len(text) > least:
            return text, n + 1, None
        error = "too short"
    return None, retries, error


#: Calls that one task has open at a time.
CALLS = 8
#: Answers that a task gathers before it writes them, and rounds of calls between looks
#: for a mark.
GATHERED, ROUNDS = 1000, 4
#: Seconds between the driver's looks, and those it gives tasks to write what they have.
LOOK, GRACE = 0.2, 10.0
_ANSWERS = pa.schema([("prompt_key", pa.string()), ("text", pa.string()), ("attempts", pa.int32()), ("error", pa.string())])
_ASKED = "prompt_key string, text string, attempts int, error string"
_FATAL = "fatal: "


class Stopped(GenerationError):
    """A run that a fatal answer ended; the store has what was answered."""

    def __init__(self, message: str, answered: int, cancelled: int):
        super().__init__(0, f"{message} ({answered} prompts answered, {cancelled} cancelled)")
        self.answered, self.cancelled = answered, cancelled


def prompt_key(prompt: Column, max_tokens: Column, min_len: Column) -> Column:
    """What a completion is kept under."""
    return F.sha2(F.concat_ws(":", max_tokens.cast("string"), min_len.cast("string"), prompt), 256)


class Store:
    """Answers in files below a shared folder, and the mark that stops a run."""

    def __init__(self, path: str):
        self.path = path

    def marked(self) -> str | None:
        files, folder = file_system(self.path)
        mark = f"{folder}/stopped"
        if files.get_file_info(mark).type != pyarrow.fs.FileType.File:
            return None
        with files.open_input_stream(mark) as told:
            return told.read().decode()

    def mark(self, message: str) -> None:
        files, folder = file_system(self.path)
        files.create_dir(folder)
        with files.open_output_stream(f"{folder}/stopped") as out:
            out.write(message.encode())

    def clear(self) -> None:
        files, folder = file_system(self.path)
        if self.marked() is not None:
            files.delete_file(f"{folder}/stopped")

    def add(self, rows: list[tuple]) -> None:
        """A file of answers; it has its name only once it is whole."""
        files, folder = file_system(self.path)
        files.create_dir(f"{folder}/answers")
        name = uuid.uuid4().hex
        columns = zip(*rows, strict=True)
        pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, _ANSWERS, strict=True)], schema=_ANSWERS), f"{folder}/_{name}", filesystem=files)
        files.move(f"{folder}/_{name}", f"{folder}/answers/{name}.parquet")

    def answers(self, spark: SparkSession) -> DataFrame:
        """One answer for each prompt; of a prompt that two attempts of a task asked, one."""
        files, folder = file_system(self.path)
        if files.get_file_info(f"{folder}/answers").type != pyarrow.fs.FileType.Directory:
            return spark.createDataFrame([], _ASKED)
        rows = spark.read.schema(_ASKED).parquet(f"{self.path}/answers")
        return rows.groupBy("prompt_key").agg(F.min(F.struct("text", "attempts", "error")).alias("a")).select("prompt_key", "a.*")


def _asking(generator: Generator, retries: int, calls: int, store: Store) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = threading.Event()

        def ask(row: dict) -> tuple | None:
            if over.is_set():
                return None
            told = attempt(lambda: generator.complete(row["prompt"], row["most"]), row["least"] // 2, retries)
            if told[2] is not None and told[2].startswith(_FATAL):
                over.set()
                store.mark(told[2])
                return None
            return (row["prompt_key"], *told)

        held: list[tuple] = []
        count = 0
        with ThreadPoolExecutor(calls) as pool:
            for batch in batches:
                for at in range(0, batch.num_rows, calls * ROUNDS):
                    if over.is_set() or store.marked() is not None:
                        break
                    done = [x for x in pool.map(ask, batch.slice(at, calls * ROUNDS).to_pylist()) if x is not None]
                    held, count = held + done, count + len(done)
                    if len(held) >= GATHERED:
                        store.add(held)
                        held = []
        if held:
            store.add(held)
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["n"])

    return run


def _until_marked(job: DataFrame, store: Store) -> None:
    """Run a job to its end, or, once there is a mark, end it: tasks have ``GRACE`` seconds
    to write what they have, then what carries the job's tag is interrupted."""
    spark, tag, failure = job.sparkSession, f"generate-{uuid.uuid4().hex}", []

    def work() -> None:
        spark.addTag(tag)
        try:
            job.write.format("noop").mode("overwrite").save()
        except Exception as error:  # told below, unless a mark explains it
            failure.append(error)
        finally:
            spark.removeTag(tag)

    thread = threading.Thread(target=work, daemon=True)
    thread.start()
    while thread.is_alive():
        thread.join(LOOK)
        if thread.is_alive() and store.marked() is not None:
            thread.join(GRACE)
            if thread.is_alive():
                spark.interruptTag(tag)
            thread.join()
    if failure and store.marked() is None:
        raise failure[0]


def generate(
    df: DataFrame, generator: Generator, prompt: str = "prompt", max_tokens: str = "max_tokens", min_len: str = "min_len", retries: int = RETRIES,
    calls: int = CALLS, store: str | None = None,
) -> DataFrame:
    """Adds text (null without one of more than half of min_len characters), attempts
    and error. Each distinct prompt that ``store``, a shared folder, has no answer of is
    asked for once; reading the result again asks nobody. Raises ``Stopped`` after a fatal
    answer; the same call with the same store goes on from there. Null prompts aren't
    asked. A prompt whose retries ran out is answered, by its error."""
    spark = df.sparkSession
    kept = Store(store or work_path(spark, "completions"))
    keyed = df.withColumn("prompt_key", prompt_key(F.col(prompt), F.col(max_tokens), F.col(min_len)))
    wanted = keyed.where(F.col(prompt).isNotNull()).groupBy("prompt_key").agg(*(F.first(c).alias(n) for c, n in ((prompt, "prompt"), (max_tokens, "most"), (min_len, "least"))))
    kept.clear()
    if store is not None:
        wanted = wanted.join(kept.answers(spark).select("prompt_key"), "prompt_key", "left_anti")
    _until_marked(wanted.mapInArrow(_asking(generator, retries, calls, kept), "n long"), kept)
    message, asked = kept.marked(), kept.answers(spark)
    if message is not None:
        left = keyed.where(F.col(prompt).isNotNull()).select("prompt_key").distinct().join(asked, "prompt_key", "left_anti").count()
        raise Stopped(message.removeprefix(_FATAL), asked.count(), left)
    return keyed.join(asked, "prompt_key", "left").select(*df.columns, "text", "attempts", "error")


def calls_by_kind(df: DataFrame) -> DataFrame:
    """One row: calls in all, rows that ended with an error, and rows with a text."""
    return df.agg(
        F.coalesce(F.sum("attempts"), F.lit(0)).cast("long").alias("total"),
        F.count_if(F.col("error").isNotNull()).alias("error"), F.count("text").alias("completed"),
    )


def two_tier(
    df: DataFrame, first: Callable[[DataFrame], DataFrame], second: Callable[[DataFrame], DataFrame], passes: Column,
    recheck: bool = False,
) -> DataFrame:
    """Run ``first``; rows whose text doesn't pass go to ``second``. ``tier`` says
    which made the text. With ``recheck`` the second's texts must pass too; without,
    any text of it counts. Rows that end without a text have tier ``failed``. What
    either tier made is written before it is read."""
    made = written(first(df).withColumn("_ok", F.coalesce(passes, F.lit(False))), "first-tier")
    good = made.where("_ok").drop("_ok").withColumn("tier", F.lit("gen"))
    again = written(second(made.where("NOT _ok").select(*df.columns)), "second-tier")
    fine = F.col("text").isNotNull() & (F.coalesce(passes, F.lit(False)) if recheck else F.lit(True))
    again = again.withColumn("tier", F.when(fine, "rewrite").otherwise("failed"))
    return good.unionByName(again)
