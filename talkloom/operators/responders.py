"""Responders: where a language model would be called.

A responder adds a reply column to rows with a prompt column.  ``Replay`` looks
replies up by prompt and model, which is deterministic and works offline;
``Call`` calls a function from the tasks, a few at a time, with errors kept as a
column; write its replies before reusing them, as tasks may run twice.
``CallOnce`` keeps a log, so that no prompt is paid for twice.
"""

from __future__ import annotations

import json
import subprocess
import threading
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.work import file_system, stored


class Responder(Protocol):
    def respond(self, rows: DataFrame, prompt: str) -> DataFrame: ...


def prompt_key(prompt: Column, model: str) -> Column:
    return F.md5(F.concat_ws("\x01", prompt, F.lit(model)))


class Replay:
    """Replies from a table (key, reply, duration_ms)."""

    def __init__(self, replies: DataFrame, model: str):
        self.replies, self.model = replies, model

    def respond(self, rows: DataFrame, prompt: str) -> DataFrame:
        keyed = rows.withColumn("key", prompt_key(F.col(prompt), self.model))
        return keyed.join(self.replies.select("key", "reply", "duration_ms"), "key", "left").drop("key")


def answered(function: Callable[[str], str], prompt: str, timeout: float) -> tuple[str, float, str | None]:
    """(reply, duration_ms, error) of one call; one that hangs is left to a daemon thread, which ends with the worker."""
    box: list = []

    def call() -> None:
        try:
            box.append((function(prompt), None))
        except Exception as e:  # noqa: BLE001
            box.append(("", str(e) or type(e).__name__))

    began = time.monotonic()
    thread = threading.Thread(target=call, daemon=True)
    thread.start()
    thread.join(timeout)
    reply, error = box[0] if box else ("", "TimeoutError")
    return reply, 0.0 if error else (time.monotonic() - began) * 1000, error


class Call:
    """Replies from a function of the prompt; each task calls for one row at a time.

    ``parallel`` is the number of tasks, by default as many as the rows have.
    A call that fails, or takes longer than ``timeout`` seconds, gives an empty
    reply, no duration and its error.
    """

    def __init__(self, function: Callable[[str], str], parallel: int | None = None, timeout: float = 600.0):
        self.function, self.parallel, self.timeout = function, parallel, timeout

    def respond(self, rows: DataFrame, prompt: str) -> DataFrame:
        function, timeout = self.function, self.timeout

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                got = [answered(function, text, timeout) for text in batch[prompt]]
                replies, times, errors = (list(x) for x in zip(*got, strict=True)) if got else ([], [], [])
                yield batch.assign(reply=replies, duration_ms=times, error=errors)

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        dealt = rows.repartition(self.parallel) if self.parallel else rows
        return dealt.mapInPandas(run, f"{fields}, reply string, duration_ms double, error string")


def chat_request(model: str, system: str, temperature: float = 0.3) -> Callable[[str], dict]:
    """The request body of a chat completion for a prompt."""
    return lambda prompt: {
        "model": model,
        "messages": [{"role": "system", "content": system}, {"role": "user", "content": prompt}],
        "temperature": temperature,
        "stream": False,
    }


class ChatCompletion:
    """A call of a chat-completion server: posts the request body, gives the first choice's content."""

    def __init__(self, url: str, model: str, system: str, temperature: float = 0.3, timeout: float = 600.0):
        self.url, self.body, self.timeout = url, chat_request(model, system, temperature), timeout

    def __call__(self, prompt: str) -> str:
        data = json.dumps(self.body(prompt)).encode()
        request = urllib.request.Request(self.url, data, {"Content-Type": "application/json"})  # noqa: S310
        with urllib.request.urlopen(request, timeout=self.timeout) as response:  # noqa: S310
            reply = json.loads(response.read())
        return reply["choices"][0]["message"]["content"] or ""


class CommandLine:
    """A call of a program: the prompt on its input, its output stripped; another exit status than 0 is an error.

    ``without`` names environment variables that the program must not see.
    """

    def __init__(self, arguments: list[str], timeout: float = 600.0, without: tuple[str, ...] = ()):
        self.arguments, self.timeout, self.without = arguments, timeout, without

    def __call__(self, prompt: str) -> str:
        import os

        environment = {k: v for k, v in os.environ.items() if k not in self.without}
        done = subprocess.run(self.arguments, input=prompt, capture_output=True, text=True, timeout=self.timeout, env=environment, check=False)  # noqa: S603
        if done.returncode:
            raise RuntimeError(f"exit status {done.returncode}: {done.stderr.strip()[:500]}")
        return done.stdout.strip()


class CallOnce:
    """Replies from a function of the prompt, each paid call made once for good.

    Distinct prompts that the log has no reply to are dealt to ``tasks`` tasks,
    each of which makes up to ``at_once`` calls side by side; so no more than
    their product are ever open.  A reply is put into the log under ``folder`` as
    soon as it is there, one file by task and prompt, moved into place when whole:
    a task that runs again, or a whole job that does, finds what was answered and
    calls for the rest.  A call that fails is tried ``tries`` times, with waits
    that double from ``wait`` seconds; then it gives an empty reply and its error,
    which isn't logged, so the next run tries it again.

    Once all are answered, replies go to one table (key, reply, duration_ms,
    error) in the log, and files of single replies are removed.
    """

    def __init__(
        self, function: Callable[[str], str], model: str, folder: str, tasks: int = 8, at_once: int = 5,
        tries: int = 3, wait: float = 1.0, timeout: float = 600.0,
    ):
        self.function, self.model, self.folder = function, model, folder.rstrip("/")
        self.tasks, self.at_once, self.tries, self.wait, self.timeout = tasks, at_once, tries, wait, timeout

    def respond(self, rows: DataFrame, prompt: str) -> DataFrame:
        """The rows with reply, duration_ms and error."""
        spark = rows.sparkSession
        keyed = rows.withColumn("_key", prompt_key(F.col(prompt), self.model))
        asked = keyed.select("_key", F.col(prompt).alias("_prompt")).distinct()
        known = self.logged(spark)
        waiting = asked.join(known.select("_key"), "_key", "left_anti")
        # tasks are told by their number, so a prompt goes to the same one each time
        dealt = waiting.withColumn("_task", F.pmod(F.crc32("_key"), F.lit(self.tasks)).cast("int")).repartition(self.tasks, "_task")
        got = stored(dealt.mapInPandas(self.caller(), REPLY), f"{self.folder}/got-{uuid.uuid4().hex}")
        got.where("error is null").write.mode("append").parquet(f"{self.folder}/replies")
        files, where = file_system(spark, f"{self.folder}/calls")
        files.delete(where, True)
        every = self.logged(spark).select("_key", "reply", "duration_ms", "error").union(got.where("error is not null").select("_key", "reply", "duration_ms", "error"))
        return keyed.join(every, "_key", "left").drop("_key")

    def logged(self, spark: SparkSession) -> DataFrame:
        """The log's replies, one for each prompt."""
        files, where = file_system(spark, f"{self.folder}/replies")
        if not files.exists(where):
            return spark.createDataFrame([], REPLY)
        return spark.read.schema(REPLY).parquet(f"{self.folder}/replies").dropDuplicates(["_key"])

    def caller(self) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        function, folder, at_once, tries, wait, timeout = self.function, self.folder, self.at_once, self.tries, self.wait, self.timeout

        def one(key: str, prompt: str, log: ReplyLog) -> tuple:
            if key in log.known:
                return (key, *log.known[key])
            for k in range(tries):
                reply, duration, error = answered(function, prompt, timeout)
                if error is None:
                    log.put(key, reply, duration)
                    break
                if k + 1 < tries:
                    time.sleep(wait * 2**k)
            return key, reply, duration, error

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from concurrent.futures import ThreadPoolExecutor

            logs: dict[int, ReplyLog] = {}
            with ThreadPoolExecutor(at_once) as pool:
                for batch in batches:
                    for t in batch["_task"].unique():
                        logs.setdefault(t, ReplyLog(f"{folder}/calls/{t:05d}"))
                    made = pool.map(lambda r: one(r[0], r[1], logs[r[2]]), batch[["_key", "_prompt", "_task"]].itertuples(index=False))
                    yield pd.DataFrame(list(made), columns=["_key", "reply", "duration_ms", "error"])

        return run


REPLY = "_key string, reply string, duration_ms double, error string"


class ReplyLog:
    """Replies of one task's prompts, a file each, on storage that outlives the task."""

    def __init__(self, folder: str):
        from pyarrow import fs

        from ..sources.log_source import opened

        self.files, self.folder = opened(folder)
        self.files.create_dir(self.folder)
        self.known: dict[str, tuple[str, float, None]] = {}
        for info in self.files.get_file_info(fs.FileSelector(self.folder)):
            if info.base_name.endswith(".json"):
                with self.files.open_input_stream(info.path) as f:
                    row = json.loads(f.read())
                self.known[info.base_name.removesuffix(".json")] = (row["reply"], row["duration_ms"], None)

    def put(self, key: str, reply: str, duration: float) -> None:
        part = f"{self.folder}/{key}.{uuid.uuid4().hex}.part"
        with self.files.open_output_stream(part) as f:
            f.write(json.dumps({"reply": reply, "duration_ms": duration}).encode())
        self.files.move(part, f"{self.folder}/{key}.json")


@F.pandas_udf(T.BooleanType())
def mersenne_coin(seed: pd.Series) -> pd.Series:
    """The first draw of the standard library's generator, below one half."""
    import random

    return seed.map(lambda s: random.Random(int(s)).random() < 0.5)


@F.pandas_udf(T.DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    """p of a normal statistic; neither engine has the error function."""
    import math

    return z.map(lambda x: None if x is None or x != x else math.erfc(abs(x) / math.sqrt(2)))


@F.pandas_udf(T.DoubleType())
def signed_rank_p(n: pd.Series, w: pd.Series, ties: pd.Series, z: pd.Series) -> pd.Series:
    """Two-sided p of a signed-rank sum: exact for at most 50 differences of
    different sizes, else normal; null where there is no z."""
    import math

    def exact(size: int, least: int) -> float:
        ways = [1] + [0] * (size * (size + 1) // 2)
        for rank in range(1, size + 1):
            for total in range(len(ways) - 1, rank - 1, -1):
                ways[total] += ways[total - rank]
        return min(1.0, 2 * sum(ways[: least + 1]) / 2**size)

    out = []
    for size, least, tied, x in zip(n, w, ties, z, strict=True):
        if x is None or x != x:
            out.append(None)
        else:
            out.append(exact(int(size), int(least)) if size <= 50 and tied == 0 else math.erfc(abs(x) / math.sqrt(2)))
    return pd.Series(out, dtype="float64")
