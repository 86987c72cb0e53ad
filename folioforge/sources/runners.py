"""Model runners as the boundary of the engine: any function of a row, in partitions, with errors as data."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.session import materialize


class RunnerError(Exception):
    """A failed call: its kind, the status where there is one, and whether another try may help."""

    kind, retryable = "failed", False

    def __init__(self, message: str = "", status: int | None = None):
        super().__init__(message)
        self.status = status


class RetryableError(RunnerError):
    """A failure worth another try."""

    kind, retryable = "retryable", True


class UnreadableReply(RunnerError):
    """A reply that cannot be read; it is asked for once more, then it is a failure."""

    kind = "unreadable"


class MissingPage(RunnerError):
    """There is no such page."""

    kind = "missing"


@dataclass(frozen=True)
class Endpoint:
    """Where and how a model is called; a NULL temperature is left to the model."""

    model: str
    url: str = ""
    temperature: float | None = None
    token_limit_name: str = "max_tokens"
    token_limit: int | None = None
    strict_schema: bool = False

    def request(self, content: str) -> dict:
        """The body of a call; settings without a value are left out."""
        body: dict = {"model": self.model, "messages": [{"role": "user", "content": content}]}
        if self.temperature is not None:
            body["temperature"] = self.temperature
        if self.token_limit is not None:
            body[self.token_limit_name] = self.token_limit
        if self.strict_schema:
            body["response_format"] = {"type": "json_schema"}
        return body


class Limiter:
    """Token bucket of one task: *rate* calls a second, *burst* at once."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
        self.at = now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            self.tokens = 1.0
            self.at = self.clock()
        self.tokens -= 1


class Breaker:
    """Stops calls after *limit* failures in a row; after *rest* seconds one call is let through, and its success closes it.

    Without *rest* it stays open.
    """

    def __init__(self, limit: int, rest: float | None = None, clock: Callable[[], float] = time.monotonic):
        self.limit, self.rest, self.clock = limit, rest, clock
        self.failures, self.opened = 0, None

    def lets(self) -> bool:
        if self.opened is None:
            return True
        return self.rest is not None and self.clock() - self.opened >= self.rest

    def note(self, failed: bool) -> None:
        self.failures = self.failures + 1 if failed else 0
        self.opened = self.clock() if self.failures >= self.limit else None


#: What a failure is as data.
FAULT = "struct<kind:string,status:int,retryable:boolean,message:string>"


def _one(call: Callable[[str], str], text: str, tries: int, base_wait: float, limit: Limiter | None) -> tuple[str | None, str | None, int, tuple | None]:
    """(value, error, tries, fault) of one row."""
    error, fault, n, asked_again = None, None, 0, False
    while n < tries:
        n += 1
        if limit:
            limit.take()
        try:
            return call(text), None, n, None
        except RunnerError as e:
            error, fault = f"{e.kind}: {e}", (e.kind, e.status, e.retryable, str(e))
            if isinstance(e, UnreadableReply) and not asked_again and n < tries:
                asked_again = True
                continue
            if not e.retryable:
                break
            if base_wait and n < tries:
                time.sleep(base_wait * 2 ** (n - 1) * random.uniform(0.7, 1.3))
        except Exception as e:  # a page must not end the job
            error, fault = f"{type(e).__name__}: {e}", (type(e).__name__, None, False, str(e))
            break
    return None, error, n, fault


def run_model(df: DataFrame, key: str, text: str, call: Callable[[str], str], tries: int = 3, rate: float | None = None, breaker: int = 20, base_wait: float = 0.0, rest: float | None = None) -> DataFrame:
    """(key, value, error, tries, fault): *call* of every row's text; a failure is data, not a lost job.

    Retryable failures are tried again with doubled waits of up to 30 % jitter,
    an unreadable reply is asked for once more; after *breaker* failures in a row
    a task stops calling, marks the rows, and probes again after *rest* seconds.
    *rate* is that of the whole job: each of the tasks that can run at once gets
    its share. Runs in mapInPandas, so that a plan holds the calls once. Write
    the result before using it twice.
    """
    schema = T.StructType([df.schema[key], T.StructField("value", T.StringType()), T.StructField("error", T.StringType()), T.StructField("tries", T.IntegerType()), T.StructField("fault", T._parse_datatype_string(FAULT))])
    side_by_side = max(1, df.sparkSession.sparkContext.defaultParallelism)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limit = Limiter(rate / side_by_side) if rate else None
        gate = Breaker(breaker, rest)
        for pdf in it:
            rows = []
            for t in pdf[text]:
                if not gate.lets():
                    rows.append((None, "circuit open", 0, ("circuit", None, True, "circuit open")))
                    continue
                rows.append(_one(call, t, tries, base_wait, limit))
                gate.note(rows[-1][1] is not None)
            out = pd.DataFrame(rows, columns=["value", "error", "tries", "fault"])
            out["fault"] = [None if f is None else dict(zip(("kind", "status", "retryable", "message"), f)) for f in out["fault"]]
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    return df.select(key, text).mapInPandas(run, schema)


def cached_run(requests: DataFrame, cache: DataFrame, key: str, text: str, call: Callable[[str], str]) -> tuple[DataFrame, DataFrame]:
    """(results of all requests, rows to append to the cache): only what the cache lacks is called, once per key.

    The calls' results are a written table, so that using both makes no call
    twice. Of entries that share a key the first by value counts; an entry
    without a value is none.
    """
    known = cache.filter(F.col("value").isNotNull()).groupBy(key).agg(F.min("value").alias("value"))
    misses = requests.join(known.select(key), key, "left_anti").dropDuplicates([key])
    fresh = materialize(run_model(misses, key, text, call), "fresh-calls").filter(F.col("error").isNull()).select(key, "value")
    return requests.join(known.unionByName(fresh), key, "left"), fresh


def quarantined(runs: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, role, kind, message): the failures of all roles' runs, one row per key and role."""
    parts = [r.filter(F.col("fault").isNotNull()).select(key, F.lit(role).alias("role"), F.col("fault.kind").alias("kind"), F.col("fault.message").alias("message")) for role, r in sorted(runs.items())]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy(key, "role").agg(F.min(F.struct("kind", "message")).alias("f")).select(key, "role", "f.*")


def configured(roles: dict[str, Endpoint | None]) -> tuple[dict[str, Endpoint], list[str]]:
    """(roles that can be called, roles that are skipped as they have no endpoint)."""
    return {k: e for k, e in roles.items() if e is not None}, sorted(k for k, e in roles.items() if e is None)
