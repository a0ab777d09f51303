"""Text providers: which endpoint may be asked, how outcomes park it, and how a streamed reply is
put together."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values, in seconds: delays after a saturated endpoint, a timeout, a refused key.
BASE_DELAY, MOST_DELAY, JITTER, MOST_DOUBLINGS = 2.0, 45.0, 0.4, 5
TIMEOUT_DELAY, MOST_TIMEOUT_DELAY = 30.0, 3600.0
REFUSED_DELAY, ATTEMPTS, TRUNCATIONS = 86400.0, 8, 2
# End of fixed values.


def outcome_of(error: Column) -> Column:
    """What an error message means: retired, saturated, timeout, refused, other; null is success."""
    low = F.lower(error)
    return (
        F.when(error.isNull(), "ok")
        .when((error.contains("410") & error.contains("Gone")) | low.contains("end of life"), "retired")
        .when(error.rlike("429|Too Many Requests|ResourceExhausted|request limit reached"), "saturated")
        .when(error.contains("Timeout") | low.contains("timed out"), "timeout")
        .when(error.rlike("401|invalid_api_key|No auth"), "refused")
        .otherwise("other")
    )


def cooldown(outcome: Column, attempt: Column, strikes: Column, jitter: Column) -> Column:
    """Seconds that an endpoint rests after an outcome: doubling with the attempt and up to 40 %
    more (jitter: a uniform) when saturated, doubling with each timeout in a row, a day for a
    refused key."""
    base = F.least(F.pow(F.lit(2.0), F.least(attempt, F.lit(MOST_DOUBLINGS))) * BASE_DELAY, F.lit(MOST_DELAY))
    return (
        F.when(outcome == "saturated", base * (1 + jitter * JITTER))
        .when(outcome == "timeout", F.least(F.pow(F.lit(2.0), strikes - 1) * TIMEOUT_DELAY, F.lit(MOST_TIMEOUT_DELAY)))
        .when(outcome == "refused", F.lit(REFUSED_DELAY))
        .otherwise(0.0)
    )


def endpoint_states(events: DataFrame) -> DataFrame:
    """(endpoint, retired, strikes, until) after a log of (endpoint, seq, at, outcome, attempt,
    jitter), at in seconds: whether it was retired, timeouts in a row, and until when the last
    outcome that parks it holds."""
    order = Window.partitionBy("endpoint").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wins = F.count_if(F.col("outcome") == "ok").over(order)
    runs = events.withColumn("_run", wins)
    within = Window.partitionBy("endpoint", "_run").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = runs.withColumn("_strikes", F.count_if(F.col("outcome") == "timeout").over(within))
    rest = cooldown(F.col("outcome"), F.col("attempt"), F.col("_strikes"), F.col("jitter"))
    parks = F.col("outcome").isin("saturated", "timeout", "refused")
    return counted.groupBy("endpoint").agg(
        F.bool_or(F.col("outcome") == "retired").alias("retired"),
        F.max_by("_strikes", "seq").alias("strikes"),
        F.coalesce(F.max_by(F.when(parks, F.col("at") + rest), F.when(parks, F.col("seq"))), F.lit(0.0)).alias("until"),
    )


def available(states: DataFrame, now: Column) -> DataFrame:
    """Endpoints that may be asked: none that is retired; those that do not rest, or else the one
    whose rest ends first.  One row for each endpoint there is, so a pool's size at most."""
    alive = states.where("not retired").withColumn("_free", F.col("until") <= now)
    soonest = alive.agg(F.bool_or("_free").alias("_any"), F.min_by("endpoint", F.struct("until", "endpoint")).alias("_soonest"))
    joined = alive.join(F.broadcast(soonest), F.when(F.col("_any"), F.col("_free")).otherwise(F.col("endpoint") == F.col("_soonest")))
    return joined.drop("_free", "_any", "_soonest")


def folded(deltas: DataFrame, request: str = "request", seq: str = "seq") -> DataFrame:
    """Replies from streamed parts (request, seq, reasoning, content, finish_reason): texts joined
    in order and stripped, empty ones null; a reply that holds only reasoning and no reason why it
    ended was cut off."""
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(F.col(seq), F.col(c).alias("t"))))), lambda p: p["t"]), "")
    whole = deltas.groupBy(request).agg(text("reasoning").alias("r"), text("content").alias("c"), F.max_by("finish_reason", F.when(F.col("finish_reason").isNotNull(), F.col(seq))).alias("f"))
    shown = lambda c: F.nullif(F.trim(F.col(c), F.lit(" \t\n\r")), F.lit(""))
    out = whole.select(request, shown("r").alias("reasoning"), shown("c").alias("content"), "f")
    cut = F.col("reasoning").isNotNull() & F.col("content").isNull()
    return out.select(request, "reasoning", "content", F.coalesce("f", F.when(cut, F.lit("length"))).alias("finish_reason"))


#: (system prompt, user prompt) to (reasoning, content)
Provider = Callable[[str, str], "tuple[str | None, str | None]"]


def canned(system: str, user: str) -> tuple[str | None, str | None]:
    """A provider for tests: repeats the last line it is given."""
    return None, user.rstrip().rsplit("\n", 1)[-1]


def ask(prompts: DataFrame, open_provider: Callable[[], Provider], *, system: str = "system", user: str = "user", attempts: int = ATTEMPTS, truncations: int = TRUNCATIONS) -> DataFrame:
    """prompts with reasoning, content and error: each row asks the provider that its task opens,
    again after an error up to `attempts` times, and gives up after so many empty replies."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema.fields if f.name not in ("reasoning", "content", "error")]
    names = [f.name for f in prompts.schema.fields if f.name not in ("reasoning", "content", "error")]

    def one(provider: Provider, s: str, u: str) -> tuple[str | None, str | None, str | None]:
        error, empty = None, 0
        for _ in range(attempts):
            try:
                reasoning, content = provider(s, u)
            except Exception as e:  # whatever a provider raises is what the row reports
                error = f"{type(e).__name__}: {e}"
                continue
            if content:
                return reasoning, content, None
            empty, error = empty + 1, "no content"
            if empty >= truncations:
                break
        return None, None, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = open_provider()
        for frame in frames:
            answers = [one(provider, s or "", u or "") for s, u in zip(frame[system], frame[user])]
            for k, name in enumerate(("reasoning", "content", "error")):
                frame[name] = pd.Series([a[k] for a in answers], index=frame.index, dtype=object)
            yield frame

    return prompts.select(*names).mapInPandas(run, ", ".join([*fields, "reasoning string", "content string", "error string"]))
