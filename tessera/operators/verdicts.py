"""The whole quality gate: all predicates of a transcript in one array, calls against the catalog,
and first-wins duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, strip_think, think_balance
from . import call_checks, gate

NAMES = (
    "orphan_tool_result", "thin_user_turn", "robotic_prompt", "user_turn_meta", "broken_think", "thin_assistant_turn", "truncated", "version_drift", "prompt_artifact",
    "instruction_echo", "prompt_leak", "chatty", "tool_call_as_text", "unsupported_state_claim", "fabricated_reference", "teacher_voice", "over_length", "claimed_unmade_write",
)


def reasons(messages: Column, product: str = "product", prefix: str = "tool_", *, wanted: tuple[str, ...] = NAMES, max_chars: int = gate.MAX_CHARS, allow_robotic: bool = False) -> Column:
    """Names of the failed predicates of a transcript, in order; `malformed` alone ends the check.

    An answer may be short or end anywhere where the last assistant turn makes a call; calls written
    as text count only where the transcript has calls.  wanted: the predicates to evaluate.  The
    turns' texts are put together once for all of them."""
    assistants = F.filter(messages, lambda m: m["role"] == "assistant")
    acts = F.coalesce(F.size(F.try_element_at(assistants, F.lit(-1))["tool_calls"]) > 0, F.lit(False))
    joined = F.array_join(gate.contents(messages, "assistant"), "\n")
    parts = F.struct(
        gate.contents(messages, "user").alias("users"), joined.alias("joined"), strip_think(joined).alias("spoken"), gate.final_answer(messages).alias("final"),
        acts.alias("acts"), (F.size(call_checks.calls(messages)) > 0).alias("calls"),
    )

    def found(p: Column) -> Column:
        references = lambda: F.regexp_extract_all(p["spoken"], F.lit(gate.FABRICATED_REFERENCE), F.lit(0))
        checks = {
            "orphan_tool_result": lambda: call_checks.orphan_results(messages),
            "thin_user_turn": lambda: F.length(strip(F.get(p["users"], F.lit(0)))) < gate.MIN_USER,
            "robotic_prompt": lambda: F.lit(False) if allow_robotic else F.exists(p["users"], lambda u: strip(u).rlike(gate.robotic(product))),
            "user_turn_meta": lambda: F.exists(p["users"], lambda u: u.rlike(gate.user_meta(product))),
            "broken_think": lambda: think_balance(p["joined"]) != 0,
            "thin_assistant_turn": lambda: ~p["acts"] & (F.length(strip(p["final"])) < gate.MIN_ANSWER),
            "truncated": lambda: ~p["acts"] & gate.truncated(p["final"]),
            "version_drift": lambda: p["joined"].rlike(gate.version_drift(product)),
            "prompt_artifact": lambda: p["joined"].rlike(gate.PROMPT_ARTIFACT),
            "instruction_echo": lambda: p["joined"].rlike(gate.instruction_echo(product)),
            "prompt_leak": lambda: p["joined"].rlike(gate.prompt_leak(product)),
            "chatty": lambda: p["final"].rlike(gate.chatty(product)),
            "tool_call_as_text": lambda: p["calls"] & p["spoken"].rlike(gate.call_as_text(prefix)),
            "unsupported_state_claim": lambda: call_checks.unsupported_state(messages),
            "fabricated_reference": lambda: F.exists(references(), lambda r: ~r.contains(gate.REFERENCE_YEAR)),
            "teacher_voice": lambda: p["spoken"].rlike(gate.TEACHER_VOICE),
            "over_length": lambda: call_checks.message_json_length(messages) > max_chars,
            "claimed_unmade_write": lambda: call_checks.unmade_write(messages, prefix),
        }
        return F.array_compact(F.array(*[F.when(checks[n](), F.lit(n)) for n in NAMES if n in wanted]))

    return F.when(gate.malformed(messages), F.array(F.lit("malformed"))).otherwise(gate.let(parts, found))


def judge(samples: DataFrame, key: str, order: str, methods: DataFrame | None = None, *, messages: str = "messages", product: str = "product", prefix: str = "tool_", max_chars: int = gate.MAX_CHARS, allow_robotic: bool = False) -> DataFrame:
    """samples with `reasons`: the transcript's, then those of its calls, then duplicate or
    near_duplicate.  Transcripts that are malformed neither are duplicates nor make others so; all
    others do, even if rejected for something else.  key is unique."""
    own = samples.withColumn("_own", reasons(F.col(messages), product, prefix, max_chars=max_chars, allow_robotic=allow_robotic))
    bad = F.array_contains("_own", "malformed")
    called = call_checks.call_reasons(samples, key, methods, messages, prefix).withColumnRenamed("reasons", "_calls")
    users = gate.contents(F.col(messages), "user")
    near = gate.near_key(F.get(users, F.lit(0)), gate.final_answer(F.col(messages)))
    sound = samples.where(~gate.malformed(F.col(messages)))
    flagged = gate.first_wins(sound.select(key, order, F.to_json(messages).alias("_e"), near.alias("_n")), order, F.col("_e"), F.col("_n"))
    flagged = flagged.select(key, F.when(F.col("duplicate"), "duplicate").when(F.col("near_duplicate"), "near_duplicate").alias("_copy"))
    out = own.join(called, key, "left").join(flagged, key, "left")
    more = F.when(bad, F.array().cast("array<string>")).otherwise(F.concat(F.coalesce("_calls", F.array().cast("array<string>")), F.array_compact(F.array("_copy"))))
    return out.withColumn("reasons", F.concat("_own", more)).drop("_own", "_calls", "_copy")
