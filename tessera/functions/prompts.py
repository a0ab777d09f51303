"""Prompts for a text model that writes requests and answers, as Columns over a sample's context.

The words are our own; what each prompt must hold (who asks, what is known, what is wanted, in which
form) follows the kinds of samples.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .requests import first_hit

# How often a request is untidy, and in which way.
UNTIDY = ((0.14, "Make one small slip of the keyboard."), (0.10, "Write without capitals and with hardly a comma."), (0.08, "Begin in the middle of a thought."), (0.07, "Add a short remark about something else."))
# End of fixed values.

LENGTHS = {"terse": "One short sentence at most.", "normal": "One to three sentences.", "rambling": "Two to four sentences, with a worry that matters little."}
SHAPES = {
    "clarify": "Leave out what the other side needs to know, without noticing it.",
    "refuse_or_warn": "Ask as if it were an everyday matter.",
    "analysis": "Ask for a number or a short list, and for no change.",
    "explain": "Ask how it works, and for no change.",
    "multi_step": "Say where it should end, and leave the way there open.",
    "record_creation": "Ask for something new and give one or two details.",
    "record_update": "Ask for a correction of what is there, and name the record.",
    "state_write_refusal": "Speak of the status as of a cell that one fills in.",
}


def _choice(value: Column, texts: dict[str, str], default: str) -> Column:
    out = None
    for name, text in texts.items():
        out = F.when(value == name, text) if out is None else out.when(value == name, text)
    return out.otherwise(default)


def _lines(*parts) -> Column:
    """Parts joined by line ends; null ones are left out."""
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _told(label: str, value: Column) -> Column:
    return F.concat(F.lit(label + ": "), value)


def request_prompt(role: Column, style: Column, situation: Column, intent: Column, reference: Column, shape: Column, verbosity: Column, model: Column, draws: Column) -> Column:
    """For the message of a person; draws: four uniforms for how untidy it is."""
    return _lines(
        F.concat(F.lit("You are a "), role, F.lit(". "), style),
        _told("What happened", situation),
        _told("What you want", intent),
        _told("It concerns", reference),
        _choice(verbosity, LENGTHS, LENGTHS["normal"]),
        first_hit(list(UNTIDY), draws),
        _choice(shape, SHAPES, "Ask for what you want."),
        F.concat(F.lit("You have never heard of "), model, F.lit(", of methods, fields or record numbers.")),
        "Reply with your message alone.",
    )


def answer_prompt(label: Column, request: Column, transcript: Column, outcome: Column) -> Column:
    """For an agent's answer after its calls."""
    return _lines(_told("Request", request), _told("Calls and results", transcript), _told("Outcome", outcome), F.concat(F.lit("Report on the "), label, F.lit(" from these results and from nothing else, speaking to whoever asked.")))


def recovery_prompt(label: Column, request: Column, error: Column, hint: Column) -> Column:
    """For an answer to a call that was refused."""
    return _lines(_told("Request", request), _told("The system refused with", error), _told("What helps", hint), F.concat(F.lit("Say that the "), label, F.lit(" is as it was, why, and what would have to be done first.")))


def clarification_prompt(label: Column, request: Column, missing: Column) -> Column:
    """For a question back."""
    return _lines(_told("Request", request), _told("Not known", missing), F.concat(F.lit("Ask for what is not known about the "), label, F.lit(", in one question, before anything is done.")))


def analysis_prompt(label: Column, request: Column, query: Column, rows: Column) -> Column:
    """For an answer to a question about data."""
    return _lines(_told("Question", request), _told("What was read", query), _told("Rows", rows), F.concat(F.lit("Answer from these rows of "), label, F.lit("; if they do not hold the answer, say so.")))


def explain_prompt(label: Column, request: Column, schema: Column) -> Column:
    """For an explanation without calls."""
    return _lines(_told("Question", request), _told("What is known", schema), F.concat(F.lit("Explain how a "), label, F.lit(" behaves, from what is known alone.")))
