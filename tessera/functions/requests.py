"""Messages out of a text model's replies, and small texts around calls, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.gate import let, user_meta
from .text import strip

# Bounds of an acceptable message; leads that a reply puts before it.
REQUEST, FOLLOW_UP = (12, 900), (6, 400)
LEADS = ("User:", "Message:", "Request:", "user:", "Here is", "Here's")
QUOTED = r'"([^"]{12,600})"'
KEY_PREFIXES = {"nvapi-": "nvidia", "sk-or-": "openrouter"}
# End of fixed values.


def unquoted(c: Column) -> Column:
    return strip(F.trim(strip(c), F.lit('"')))


def acceptable(c: Column, product: str = "product", bounds: tuple[int, int] = REQUEST) -> Column:
    """Whether a message is of a sensible length and does not talk about the writing task."""
    return F.length(c).between(*bounds) & ~c.rlike(user_meta(product))


def candidates(c: Column, product: str = "product") -> Column:
    """Guesses at the message in a reply, best first, once each: a single clean paragraph, quoted
    spans from the longest, clean paragraphs, the whole."""

    def longest_first(spans: Column) -> Column:
        return F.array_sort(spans, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).otherwise(0))

    def over(text: Column) -> Column:
        paragraphs = F.filter(F.transform(F.split(text, "\n\n"), strip), lambda p: (p != "") & ~p.rlike(user_meta(product)))
        single = lambda own: F.when(F.size(own) == 1, own).otherwise(F.slice(own, 1, 0))
        quoted = longest_first(F.regexp_extract_all(text, F.lit(QUOTED), F.lit(1)))
        return let(paragraphs, lambda own: F.concat(single(own), quoted, own, F.array(text)))

    return F.array_distinct(F.filter(F.transform(let(c, over), unquoted), lambda x: x != ""))


def tidy_request(c: Column, product: str = "product", bounds: tuple[int, int] = REQUEST) -> Column:
    """The message in a text model's reply, null if none of its parts is acceptable."""
    own = unquoted(F.coalesce(c, F.lit("")))
    for lead in LEADS:
        after = F.trim(strip(F.regexp_replace(own, r"^[^:]*:", "")), F.lit('"'))
        own = F.when(own.startswith(lead), after).otherwise(own)
    return F.get(F.filter(candidates(own, product), lambda x: acceptable(x, product, bounds)), F.lit(0))


def first_hit(table: list[tuple[float, str]], draws: Column) -> Column:
    """The first text whose probability is above its own uniform draw (an array, one for each);
    null if none is."""
    out = None
    for k, (probability, text) in enumerate(table):
        hit = F.get(draws, F.lit(k)) < probability
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out


def think_block(reasoning: Column) -> Column:
    """Reasoning as the block that leads an answer; nothing where there is none."""
    return F.when(F.coalesce(reasoning, F.lit("")) != "", F.concat(F.lit("<think>\n"), strip(reasoning), F.lit("\n</think>\n\n"))).otherwise("")


def call_envelope(name: Column, arguments: Column, call_id: Column) -> Column:
    """A call as messages hold it; arguments: JSON text, or a value that becomes it."""
    return F.struct(call_id.alias("id"), F.lit("function").alias("type"), F.struct(name.alias("name"), arguments.alias("arguments")).alias("function"))


def change_text(values: Column) -> Column:
    """New values (a map of texts) in words that name no record number."""

    def one(e: Column) -> Column:
        link = e["key"].endswith("_id") & e["value"].rlike("^-?[0-9]+$")
        role = F.replace(F.regexp_replace(e["key"], "_id$", ""), F.lit("_"), F.lit(" "))
        plain = F.when(e["value"].rlike(r"^-?[0-9]+(\.[0-9]+)?$"), e["value"]).otherwise(F.concat(F.lit("'"), e["value"], F.lit("'")))
        return F.when(link, F.concat(role, F.lit(" should be a different one (do not name a number)"))).otherwise(F.concat(e["key"], F.lit(" becomes "), plain))

    return F.array_join(F.transform(F.map_entries(values), one), ", ")


def base_key(key: Column) -> Column:
    """The weight that an adapter's matrix changes; null for other names."""
    stem = F.regexp_replace(F.regexp_replace(key, r"(?s)\.lora_.*$", ""), r"^base_model\.(?:model\.)?", "")
    return F.when(key.contains(".lora_A.") | key.contains(".lora_B."), F.concat(stem, F.lit(".weight")))


def title_of(field: Column) -> Column:
    """A column's label: without the suffix of a link, words capitalised."""
    return F.initcap(F.replace(F.regexp_replace(field, "_ids?$", ""), F.lit("_"), F.lit(" ")))


def provider_of(key: Column) -> Column:
    """Whose key it is, by how it begins; null if nobody's."""
    out = None
    for prefix, name in KEY_PREFIXES.items():
        out = F.when(key.startswith(prefix), name) if out is None else out.when(key.startswith(prefix), name)
    return out


def wrong_tools(to_state: Column, prefix: str = "tool_") -> Column:
    """Calls that would seem to do what a method does, and why they do not."""
    write = F.concat(F.lit(f"`{prefix}write` on the state, to '"), to_state, F.lit("' (skips what the method does besides)"))
    return F.array_join(F.array_compact(F.array(write, F.lit(f"`{prefix}unlink` (removes the record, which then has no state at all)"))), "; ")
