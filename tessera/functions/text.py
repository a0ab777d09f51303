"""Text functions over message contents, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = " \t\n\r"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACE))


def strip_think(c: Column) -> Column:
    """Text without <think> blocks."""
    return F.regexp_replace(c, r"(?s)<think>.*?</think>", "")


def normalise(c: Column) -> Column:
    """Lower case, digit runs as #, white space as single spaces: the key of near-duplicates."""
    low = F.regexp_replace(F.lower(c), r"[0-9]+", "#")
    return F.trim(F.regexp_replace(low, r"[ \t\n\r\f]+", " "))


def think_balance(c: Column) -> Column:
    """Opened minus closed think tags."""
    return F.regexp_count(c, F.lit("<think>")) - F.regexp_count(c, F.lit("</think>"))


def clean_reasoning(c: Column, directive: str, least: int = 150) -> Column:
    """struct(text, removed): sentences that match the directive pattern leave; what remains is
    dropped when shorter than `least`, and text without such sentences is untouched."""
    sentences = F.regexp_extract_all(c, F.lit(r"(?s)[^.!?\n]+(?:[.!?]+|\n|$)\s*"), F.lit(0))
    kept = F.filter(sentences, lambda s: ~s.rlike(directive))
    removed = F.size(sentences) - F.size(kept)
    joined = strip(F.array_join(kept, ""))
    text = F.when(removed == 0, c).when(F.length(joined) >= least, joined).otherwise("")
    return F.struct(text.alias("text"), removed.cast("bigint").alias("removed"))


def sample_key(version: Column, *parts: Column) -> Column:
    """24 hex digits of the joined parts' sha256."""
    return F.substring(F.sha2(F.concat_ws("|", version, *parts), 256), 1, 24)


def group_key(model: Column, method: Column) -> Column:
    return F.concat_ws("::", F.coalesce(model, F.lit("?")), F.coalesce(method, F.lit("?")))


def scrub_think(c: Column, directive: str, least: int = 150) -> Column:
    """struct(text, changed): clean_reasoning inside every think block, of which emptied ones go.
    Text between blocks stays as it is; an unclosed block is no block."""
    block = r"(?is)<think>.*?</think>"
    gaps, blocks = F.split(c, block, -1), F.regexp_extract_all(c, F.lit(block), F.lit(0))

    def cleaned(b: Column) -> Column:
        inner = clean_reasoning(F.regexp_replace(b, r"(?i)^<think>|</think>$", ""), directive, least)
        kept = F.when(inner["text"] == "", "").otherwise(F.concat(F.lit("<think>"), inner["text"], F.lit("</think>")))
        return F.when(inner["removed"] == 0, b).otherwise(kept)

    text = F.array_join(F.zip_with(gaps, F.transform(blocks, cleaned), lambda g, b: F.concat(g, F.coalesce(b, F.lit("")))), "")
    return F.struct(text.alias("text"), (text != c).alias("changed"))


#: Fixed value: a closing clause on an answer's last line.
CLOSING = r"\s*(?:Let me know if [^.\n]*\.?|I hope this helps\.?|Would you like me to [^?\n]*\?)\s*$"


def drop_chatty_tail(c: Column, chatty: str) -> Column:
    """Text without the lines at its end that match the pattern, a closing clause after them, and
    white space at the end."""
    bare = lambda x: F.rtrim(x, F.lit(SPACE))
    lines = F.split(bare(c), "\n")
    flags = F.transform(lines, lambda x: x.rlike(chatty))
    last = F.aggregate(F.sequence(F.lit(1), F.size(lines)), F.lit(0), lambda a, i: F.when(F.element_at(flags, i), a).otherwise(i))
    return bare(F.regexp_replace(bare(F.array_join(F.slice(lines, F.lit(1), last), "\n")), CLOSING, ""))


def split_reasoning(c: Column) -> Column:
    """struct(reasoning, answer): the first think block and the rest; without one the first third
    of the text counts as reasoning."""
    inside = F.regexp_extract(c, r"(?is)<think>(.*?)</think>", 1)
    third = F.floor(F.length(c) / 3).cast("int")
    has = c.rlike(r"(?is)<think>.*?</think>")
    reasoning = F.when(has, strip(inside)).otherwise(F.substring(c, F.lit(1), third))
    answer = F.when(has, strip(F.regexp_replace(c, r"(?is)^.*?<think>.*?</think>", ""))).otherwise(c)
    return F.struct(reasoning.alias("reasoning"), answer.alias("answer"))
