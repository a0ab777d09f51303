"""The quality gate: row predicates over a transcript, and first-wins duplicate removal.

Every predicate is a Column over a `messages` array of struct(role, content), so a gate is one
projection without a shuffle; duplicates need one shuffle on their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise, strip

# The gate's patterns and bounds.
MIN_USER, MIN_ANSWER, MAX_CHARS = 12, 120, 32768
TERMINALS = ".!?)]`:\"'*…—✓✅"
LIST_ITEM = r"(?U)^`?[\w.]+(?:\(\))?`?\s*[–—:-]\s+\S"
PROMPT_ARTIFACT = (
    r"(?i)\bScenario\s*#\d+|\bThey labeled this as\b|\bAs an AI\b|\bas an AI language model\b"
    r"|\bI don'?t have (?:the )?context for (?:previous|prior|earlier)\b|\bthe teacher (?:prompt|model|said)\b"
    r"|\bmy system prompt\b|\bWe need to respond as\b|\bthe user'?s (?:teacher|meta) prompt\b"
)
FABRICATED_REFERENCE = r"(?i)\b(?:INV|BILL|RINV|RBILL|SO|PO|POS|BNK\d?|MO|RO)[\-/](?:20[0-2]\d)[\-/]\d|\b(?:INV|BILL|SO|PO)[\-/]?(?:20[0-2]\d)\b"
REFERENCE_YEAR = "2026"
TEACHER_VOICE = r"(?i)\bthe user (?:asked|wants|is asking|said|requested|has requested)\b|\bWe need to (?:produce|provide|answer)\b"
PLACEHOLDER = r"^Sample .*#\d+$|^Sample Value$|^option1$|^Updated #\d+$"
STATE_CLAIM = (
    r"(?i)\b(?:state|status)\s+(?:is|was|has been (?:set|changed|updated))\s+(?:now\s+)?(?:to\s+|set to\s+)?[`'\"*]{0,2}([a-z_][a-z_ ]{1,24})[`'\"*]{0,2}"
    r"|\bis now in (?:the\s+)?(?:state|status)\s+[`'\"*]{0,2}([a-z_]{2,24})"
)
WRITE_CLAIM = (
    r"(?i)(?:^|[^a-zA-Z])I (?:have )?(?:confirmed|created|posted|updated|cancelled|canceled|deleted|validated|archived|changed|moved|assigned)"
    r"|(?:has|have|had) been (?:confirmed|created|posted|updated|cancelled|canceled|deleted|validated|archived|moved)"
    r"|successfully (?:confirmed|created|posted|updated|cancelled|deleted|validated)"
)
NEGATED = r"(?i)\b(?:no|not|never|nothing|without|cannot|can't|won't|isn't|aren't|hasn't|haven't|nor|neither|yet to be|before)\b[^.!?]{0,40}$"


def version_drift(product: str) -> str:
    """Mentions of releases 8 to 18 of the product."""
    return rf"(?i)\b{product}\s*(?:v\.?\s*)?(?:[89]|1[0-8])(?:\.\d)?\b|\bversion\s+(?:[89]|1[0-8])(?:\.\d)?\s+of\s+{product}\b"


def call_as_text(prefix: str) -> str:
    return rf"(?m)^\s*`?{prefix}(?:search_read|read_group|create|write|execute_method|unlink)\s*\("


def user_meta(product: str) -> str:
    """A user turn that talks about the writing task."""
    return (
        r"(?i)\bthe rules? (?:say|says|said|only forbids)\b|\bdo not (?:name the|describe steps|use phrases)\b|\bmust not (?:use|name|describe)\b"
        rf"|\bper the instruction\b|\bthe instruction says\b|\bas the persona\b|\brole-?play\b|\bthe {product} model\b|\btechnical name\b"
        r"|\boutput (?:only|just) (?:that|the message|the text)\b|\bno (?:quotation marks|label|preamble|extra formatting)\b"
        r"|\bwe need to (?:write|start mid-thought|finish the sentence)\b|\bwe need to (?:keep|avoid) (?:the reference|it to|naming|the word)\b"
        r"|\bmissing apostrophe\b|\binclude (?:a|one) small typo\b|\bthat'?s (?:one|two|three) (?:long )?sentences?\b"
        r"|\bcould add a third\b|\bcomma splice\b|\bLet'?s (?:count|do two sentences|write|draft)\b|\bso (?:maybe|we can|to be safe) \""
        r"|\bensure no extra\b|\\boxed\{"
    )


def instruction_echo(product: str) -> str:
    """Style directives rehearsed instead of followed."""
    return (
        r"(?im)\bno sign-?offs?\b|\bno emojis?\b|\b\d\s*(?:-|–|to)\s*\d\s+sentences\b|\bmust be (?:concrete|brief|short|useful and no more)\b"
        r"|\bno (?:fluff|padding|preamble)\b|\bno \"?let me know\"?\b|\bmust speak to the user\b"
        rf"|\b(?:without mentioning|not mention|never mention) {product}\b|\bas (?:instructed|per the instructions)\b"
        r"|\bthe (?:hard )?constraints? (?:say|require|state)\b|\bfollow(?:ing)? the (?:house )?rules\b"
        r"|\bWe need to (?:respond|reply|produce|write|answer|provide|explain|present)\b|\bWe also need to (?:present|provide|include|mention|show)\b"
        r"|\b(?:should|do) not make (?:a )?tool call\b|\bprovide (?:one or two|1-2) questions?\b|\boffer (?:the )?likely answer\b"
        r"|\bprovide (?:a )?step(?:-| )?by(?:-| )?step (?:plan|recovery)\b|\bprovide stepwise\b|\bend with (?:a )?step(?:-| )?by(?:-| )?step\b"
        r"|\buse clear language\b|\bpolitely,? then\b|\bSo (?:reply|answer|something like)\s*:|\bLet'?s craft\b"
        r"|\bmust not (?:mention|quote|say|state|fabricate|invent|include|use)\b|\bmust (?:report|say|mention|state|include|avoid|keep it|write)\b"
        r"|\bwrite (?:a )?concise reply\b|\bone sentence,? maybe two\b|\bwe (?:cannot|can'?t) state its status\b"
        r"|\bonly (?:have|got) (?:a )?success flag\b|\bnot returned by the (?:call|tool)\b"
        r"|^\s*(?:Keep (?:it )?concise|Be concise|Keep it short|No fluff)\.?\s*$"
    )


def prompt_leak(product: str) -> str:
    """Parts of the grounding block in an answer."""
    return (
        rf"(?im)===\s*{product} 19 MODEL TECHNICAL DEFINITION\s*===|\[MANDATORY REQUIRED FIELD\]|\[SELECTION OPTIONS:|^Model Technical Name:"
        r"|Extracted Fields & Constraints|Relational Edges:|\bUser request: '|\bTeacher prompt\b"
    )


def chatty(product: str) -> str:
    """Sign-offs."""
    return (
        rf"(?i)Happy (?:implementing|{product}|building|configuring)|Let me know if you(?:'d| would) like"
        r"|Would you like me to (?:elaborate|expand|continue|dive)|feel free to (?:ask|reach out)|I hope this helps|Good luck (?:with|on)|🚀|🎉|💡\s*$"
    )


def robotic(product: str) -> str:
    """User turns that are filled templates."""
    return (
        r"(?i)^Execute standard ERP database operation on|^Execute full multi-step business workflow|^Invoke MCP tool `"
        rf"|^Search and retrieve (?:active )?records from {product} model|^Update security policy and access rights configuration for"
        r"|^Execute manufacturing workflow operation for|^Manage inventory transfer and stock valuation for|^Process human resources record for"
        r"|^Configure project management stage and workflow settings for|^Update inventory catalog definition and pricing rules for"
        r"|^Create and initialize a new .* record for partner|^Verify database mutation and lock status for|^Confirm whether database record"
        r"|^Check if .* record .* has completed its state transition|^Call business method '"
        rf"|^Transition {product} .* from '.*' state to '.*' state|^Validate that {product} .* has been properly processed with state"
        rf"|^Verify whether {product} .* is .* in the database|^Provide a complete execution plan for an {product} business workflow from"
        rf"|^Perform full end-to-end management of {product} model|^I want to create a new .* record\.$|^Update {product} .* record ID \d+ with"
        rf"|^Create a new .* \(.*\) record in {product} with|^Post customer invoice \S+ for .+\.$|^Confirm sales order \S+ for .+\.$"
        r"|^Confirm purchase order \S+ from vendor .+\.$|^Validate warehouse delivery transfer \S+\.$|^Create partner record for '.*' with internal reference"
        r"|^Reverse posted customer invoice \S+\.$|^Register payment for invoice \S+\.$|^Send invoice \S+ via email and download PDF\.$"
        r"|^Approve employee leave request \S+\.$|^Confirm employee payslip \S+\.$|^Scrap damaged components for production order \S+\.$"
    )


# End of fixed values.


def contents(messages: Column, role: str) -> Column:
    return F.transform(F.filter(messages, lambda m: m["role"] == role), lambda m: F.coalesce(m["content"], F.lit("")))


def final_answer(messages: Column) -> Column:
    """The last assistant content that is not empty; empty if there is none."""
    said = F.filter(contents(messages, "assistant"), lambda c: c != "")
    return F.coalesce(F.try_element_at(said, F.lit(-1)), F.lit(""))


def malformed(messages: Column) -> Column:
    roles = F.transform(messages, lambda m: m["role"])
    known = F.forall(roles, lambda r: F.coalesce(r.isin("system", "user", "assistant", "tool"), F.lit(False)))
    return F.coalesce((F.size(messages) < 2) | ~known | ~F.array_contains(roles, "user") | ~F.array_contains(roles, "assistant"), F.lit(True))


def truncated(text: Column) -> Column:
    t = F.rtrim(text, F.lit(" \t\n\r"))
    last = F.right(t, F.lit(1))
    lines = F.filter(F.transform(F.split(t, "\n"), strip), lambda s: s != "")
    tail = strip(F.element_at(F.split(t, "\n"), -1))
    listed = (F.size(lines) >= 3) & tail.rlike(LIST_ITEM) & (F.size(F.filter(lines, lambda s: s.rlike(LIST_ITEM))) >= 3)
    marked = tail.rlike(r"^[|*#-]") & (F.length(tail) > 3)
    return (t == "") | ~(F.lit(TERMINALS).contains(last) | last.rlike(r"[\p{So}\p{Sk}]") | marked | listed)


def unnegated_write(text: Column) -> Column:
    """Whether a past-tense write is claimed that no negation shortly before undoes."""
    gaps = F.split(text, WRITE_CLAIM, -1)
    found = F.regexp_extract_all(text, F.lit(WRITE_CLAIM), F.lit(0))
    return F.exists(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("g"), found.alias("m")), lambda p: ~F.right(p["g"], F.lit(40)).rlike(NEGATED))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_wins(rows: DataFrame, order: str, exact: Column, near: Column) -> DataFrame:
    """rows with duplicate and near_duplicate flags: the first in `order` of equal keys stays; null
    keys equal each other and no text.  Keys are digests; each is one aggregate that combines before
    its shuffle, then a join."""
    digest = lambda c: F.coalesce(F.sha2(c, 256), F.lit("null"))
    keyed = rows.withColumns({"_exact": digest(exact), "_near": digest(near)})
    firsts = keyed.groupBy("_exact").agg(F.min(order).alias("_first"))
    nears = keyed.groupBy("_near").agg(F.min(order).alias("_lead"))
    out = keyed.join(firsts, "_exact").join(nears, "_near")
    dup = F.coalesce(F.col(order) > F.col("_first"), F.lit(False))
    close = F.coalesce(F.col(order) > F.col("_lead"), F.lit(False))
    return out.withColumns({"duplicate": dup, "near_duplicate": ~dup & close}).drop("_exact", "_near", "_first", "_lead")


def near_key(user: Column, answer: Column) -> Column:
    """What near-duplicate transcripts share: request and start of the answer, normalised."""
    return F.concat(normalise(user), F.lit("||"), normalise(F.substring(answer, 1, 600)))
