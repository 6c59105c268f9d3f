"""Text safety over columns: fences and role tags, injection rules, personal data, report fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import bands

# The rules' patterns (read without regard to case), labels and severities.
INJECTION = [
    (r"\bignore (?:all )?previous (?:instructions?|prompts?)\b", "instruction_override", 90),
    (r"\bdisregard (?:all )?previous\b", "instruction_override", 80),
    (r"\b(?:new|updated) instructions?\s*[:.]", "instruction_takeover", 70),
    (r"\bdelete (?:all )?(?:files|data|projects|history)\b", "destructive_command", 95),
    (r"\bdrop (?:all )?(?:tables?|databases?)\b", "destructive_command", 95),
    (r"\brm\s+-rf\b", "destructive_command", 100),
    (r"\bexec(?:ute)?\b.*\bsystem\b", "command_execution", 80),
    (r"<\s*(?:script|iframe|object)\b", "html_injection", 60),
    (r"</?(?:system|assistant|tool|instructions?)\b", "fake_role_tag", 70),
    (r"\bact as\b.*\b(?:admin|root|sudo)\b", "privilege_escalation", 80),
    (r"\bjailbreak\b|\bDAN\b", "jailbreak_attempt", 75),
]
# What is taken for personal data, in the order of replacement, and the marks.
PERSONAL = [
    (r"[\w.+-]+@[\w-]+\.[\w.-]+", "[REDACTED_EMAIL]"),
    (r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "[REDACTED_IP]"),
    (r"(?i)\b[a-f0-9]{32,}\b", "[REDACTED_HEX_KEY]"),
    (r"\b\d{8,}\b", "[REDACTED_NUMBER]"),
]
#: What a text must have for each pattern to match.
PERSONAL_TESTS = ("@", r"\p{Nd}\.\p{Nd}", "[a-fA-F0-9]{32}", r"\p{Nd}{8}")
SEVERITY = [("<", 50, "low_concern"), ("<", 80, "medium_concern"), ("<", 95, "high_concern")]
#: One of these is in every match, in lower case: a cheap test that spares most texts the rules. Letters of which Unicode has other cases are left out.
MARKERS = ("gnore", "regard", "truct", "delete", "drop", "-rf", "exec", "<", "act a", "lbrea")
#: No regard to case, words and spaces of Unicode, and a line that ends at a line feed alone.
FLAGS = "(?iUd)"
HITS = "array<struct<rule:string,rule_no:int,severity:int,matches:bigint,first_match:string,position:bigint>>"
#: Characters of a match that are kept.
SHOWN = 120
# The names of role tags.
ROLE_TAG = r"(?i)<(/?(?:system|assistant|user|tool|instructions?))>"


def sanitize(text: Column, redact_pii: bool = False) -> Column:
    """Breaks code fences with a zero-width space and escapes role tags; then, if asked, redacts personal data."""
    out = F.regexp_replace(text, "```", "``​`")
    out = F.regexp_replace(out, ROLE_TAG, "&lt;$1&gt;")
    return redact(out) if redact_pii else out


def redact(text: Column) -> Column:
    """Personal data replaced by marks; words and digits are those of Unicode.

    Each pattern has a plain test without which it cannot match: most texts have no ``@`` and no long run of digits, and skip the search for
    word borders. Marks have brackets around them, so a replacement never makes a later test true, and all tests read the text as it came.
    """
    out = text
    for (pattern, mark), test in zip(PERSONAL, PERSONAL_TESTS):
        found = F.contains(text, F.lit(test)) if len(test) == 1 else text.rlike(test)
        out = F.when(found, F.regexp_replace(out, f"(?U){pattern}", mark.replace("$", r"\$"))).otherwise(out)
    return out


def over_strings(value: Column, kind: T.DataType, f) -> Column:
    """``f`` on every string inside a column of any nesting; the schema is walked, not the data."""
    if isinstance(kind, T.StringType):
        return f(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: over_strings(x, kind.elementType, f))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: over_strings(x, kind.valueType, f))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(over_strings(value[n.name], n.dataType, f).alias(n.name) for n in kind.fields)))
    return value


def injection_hits(text: Column) -> Column:
    """Array of (rule, rule_no, severity, matches, first_match, position) of the rules that match a text: how often, and where first (from 0)."""
    t = F.coalesce(text, F.lit(""))

    def hit(k: int, pattern: str, label: str, severity: int) -> Column:
        p = F.lit(FLAGS + pattern)
        return F.struct(
            F.lit(label).alias("rule"), F.lit(k).alias("rule_no"), F.lit(severity).alias("severity"), F.regexp_count(t, p).cast("long").alias("matches"),
            F.left(F.regexp_substr(t, p), F.lit(SHOWN)).alias("first_match"), (F.regexp_instr(t, p) - 1).cast("long").alias("position"),
        )

    found = F.array(*(F.when(t.rlike(FLAGS + p), hit(k, p, label, severity)) for k, (p, label, severity) in enumerate(INJECTION)))
    low = F.lower(t)
    quick = F.contains(low, F.lit("dan")) & low.rlike(r"(?<![a-z])dan(?![a-z])")
    for marker in MARKERS:
        quick = F.contains(low, F.lit(marker)) | quick
    return F.when(quick, F.array_compact(found)).otherwise(F.array().cast(HITS))


def injections(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """A row a rule that matches a text: keys, then the columns of ``injection_hits``. Texts without any match give none."""
    return rows.select(*keys, F.inline(injection_hits(F.col(text))))


def injection_verdicts(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Per row the number of matches, the largest severity and the verdict; one projection, so rows that repeat a key stay apart."""
    out = rows.select(*keys, injection_hits(F.col(text)).alias("_hits"))
    matches, severity = F.aggregate("_hits", F.lit(0).cast("long"), lambda n, x: n + x["matches"]), F.coalesce(F.array_max(F.transform("_hits", lambda x: x["severity"])), F.lit(0))
    out = out.select(*keys, matches.alias("matches"), severity.alias("severity"))
    return out.withColumn("verdict", F.when(F.col("matches") == 0, "clean").otherwise(bands(F.col("severity"), SEVERITY, "critical_concern")))


def plain(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"\s+", " "))


def field(text: Column, labels: list[str]) -> Column:
    """Number after the first label of ``labels`` that has one; a decimal comma is read as a point."""
    at = [F.regexp_extract(text, rf"\b{label}\s*:?\s*(-?\d+(?:[.,]\d+)?)", 1) for label in labels]
    raw = F.coalesce(*(F.nullif(x, F.lit("")) for x in at))
    return F.translate(raw, ",", ".").try_cast("double")
