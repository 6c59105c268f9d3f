"""Secret scans by expressions only: fixed patterns, and sliding-window entropy per character class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, free_name, text_of

# Fixed values of the contract: patterns and least lengths, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # matches are maximal, so a least length in the pattern drops the same ones
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

# Parameters of the entropy scan: window in characters, candidates, and bits by class of the candidate.
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{WINDOW},}}={{0,2}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
CLASSES = (("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.9), ("upper", r"^[A-Z0-9]+$", 3.2), ("lower", r"^[a-z0-9]+$", 3.4), ("mixed", r".", 3.6))
#: A candidate that matches one of these is no secret.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",  # UUID
    r"^sha(?:1|256|384|512)-",  # integrity attribute
    r"(?i)example|placeholder|your[_-]?(?:key|token)|x{6,}|0123456789",
    r"^[a-z]+(?:[/_-][a-z]+)*[/_-]?[0-9]{0,4}$",  # words and paths
)

#: Rows that a fold appends to one short array.
CHUNK = 256
_SPANS = "array<struct<start:int,end:int,value:string>>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often, and inside whatever lambda, it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _fold(rows: Column, kind: str, step) -> Column:
    """Array of what ``step`` makes of each row and the position reached before it; ``step`` gives (position after, array to append).

    Folded by CHUNK rows into short arrays, which are then appended whole: appending to one array row by row would be
    quadratic in the matches of a text.
    """
    empty = F.array().cast(kind)

    def one(acc: Column, x: Column) -> Column:
        at, more = step(acc["at"], x)
        return F.struct(at.alias("at"), F.concat(acc["out"], more).alias("out"))

    def chunk(acc: Column, i: Column) -> Column:
        part = F.aggregate(F.slice(rows, i * CHUNK + 1, CHUNK), F.struct(acc["at"].alias("at"), empty.alias("out")), one)
        return F.struct(part["at"].alias("at"), F.concat(acc["out"], part["out"]).alias("out"))

    count = F.greatest(F.lit(0), F.ceil(F.size(rows) / CHUNK).cast("int") - 1)  # an empty array is one empty chunk
    return F.aggregate(F.sequence(F.lit(0), count), F.struct(F.lit(0).alias("at"), empty.alias("out")), chunk)["out"]


def match_spans(text: Column, pattern: str, keep: int = 0) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches; value is group ``keep``.

    The pieces between the matches and the matches themselves give the places, in code points.
    """
    pieces, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = whole if keep == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(keep))
    rows = F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("p"), whole.alias("m"), values.alias("v"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["p"])
        end = start + F.length(x["m"])
        return end, F.array(F.struct(start.alias("start"), end.alias("end"), x["v"].alias("value")))

    return F.when(text.rlike(pattern), _bound(rows, lambda r: _fold(r, _SPANS, step))).otherwise(F.array().cast(_SPANS))


def _hot_windows(value: Column, bits: Column) -> Column:
    """Spans of ``value`` covered by windows of entropy ``bits`` or more, from counts that change by one character in and one out.

    With c the counts, the entropy of a window is log2(W) - sum(c log2 c) / W.
    """
    chars = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) + 1)  # places in the table of counts, 1 being any other character
    term = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))
    state = "struct<i:int,n:string,s:double,old:array<int>,out:array<struct<start:int,end:int>>>"
    # the table is a string: its k-th letter is A for a count of zero, B for one and so on, so that a change rewrites one letter
    zero = F.struct(F.lit(0), F.lit("A" * (len(ALPHABET) + 1)), F.lit(0.0), F.array().cast("array<int>"), F.array().cast("array<struct<start:int,end:int>>")).cast(state)
    count = lambda n, k: F.ascii(F.substr(n, k, F.lit(1))) - ord("A")
    changed = lambda n, k, by: F.overlay(n, F.char(count(n, k) + ord("A") + by), k, F.lit(1))

    def step(a: Column, c: Column) -> Column:
        full = F.size(a["old"]) >= WINDOW
        gone = F.element_at(a["old"], 1)
        less = F.when(full, changed(a["n"], gone, -1)).otherwise(a["n"])
        return _bound(less, lambda less: moved(a, c, full, gone, less))

    def moved(a: Column, c: Column, full: Column, gone: Column, less: Column) -> Column:
        was_in, was_out = count(less, c), F.when(full, count(a["n"], gone)).otherwise(F.lit(0))
        n = changed(less, c, 1)
        s = a["s"] - F.when(full, term(was_out) - term(was_out - 1)).otherwise(F.lit(0.0)) + term(was_in + 1) - term(was_in)
        old = F.concat(F.when(full, F.slice(a["old"], 2, WINDOW - 1)).otherwise(a["old"]), F.array(c))
        end = a["i"] + 1
        hot = (F.size(old) >= WINDOW) & (F.lit(WINDOW).cast("double") * (F.log2(F.lit(float(WINDOW))) - bits) >= s - 1e-9)
        start, last = end - WINDOW, F.try_element_at(a["out"], F.lit(-1))
        joined = F.concat(F.slice(a["out"], 1, F.greatest(F.size(a["out"]) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), end.alias("end"))))
        fresh = F.concat(a["out"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        out = F.when(~hot, a["out"]).when(last["end"] >= start, joined).otherwise(fresh)
        return F.struct(end, n, s, old, out).cast(state)

    return F.aggregate(chars, zero, step)["out"]


def entropy_spans(text: Column) -> Column:
    """Spans of high entropy inside candidate strings that no allow-list pattern suppresses."""
    found = F.filter(
        match_spans(text, CANDIDATE),
        lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]") & ~F.greatest(*(x["value"].rlike(p) for p in ALLOWED)),
    )

    def spans(x: Column) -> Column:
        bits = F.lit(CLASSES[-1][2])
        for _, pattern, b in reversed(CLASSES[:-1]):
            bits = F.when(x["value"].rlike(pattern), F.lit(b)).otherwise(bits)
        hot = _bound(bits, lambda b: _hot_windows(x["value"], b))
        return F.transform(hot, lambda w: F.struct((x["start"] + w["start"]).alias("start"), (x["start"] + w["end"]).alias("end")))

    return F.flatten(F.transform(found, spans))


def scan(docs: DataFrame, name: str = "spans") -> DataFrame:
    """``docs`` with column ``name``: all spans of all kinds, sorted by start, then kind as listed.

    A null text is empty and has none. Matching of base kinds is leftmost and non-overlapping per
    kind; an assign match spans from its keyword to the end of its value. Spans of different kinds may overlap.
    """
    text = text_of()

    def tagged(k: int, spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end")))

    assign = F.filter(match_spans(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= ASSIGN_LEAST)
    found = {"assign": assign, "access": match_spans(text, ACCESS), "hex": match_spans(text, HEX), "entropy": entropy_spans(text)}
    out = docs.withColumn(name, F.struct(*(c.alias(k) for k, c in found.items())))
    return out.withColumn(name, F.array_sort(F.concat(*(tagged(k, F.col(name)[kind]) for k, kind in enumerate(KINDS)))))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans, one row per document with a doc_id."""
    s = F.col("spans")
    count = lambda k: F.size(F.filter(s, lambda x: x["kind"] == k)).cast("long")
    return scan(docs.select("doc_id", "text").filter("doc_id is not null")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.filter(s, lambda x: x["kind"] < 3)), 256).alias("base_sha256"), _joined(s).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) in ``text`` replaced by ``mark`` (``n_chars``, if there, follows); other texts are unchanged.

    No row is dropped, whatever its doc_id; null and empty texts stay as they are, repeated rows get repeated results,
    and helper columns keep clear of the frame's own.
    """
    text = text_of()
    spans, new = free_name(docs, "_spans"), free_name(docs, "_new")

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        cut = F.array(F.substr(text, at + 1, x["start"] - at), F.lit(mark))
        return F.greatest(at, x["end"]), F.when(x["start"] >= at, cut).otherwise(F.array().cast("array<string>"))

    last = F.array_max(F.transform(F.col(spans), lambda x: x["end"]))
    done = F.concat(F.array_join(_bound(F.col(spans), lambda r: _fold(r, "array<string>", step)), ""), F.substr(text, last + 1))
    out = scan(docs, spans).withColumn(new, F.when(F.size(spans) > 0, done))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length(new).cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.withColumn("text", F.coalesce(new, "text")).drop(spans, new)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``report`` of all documents."""
    return report(documents(spark, sf_dir))
