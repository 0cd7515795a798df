"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust scores.

Only DataFrame functions: each kind's pattern splits the text into matches and the gaps between
them, whose lengths give the offsets (code points, end exclusive). Base kinds (email, ip, card,
phone) need their checks only; they always stay. Further kinds start from a prior score, which a
checksum or a nearby word raises and a contrary word lowers; spans of at least MIN_SCORE that touch
no base span stay.

Defined cases: a null text is empty; a text may match any number of times (offsets are summed in
chunks, not from the start for each match); repeated rows each get their own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

BASE = ("email", "ip", "card", "phone")
EXTRA = ("iban", "secret", "local_phone", "ssn")
MIN_SCORE = 0.5
CONTEXT = 40  # code points to either side
SHORTEST = 8  # code points of the shortest match of a further kind
PIECE = 256  # code points of a piece of text in redaction
CHUNK = 64

# Fixed values. Possessive and with a look-behind at run starts, so that no run is scanned from each of its characters;
# they match what the plain greedy patterns match. \G lets a match start where the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?=[A-Z])(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?=[0-9a-fA-F])(?<![0-9A-Za-z])[0-9a-fA-F]{32,128}(?![0-9A-Za-z])",
    "local_phone": r"(?=[0-9])(?<![0-9+.-])(?:[0-9]{3}[-.\x20])?[0-9]{3}[-.][0-9]{4}(?![0-9.-])",
    "ssn": r"(?=[0-9])(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# What a text must contain for a pattern to be tried; a cheap test that never rejects a match.
GUARDS = {"email": "@", "phone": "+"}
# kind: (prior, words that raise, words that lower); a raise is +0.4, a lowering is -0.3.
CONTEXT_WORDS = {
    "iban": (0.2, r"\b(?:iban|account|konto|compte|cuenta|bank)\b", r"\b(?:serial|isbn|order)\b"),
    "secret": (0.2, r"(?:token|secret|password|passwd|api[_-]?key|\bkey\b)", r"\b(?:commit|sha1|sha256|checksum|digest)\b"),
    "local_phone": (0.2, r"\b(?:phone|tel|telephone|call|fax|mobile|cell|contact)\b", r"\b(?:isbn|order|version|part)\b"),
    "ssn": (0.2, r"\b(?:ssn|social security|tax id|taxpayer)\b", r"\b(?:part|serial|order|isbn)\b"),
}
RAISE, LOWER, CHECKSUM = 0.4, 0.3, 0.6


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits passes Luhn's check."""
    value = lambda c, i: F.when(i % 2 == 0, c).otherwise(c * 2 - F.when(c > 4, 9).otherwise(0))
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: let(c.cast("int"), lambda d: value(d, i)))
    return F.aggregate(each, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def mod97(value: Column) -> Column:
    """True if the rearranged account number is 1 modulo 97."""
    clean = F.regexp_replace(value, "\\x20", "")
    turned = F.concat(F.substring(clean, F.lit(5), F.length(clean)), F.substring(clean, 1, 4))
    step = lambda acc, c: F.when(F.ascii(c) >= 65, (acc * 100 + F.ascii(c) - 55) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _sides(i: Column, parts: Column) -> tuple[Column, Column]:
    """CONTEXT code points of the text before and after match i, neighbouring matches included. parts: as _parts."""
    reach = 2 * -(-CONTEXT // SHORTEST)  # so many matches and their gaps cover the context
    first = F.greatest(F.lit(1), 2 * i + 1 - reach)
    before, after = F.slice(parts, first, 2 * i + 2 - first), F.slice(parts, 2 * i + 3, F.lit(reach + 1))
    return F.right(F.array_join(before, ""), F.lit(CONTEXT)), F.left(F.array_join(after, ""), F.lit(CONTEXT))


def _parts(gaps: Column, found: Column) -> Column:
    """gap, match, gap, ..., gap; long gaps are cut to the context of their two neighbours."""
    short = lambda g: F.when(F.length(g) > 2 * CONTEXT, F.concat(F.left(g, F.lit(CONTEXT)), F.right(g, F.lit(CONTEXT)))).otherwise(g)
    return F.flatten(F.transform(gaps, lambda g, i: F.filter(F.array(short(g), F.get(found, i)), lambda x: x.isNotNull())))


def _located(gaps: Column, found: Column, context: bool) -> Column:
    """array<struct<start, end, value, before, after>> from the gaps around and the texts of all matches; before and after only with context."""
    last = F.size(found) - 1
    lens = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(F.get(found, i)).alias("size"), i.alias("i")))
    chunked = lambda all_: F.transform(F.sequence(F.lit(0), F.floor(last / CHUNK).cast("int")), lambda k: F.slice(all_, k * CHUNK + 1, F.lit(CHUNK)))
    total = lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + x["gap"] + x["size"])
    row = lambda acc, x: F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end"), x["i"].alias("i"))
    begin = lambda at: F.struct(at.alias("at"), F.array().cast("array<struct<start:int,end:int,i:int>>").alias("out"))
    walk = lambda acc, x: F.struct((acc["at"] + x["gap"] + x["size"]).alias("at"), F.concat(acc["out"], F.array(row(acc, x))).alias("out"))
    before = lambda totals, k: F.aggregate(F.slice(totals, F.lit(1), k), F.lit(0), lambda acc, x: acc + x)
    place = lambda chunks, totals: F.flatten(F.transform(chunks, lambda c, k: F.aggregate(c, begin(before(totals, k)), walk)["out"]))
    placed = let(lens, lambda all_: let(chunked(all_), lambda chunks: let(F.transform(chunks, total), lambda totals: place(chunks, totals))))
    plain = lambda s: [s["start"].alias("start"), s["end"].alias("end"), F.get(found, s["i"]).alias("value")]
    if not context:
        return F.transform(placed, lambda s: F.struct(*plain(s)))
    sided = lambda s, parts: F.struct(*plain(s), *[c.alias(n) for c, n in zip(_sides(s["i"], parts), ("before", "after"))])
    return let(_parts(gaps, found), lambda parts: F.transform(placed, lambda s: sided(s, parts)))


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}")
    if kind == "card":
        return let(_digits(v), lambda d: (F.length(d) >= 14) & (F.length(d) <= 19) & luhn(d))
    if kind == "phone":
        return F.length(_digits(v)).between(10, 15)
    return F.lit(True)


def _score(kind: str, s: Column) -> Column:
    if kind in BASE:
        return F.lit(1.0)
    prior, up, down = CONTEXT_WORDS[kind]
    near = F.lower(F.concat(s["before"], F.lit(" "), s["after"]))
    score = let(near, lambda n: F.lit(prior) + F.when(n.rlike(up), RAISE).otherwise(0.0) - F.when(n.rlike(down), LOWER).otherwise(0.0))
    return score + F.when(mod97(s["value"]), CHECKSUM).otherwise(-prior - RAISE) if kind == "iban" else score


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def _spans_of(kind: str, t: Column) -> Column:
    rank = (BASE + EXTRA).index(kind)
    none = F.array().cast(SPAN)
    found = F.regexp_extract_all(t, F.lit(PATTERNS[kind]), F.lit(0))
    entry = lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), _score(kind, s).alias("score"))
    located = lambda f: let(F.split(t, PATTERNS[kind], -1), lambda gaps: _located(gaps, f, kind in EXTRA))
    spans = let(found, lambda f: F.when(F.size(f) > 0, F.transform(F.filter(located(f), lambda s: _valid(kind, s["value"])), entry).cast(SPAN)).otherwise(none))
    return F.when(F.contains(t, F.lit(GUARDS[kind])), spans).otherwise(none) if kind in GUARDS else spans


def spans_of(text: Column) -> Column:
    """array<struct<start, rank, end, kind, score>> sorted by start, then kind as listed (rank)."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    apart = lambda e, base: ~F.exists(base, lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"]))
    both = lambda base, extra: F.when(F.size(extra) > 0, F.array_sort(F.concat(base, F.filter(extra, lambda e: apart(e, base))))).otherwise(F.array_sort(base))
    scored = F.filter(F.concat(*[_spans_of(k, t) for k in EXTRA]), lambda s: s["score"] >= MIN_SCORE)
    return let(F.concat(*[_spans_of(k, t) for k in BASE]), lambda base: let(scored, lambda extra: both(base, extra)))


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """docs with the column `out` as spans_of."""
    return docs.withColumn(out, spans_of(F.col(f"`{text}`")))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["rank"] < len(BASE))


def digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_extra of each row."""
    found = find_spans(docs.select("doc_id", F.col(f"`{text}`").alias("text")), "text", "found").drop("text")
    count = lambda k: F.size(F.filter(F.col("found"), lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(spans_text(base_spans(F.col("found"))), 256).alias("base_sha256"), spans_text(F.col("found")).alias("spans"), F.size(F.filter("found", lambda s: s["rank"] >= len(BASE))).cast("long").alias("n_extra"))


def _running_max(values: Column) -> Column:
    """For each of the values (array<int>), the greatest before it, 0 at the first. In chunks, so the cost of growing arrays is bounded."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")), lambda k: F.slice(values, k * CHUNK + 1, F.lit(CHUNK)))
    begin = lambda tops, k: F.struct(F.coalesce(F.array_max(F.slice(tops, F.lit(1), k)), F.lit(0)).alias("m"), F.array().cast("array<int>").alias("out"))
    walk = lambda acc, x: F.struct(F.greatest(acc["m"], x).alias("m"), F.concat(acc["out"], F.array(acc["m"])).alias("out"))
    ran = lambda c, tops: F.flatten(F.transform(c, lambda chunk, k: F.aggregate(chunk, begin(tops, k), walk)["out"]))
    return F.when(F.size(values) > 0, let(chunks, lambda c: let(F.transform(c, lambda chunk: F.array_max(chunk)), lambda tops: ran(c, tops)))).otherwise(values)


def redacted(text: Column, spans: Column) -> Column:
    """text with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    A span that starts before the end of an earlier one belongs to that one's group; a group's first span knows where the
    group before it ends. The text between groups is cut from pieces of PIECE code points, so each is read once."""
    ends = F.transform(spans, lambda s: s["end"])
    first_of = lambda reach: F.filter(F.zip_with(spans, reach, lambda s, r: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), r.alias("after"))), lambda x: x["start"] >= x["after"])
    within = lambda parts, a, b: F.array_join(F.slice(parts, F.floor(a / PIECE).cast("int") + 1, (F.floor(b / PIECE) - F.floor(a / PIECE)).cast("int") + 1), "").substr(a % PIECE + 1, b - a)
    put = lambda parts, x: F.concat(within(parts, x["after"], x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
    rest = lambda parts: within(parts, F.array_max(ends), F.length(text))
    built = lambda parts: F.concat(F.array_join(F.transform(first_of(_running_max(ends)), lambda x: put(parts, x)), ""), rest(parts))
    return F.when(F.size(spans) > 0, let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), built)).otherwise(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with all spans of `text` redacted; other columns as they were. Null texts stay null."""
    t = F.col(f"`{text}`")
    return docs.withColumn(text, let(spans_of(t), lambda s: redacted(t, s)))
