"""Column expressions with the domain's meaning; all stay inside whole-stage code generation where Spark allows it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SEVERITY_ORDER = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "NONE", "UNKNOWN")
PLACEHOLDER_VENDORS = ("", "n/a", "na", "unknown", "none")
PLACEHOLDER_PRODUCTS = ("n/a", "n\\a", "na", "unknown", "none", "not applicable", "-", "")
DEGENERATE_SLUGS = ("", "*", "-", "n\\/a", "other")
DEGENERATE_CPE_PARTS = ("", "*", "-", "n/a", "n\\a", "other")
PATCH_TAGS = ("vendor-advisory", "patch", "mitigation", "x_refsource_CONFIRM", "x_refsource_REDHAT")
POC_TAGS = ("exploit", "x_refsource_EXPLOIT-DB", "signature")
MAX_LIMIT = 100


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def not_blank(c: str | Column) -> Column:
    """True where there is more than spaces; false for null."""
    return F.coalesce(F.trim(col(c)), F.lit("")) != ""


def unset(c: str | Column, label: str = "(unset)") -> Column:
    return F.coalesce(blank_to_null(c), F.lit(label))


def timestamp(c: str | Column) -> Column:
    """ISO date or date-time text as a UTC timestamp; anything else is null."""
    t = strip(c)
    return F.coalesce(F.try_to_timestamp(F.regexp_replace(t, r"Z$", "+00:00")), F.try_to_timestamp(t))


def day(c: str | Column) -> Column:
    """The date of the first ten characters; null if they are none."""
    return F.try_to_timestamp(F.substring(strip(c), 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def in_window(c: str | Column, low: str | None = None, high: str | None = None) -> Column:
    """Rows with a non-blank date whose first ten characters lie within [low, high]; open ends allowed."""
    keep = not_blank(c)
    head = F.substring(F.trim(col(c)), 1, 10)
    if low:
        keep = keep & (head >= low)
    return keep & (head <= high) if high else keep


def year_key(c: str | Column) -> Column:
    return F.date_format(timestamp(c), "yyyy")


def month_key(c: str | Column) -> Column:
    return F.date_format(timestamp(c), "yyyy-MM")


def week_key(c: str | Column) -> Column:
    """yyyy-WW with weeks from Monday, 00 before the first Monday of the year."""
    d = timestamp(c)
    week = F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7)
    return F.concat(F.date_format(d, "yyyy"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


def severity_bucket(score: str | Column) -> Column:
    """Of a highest score, when read: null is UNKNOWN, 0 is NONE."""
    s = col(score)
    return F.when(s.isNull(), "UNKNOWN").when(s >= 9, "CRITICAL").when(s >= 7, "HIGH").when(s >= 4, "MEDIUM").when(s > 0, "LOW").otherwise("NONE")


def severity_on_write(declared: str | Column, score: str | Column) -> Column:
    """The declared name if known, else by score; here a score of 0 or less is UNKNOWN."""
    d, s = F.upper(strip(declared)), F.coalesce(col(score), F.lit(0.0))
    by_score = F.when(s <= 0, "UNKNOWN").when(s >= 9, "CRITICAL").when(s >= 7, "HIGH").when(s >= 4, "MEDIUM").otherwise("LOW")
    return F.when(d.isin("CRITICAL", "HIGH", "MEDIUM", "LOW", "NONE"), d).otherwise(by_score)


def epss_decile(score: str | Column) -> Column:
    s = col(score)
    return F.when(s >= 1, 9).when(s < 0, 0).otherwise((s * 10).cast("int"))


def due_bucket(due: str | Column, today: str) -> Column:
    left = F.datediff(day(due), F.lit(today).cast("date"))
    return F.when(~not_blank(due) | left.isNull(), "No due date").when(left < 0, "Overdue").when(left <= 30, "Due in 30 days").when(left <= 90, "Due in 90 days").otherwise("Due later")


def whole_days(later: Column, earlier: Column) -> Column:
    """Days between timestamps, truncated toward zero."""
    return ((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(86_400_000_000.0)).cast("int")


def contains_ci(c: str | Column, term: str, wildcards: bool = False) -> Column:
    """Case-insensitive substring; with wildcards, % and _ in the term match as in LIKE."""
    low = F.lower(col(c))
    return low.like(f"%{term.lower()}%") if wildcards else low.contains(term.lower())


def clamp_limit(n: int) -> int:
    return max(1, min(MAX_LIMIT, int(n)))


def canonical_id(text: str) -> str:
    return text.strip().upper()


def cpe_slug(criteria: str | Column) -> Column:
    """The vendor part of a 2.3 criterion up to the next colon, escaped or not; empty if malformed."""
    return F.regexp_extract(col(criteria), r"^cpe:2\.3:.:([^:]*):", 1)


def is_cpe(criteria: str | Column) -> Column:
    return col(criteria).like("cpe:2.3:_:%")


def cpe_parts(criteria: str | Column) -> Column:
    """struct<vendor, product> with quoting undone and folded to lower case; null if short or degenerate."""
    parts = F.split(col(criteria), r"(?<!\\):")
    clean = lambda i: F.lower(strip(F.regexp_replace(F.get(parts, i), r"\\(.)", "$1")))
    ok = (F.size(parts) >= 5) & ~clean(3).isin(*DEGENERATE_CPE_PARTS) & ~clean(4).isin(*DEGENERATE_CPE_PARTS)
    return F.when(ok, F.struct(clean(3).alias("vendor"), clean(4).alias("product")))


def humanise(slug: str | Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(col(slug), "_", " "), r"\s+", " "))


def norm_key(name: str | Column) -> Column:
    return F.regexp_replace(F.lower(col(name)), "[^a-z0-9]", "")


def is_placeholder_vendor(name: str | Column) -> Column:
    return F.lower(strip(F.coalesce(col(name), F.lit("")))).isin(*PLACEHOLDER_VENDORS)


def is_placeholder_product(name: str | Column) -> Column:
    return F.lower(strip(F.coalesce(col(name), F.lit("")))).isin(*PLACEHOLDER_PRODUCTS)


def extract_all(text: str | Column, pattern: str) -> Column:
    """Sorted distinct upper-cased matches."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(pattern), F.lit(0)), F.upper)))


CVE_ID = r"(?i)CVE-\d{4}-\d{4,}"


def first_english(descriptions: Column) -> Column:
    """value of the first entry whose lang is exactly en in any case, else of the first entry, else empty."""
    english = F.get(F.filter(descriptions, lambda x: F.lower(x["lang"]) == "en"), F.lit(0))["value"]
    return F.coalesce(english, F.get(descriptions, F.lit(0))["value"], F.lit(""))
