"""Value-repair and labelling expressions (``Column -> Column``).

Every function here builds a Catalyst expression; nothing runs Python per row.
Null behaviour follows the studied cleaning steps: a null input stays null
unless the step says otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- strings (B1)

def strip(col) -> Column:
    """Remove leading/trailing whitespace, Unicode spaces included (like ``str.strip``)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def title_case(col) -> Column:
    """Python ``str.title``: upper-case a cased character that follows an uncased one.

    ``initcap`` only splits on spaces, so ``o'hare`` and ``2nd`` differ; here the
    text is cut into runs of cased characters (Unicode upper, lower, title
    case) and the rest, and each run is capitalised (uncased runs are left
    as they are by upper/lower).
    """
    cased = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"
    runs = F.regexp_extract_all(_c(col), F.lit(f"([{cased}]+|[^{cased}]+)"), 1)

    def cap(r):
        # title case of the first character = first char of its upper-case form,
        # rest of that form lower-cased (so "\u00df" -> "Ss", "\ufb01" -> "Fi")
        up = F.upper(F.substring(r, 1, 1))
        return F.concat(F.substring(up, 1, 1), F.lower(F.substring(up, 2, 1 << 30)),
                        F.lower(F.substring(r, 2, 1 << 30)))

    return F.array_join(F.transform(runs, cap), "")


def standardize_string(col, strip_ws: bool = True, title: bool = False, upper: bool = False) -> Column:
    """B1: strip, then title case, then upper case; null stays null."""
    out = _c(col)
    if strip_ws:
        out = strip(out)
    if title:
        out = title_case(out)
    if upper:
        out = F.upper(out)
    return out


# ---------------------------------------------------------------- dates (B2)

#: Text forms of a date or date-time that are understood, first match wins.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSSSSS", "yyyy-MM-dd HH:mm",
                "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ssXXX",
                "yyyy/MM/dd", "MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss")


#: Further forms, told by their shape so that a value is tried with one of them at most: compact, unpadded and textual dates.
DATE_SHAPES = ((r"^\d{8}$", "yyyyMMdd"), (r"^\d{14}$", "yyyyMMddHHmmss"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
               (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}$", "yyyy-M-d H:mm"),
               (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy-M-d H:mm:ss"), (r"^\d{1,2} \p{L}{3} \d{4}$", "d MMM yyyy"),
               (r"^\d{1,2}-\p{L}{3}-\d{4}$", "d-MMM-yyyy"), (r"^\d{1,2} \p{L}{4,} \d{4}$", "d MMMM yyyy"), (r"^\p{L}{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
               (r"^\p{L}{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"))


def _may_read(text: Column, form: str) -> Column:
    """False only for texts that ``form`` can't read: one of its separators is missing, or it knows no time of day and the text has one."""
    marks = sorted(set(re.sub(r"[A-Za-z]", "", form)) - {"'"} | set("".join(re.findall(r"'([^']*)'", form))))
    has = [F.contains(text, F.lit(m)) for m in marks] + ([] if ":" in marks else [~F.contains(text, F.lit(":"))])
    return reduce(and_, has)


def parse_timestamp(col, formats: Sequence[str] = DATE_FORMATS, shapes: Sequence[tuple[str, str]] = DATE_SHAPES) -> Column:
    """Lenient parse of text, a date or a timestamp (whose text form has its fraction) to a timestamp.

    The first of ``formats`` that reads the value wins; otherwise the value's shape names the format.  A format isn't tried
    on text without its separators, as every failed trial costs an exception.
    """
    c = F.trim(_c(col).cast("string"))
    by_shape = None
    for pattern, form in shapes:
        hit, value = c.rlike(pattern), F.try_to_timestamp(F.initcap(c) if "MMM" in form else c, F.lit(form))
        by_shape = F.when(hit, value) if by_shape is None else by_shape.when(hit, value)
    tried = [F.when(_may_read(c, f), F.try_to_timestamp(c, F.lit(f))) for f in formats]
    return F.coalesce(*tried, *([by_shape] if by_shape is not None else []))


def parse_date(col, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """B2: lenient parse to DATE; text that parses with none of the formats is null."""
    return F.to_date(parse_timestamp(col, formats))


def format_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_c(col), fmt)


def parse_and_format_date(col, formats: Sequence[str] = DATE_FORMATS,
                          out_fmt: str = "yyyy-MM-dd") -> Column:
    """B2 as in the reference: re-format parsable text, bad text becomes null."""
    return format_date(parse_date(col, formats), out_fmt)


# ---------------------------------------------------------------- value rules

def clip(col, lower, upper) -> Column:
    """B3 apply step: clip to [lower, upper]; bounds are Columns or numbers."""
    c = _c(col)
    lo = lower if isinstance(lower, Column) else F.lit(lower)
    hi = upper if isinstance(upper, Column) else F.lit(upper)
    return F.when(c.isNull(), c).otherwise(F.least(F.greatest(c, lo), hi))


def null_unless_match(col, pattern: str) -> Column:
    """Non-null values that do not match the anchored pattern become null."""
    c = _c(col)
    return F.when(c.isNull() | c.cast("string").rlike(pattern), c)


def null_unless_in(col, valid: Iterable) -> Column:
    """Values outside the valid set become null."""
    c = _c(col)
    return F.when(c.isNull() | c.isin(list(valid)), c)


def null_outside_range(col, lo=None, hi=None, fill=None) -> Column:
    """Values outside [lo, hi] are replaced by ``fill`` (null by default)."""
    c = _c(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    bad = F.coalesce(bad, F.lit(False))
    return F.when(bad, F.lit(fill)).otherwise(c)


def cancelled_air_time(cancelled, air_time) -> Column:
    """Cancelled (null counts as 0) and positive air time -> air time null."""
    a = _c(air_time)
    mask = (F.coalesce(_c(cancelled), F.lit(0)) > 0) & (a > 0)
    return F.when(F.coalesce(mask, F.lit(False)), F.lit(None)).otherwise(a)


def dew_point_swap(temp, dew) -> tuple[Column, Column]:
    """Where dew point exceeds temperature both values are swapped.

    Returns (new_temp, new_dew); use both in one ``select`` so the swap is
    simultaneous.
    """
    t, d = _c(temp), _c(dew)
    swap = F.coalesce(d > t, F.lit(False))
    return F.when(swap, d).otherwise(t), F.when(swap, t).otherwise(d)


def wind_gust_floor(spd, gust) -> Column:
    """A gust below the sustained wind is raised to it."""
    s, g = _c(spd), _c(gust)
    return F.when(s.isNotNull() & g.isNotNull() & (g < s), s).otherwise(g)


def cloud_cover_fix(cover, flags: Sequence = (), layer=None, layer_limit: float = 10_000) -> Column:
    """Cover 0 while a layer flag is 1 or the lowest layer is <= limit -> 1."""
    cv = _c(cover)
    active = F.lit(False)
    for f in flags:
        active = active | (F.coalesce(_c(f).cast("double"), F.lit(0.0)) == 1.0)
    if layer is not None:
        active = active | F.coalesce(_c(layer) <= F.lit(layer_limit), F.lit(False))
    return F.when(cv.isNotNull() & (cv == 0) & active, F.lit(1).cast("double")).otherwise(cv)


def snap_to_domain(col, values: Sequence[float]) -> Column:
    """Nearest allowed value, ties to the lower one; null stays null.

    ``array_min`` over (distance, value) structs orders by distance then value,
    which is exactly "nearest, tie to lower".  Guarded: without the guard a null
    input would snap to the smallest value.
    """
    c = _c(col).cast("double")
    vals = F.array(*[F.lit(float(v)) for v in sorted(values)])
    best = F.array_min(F.transform(vals, lambda v: F.struct(F.abs(v - c).alias("d"), v.alias("v"))))
    return F.when(c.isNotNull(), best["v"])


def clean_city(city, state_name=None, state_code=None) -> Column:
    """Drop the text after the last comma when it names the state.

    The suffix is compared with the state name and code after trimming,
    removing dots and lower-casing.
    """
    raw = strip(_c(city))

    def norm(x):
        return F.lower(F.regexp_replace(strip(x), r"\.", ""))

    base = F.regexp_extract(raw, r"^(.*),([^,]*)$", 1)
    suffix = norm(F.regexp_extract(raw, r"^(.*),([^,]*)$", 2))
    candidates = [norm(F.coalesce(_c(s).cast("string"), F.lit(""))) for s in (state_name, state_code) if s is not None]
    hit = F.lit(False)
    for cand in candidates:
        hit = hit | (suffix == cand)
    has_comma = raw.contains(",")
    return (F.when(raw.isNull(), raw)
            .when(has_comma & (suffix != "") & hit, strip(base))
            .otherwise(raw))


# ---------------------------------------------------------------- labels

# Fixed values that must equal the studied system's output: hour bands
# (0-3 Night, 4-7 Early Morning, 8-11 Morning, 12-15 Afternoon,
# 16-19 Evening, 20-23 Late Evening).
TIME_BANDS = ["Night", "Early Morning", "Morning", "Afternoon", "Evening", "Late Evening"]


def time_band(hour) -> Column:
    """Six four-hour bands; hours outside 0..23 fall in the last band."""
    h = _c(hour)
    return (F.when((h >= 0) & (h < 4), "Night").when((h >= 4) & (h < 8), "Early Morning")
            .when((h >= 8) & (h < 12), "Morning").when((h >= 12) & (h < 16), "Afternoon")
            .when((h >= 16) & (h < 20), "Evening").otherwise("Late Evening"))


def bucket(col, edges: Sequence[float], labels: Sequence[str], strict_null: bool = False,
           right_closed: bool = True, zero_label: str | None = None) -> Column:
    """Label buckets ``<= edge`` (or ``< edge``); null goes to the last label.

    ``zero_label`` adds an ``= 0`` bucket in front (visibility 0).
    """
    c = _c(col)
    expr = None
    if zero_label is not None:
        expr = F.when(c == 0, zero_label)
    for e, lab in zip(edges, labels):
        cond = (c <= e) if right_closed else (c < e)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    expr = expr.otherwise(labels[-1])
    if strict_null:
        return F.when(c.isNotNull(), expr)
    return expr


# Fixed values that must equal the dashboard fields: bucket edges and labels.
VISIBILITY_BUCKETS = ([2, 4, 6, 8, 10], ["0-2 mi", "2-4 mi", "4-6 mi", "6-8 mi", "8-10 mi", ">10 mi"], "0 mi")
GUST_BUCKETS = ([10, 20, 30], ["\u226410 kt", "10-20 kt", "20-30 kt", ">30 kt"])
TEMPERATURE_BUCKETS = ([-10, 0, 10, 20, 30],
                       ["\u2264 -10 \u00b0C", "-10 to 0 \u00b0C", "0 to 10 \u00b0C", "10 to 20 \u00b0C",
                        "20 to 30 \u00b0C", "> 30 \u00b0C"])
AGE_BUCKETS = ([6, 16, 31], ["0-5 yr", "6-15 yr", "16-30 yr", "31+ yr"])


def visibility_bucket(col, strict_null=False) -> Column:
    edges, labels, zero = VISIBILITY_BUCKETS
    return bucket(col, edges, labels, strict_null=strict_null, zero_label=zero)


def gust_bucket(col, strict_null=False) -> Column:
    edges, labels = GUST_BUCKETS
    return bucket(col, edges, labels, strict_null=strict_null)


def temperature_bucket(col, strict_null=False) -> Column:
    edges, labels = TEMPERATURE_BUCKETS
    return bucket(col, edges, labels, strict_null=strict_null)


def age_bucket(col, strict_null=False) -> Column:
    edges, labels = AGE_BUCKETS
    return bucket(col, edges, labels, strict_null=strict_null, right_closed=False)


def is_departed(reason) -> Column:
    """The cancellation reason reads "Not Cancelled"."""
    return F.coalesce(_c(reason) == F.lit("Not Cancelled"), F.lit(False))


def not_cancelled_filter(cancelled) -> Column:
    """``cancelled != 0`` where a null also passes (NaN != 0 in pandas)."""
    return ~_c(cancelled).eqNullSafe(F.lit(0))


def changed_mask(before, after) -> Column:
    """True where a non-null value was changed (null -> value counts as a fill)."""
    b, a = _c(before), _c(after)
    return F.coalesce(~b.eqNullSafe(a), F.lit(False))
