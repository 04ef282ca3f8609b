"""Text parsing expressions (F10-F16, F32) and tokenisation for the text jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateau.functions.common import as_col

# Word tokens of two or more word characters, Unicode-aware, on lower-cased text.
TOKEN_PATTERN = r"(?U)\b\w\w+\b"


def parse_tags(c) -> Column:
    """Tags from a JSON list, a ','/'|'-delimited string, or whitespace-separated words;
    items trimmed, empty ones dropped; NULL -> [] (F12)."""
    t = F.trim(as_col(c).cast("string"))
    js = F.when(t.startswith("["), F.from_json(t, "array<string>"))
    parts = F.split(t, r"[,|]")
    parts = F.when(F.size(parts) == 1, F.split(t, r"\s+")).otherwise(parts)
    arr = F.coalesce(js, parts)
    cleaned = F.filter(F.transform(arr, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).otherwise(cleaned)


def sanitize_tag(c) -> Column:
    """lower, non-alphanumerics -> '_', collapse, strip '_', first 40 chars."""
    s = F.regexp_replace(F.lower(as_col(c)), r"[^a-z0-9]+", "_")
    s = F.regexp_replace(F.regexp_replace(s, r"_+", "_"), r"^_+|_+$", "")
    return F.substring(s, 1, 40)


def sanitize_col(c) -> Column:
    """Feature-column name sanitising: non [a-zA-Z0-9_] runs -> '_', first 60 chars."""
    return F.substring(F.regexp_replace(as_col(c), r"[^a-zA-Z0-9_]+", "_"), 1, 60)


def tags_preview(c, n: int = 5) -> Column:
    """Display form of a stored tag list: strip '[', ']' and quotes, split on ', ', first n
    joined by ', ' (F13)."""
    s = F.translate(as_col(c).cast("string"), "[]'", "")
    return F.array_join(F.slice(F.split(s, ", "), 1, n), ", ")


def truncate_text(c, n: int = 200) -> Column:
    """First n characters + '...' when longer than n (F16)."""
    s = as_col(c)
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("..."))).otherwise(s)


_INT = r"^[+-]?[0-9]+$"


def _trunc(v: Column) -> Column:
    """float -> int truncation toward zero; NaN/inf -> NULL."""
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(None)).otherwise(v).cast("bigint")


def parse_minutes(c) -> Column:
    """Cooking time text -> whole minutes.

    With both 'h' and 'm': integer hours before the first 'h' and integer minutes after it
    ('1h 30m' -> 90, '1h ' -> 60); only 'h': decimal hours truncated ('1.5h' -> 90); only
    'm': integer minutes ('30m' -> 30); else a number truncated ('30' -> 30). Empty or
    unparsable ('soon', '') -> NULL.
    """
    s = F.lower(F.trim(as_col(c).cast("string")))
    parts = F.split(s, "h")
    p0, p1 = F.trim(F.element_at(parts, 1)), F.element_at(parts, 2)
    rest = F.trim(F.regexp_replace(p1, "m", ""))
    mins = F.when(F.trim(p1) == "", F.lit(0)).when(rest.rlike(_INT), rest.cast("bigint"))
    both = F.when(p0.rlike(_INT), p0.cast("bigint") * 60 + mins)
    only_h = _trunc(F.trim(F.regexp_replace(s, "h", "")).try_cast("double") * 60)
    m_only = F.trim(F.regexp_replace(s, "m", ""))
    only_m = F.when(m_only.rlike(_INT), m_only.cast("bigint"))
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("bigint"))
            .when(s.contains("h") & s.contains("m"), both)
            .when(s.contains("h"), only_h)
            .when(s.contains("m"), only_m)
            .otherwise(_trunc(s.try_cast("double"))))


def parse_servings(c) -> Column:
    """Servings text -> whole number (truncated); invalid -> NULL."""
    return _trunc(F.trim(as_col(c).cast("string")).try_cast("double"))


def parse_list(c) -> Column:
    """A stored Python-style list of strings -> array, read as JSON, never evaluated (F32)."""
    return F.from_json(F.translate(as_col(c).cast("string"), "'", '"'), "array<string>")


def tokens(c) -> Column:
    """Lower-cased word tokens (>= 2 word characters)."""
    return F.regexp_extract_all(F.lower(F.coalesce(as_col(c).cast("string"), F.lit(""))),
                                F.lit(TOKEN_PATTERN), 0)


def ngrams_1_2(words: Column) -> Column:
    """Unigrams followed by adjacent-word bigrams."""
    n = F.size(words)
    bi = F.when(n >= 2, F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1),
                                   lambda a, b: F.concat(a, F.lit(" "), b))) \
        .otherwise(F.array().cast("array<string>"))
    return F.concat(words, bi)
