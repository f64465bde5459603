"""Text predicates and transformations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framefold.constants import DEFAULT_MIME, TITLE_LIMIT


WHITESPACE = " \t\n\r\f\v"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def starts(c, text: str) -> Column:
    """Prefix test; a missing value counts as empty text."""
    return F.coalesce(col(c), F.lit("")).startswith(text)


def ends(c, text: str) -> Column:
    return F.coalesce(col(c), F.lit("")).endswith(text)


def has(c, text: str) -> Column:
    return F.coalesce(col(c), F.lit("")).contains(text)


def replace_all(c, old: str, new: str) -> Column:
    return F.replace(col(c), F.lit(old), F.lit(new))


def keep_chars(c, char_class: str = r"\p{L}\p{N}_.\-") -> Column:
    """Drop every character outside ``char_class``."""
    return F.regexp_replace(col(c), f"[^{char_class}]", "")


def strip_chars(c, char_class: str) -> Column:
    """Drop every character inside ``char_class`` and trim."""
    return F.trim(F.regexp_replace(col(c), f"[{char_class}]", ""), F.lit(WHITESPACE))


def truncate(c, n: int) -> Column:
    return F.left(col(c), F.lit(n))


def segment(c, sep: str, index: int) -> Column:
    """Segment of a separated text, 1-based from the left or -1-based from the right.

    NULL when the text has too few segments.
    """
    return F.try_element_at(F.split(col(c), _quoted(sep)), F.lit(index))


def segment_count(c, sep: str) -> Column:
    return F.size(F.split(col(c), _quoted(sep)))


def _quoted(sep: str) -> str:
    return "".join(f"[{ch}]" if ch not in "^\\" else f"\\{ch}" for ch in sep)


def case_fold(c, mode: str) -> Column:
    c = col(c)
    if mode == "lower":
        return F.lower(c)
    if mode == "upper":
        return F.upper(c)
    if mode == "trim":
        return F.trim(c, F.lit(WHITESPACE))
    if mode == "capitalise":
        return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))
    raise ValueError(f"unknown mode {mode!r}")


def build(*parts, sep: str = "") -> Column:
    """Join texts; NULL parts make the result NULL, as string building on a missing part should."""
    cols = [col(p) for p in parts]
    if not sep:
        return F.concat(*cols)
    joined = [cols[0]]
    for c in cols[1:]:
        joined += [F.lit(sep), c]
    return F.concat(*joined)


def default_if_empty(c, default) -> Column:
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default))


def to_text(c) -> Column:
    return col(c).cast("string")


def to_int(c) -> Column:
    """Integer of a text or number, NULL where it is none."""
    return col(c).try_cast("bigint")


def infer_ext(mime, url) -> Column:
    """File extension: mp4 if either text mentions it, else webm, else mp4."""
    mime = F.coalesce(col(mime), F.lit(DEFAULT_MIME))
    return (
        F.when(has(mime, "mp4") | has(url, "mp4"), "mp4")
        .when(has(mime, "webm") | has(url, "webm"), "webm")
        .otherwise("mp4")
    )


def safe_title(c) -> Column:
    """Title as a file-name part: no namespace, no blanks, letters/digits/_-. only."""
    plain = replace_all(replace_all(c, "File:", ""), " ", "_")
    return truncate(keep_chars(plain), TITLE_LIMIT)


def normalize_campaign(custom, selected) -> Column:
    """A typed campaign, lower-cased and trimmed, else the selected one."""
    typed = F.trim(F.lower(col(custom)), F.lit(WHITESPACE))
    return F.when(typed != "", typed).otherwise(col(selected))
