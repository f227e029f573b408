"""Text, URL, typing and display helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the surrogate key: text for a NULL field and the joining mark.
NULL_MARK = "_null_"
KEY_SEPARATOR = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(cols) -> Column:
    """MD5 over the fields as text; a NULL field differs from an empty one."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts).cast("binary"))


def slugify(text) -> Column:
    """Lower case, runs of blanks and dashes to ``_``, other marks dropped, ``_`` before a digit."""
    words = F.regexp_replace(F.lower(_col(text)), "[ -]+", "_")
    clean = F.regexp_replace(words, "[^a-z0-9_]+", "")
    return F.regexp_replace(clean, "^(?=[0-9])", "_")


def slug(text: str) -> str:
    """Driver-side :func:`slugify` for column names."""
    clean = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", (text or "").lower()))
    return f"_{clean}" if clean[:1].isdigit() else clean


def _strip_scheme(url, schemes) -> Column:
    out = _col(url)
    for scheme in schemes:
        out = F.replace(out, F.lit(scheme), F.lit(""))
    return out


def url_host(url) -> Column:
    """Host (with any port): scheme dropped, cut at the first ``/`` or ``?``."""
    bare = _strip_scheme(url, ("android-app://", "http://", "https://"))
    return F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(url) -> Column:
    """Text after the first ``/`` up to ``?``.

    Without a slash it starts at ``?`` (so the path is empty); with neither, the whole
    text is returned.
    """
    bare = _strip_scheme(url, ("http://", "https://"))
    slash = F.instr(bare, "/")
    query = F.instr(bare, "?")
    rest = (
        F.when(slash > 0, F.substr(bare, slash + 1))
        .when(query > 0, F.substr(bare, query))
        .otherwise(bare)
    )
    return F.split_part(rest, F.lit("?"), F.lit(1))


def url_parameter(url, name: str) -> Column:
    """Text between ``name=`` and the next ``&``; NULL when absent or empty.

    It is a plain text search: ``ref`` also matches inside ``xref=``, and a trailing
    ``#fragment`` stays.
    """
    after = F.split_part(_col(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(after, F.lit("&"), F.lit(1)), F.lit(""))


# Words read as missing, and the shapes of whole and real numbers.
MISSING_WORDS = ("", "none", "null")
INT_PATTERN = r"^[+-]?[0-9]+$"
REAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity|nan)$"


def lenient_value(text) -> Column:
    """Struct ``(kind, whole, real, text)``: missing word -> null, else int, real or trimmed text.

    Whole numbers too long for a bigint fall through to ``real``.
    """
    raw = F.trim(_col(text))
    missing = raw.isNull() | F.lower(raw).isin(*MISSING_WORDS)
    whole = F.when(~missing & raw.rlike(INT_PATTERN), raw.try_cast("bigint"))
    real = F.when(
        ~missing & whole.isNull() & (raw.rlike(INT_PATTERN) | raw.rlike(REAL_PATTERN)),
        raw.try_cast("double"),
    )
    plain = F.when(~missing & whole.isNull() & real.isNull(), raw)
    kind = (
        F.when(missing, "null")
        .when(whole.isNotNull(), "int")
        .when(real.isNotNull(), "real")
        .otherwise("text")
    )
    return F.struct(kind.alias("kind"), whole.alias("whole"), real.alias("real"), plain.alias("text"))


def display_value(value, style: str) -> Column:
    """Text shown for a metric: ``$1,234``, ``12.3%`` or a plain number; ``N/A`` for NULL."""
    value = _col(value)
    if style == "currency":
        shown = F.concat(F.lit("$"), F.format_number(F.floor(value + 0.5), 0))
    elif style == "percent":
        # format_string prints NULL as text, so it is kept away from it.
        shown = F.when(
            value.isNotNull(), F.concat(F.format_string("%.1f", value.cast("double")), F.lit("%"))
        )
    else:
        shown = F.format_number(value, "#,##0.###")
    return F.coalesce(shown, F.lit("N/A"))


def legend_labels(low, high, style: str) -> Column:
    """Struct ``(low, high)`` of legend texts; the upper end carries a ``+``."""
    return F.struct(
        display_value(low, style).alias("low"),
        F.concat(display_value(high, style), F.lit("+")).alias("high"),
    )
