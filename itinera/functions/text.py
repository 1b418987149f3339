"""Text expressions with the source system's semantics made explicit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INT32_MAX = 2147483647


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x, upper: bool = False) -> Column:
    """ltrim(rtrim(x)); optionally upper-cased (keys compare case-blind)."""
    c = F.trim(_c(x))
    return F.upper(c) if upper else c


def fit(x, n: int) -> Column:
    """Cut text to a column width (oversize text is cut silently)."""
    return F.substring(_c(x), 1, n)


def tsql_substring(x, start, length) -> Column:
    """substring(x, start, n) where a start <= 0 shortens the result
    instead of counting from the end."""
    start = start if isinstance(start, Column) else F.lit(start)
    length = length if isinstance(length, Column) else F.lit(length)
    eff_len = F.when(start < 1, length + start - 1).otherwise(length)
    return F.when(eff_len <= 0, F.lit("")).otherwise(
        F.substring(_c(x), F.greatest(start, F.lit(1)), eff_len))


def like_regex(pattern: Column) -> Column:
    """The regular expression of a LIKE pattern with character classes, itself a column: rule
    tables hold patterns as data.  ``%`` any text, ``_`` one character, ``[a-x0-9]`` one of a
    class, ``[^..]`` one outside it; everything else stands for itself, in a class as well
    (``[[]`` is a bracket).  A bracket that is never closed matches nothing."""
    token = F.regexp_extract_all(pattern, F.lit(r"(?s)(\[\^?[^\]]+\]|.)"), 1)

    def one(t: Column) -> Column:
        negated = t.startswith("[^") & (F.length(t) > 3)
        inside = F.when(negated, F.substring(t, F.lit(3), F.length(t) - 3)).otherwise(F.substring(t, F.lit(2), F.length(t) - 2))
        inside = F.regexp_replace(inside, r"([\[\\&^])", r"\\$1")
        return (F.when(t == "%", ".*").when(t == "_", ".").when(t == "[", "(?!)")
                .when(F.length(t) > 1, F.concat(F.when(negated, "[^").otherwise("["), inside, F.lit("]")))
                .otherwise(F.regexp_replace(t, r"([.$*+?(){}|\\^\]])", r"\\$1")))
    return F.concat(F.lit(r"(?s)\A"), F.array_join(F.transform(token, one), ""), F.lit(r"\z"))


def like_class(x, pattern: str) -> Column:
    """LIKE with character classes ([0-9], [^0-9])."""
    return F.regexp_like(_c(x), like_regex(F.lit(pattern)))


def is_int32_text(x) -> Column:
    """True when the text is digits only and fits a signed 32-bit int."""
    c = _c(x)
    return (c.rlike("^[0-9]+$")
            & F.coalesce(c.try_cast("decimal(38,0)") <= F.lit(INT32_MAX), F.lit(False)))


def int32_or_null(x) -> Column:
    c = _c(x)
    return F.when(is_int32_text(c), c.try_cast("int"))


def is_numeric_text(x) -> Column:
    """The accepted set of a numeric test: optional sign, digits with an
    optional decimal point, optional exponent."""
    return _c(x).rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")


def to_money(x) -> Column:
    """Text to money: empty text is 0, ',' is a decimal comma, bad text null."""
    c = F.trim(_c(x))
    return (F.when(c == "", F.lit(0).cast("decimal(19,4)"))
            .otherwise(F.regexp_replace(c, ",", ".").try_cast("decimal(19,4)")))


def last_token(x, sep: str) -> Column:
    """Text after the last separator; the whole text when there is none."""
    return F.substring_index(_c(x), sep, -1)


def mask_card(x) -> tuple[Column, Column]:
    """(first 6, last 4) of a card number; the caller drops the full number."""
    c = F.trim(_c(x))
    return F.left(c, F.lit(6)), F.right(c, F.lit(4))


def hhmm_minutes(x, default=None) -> Column:
    """HHMM text (00:00-23:59) to minutes after midnight; other text gives
    ``default``."""
    c = _c(x)
    ok = c.rlike("^([01][0-9]|2[0-3])[0-5][0-9]$")
    mins = F.substring(c, 1, 2).cast("int") * 60 + F.substring(c, 3, 2).cast("int")
    d = default if isinstance(default, Column) else F.lit(default).cast("int")
    return F.when(ok, mins).otherwise(d)


def clean_department_name(x) -> Column:
    """Department name as a join key: punctuation removed, blanks squeezed,
    trimmed and upper-cased (the source function body is absent; this rule
    is ours)."""
    c = F.regexp_replace(_c(x), "[^0-9A-Za-z ]", "")
    return F.upper(F.trim(F.regexp_replace(c, " +", " ")))
