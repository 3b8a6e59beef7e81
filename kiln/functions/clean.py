"""Column -> Column cleaning functions.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage code generation; none is a Python UDF.  Raw input is text, and
every conversion uses the ``try_`` family so that one bad value becomes NULL
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from kiln.functions import constants as K


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_text(col: Column | str) -> Column:
    """Strip leading and trailing blanks."""
    return F.trim(_c(col))


def title_case(col: Column | str) -> Column:
    """Upper-case the first letter of every blank-separated word.

    ``initcap`` lower-cases the rest of each word; NULL stays NULL.
    """
    return F.initcap(_c(col))


def normalize_name(col: Column | str) -> Column:
    """Trim, then title-case (J1 + J2)."""
    return F.initcap(F.trim(_c(col)))


def fix_typo(col: Column | str, pattern: str = K.PRODUCT_TYPO[0],
             replacement: str = K.PRODUCT_TYPO[1]) -> Column:
    """Regex spelling fix; use ``(?i)`` in ``pattern`` for any case."""
    return F.regexp_replace(_c(col), pattern, replacement)


def strip_weekday(col: Column | str, pattern: str = K.WEEKDAY_PREFIX_PATTERN) -> Column:
    """Remove a leading ``Weekday,`` from a date text."""
    return F.regexp_replace(_c(col), pattern, "")


def extract_parenthesised(col: Column | str, pattern: str = K.PARENTHESISED_PATTERN) -> Column:
    """Text in the first parentheses; ``''`` when there is none."""
    return F.regexp_extract(_c(col), pattern, 1)


def hash_key(*cols: Column | str, sep: str = "|") -> Column:
    """SHA-256 hex business key over one or more text columns.

    One column hashes its text as is.  Several are joined with ``sep``; inside
    them ``sep`` and the backslash are escaped and NULL is written ``\\N``, so
    different tuples never give the same text.
    """
    parts = [_c(c).cast("string") for c in cols]
    if len(parts) == 1:
        return F.sha2(parts[0], 256)
    safe = [F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep)) for p in parts]
    return F.sha2(F.concat_ws(sep, *[F.coalesce(p, F.lit("\\N")) for p in safe]), 256)


def format_guard(fmt: str) -> str:
    """A regex every text that ``fmt`` can parse must match (necessary, not
    sufficient): numeric fields become digit runs, text fields letter runs,
    separators stay literal."""
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch == "'":
            k = fmt.index("'", i + 1)
            out.append(re.escape(fmt[i + 1:k]))
            j = k + 1
        elif ch == "y":
            out.append(r"\d{4,}" if run == 4 else r"\d+")
        elif ch in "Md" and not (ch == "M" and run >= 3):
            out.append(r"\d{1,2}")
        elif ch in "ME" or ch == "L":
            out.append(r"[A-Za-z]+")
        elif ch.isalpha():
            out.append(".+")
        elif ch.isspace():
            out.append(r"\s*")
        else:
            out.append(re.escape(ch * run))
        i = j
    return "^" + "".join(out) + "$"


def date_text(col: Column | str) -> Column:
    """A date text without blanks around it and without a weekday."""
    text = F.trim(_c(col).cast("string"))
    return F.when(text.contains(","), strip_weekday(text)).otherwise(text)


_MONTHS = {name.lower(): f"{k:02d}" for k, name in enumerate(
    "January February March April May June July August September October November December".split(), 1)}


def _plain_date(text: Column, fmt: str) -> Column | None:
    """``try_to_date(text, fmt)`` of texts that have the shape of ``fmt`` to the digit, by a cast of their parts; NULL for all others.

    For formats of ``yyyy``, ``dd`` and ``MM`` (or a leading ``MMMM``) between separators; None for another.
    """
    parts = re.findall(r"y+|M+|d+|[^A-Za-z'\[\]{}#]", fmt)
    fields = [p for p in parts if p.isalpha()]
    month = "MMMM" if parts[0] == "MMMM" and len(parts) > 1 and not parts[1].isalpha() else "MM"
    if "".join(parts) != fmt or sorted(fields) != sorted(["yyyy", month, "dd"]):
        return None
    digits = {"yyyy": r"\d{4}", "MM": r"\d{2}", "dd": r"\d{2}", "MMMM": "[A-Za-z]+"}
    shape = "^" + "".join(digits.get(p) or re.escape(p) for p in parts) + r"\z"
    at, end = {}, 0  # places from the end
    for p in reversed(parts):
        end += len(p)
        at[p] = F.substring(text, -end, len(p))
    if month == "MMMM":
        at[month] = F.try_element_at(_map_literal(_MONTHS), F.lower(F.substring_index(text, parts[1], 1)))
        like = text.rlike(shape)
    else:  # most texts of another format are told by a separator
        apart = [(i, p) for i, p in enumerate(parts) if not p.isalpha()]
        like = text.rlike(shape) if not apart else (
            (F.substring(text, 1 + len("".join(parts[:apart[0][0]])), 1) == apart[0][1]) & text.rlike(shape))
    iso = F.concat(at["yyyy"], F.lit("-"), at[month], F.lit("-"), at["dd"])
    return F.when(like, iso.try_cast("date"))


def parse_date(col: Column | str, formats: Iterable[str] = K.DATE_FORMATS,
               strip_prefix: bool = True) -> Column:
    """First format that parses wins; none parses -> NULL.

    A failed ``try_to_date`` costs a JVM exception and a parse by a pattern
    costs several casts, so each format is tried only on texts of its shape: by a cast of
    the parts (``_plain_date``), or by its pattern behind ``format_guard``.  Only texts that none of these attempts
    parses fall through to trying every format, which keeps the result identical to a plain
    ``coalesce`` over all formats.
    """
    formats = list(formats)
    text = date_text(col) if strip_prefix else F.trim(_c(col).cast("string"))

    def attempt(fmt: str) -> Column:
        plain = _plain_date(text, fmt)
        return F.when(text.rlike(format_guard(fmt)), F.try_to_date(text, fmt)) if plain is None else plain

    every = F.coalesce(*[F.try_to_date(text, f) for f in formats])
    return F.coalesce(*map(attempt, formats), every)


def sanitize_id(col: Column | str, sentinel: str = K.BAD_CUSTOMER_ID,
                pattern: str = K.NUMERIC_ID_PATTERN) -> Column:
    """Keep all-digit ids as text; anything else, NULL included, -> sentinel."""
    text = _c(col).cast("string")
    return F.when(text.rlike(pattern), text).otherwise(F.lit(sentinel))


def clean_number_abs(col: Column | str, pattern: str = K.NUMERIC_TEXT_PATTERN,
                     default: float = 0.0) -> Column:
    """Numeric text -> its absolute value as double; other text or NULL -> ``default``."""
    text = F.trim(_c(col).cast("string"))
    return F.when(text.rlike(pattern), F.abs(text.try_cast("double"))) \
        .otherwise(F.lit(default).cast("double"))


def to_double(col: Column | str) -> Column:
    """Text such as ``310`` or ``38.0`` -> double; bad text -> NULL."""
    return F.trim(_c(col).cast("string")).try_cast("double")


def _map_literal(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def map_values(col: Column | str, mapping: Mapping[str, str],
               case_insensitive: bool = False) -> Column:
    """Dictionary replace: mapped values are swapped, others kept.

    The map is a literal ``MapType`` lookup evaluated in the JVM.  With
    ``case_insensitive`` the keys are compared in lower case.
    """
    c = _c(col)
    if case_insensitive:
        lowered = {k.lower(): v for k, v in mapping.items()}
        return F.coalesce(F.try_element_at(_map_literal(lowered), F.lower(c)), c)
    # try_element_at: a missing key yields NULL, not an error, under ANSI
    return F.coalesce(F.try_element_at(_map_literal(mapping), c), c)


def allow_list(col: Column | str, allowed: Iterable[str]) -> Column:
    """Keep a value only if it is in ``allowed``; otherwise NULL."""
    c = _c(col)
    return F.when(c.isin(list(allowed)), c)


def map_category(col: Column | str, mapping: Mapping[str, str] = K.CATEGORY_TO_DIVISION) -> Column:
    """Chained ``when`` with no default: unmapped -> NULL."""
    c = _c(col)
    out = None
    for src, dst in mapping.items():
        out = F.when(c == src, dst) if out is None else out.when(c == src, dst)
    return out


def zero_flag(col: Column | str) -> Column:
    """1 when the value is zero, else 0."""
    return F.when(_c(col) == 0, 1).otherwise(0)


def month_start(col: Column | str) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_c(col), "month")
