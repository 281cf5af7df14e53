"""Text expressions (Column -> Column), all JVM-side except one narrow branch.

Canonical text = NFKD, drop combining characters, lower-case, trim, collapse
whitespace. For Latin text with its typography (``_NATIVE``) this compiles to
``translate`` + ``lower`` + ``regexp_replace``, which stays inside whole-stage
codegen. The tables are generated from ``unicodedata`` at import time rather
than written out. Only values holding another character go to an Arrow-batched
pandas UDF that applies the exact Unicode rule; for every other row the UDF
receives a null, so the Python side is nearly free.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaprecon.plans.spec import FOLD
from snaprecon.plans.spec import canonical as _canonical_py

# Latin, combining accents, Vietnamese and other extended Latin, typographic punctuation, currency signs, f-ligatures
_NATIVE = ((0x0000, 0x024F), (0x0300, 0x036F), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x20A0, 0x20BF), (0xFB00, 0xFB06))


def _latin_fold_tables() -> tuple[str, str, list[tuple[str, str]]]:
    src, dst, multi = [], [], []
    for cp in (cp for first, last in _NATIVE for cp in range(max(first, 0x80), last + 1)):
        ch = chr(cp)
        folded = FOLD[cp]
        if folded == ch or not folded:
            continue
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        else:
            multi.append((ch, folded))
    return "".join(src), "".join(dst), multi


def _combining_chars() -> str:
    """The native characters that fold to nothing (deleted by ``translate``)."""
    return "".join(chr(cp) for first, last in _NATIVE for cp in range(first, last + 1) if not FOLD[cp])


_FOLD_SRC, _FOLD_DST, _FOLD_MULTI = _latin_fold_tables()
# one translate pass: single-letter folds first, then combining marks with no replacement (deleted)
_TRANSLATE_SRC = _FOLD_SRC + _combining_chars()
_MULTI_CLASS = "[" + "".join(f"\\x{{{ord(ch):04X}}}" for ch, _ in _FOLD_MULTI) + "]"
# Python's whitespace among the native characters
_WS = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}]+"
_OUTSIDE_LATIN = "[^" + "".join(f"\\x{{{first:X}}}-\\x{{{last:X}}}" for first, last in _NATIVE) + "]"


@F.pandas_udf(T.StringType())
def _canonical_exact(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else _canonical_py(v))


# Python's whitespace among the native characters, as a set to trim by
_BLANKS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"


def _collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), _WS, " "))


def _canonical_latin(c: Column) -> Column:
    # the few letters that expand to two characters (e.g. a ligature) are replaced only where present
    expanded = c
    for ch, rep in _FOLD_MULTI:
        expanded = F.replace(expanded, F.lit(ch), F.lit(rep))
    pre = F.when(c.rlike(_MULTI_CLASS), expanded).otherwise(c)
    return _collapsed(F.translate(pre, _TRANSLATE_SRC, _FOLD_DST))


def canonical_text(c: Column | str, exact_fallback: bool = True) -> Column:
    """Accent-insensitive canonical form of a text column (null stays null)."""
    c = F.col(c) if isinstance(c, str) else c
    # as many bytes as characters: ASCII, in which nothing folds
    ascii_only = F.octet_length(c) == F.length(c)
    if not exact_fallback:
        return F.when(ascii_only, _collapsed(c)).otherwise(_canonical_latin(c))
    outside = ~ascii_only & c.rlike(_OUTSIDE_LATIN)
    return F.when(ascii_only, _collapsed(c)).when(outside, _canonical_exact(F.when(outside, c))).otherwise(_canonical_latin(c))


def equality_key(c: Column | str) -> Column:
    """A key for joins and filters that ignores case, accents and runs of white space, compared by collation.

    Only its equality is meant: the text keeps its letters, and nothing of it
    runs in Python, whatever the script. Equal canonical texts (X1) have equal
    keys in Latin text; beyond that a collation is wider in places (``ß`` and
    ``ss``, full-width forms) and the Turkish dotless i stays apart.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.collate(F.trim(F.regexp_replace(c, _WS, " ")), "UNICODE_CI_AI")


def canonical_column(c: Column | str) -> Column:
    """Display name -> column-safe key (camelCase split, canonical, non-alnum to _)."""
    c = F.col(c) if isinstance(c, str) else c
    spaced = F.regexp_replace(c, "(?<=[a-z0-9])(?=[A-Z])", " ")
    safe = F.regexp_replace(canonical_text(spaced), "[^a-z0-9]+", "_")
    return F.regexp_replace(safe, "^_+|_+$", "")


def comparison_scalar(c: Column | str) -> Column:
    """Null -> '', trimmed, a trailing '.0' after an all-digit value dropped."""
    c = F.col(c) if isinstance(c, str) else c
    trimmed = F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(_BLANKS))
    return F.when(F.endswith(trimmed, F.lit(".0")), F.regexp_replace(trimmed, r"^([0-9]+)\.0$", "$1")).otherwise(trimmed)


def table_text(c: Column | str) -> Column:
    """Trimmed text, empty -> null."""
    c = F.col(c) if isinstance(c, str) else c
    trimmed = F.btrim(c.cast("string"), F.lit(_BLANKS))
    return F.when(trimmed != "", trimmed)


def signature_text(c: Column | str) -> Column:
    """Comparison key of one text value: X3 then X1."""
    return canonical_text(comparison_scalar(c))
