"""Text helpers: whitespace normalisation, numeric coercion, accent stripping, mojibake repair."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``\s`` / ``str.isspace`` treat as whitespace
# (the reference normalises with Python regexes), plus the zero-width space that
# the reference maps to a blank explicitly.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ZERO_WIDTH_SPACE = "\u200b"


def _regex_class(chars: str) -> str:
    """A character class spelled with \\x{...} escapes (valid for Java regex and RE2)."""
    return "[" + "".join(f"\\x{{{ord(c):04X}}}" for c in chars) + "]"


WS_RUN = _regex_class(PY_WHITESPACE + ZERO_WIDTH_SPACE) + "+"


_WS_CHARS = PY_WHITESPACE + ZERO_WIDTH_SPACE


def normalize_ws(c: Column) -> Column:
    """NBSP/ZWSP -> blank, collapse whitespace runs, trim (NULL stays NULL).

    Same result as replacing runs of the class ``WS_RUN`` by one blank, computed as a
    per-character translate plus a collapse of literal blanks (about twice as fast as
    the class regex on long texts)."""
    blanks = F.translate(c, _WS_CHARS, " " * len(_WS_CHARS))
    return F.trim(F.regexp_replace(blanks, "  +", " "))


def strip_ws(c: Column) -> Column:
    """Python's ``str.strip``, zero-width spaces included."""
    return F.regexp_replace(c, f"^{WS_RUN}|{WS_RUN}$", "")


# A decimal number as accepted by a numeric coercion: optional sign, digits with an
# optional fraction, optional exponent, surrounding blanks allowed.  Spark's own
# cast would also accept 'nan', 'Infinity' and suffixes such as '1d'.
NUMERIC_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_numeric(c: Column) -> Column:
    """String -> double, NULL when the text is not a plain decimal number."""
    return F.when(c.rlike(NUMERIC_RE), F.trim(c).try_cast("double"))


# ---------------------------------------------------------------- accent stripping
# Built by rule: the ASCII part of the NFKD decomposition of every character that has
# one.  One-to-one results make a translate() map.  Rows that hold a character with a
# longer result are taken character by character.  Everything else that is non-ASCII is
# removed, as an ASCII re-encoding with errors ignored would do.
@lru_cache(maxsize=1)
def accent_tables() -> tuple[str, str, str, tuple[str, ...]]:
    src, dst, keys, longer = [], [], [], []
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(out) == 1:
            src.append(ch)
            dst.append(out)
        elif len(out) > 1:
            keys.append(ch)
            longer.append(out)
    return "".join(src), "".join(dst), "".join(keys), tuple(longer)


def strip_accents_name(name: str) -> str:
    """Driver-side form for column names (exact NFKD -> ASCII)."""
    return unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")


def _char_class(chars: str) -> str:
    """A regex class of the characters, neighbouring code points as ranges."""
    out, codes = [], sorted(map(ord, chars))
    start = prev = codes[0]
    for cp in codes[1:] + [-1]:
        if cp != prev + 1:
            out.append(f"\\x{{{start:X}}}" + (f"-\\x{{{prev:X}}}" if prev > start else ""))
            start = cp
        prev = cp
    return "[" + "".join(out) + "]"


def strip_accents(c: Column) -> Column:
    """NFKD to ASCII; what has no ASCII form is removed."""
    src, dst, keys, longer = accent_tables()
    outputs = F.array(*[F.lit(x) for x in longer])

    def longer_form(ch: Column) -> Column:
        return F.coalesce(F.get(outputs, F.position(ch, F.lit(keys)) - 1), ch)

    spelled = F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(?s)."), 0), longer_form), "")
    out = F.when(c.rlike(_char_class(keys)), spelled).otherwise(c)
    return F.regexp_replace(F.translate(out, src, dst), r"[^\x{0000}-\x{007F}]", "")


# ---------------------------------------------------------------- mojibake
def repair_mojibake(c: Column) -> Column:
    """Undo one round of 'UTF-8 bytes read as Latin-1' (RÃ©fÃ©rence -> Référence).

    Text holding a character above U+00FF cannot be such mojibake and is kept; so
    is text whose Latin-1 bytes are not valid UTF-8.
    """
    as_bytes = F.encode(c, "ISO-8859-1")
    fixed = F.try_validate_utf8(as_bytes.cast("string"))
    return F.when(c.rlike(r"[^\x{0000}-\x{00FF}]"), c).otherwise(F.coalesce(fixed, c))


def make_mojibake(c: Column) -> Column:
    """The damage repaired above: UTF-8 bytes decoded as Latin-1."""
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")


def repair_mojibake_name(name: str) -> str:
    """Driver-side form for column names."""
    try:
        return name.encode("latin-1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return name
