"""Text normalisation as native Spark column expressions (SC-9..20, SIM-1).

Everything here returns a ``Column`` and stays inside whole-stage codegen;
no Python runs per row.
"""

from __future__ import annotations

import functools
import unicodedata
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values that must equal the behaviour being reproduced.
# --------------------------------------------------------------------------
# Characters removed from names before n-gram fitting (SC-11).
NAME_STRIP_PATTERN = r'[,"&]'
# N-gram pre-clean (SC-13): a leading $token$, any of , - . / and the
# whitespace+"BD" sequence (never matches once the text is lower-cased).
NGRAM_STRIP_PATTERN = r"^\$[a-zA-Z0-9_]+\$|[,\-./]|\sBD"
# Trailing tildes removed from matched names (SC-12).
TRAILING_TILDES_PATTERN = r"~+$"
# Quantity + unit in a product name (SC-19), case-insensitive, first hit.
QUANTITY_UNIT_PATTERN = r"(?i)(\d+\.?\d*)\s*(ML|G|KG|L|Unid.|Unid)"
# Isolated "kg" (SC-20).
PER_KG_PATTERN = r"(?iU)\bkg\b"
# Word tokens of two or more word characters (vectoriser default).
WORD_TOKEN_PATTERN = r"(?U)\b\w\w+\b"
# Characters kept by the clean step (SIM-1): letters, digits, whitespace.
CLEAN_DROP_PATTERN = r"(?U)[^\p{L}\p{N}\s]"


# --------------------------------------------------------------------------
# Unicode fold: lower-case, NFKD, drop non-ASCII (SC-9, SC-10)
# --------------------------------------------------------------------------
@functools.lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Build the fold tables from the NFKD rule over all code points.

    ``translate`` handles every character whose NFKD form keeps exactly one
    ASCII character; characters that expand to several ASCII characters
    (ligatures, fractions, digraphs) go into a small map used only on rows
    that contain one of them.
    """
    src, dst, multi = [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(out) == 1:
            src.append(ch)
            dst.append(out)
        elif len(out) > 1:
            multi[ch] = out
    return "".join(src), "".join(dst), multi


def fold_ascii(c: Column) -> Column:
    """NFKD-decompose and drop everything that is not ASCII (no lower-casing).

    One ``translate`` pass does every single-character fold. Rows holding a
    character that expands to several (rare) are found by deleting those
    characters with a second ``translate`` and comparing lengths — a hash
    lookup per character, where a 400-member regex class would be slow — and
    only those rows take the per-character map.
    """
    src, dst, multi = _fold_tables()
    single = F.translate(c, src, dst)
    mchars = "".join(multi)
    mapping = F.create_map(*[F.lit(x) for kv in multi.items() for x in kv])
    expanded = F.array_join(
        F.transform(F.split(single, ""), lambda x: F.coalesce(F.element_at(mapping, x), x)), "")
    has_multi = F.length(F.translate(single, mchars, "")) < F.length(single)
    widened = F.when(has_multi, expanded).otherwise(single)
    return F.regexp_replace(widened, r"[^\x00-\x7F]", "")


def fold_name(c: Column, strip_chars: bool = True) -> Column:
    """Name normalisation used before matching: lower, NFKD-to-ASCII, drop , " & ."""
    out = fold_ascii(F.lower(c))
    if strip_chars:
        out = F.regexp_replace(out, NAME_STRIP_PATTERN, "")
    return out


def ngram_source(c: Column) -> Column:
    """Apply the n-gram pre-clean (SC-13) to an already folded name."""
    return F.regexp_replace(c, NGRAM_STRIP_PATTERN, "")


def strip_trailing_tildes(c: Column) -> Column:
    return F.regexp_replace(c, TRAILING_TILDES_PATTERN, "")


# --------------------------------------------------------------------------
# Character n-grams (SC-17)
# --------------------------------------------------------------------------
def char_ngrams(c: Column, n: int = 3) -> Column:
    """All length-``n`` substrings, as a multiset ``ARRAY<STRING>``.

    One regex pass with a capturing look-ahead returns every overlapping
    n-gram in O(length); indexing with ``substring(c, i, n)`` would rescan
    the UTF-8 bytes for every position (quadratic on whole documents).
    Strings shorter than ``n`` give an empty array.
    """
    return F.regexp_extract_all(c, F.lit("(?s)(?=(.{%d}))" % n), 1)


# --------------------------------------------------------------------------
# Word-level cleaning (SIM-1, SC-14..16, SC-18)
# --------------------------------------------------------------------------
@functools.lru_cache(maxsize=None)
def stop_words(language: str = "portuguese") -> tuple[str, ...]:
    """Stop words kept as package data (``functions/data/``), in file order.

    Read with ``importlib.resources``, so it does not depend on how Spark is
    installed (thin client, separate distribution, zipped package).
    """
    source = resources.files("shelfmatch.functions") / "data" / f"stopwords_{language}.txt"
    lines = source.read_text(encoding="utf-8").splitlines()
    return tuple(w for w in lines if w and not w.startswith("#"))


def words(c: Column) -> Column:
    """Whitespace tokens (``str.split()`` semantics: no empty tokens)."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def clean_words(c: Column, language: str | None = "portuguese") -> Column:
    """Lower-case, keep letters/digits/whitespace, split, drop stop words."""
    kept = F.regexp_replace(F.lower(c), CLEAN_DROP_PATTERN, "")
    toks = words(kept)
    if language:
        toks = F.filter(toks, lambda w: ~w.isin(*stop_words(language)))      # a hash lookup a word
    return toks


def clean_text(c: Column, language: str | None = "portuguese") -> Column:
    """SIM-1: cleaned text re-joined with single spaces."""
    return F.array_join(clean_words(c, language), " ")


def word_ngrams(c: Column, n: int = 1) -> Column:
    """Word n-grams of a cleaned text, joined by a space (SC-18)."""
    return joined_runs(words(c), n)


def joined_runs(toks: Column, n: int) -> Column:
    """The ``n`` consecutive tokens from each position on, joined by a space.

    Shifted copies of the array are zipped, so the array is read ``n`` times whatever its
    length (an expression inside a lambda would be made anew for every position). Pass a
    column that a ``select`` before made, where making the tokens is not cheap.
    """
    if n == 1:
        return toks
    cnt = F.size(toks) - (n - 1)
    grams = F.slice(toks, 1, F.greatest(cnt, F.lit(0)))
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(toks, k + 1, F.greatest(cnt, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(cnt >= 1, grams).otherwise(F.array().cast("array<string>"))


def word_tokens(c: Column) -> Column:
    """Vectoriser tokens: lower-case, runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_TOKEN_PATTERN), 0)


# --------------------------------------------------------------------------
# Quantity and unit parsing (SC-19, SC-20)
# --------------------------------------------------------------------------
def quantity_unit(c: Column) -> tuple[Column, Column]:
    """First ``<number><unit>`` hit as (quantity text, unit text); NULLs if none."""
    q = F.regexp_extract(c, QUANTITY_UNIT_PATTERN, 1)
    u = F.regexp_extract(c, QUANTITY_UNIT_PATTERN, 2)
    return F.nullif(q, F.lit("")), F.nullif(u, F.lit(""))


def is_per_kg(c: Column) -> Column:
    """True when the text has an isolated ``kg`` (``5 kg`` yes, ``5kg`` no)."""
    return F.coalesce(c.rlike(PER_KG_PATTERN), F.lit(False))
