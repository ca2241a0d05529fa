"""Pair similarity scores as native column expressions (SIM-2..6, SIM-8, SIM-11..13, AGG-12).

Each function takes two string (or number) columns of the same row and
returns a ``Column``; nothing leaves the JVM. Scores are NULL where the
definition divides by zero (both sides empty after cleaning).
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions import text as T

# Weights of the final confidence (SIM-13) and the distance curve (SIM-8).
CONFIDENCE_WEIGHTS = {"similarity": 5.0, "distance_score": 1.0, "token_sort_ratio": 2.0,
                      "token_set_ratio": 0.5, "price_similarity": 1.0, "config_similarity": 3.0}
CURVE_SCALE = 15.0
CURVE_DECAY = 0.16
# Vectoriser token: a maximal run of two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def jaccard_sets(sa: Column, sb: Column) -> Column:
    """|A∩B| / (|A|+|B|-|A∩B|) of two distinct-word arrays; NULL if both empty."""
    inter = F.size(F.array_intersect(sa, sb))
    union = F.size(sa) + F.size(sb) - inter
    return F.when(union > 0, inter / union)


def edit_ratio(ca: Column, cb: Column) -> Column:
    """1 - levenshtein / max(len); NULL if both strings are empty."""
    m = F.greatest(F.length(ca), F.length(cb))
    return F.when(m > 0, 1 - F.levenshtein(ca, cb) / m)


def _merged(ta: Column, tb: Column, start: Column, close) -> Column:
    """One pass over the tokens of both sides in sorted order.

    Each token stands with its side; equal tokens meet, are counted for both
    sides and handed to ``close(state, in_a, in_b)`` once, which returns the new
    state (a struct like ``start``). After the sort the work is linear in the tokens.
    """
    tagged = F.array_sort(F.concat(F.transform(ta, lambda t: F.struct(t.alias("t"), F.lit(0).alias("side"))),
                                   F.transform(tb, lambda t: F.struct(t.alias("t"), F.lit(1).alias("side")))))
    one = F.lit(1).cast("long")
    zero = F.lit(0).cast("long")

    def step(acc, x):
        same = acc["t"] == x["t"]
        in_a, in_b = (F.when(x["side"] == side, one).otherwise(zero) for side in (0, 1))
        return F.struct(x["t"].alias("t"), (F.when(same, acc["a"]).otherwise(zero) + in_a).alias("a"),
                        (F.when(same, acc["b"]).otherwise(zero) + in_b).alias("b"),
                        F.when(same, acc["s"]).otherwise(close(acc["s"], acc["a"], acc["b"])).alias("s"))

    # No token is empty, so the empty string stands for "none yet"; its counts of 0 add nothing.
    first = F.struct(F.lit("").alias("t"), zero.alias("a"), zero.alias("b"), start.alias("s"))
    return F.aggregate(tagged, first, step, lambda acc: close(acc["s"], acc["a"], acc["b"]))


def cosine_tokens(ta: Column, tb: Column) -> Column:
    """Two-document TF-IDF cosine of token arrays (raw tf, smooth idf, L2).

    idf is 1 for a term in both and ln(3/2)+1 for a term in one; NULL when
    neither side has a token, 0 when only one side is empty.
    """
    solo = math.log(1.5) + 1.0

    def close(s, a, b):
        idf = F.when((a > 0) & (b > 0), F.lit(1.0)).otherwise(F.lit(solo))
        return F.struct((s["dot"] + a * b).alias("dot"), (s["na"] + F.pow(a * idf, 2)).alias("na"), (s["nb"] + F.pow(b * idf, 2)).alias("nb"))

    sums = _merged(ta, tb, F.struct(*[F.lit(0.0).alias(n) for n in ("dot", "na", "nb")]), close)
    return (F.when((F.size(ta) == 0) & (F.size(tb) == 0), F.lit(None).cast("double"))
            .when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0))
            .otherwise(F.aggregate(F.array(sums), F.lit(0.0), lambda _, s: s["dot"] / F.sqrt(s["na"] * s["nb"]))))


def containment_tokens(ta: Column, tb: Column) -> Column:
    """Σ min(count_A, count_B) / Σ count_A; NULL when A has no token."""
    inter = _merged(ta, tb, F.struct(F.lit(0).cast("long").alias("low")), lambda s, a, b: F.struct((s["low"] + F.least(a, b)).alias("low")))
    return F.when(F.size(ta) > 0, inter["low"] / F.size(ta))


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


# Column-in/Column-out forms, for short names used inline. On long texts
# prefer :func:`with_pair_scores`, which computes each token array once.
def jaccard(a: Column, b: Column, language: str | None = "portuguese") -> Column:
    """SIM-2: Jaccard of the cleaned word sets."""
    return jaccard_sets(F.array_distinct(T.clean_words(a, language)),
                        F.array_distinct(T.clean_words(b, language)))


def edit_similarity(a: Column, b: Column, language: str | None = "portuguese") -> Column:
    """SIM-3: 1 - levenshtein / max(len) over the cleaned strings."""
    return edit_ratio(T.clean_text(a, language), T.clean_text(b, language))


def pair_cosine(a: Column, b: Column, language: str | None = "portuguese") -> Column:
    """SIM-4: TF-IDF cosine with the two cleaned strings as the whole corpus."""
    return cosine_tokens(_tokens(T.clean_text(a, language)), _tokens(T.clean_text(b, language)))


def containment(a: Column, b: Column) -> Column:
    """SIM-5: unigram containment over raw (uncleaned) word tokens."""
    return containment_tokens(_tokens(a), _tokens(b))


def row_median(*cols: Column) -> Column:
    """AGG-12: median of the non-null values of one row (mean of the middle two)."""
    vals = F.array_sort(F.filter(F.array(*[c.cast("double") for c in cols]), lambda x: x.isNotNull()))
    n = F.size(vals)
    lo = F.element_at(vals, F.floor((n + 1) / 2).cast("int"))
    hi = F.element_at(vals, F.floor(n / 2).cast("int") + 1)
    return F.when(n > 0, (lo + hi) / 2)


def name_agreement(a: Column, b: Column, language: str | None = "portuguese") -> Column:
    """SIM-6: median of Jaccard, edit similarity and pair cosine."""
    return row_median(jaccard(a, b, language), edit_similarity(a, b, language),
                      pair_cosine(a, b, language))


PAIR_SCORES = ("jaccard", "edit_similarity", "cosine", "containment", "name_agreement")


def with_pair_scores(df: DataFrame, a: str, b: str, scores=PAIR_SCORES,
                     language: str | None = "portuguese", prefix: str = "") -> DataFrame:
    """Add SIM-2..6 columns for the text pair (``a``, ``b``) of every row.

    The cleaned words and token arrays are projected once as columns, then
    every score reads them; written inline, the cleaning would be re-run for
    every token a lambda visits.
    """
    base = list(df.columns)
    wa, wb = T.clean_words(F.col(a), language), T.clean_words(F.col(b), language)
    x = df.select(*base, wa.alias("_wa"), wb.alias("_wb"))
    x = x.select(*base, "_wa", "_wb",
                 F.array_join("_wa", " ").alias("_ca"), F.array_join("_wb", " ").alias("_cb"))
    x = x.select(*base, "_wa", "_wb", "_ca", "_cb",
                 _tokens(F.col("_ca")).alias("_ta"), _tokens(F.col("_cb")).alias("_tb"),
                 _tokens(F.col(a)).alias("_ra"), _tokens(F.col(b)).alias("_rb"))
    cols = {
        "jaccard": jaccard_sets(F.array_distinct("_wa"), F.array_distinct("_wb")),
        "edit_similarity": edit_ratio(F.col("_ca"), F.col("_cb")),
        "cosine": cosine_tokens(F.col("_ta"), F.col("_tb")),
        "containment": containment_tokens(F.col("_ra"), F.col("_rb")),
    }
    x = x.select(*base, *[cols[k].alias(f"_{k}") for k in cols])
    out = {k: F.col(f"_{k}") for k in cols}
    out["name_agreement"] = row_median(out["jaccard"], out["edit_similarity"], out["cosine"])
    return x.select(*base, *[out[k].alias(prefix + k) for k in scores])


# Fixed value: the token-ratio clean-up removes the characters 128..255.
_LATIN1_HIGH = "".join(map(chr, range(128, 256)))


def ratio_tokens(c: Column) -> Column:
    """Tokens of a text for SIM-9 and SIM-10: characters 128..255 dropped, runs of letters, digits and
    underscores in lower case, sorted."""
    kept = F.lower(F.translate(c, _LATIN1_HIGH, ""))
    return F.array_sort(F.regexp_extract_all(kept, F.lit(r"[\p{L}\p{N}_]+"), 0))


def token_sort_strings(a: Column, b: Column) -> tuple[Column, Column]:
    """SIM-9: the sorted tokens of either side, joined by a space."""
    return F.array_join(ratio_tokens(a), " "), F.array_join(ratio_tokens(b), " ")


def token_set_strings(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """SIM-10: shared tokens, and shared then other tokens of either side (each once, sorted)."""
    ta, tb = F.array_distinct(ratio_tokens(a)), F.array_distinct(ratio_tokens(b))
    both = F.array_sort(F.array_intersect(ta, tb))
    return tuple(F.array_join(x, " ") for x in (both, F.concat(both, F.array_except(ta, tb)), F.concat(both, F.array_except(tb, ta))))


def _percent(common: Column, a: Column, b: Column) -> Column:
    """2 * common / (|a| + |b|) in whole percent (halves to even), / 100; an empty side gives 0, equal sides 1."""
    share = F.bround(100.0 * ((2.0 * common) / (F.length(a) + F.length(b))), 0) / 100.0
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(share)


def token_sort_ratio(a: Column, b: Column, lcs: Column) -> Column:
    """SIM-9 of the two strings of :func:`token_sort_strings` and the length of their longest common subsequence."""
    return _percent(lcs, a, b)


def token_set_ratio(both: Column, a: Column, b: Column, lcs: Column) -> Column:
    """SIM-10 of the strings of :func:`token_set_strings`: the best of three ratios; ``lcs`` is that of ``a`` and ``b``.

    The shared tokens begin both others, so what they have in common with those is their own length."""
    best = F.greatest(_percent(F.length(both), both, a), _percent(F.length(both), both, b), _percent(lcs, a, b))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(best)


def distance_score(d: Column) -> Column:
    """SIM-8: round(1 - exp(-15 * exp(-0.16 d)), 8)."""
    return F.round(1 - F.exp(-CURVE_SCALE * F.exp(-CURVE_DECAY * d.cast("double"))), 8)


def price_similarity(a: Column, b: Column) -> Column:
    """SIM-11: 1 - |a-b| / max(a, b); NULL if either is NULL or max is 0."""
    m = F.greatest(a, b)
    return F.when(a.isNotNull() & b.isNotNull() & (m != 0), 1 - F.abs(a - b) / m)


def confidence(scores: Mapping[str, Column], weights: Mapping[str, float] = CONFIDENCE_WEIGHTS) -> Column:
    """SIM-13: weighted mean of the six scores (NULL if any score is NULL)."""
    total = sum(weights.values())
    acc = None
    for name, w in weights.items():
        term = scores[name] * F.lit(w)
        acc = term if acc is None else acc + term
    return acc / F.lit(total)
