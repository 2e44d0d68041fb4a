"""Scalar column functions (F1-F12). Pure Column -> Column, all JVM-side."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from bondmart import labels as L


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_paren_suffix(c) -> Column:
    """cut a display name at the later of the first '(' and first '（'.

    A paren at the very start (or none) leaves the name unchanged and
    untrimmed; otherwise the part before it is trimmed.
    """
    s = _col(c)
    pos = F.greatest(F.instr(s, "("), F.instr(s, "（"))
    return F.when(pos > 1, F.trim(s.substr(F.lit(1), pos - 1))).otherwise(s)


def first_paren_prefix(c) -> Column:
    """Part before the first '(' (else before the first '（'); a name
    without any paren gives NULL. Kept as the documented cash-job variant."""
    s = _col(c)
    return (
        F.when(F.instr(s, "(") > 0, F.substring_index(s, "(", 1))
        .when(F.instr(s, "（") > 0, F.substring_index(s, "（", 1))
        .otherwise(F.lit(None).cast("string"))
    )


def bond_category4(c, other: str = L.BOND_OTHER) -> Column:
    """parent bond type kept if it is one of the three reported kinds."""
    s = _col(c)
    return F.when(s.isin(*L.BOND4_KEPT), s).otherwise(F.lit(other))


def bond_category8(c, other: str = L.BOND_OTHER) -> Column:
    """8-way reported bond category."""
    s = _col(c)
    out = None
    for raw, label in L.BOND8_MAP:
        out = (F.when if out is None else out.when)(s == raw, F.lit(label))
    return out.otherwise(F.lit(other))


def maturity_bucket(c) -> Column:
    """years to maturity -> bucket label (upper bounds inclusive)."""
    y = _col(c)
    out = None
    for lower, label in L.MATURITY_BUCKETS:
        out = (F.when if out is None else out.when)(y > F.lit(lower), F.lit(label))
    return out.otherwise(F.lit(L.MATURITY_LOWEST))


def rating_rank(c) -> Column:
    """F5 as an ordinal: 2 = AAA, 1 = AA+ (three spellings), 0 = the rest."""
    s = _col(c)
    return (
        F.when(s.isin(*L.RATING_AAA_SPELLINGS), F.lit(2))
        .when(s.isin(*L.RATING_AA_PLUS_SPELLINGS), F.lit(1))
        .otherwise(F.lit(0))
    )


def rating_label(rank) -> Column:
    """Inverse of rating_rank."""
    r = _col(rank)
    return (
        F.when(r == 2, F.lit(L.RATING_AAA))
        .when(r == 1, F.lit(L.RATING_AA_PLUS))
        .otherwise(F.lit(L.RATING_LOW))
    )


def rating_normalize(c) -> Column:
    """raw rating -> AAA / AA+ / AA及以下."""
    return rating_label(rating_rank(c))


def issuer_code(c) -> Column:
    """NULL/empty -> ''; at least 4 chars -> drop the first 4."""
    s = _col(c)
    return (
        F.when(s.isNull() | (s == ""), F.lit(""))
        .when(F.length(s) >= 4, s.substr(F.lit(5), F.length(s)))
        .otherwise(s)
    )


def event_id(suffix, prefix: str = L.EVENT_ID_PREFIX) -> Column:
    """removed-deal suffix -> repo event id."""
    return F.concat(F.lit(prefix), _col(suffix))


def deal_strategy(match_status) -> Column:
    """F8: matching status 0/4 (or no entry) -> normal, else tactical."""
    s = _col(match_status)
    return F.when(
        s.isNull() | (s == "") | s.isin(*L.NORMAL_MATCH_STATUSES), F.lit(L.STRATEGY_NORMAL)
    ).otherwise(F.lit(L.STRATEGY_TACTICAL))


def set_to_string(arr, sep: str) -> Column:
    """set -> sorted, separator-joined string (deterministic order)."""
    return F.array_join(F.sort_array(_col(arr)), sep)


def trim_currency(c) -> Column:
    """F10."""
    return F.trim(_col(c))


def parse_date(c) -> Column:
    """'yyyy-MM-dd...' -> DATE; invalid days give NULL (strict)."""
    return F.try_to_date(F.substring(_col(c), 1, 10), "yyyy-MM-dd")


def ratio6(num, den) -> Column:
    """F12 division rule: double quotient rounded to 6 places, NULL on 0."""
    d = _col(den).cast("double")
    return F.round(_col(num).cast("double") / F.when(d != 0, d), 6)


def exact_sum(c, kind: DataType) -> Column:
    """``F.sum`` of a column of type ``kind``, same value and type. A decimal of 9 to
    18 digits is added up as two whole numbers (its units above and below 2^30):
    8 bytes each in the rows of an aggregate and its shuffle, where a decimal
    sum takes 32, and no arithmetic on big decimals for each row and sum."""
    if not (isinstance(kind, DecimalType) and 8 < kind.precision <= 18 and kind.scale <= 6):
        return F.sum(_col(c))
    units = (_col(c) * F.lit(10 ** kind.scale)).cast("long")
    high, low = F.shiftright(units, 30), units.bitwiseAND((1 << 30) - 1)
    whole = F.sum(high).cast("decimal(20,0)") * F.lit(1 << 30) + F.sum(low).cast("decimal(20,0)")
    return (whole * F.lit(Decimal(1).scaleb(-kind.scale))).cast(DecimalType(kind.precision + 10, kind.scale))


def sum_amount(c) -> Column:
    """Σ of a DECIMAL(18,2) amount as DECIMAL(38,2)."""
    return F.sum(_col(c)).cast("decimal(38,2)")
