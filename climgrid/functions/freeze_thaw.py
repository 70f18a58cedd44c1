"""Day of thaw, day of freeze and growing season from 12 monthly means.

``x`` is an ARRAY<DOUBLE> of January..December.  A change of sign between two
months is a crossing; its day is found on the straight line between the two
mid-months.  Which crossings count depends on how many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Days used when a thaw or freeze is known but not seen in the year.
EARLY_THAW, LATE_FREEZE, NEVER = 15, 350, 365


def zero_as_frozen(x: Column) -> Column:
    return F.transform(x, lambda v: F.when(v == 0, F.lit(-0.0001)).otherwise(v))


def sign_transitions(x: Column) -> Column:
    """0-based months after which the sign changes."""
    return F.filter(F.sequence(F.lit(0), F.lit(10)), lambda i: F.get(x, i) * F.get(x, i + 1) < 0)


def _at(x: Column, i: Column) -> Column:
    return F.get(x, F.pmod(i, F.lit(12)))


def _share(x: Column, num: Column, i: Column) -> Column:
    step = (_at(x, i + 1) - _at(x, i)) / 30.0
    return F.rint(F.try_divide(_at(x, num), step))


def thaw_day(x: Column, i: Column) -> Column:
    """Day of the crossing between months i and i+1, counted from month i."""
    return i * 30 + 15 - _share(x, i, i)


def freeze_day(x: Column, i: Column) -> Column:
    """Day of the crossing between months i and i+1, counted back from month i+1."""
    return F.lit(350) - (F.lit(10) - i) * 30 - _share(x, i + 1, i)


def spells(idx: Column) -> Column:
    """Months where a spell begins: January and the month after each crossing."""
    return F.concat(F.array(F.lit(0)), F.transform(idx, lambda i: i + 1))


def spell_lengths(starts: Column) -> Column:
    """Lengths of the spells that end in a crossing."""
    return F.transform(F.sequence(F.lit(1), F.size(starts) - 1), lambda k: F.get(starts, k) - F.get(starts, k - 1))


def last_longest(lengths: Column) -> Column:
    """1-based position of the greatest length, the last one of a tie."""
    back = F.array_position(F.reverse(lengths), F.array_max(lengths)).cast("int")
    return F.size(lengths) - back + 1


def without(lengths: Column, position: Column) -> Column:
    return F.filter(lengths, lambda _, k: k != position - 1)


def with_freeze_thaw(df: DataFrame, months: str = "months", r_compat: bool = False) -> DataFrame:
    """Add dof, dot, grow and kase from an ARRAY column of twelve monthly means.

    With more than two crossings, the ones that close the two longest spells count;
    the second is searched with the first taken out and keeps its position in that
    shorter list, one less if both are then equal.  ``r_compat`` moves the split
    between a spurious early freeze and a spurious late thaw one month earlier.

    The steps are separate projections, so that each intermediate array is computed
    once per row instead of once per mention.
    """
    x, idx, n, first = F.col("_x"), F.col("_idx"), F.col("_n"), F.get("_x", F.lit(0))
    i0, i1 = F.get(idx, F.lit(0)), F.get(idx, F.lit(1))
    m1, m2, p = F.col("_m1"), F.col("_m2"), F.col("_p")
    many = lambda c: F.when(n > 2, c)
    out = df.withColumn("_x", zero_as_frozen(F.col(months)))
    out = out.withColumn("_idx", sign_transitions(x))
    out = out.withColumns({"_n": F.size(idx), "_i0": i0, "_i1": i1, "_p": F.when(F.size(idx) > 2, spells(idx))})
    out = out.withColumn("_g", many(spell_lengths(p)))
    out = out.withColumn("_m1", last_longest(F.col("_g")))
    out = out.withColumn("_m2", last_longest(without(F.col("_g"), m1)))
    out = out.withColumn("_m2", F.when(m1 == m2, m2 - 1).otherwise(m2))
    out = out.withColumns({"_q0": F.get(p, F.least(m1, m2)) - 1, "_q1": F.get(p, F.greatest(m1, m2)) - 1})

    late = F.col("_i0") >= (6 if r_compat else 7)
    kase = (
        F.when(F.exists(x, lambda v: v.isNull()), 1)
        .when((n == 0) & (first > 0), 2)
        .when(n == 0, 3)
        .when((n == 1) & (first < 0), 4)
        .when(n == 1, 5)
        .when((n == 2) & (first < 0), 0)
        .when((n == 2) & late, 6)
        .when(n == 2, 7)
        .otherwise(8)
    )
    out = out.withColumn("kase", kase)
    # the crossing that gives each day, if the case has one
    k = F.col("kase")
    out = out.withColumns(
        {
            "_t": F.when(k.isin(0, 4), F.col("_i0")).when(k == 7, F.col("_i1")).when(k == 8, F.col("_q0")),
            "_f": F.when(k.isin(5, 6), F.col("_i0")).when(k == 0, F.col("_i1")).when(k == 8, F.col("_q1")),
        }
    )
    never = F.lit(float(NEVER))
    dot = (
        F.when(k == 2, 0.0)
        .when(k == 3, never)
        .when(k.isin(5, 6), F.lit(float(EARLY_THAW)))
        .when(k != 1, thaw_day(x, F.col("_t")))
    )
    dof = (
        F.when(k == 2, never)
        .when(k == 3, 0.0)
        .when(k.isin(4, 7), F.lit(float(LATE_FREEZE)))
        .when(k != 1, freeze_day(x, F.col("_f")))
    )
    out = out.withColumns({"dof": dof, "dot": dot})
    out = out.withColumn("grow", F.when(k == 3, 0.0).otherwise(F.col("dof") - F.col("dot")))
    return out.select(*df.columns, "kase", "dof", "dot", "grow")
