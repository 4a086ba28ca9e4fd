"""Exact sums of readings and one rounding at the end, as SQL text that both routes share.

A reading counts as its decimal text says (``0.015`` is 15 thousandths), which
is what Spark's own ``round`` takes it for.  A sum of doubles depends on the
order of summation, and a decimal of fixed scale cuts digits off; so readings
are summed as whole numbers in bins of the decimal exponent: ``m * 10^bin``
with ``bin`` a multiple of 6.  A bin's sum is exact and doesn't depend on the
order; :data:`MEAN_SQL` carries the bins of a group into one another from the
lowest on, exactly, and rounds their quotient HALF_UP to two decimals once.
There is no scale to choose: a reading of 10^-300 has its own bin.

Readings of 10^15 and more, of which two decimals mean nothing, are added up
as doubles of their bins' sums, from the lowest bin on; NaN and infinities make
the mean NaN or infinite.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCALE = 2

#: Decimal digits that a bin spans, the bin of usual readings, and where the bins of huge readings begin.
BIN = 6
USUAL = -6
HUGE = 1000

#: One bin's sum.
ENTRY = T.StructType([T.StructField("bin", T.IntegerType()), T.StructField("s", T.DecimalType(38, 0))])

_BODY = "split_part(CAST(abs({x}) AS STRING), 'E', 1)"
_EXP = f"(coalesce(try_cast(nullif(split_part(CAST(abs({{x}}) AS STRING), 'E', 2), '') AS INT), 0) - length({_BODY}) + instr({_BODY}, '.'))"
_TENS = "element_at(array(" + ", ".join(str(10**i) for i in range(BIN)) + f"), pmod({_EXP}, {BIN}) + 1)"


# Most readings have six decimals at most: then the decimal of that scale is the shortest text of the double, and gives
# the double back.  (Below 9 * 10^9 that conversion is exact.)
_SHORT = f"(abs({{x}}) < 9e9D AND CAST(try_cast({{x}} AS DECIMAL(21,{BIN})) AS DOUBLE) = {{x}})"
_SHORT_UNITS = f"CAST(try_cast({{x}} AS DECIMAL(21,{BIN})) * {10**BIN} AS DECIMAL(28,0))"


def bin_sql(x: str) -> str:
    """The bin of a reading; null for null, NaN and infinities."""
    exp = _EXP.format(x=x)
    return f"CASE WHEN {_SHORT.format(x=x)} THEN {USUAL} WHEN abs({x}) < double('Infinity') THEN CAST({exp} - pmod({exp}, {BIN}) + IF(abs({x}) >= 1e15D, {HUGE}, 0) AS INT) END"


def units_sql(x: str) -> str:
    """The reading in units of its bin; null as its bin is."""
    return (
        f"CASE WHEN {_SHORT.format(x=x)} THEN {_SHORT_UNITS.format(x=x)} WHEN abs({x}) < double('Infinity') THEN "
        f"CAST(IF({x} < 0, -1, 1) * CAST(replace({_BODY.format(x=x)}, '.', '') AS DECIMAL(18,0)) * CAST({_TENS.format(x=x)} AS DECIMAL(6,0)) AS DECIMAL(28,0)) END"
    )


def entry_sql(x: str) -> str:
    """One reading as an entry of an array of bins' sums."""
    return f"named_struct('bin', {bin_sql(x)}, 's', CAST({units_sql(x)} AS DECIMAL(38,0)))"


def _carried(entries: str) -> str:
    """Struct of ``u``, the sum of the entries below 10^15 in whole units of 10^-6, rounded down, whether ``more``
    than that is there, and ``huge``, the sum of the others (null without any)."""
    # What lies below the next bin's unit: nothing but whether it is there is needed later.
    gap = f"least(x.bin, {USUAL}) - a.at"
    power = f"CAST(rpad('1', {gap} + 1, '0') AS DECIMAL(38,0))"
    cut = f"CASE WHEN {gap} > 31 THEN IF(a.u < 0, CAST(-1 AS DECIMAL(38,0)), CAST(0 AS DECIMAL(38,0))) ELSE CAST((a.u - pmod(a.u, {power})) / {power} AS DECIMAL(38,0)) END"
    lost = f"CASE WHEN {gap} > 31 THEN a.u <> 0 ELSE pmod(a.u, {power}) <> 0 END"
    raised = f"CASE WHEN x.bin > {USUAL} THEN CAST(x.s * CAST(rpad('1', x.bin - {USUAL} + 1, '0') AS DECIMAL(22,0)) AS DECIMAL(38,0)) ELSE x.s END"
    zero = "CAST(0 AS DECIMAL(38,0))"
    state = lambda u, at, more, huge: f"named_struct('u', {u}, 'at', {at}, 'more', {more}, 'huge', {huge})"
    step = f"""CASE WHEN x.bin >= {HUGE} THEN {state("a.u", "a.at", "a.more", f"coalesce(a.huge, 0D) + CAST(concat(x.s, 'E', x.bin - {HUGE}) AS DOUBLE)")}
      WHEN {gap} = 0 THEN {state(f"CAST(a.u + {raised} AS DECIMAL(38,0))", "a.at", "a.more", "a.huge")}
      ELSE {state(f"CAST({cut} + {raised} AS DECIMAL(38,0))", f"least(x.bin, {USUAL})", f"a.more OR {lost}", "a.huge")} END"""
    # A last entry of nothing brings the sum to the usual bin.
    everything = f"sort_array(concat({entries}, array(named_struct('bin', {USUAL}, 's', {zero}))))"
    return f"aggregate({everything}, {state(zero, '-400', 'false', 'CAST(NULL AS DOUBLE)')}, (a, x) -> {step})"


_HALF = 5 * 10 ** (-USUAL - RESULT_SCALE - 1)


def _cents(u: str, units: str, n: str) -> str:
    """SQL of ``u`` whole units of 10^-6 over ``n``, rounded HALF_UP; ``units`` is its magnitude.  Never -0.0."""
    cents = f"CAST(CAST({units} + {n} * {_HALF} AS DECIMAL(38,0)) div CAST({n} * {2 * _HALF} AS DECIMAL(38,0)) AS DECIMAL(20,0))"
    value = f"CAST({cents} * {1 / 10**RESULT_SCALE}BD AS DOUBLE)"
    return f"IF({u} < 0, 0D - {value}, {value})"


def mean_sql(usual: str, unusual: str, n: str, odd: str = "CAST(NULL AS DOUBLE)") -> str:
    """SQL of the mean of ``n`` readings, rounded: ``usual`` is the usual bin's sum, ``unusual`` an array of the
    others', ``odd`` the sum of NaN and infinities among them, null without any."""
    # For a negative sum the whole units towards 0.
    exact = _cents("t.u", "IF(t.u < 0, -t.u - IF(t.more, 1, 0), t.u)", n)
    rounded = f"CASE WHEN t.huge IS NOT NULL THEN (t.huge + CAST(t.u AS DOUBLE) / 1e6D) / {n} ELSE {exact} END"
    carried = f"element_at(transform(array({_carried(_entries(usual, unusual))}), t -> {rounded}), 1)"
    return f"CASE WHEN {odd} IS NOT NULL THEN {odd} WHEN size({unusual}) = 0 THEN {_cents(usual, f'abs({usual})', n)} ELSE {carried} END"


def _entries(usual: str, unusual: str) -> str:
    return f"concat(array(named_struct('bin', {USUAL}, 's', {usual})), {unusual})"


def plain_mean_sql(usual: str, unusual: str, n: str, odd: str = "CAST(NULL AS DOUBLE)") -> str:
    """SQL of that mean as a double, not rounded to decimals: for rounding modes that take a double."""
    entries = _entries(usual, unusual)
    fine = f"aggregate(sort_array({entries}, false), 0D, (a, x) -> a + CAST(concat(x.s, 'E', IF(x.bin >= {HUGE}, x.bin - {HUGE}, x.bin)) AS DOUBLE))"
    whole = f"element_at(transform(array({_carried(entries)}), t -> IF(t.more OR t.huge IS NOT NULL, {fine}, CAST(t.u AS DOUBLE) / 1e6D)), 1)"
    return f"CASE WHEN {odd} IS NOT NULL THEN {odd} ELSE IF(size({unusual}) = 0, CAST({usual} AS DOUBLE) / 1e6D, {whole}) / {n} END"


def median_sql(low: str, high: str) -> str:
    """SQL of the rounded median, the mean of the two middle readings (one and the same of an odd number)."""
    special = f"CASE WHEN NOT abs({low}) < double('Infinity') OR NOT abs({high}) < double('Infinity') THEN {low} + {high} END"
    both = f"CAST({_SHORT_UNITS.format(x=low)} + {_SHORT_UNITS.format(x=high)} AS DECIMAL(38,0))"
    usual = _cents(both, f"abs({both})", "2")
    carried = mean_sql("CAST(0 AS DECIMAL(38,0))", f"array({entry_sql(low)}, {entry_sql(high)})", "2", special)
    return f"CASE WHEN {_SHORT.format(x=low)} AND {_SHORT.format(x=high)} THEN {usual} WHEN {low} IS NOT NULL THEN {carried} END"


def middle_sql(hist: str) -> str:
    """SQL of the two middle values (``low``, ``high``) of a histogram, an array of ``h`` and its number ``n``."""
    null = "CAST(NULL AS DOUBLE)"
    take = lambda side, rank: f"IF(a.{side} IS NULL AND a.seen + x.n > {rank}, x.h, a.{side})"
    step = f"named_struct('seen', a.seen + x.n, 'low', {take('low', '(t - 1) div 2')}, 'high', {take('high', 't div 2')})"
    walk = f"aggregate(sort_array({hist}), named_struct('seen', 0L, 'low', {null}, 'high', {null}), (a, x) -> {step})"
    return f"element_at(transform(array(aggregate({hist}, 0L, (a, x) -> a + x.n)), t -> {walk}), 1)"


#: For a single aggregate, which has no bins (update-mode streams): rows, their sum to 18 decimals, how many of
#: them that doesn't hold (10^15 and more, NaN), and the plain sum.
SINGLE_SQL = {
    "n": "count(*)",
    "units": "sum(IF(abs(temperature) < 1e15D, CAST(temperature AS DECIMAL(38,18)), NULL))",
    "wild": "count_if(NOT coalesce(abs(temperature) < 1e15D, true))",
    "total": "sum(temperature)",
    "med": "percentile(humidity, 0.5D)",
}
_SINGLE = "CAST(0 AS DECIMAL(38,0))"
_PARTS = "array(named_struct('bin', 0, 's', CAST(floor(units) AS DECIMAL(38,0))), named_struct('bin', -18, 's', CAST((units - floor(units)) * 1000000000000000000BD AS DECIMAL(38,0))))"
_PARTS = f"IF(units IS NULL, CAST(array() AS ARRAY<STRUCT<bin: INT, s: DECIMAL(38,0)>>), {_PARTS})"
SINGLE_MEAN_SQL = f"CASE WHEN wild > 0 THEN round(total / n, {RESULT_SCALE}) ELSE {mean_sql(_SINGLE, _PARTS, 'n')} END"
#: The median of an even number is there the mean of two readings as doubles: the 13th decimal is the last that counts.
SINGLE_MEDIAN_SQL = f"CASE WHEN n % 2 = 1 THEN {median_sql('med', 'med')} ELSE coalesce(CAST(round(try_cast(med AS DECIMAL(38,13)), {RESULT_SCALE}) AS DOUBLE), round(med, {RESULT_SCALE})) END"


@F.pandas_udf(T.DoubleType())
def _round2_half_even_binary(values: pd.Series) -> pd.Series:
    # Python's round() is correctly rounded on the binary value, ties to
    # even; numpy's round is not, so the builtin is applied per value.  Used
    # on aggregated rows only (one per group).
    return values.map(lambda v: None if pd.isna(v) else round(float(v), 2)).astype("float64")


def binary_half_even(c) -> Column:
    """Two-decimal rounding with Python semantics (optional rounding mode)."""
    return _round2_half_even_binary(F.col(c) if isinstance(c, str) else c)
