"""Numeric parsing, rounding, and sums that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

UNSIGNED = r"(\d+\.?\d*|\.\d+)"
NUMBER = rf"^[+-]?{UNSIGNED}([eE][+-]?\d+)?$"
FRACTION = rf"^{UNSIGNED}\s*/\s*{UNSIGNED}$"

INF = float("inf")


def finite(c: Column) -> Column:
    """NaN and infinities become null, so that averages skip them."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(INF)), c)


def parse_number(c: Column) -> Column:
    """Text to double; anything that is not a finite decimal number is null."""
    s = strip(c)
    return F.when(s.rlike(NUMBER), finite(s.try_cast("double")))


def parse_fraction(c: Column) -> Column:
    """``'3/4'`` to ``(num=3, den=4, ratio=75)``; a plain number gives only ``num``."""
    s = strip(c)
    top, bottom = F.regexp_extract(s, FRACTION, 1), F.regexp_extract(s, FRACTION, 2)
    num, den = fraction_number(s, top), bottom.try_cast("double")
    return F.struct(num.alias("num"), den.alias("den"), fraction_ratio(num, den).alias("ratio"))


def fraction_number(stripped: Column, top: Column) -> Column:
    """Numerator, from the text left of the slash or else from the whole text."""
    plain = F.when(stripped.rlike(NUMBER), stripped)
    return finite(F.when(top != "", top).otherwise(plain).try_cast("double"))


def fraction_ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den * 100)


def outlier_flag(hours: Column, low: float, high: float) -> Column:
    return F.coalesce(((hours < F.lit(low)) | (hours > F.lit(high))).cast("int"), F.lit(0))


def parse_percent(c: Column) -> Column:
    """``'87.9%'`` to ``87``: truncated, and 0 where it cannot be read."""
    value = parse_number(F.replace(c, F.lit("%"), F.lit("")))
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def round_half_away(c: Column, digits: int) -> Column:
    """Scale, round half away from zero, unscale: the arithmetic of SQL ROUND on doubles."""
    scale = float(10**digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def round_half_even(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


# Sums of doubles depend on their order; sums of whole numbers do not. A value is cut into
# whole numbers of 63 bits, those of its integer part and of two steps of its fraction, and
# each of them into pieces of 21 bits, whose sums stay exact for 2^42 rows. The pieces are
# put together when all rows are summed, and the exact total is rounded once. Beside them
# lie plain sums of what they do not reach: values of 2^62 and more, and bits below 2^-126.
STEP, BITS = 63, 21
PIECES = STEP // BITS
PARTS = [*[f"{part}{piece}" for part in ("whole", "fine", "finer") for piece in range(PIECES)], "rest", "large"]

# The expressions are written as SQL text: built call by call they would cost most of a second each.


def _text(c: Column | str) -> str:
    return c if isinstance(c, str) else c._jc.node().sql()


def _power(exponent: int) -> str:
    return f"double('{float(2) ** exponent!r}')"


def _cut(x: str) -> list[str]:
    """All parts of a value, in the order of ``PARTS``; every step is exact."""
    near = f"(case when abs({x}) < {_power(62)} then {x} end)"
    whole = f"cast({near} as bigint)"
    scaled = f"(({near} - cast({whole} as double)) * {_power(STEP)})"
    fine = f"cast({scaled} as bigint)"
    scaled_again = f"(({scaled} - cast({fine} as double)) * {_power(STEP)})"
    finer = f"cast({scaled_again} as bigint)"
    mask = f"{(1 << BITS) - 1}L"
    # The lowest bits, those above them, and the rest with the sign.
    pieces = [p for n in (whole, fine, finer) for p in (f"({n} & {mask})", f"(shiftright({n}, {BITS}) & {mask})", f"shiftright({n}, {2 * BITS})")]
    rest = f"(({scaled_again} - cast({finer} as double)) * {_power(-2 * STEP)})"
    return [*pieces, rest, f"(case when abs({x}) < {_power(62)} then null else {x} end)"]


def sum_parts(c: Column | str, name: str) -> list[Column]:
    """Aggregates of one group, named after ``name``, to be added up by ``summed_parts``."""
    return [F.expr(f"sum({x}) as `{name}_{part}`") for x, part in zip(_cut(_text(c)), PARTS, strict=True)]


def merged_parts(name: str) -> list[Column]:
    """Aggregates that bring groups of ``sum_parts`` together, under the same names."""
    return [F.expr(f"sum(`{name}_{part}`) as `{name}_{part}`") for part in PARTS]


def summed_parts(name: str, where: str | None = None) -> Column:
    """Exact sum over groups that ``sum_parts`` reduced, or those with ``where`` (SQL); null without values."""
    columns = [f"`{name}_{part}`" for part in PARTS]
    return F.expr(_total([f"sum({c})" if where is None else f"sum(case when {where} then {c} end)" for c in columns]))


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _total(sums: list[str]) -> str:
    """Carry from the lowest piece up, then round the whole once to the nearest double."""
    *pieces, rest, large = sums
    low = [p for part in (2, 1, 0) for p in pieces[part * PIECES : (part + 1) * PIECES]]
    given = f"named_struct('low', array({', '.join(low[:-1])}), 'top', {low[-1]}, 'rest', {rest}, 'large', {large})"
    digits = f"""aggregate(s.low, named_struct('carry', 0L, 'digits', cast(array() as array<bigint>)), (a, x) ->
        named_struct('carry', shiftright(a.carry + x, {BITS}), 'digits', array_append(a.digits, (a.carry + x) & {(1 << BITS) - 1}L)))"""

    def joined(first: int, n: int) -> str:
        return "(" + " + ".join(f"shiftleft(d.digits[{first + k}], {BITS * k})" for k in range(n)) + ")"

    exact = "decimal(38,0)"
    whole = f"cast(cast(s.top + d.carry as {exact}) * {1 << 2 * BITS}L + {joined(2 * PIECES, PIECES - 1)} as {exact})"
    parts = f"named_struct('whole', {whole}, 'fine', {joined(PIECES, PIECES)}, 'finer', {joined(0, PIECES)})"
    wide = f"cast(p.whole * {1 << STEP} + p.fine as {exact})"

    def nearest(number: str, more: str, exponent: int) -> str:
        """``number`` and a little above it if ``more``; an odd last bit stands for that little."""
        return f"cast({number} * 2 + cast({more} as int) as double) * {_power(exponent - 1)}"

    rounded = f"""case
        when abs(p.whole) >= {1 << 56}L then {nearest("p.whole", "p.fine > 0 or p.finer > 0", 0)}
        when abs({wide}) >= {1 << 56}L then {nearest(wide, "p.finer > 0", -STEP)}
        else cast(cast({wide} * {1 << STEP} + p.finer as {exact}) as double) * {_power(-2 * STEP)} end"""
    near = f"{_let('d', digits, _let('p', parts, rounded))} + s.rest"
    return _let("s", given, f"case when s.top is null then s.large else {near} + coalesce(s.large, 0D) end")


def stable_sum(c: Column | str) -> Column:
    """The exact sum, rounded once; null without values, the same for every order and partitioning."""
    return F.expr(_total([f"sum({x})" for x in _cut(_text(c))]))


def stable_avg(c: Column | str) -> Column:
    return F.try_divide(stable_sum(c), F.count(F.expr(_text(c))))


def at_least(c: Column, low: float | int) -> Column:
    """Clip from below; null stays null."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def presentable(c: Column, data_type: str) -> Column:
    """A result cell as plain value: NaN is null, anything but numbers, text and booleans is text."""
    if data_type in ("double", "float"):
        return F.when(~F.isnan(c), c)
    if data_type in ("tinyint", "smallint", "int", "bigint", "string", "boolean"):
        return c
    return c.cast("string")
