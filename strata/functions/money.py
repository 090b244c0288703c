"""Exact money arithmetic on double columns.

A sum of doubles depends on the order of the rows, and so on how a cluster splits them. Amounts
are therefore summed as integers (cents); the result is the same for every partitioning.
What has no exact integer form (NaN, infinities, amounts of LIMIT and more) is added as double, so
it shows in the result as it would in a plain sum: no row that is counted is missing from the money.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this every count of cents is a whole number that a double holds.
LIMIT = 9e13


def minor_units(amount: Column, digits: int = 2) -> Column:
    """The amount as a whole number of 10^-digits units; NULL when it has none."""
    exact = F.abs(amount) < F.lit(LIMIT)
    return F.when(exact, F.round(amount * F.lit(float(10**digits))).try_cast("bigint"))


def _beyond(amount: Column) -> Column:
    """The amount where it has no exact form."""
    return F.when(~(F.abs(amount) < F.lit(LIMIT)), amount)


def _with_beyond(exact: Column, amount: Column, combine) -> Column:
    """`exact`, or what `combine` makes of the sum of the other amounts when there are any."""
    odd = _beyond(amount)
    return F.when(F.count(odd) == 0, exact).otherwise(combine(F.sum(odd)))


def _total(amount: Column) -> Column:
    """Sum of the amounts with an exact form; as doubles only when the cents exceed 64 bits."""
    units = minor_units(amount)
    plain = F.sum(F.when(F.abs(amount) < F.lit(LIMIT), amount))
    return F.coalesce(F.try_sum(units) / F.lit(100.0), plain)


def exact_sum(amount: Column) -> Column:
    """Aggregate: sum of the amounts, as double; NULL when there is none."""
    total = _total(amount)
    return _with_beyond(total, amount, lambda odd: F.coalesce(total, F.lit(0.0)) + odd)


def exact_mean(amount: Column) -> Column:
    """Aggregate: mean of amounts in whole cents, rounded half up (away from zero) to cents.

    Divides with remainder instead of doubling the sum, so the range of the sum is not halved.
    """
    cents = _rounded_share(F.try_sum(minor_units(amount)), F.count(minor_units(amount)))
    plain = F.round(F.try_divide(_total(amount), F.count(amount)), 2)
    return _with_beyond(
        F.coalesce(cents, plain), amount,
        lambda odd: F.round((F.coalesce(_total(amount), F.lit(0.0)) + odd) / F.count(amount), 2),
    )


def _rounded_share(total: Column, n: Column) -> Column:
    """total / n of whole cents as an amount, rounded half up (away from zero) to cents; NULL for n = 0."""
    step = F.nullif(n, F.lit(0))
    size = F.abs(total)
    rest = size % step
    rounded = _div(size, step) + F.when(rest * 2 >= step, 1).otherwise(0)
    return F.when(total < 0, -rounded).otherwise(rounded) / F.lit(100.0)


def price_mean(price: Column) -> Column:
    """Aggregate: mean of prices with any number of decimals, rounded once, to two digits.

    Prices are summed as decimals of 12 digits after the point, which hold a price of up to seven
    figures whole; prices beyond the range are added as double.
    """
    exact = F.abs(price) < F.lit(1e12)
    total = F.coalesce(
        F.try_sum(F.when(exact, price).try_cast("decimal(28,12)")).cast("double"),
        F.sum(F.when(exact, price)),
    )
    odd = F.when(~exact, price)
    whole = F.when(F.count(odd) == 0, total).otherwise(F.coalesce(total, F.lit(0.0)) + F.sum(odd))
    return F.round(F.try_divide(whole, F.count(price)), 2)


def _div(a: Column, b: Column) -> Column:
    """Integer division; `/` would go through double and lose digits above 2^53."""
    return F.call_function("div", a, b)


# The same sums and means in parts that can be stored and added up.

def money_parts(name: str, amount: Column) -> dict[str, Column]:
    """Aggregates from which `sum_of` and `mean_of` follow; all of them are merged by adding up."""
    units, odd = minor_units(amount), _beyond(amount)
    return {
        f"{name}_cents": F.sum(units.cast("decimal(19,0)")).cast("decimal(38,0)"), f"{name}_whole": F.count(units),
        f"{name}_odd": F.sum(odd), f"{name}_odds": F.count(odd), f"{name}_n": F.count(amount),
    }


def _amount_of(name: str) -> Column:
    cents = F.col(f"{name}_cents")
    return F.coalesce(cents.try_cast("bigint") / F.lit(100.0), cents.cast("double") / F.lit(100.0))


def _odd_or(name: str, exact: Column, combine) -> Column:
    return F.when(F.coalesce(f"{name}_odds", F.lit(0)) == 0, exact).otherwise(combine(F.col(f"{name}_odd")))


def sum_of(name: str) -> Column:
    """What `exact_sum` gives, from stored parts."""
    total = _amount_of(name)
    return _odd_or(name, total, lambda odd: F.coalesce(total, F.lit(0.0)) + odd)


def mean_of(name: str) -> Column:
    """What `exact_mean` gives, from stored parts."""
    n = F.col(f"{name}_n")
    cents = _rounded_share(F.col(f"{name}_cents").try_cast("bigint"), F.col(f"{name}_whole"))
    plain = F.round(F.try_divide(_amount_of(name), n), 2)
    return _odd_or(name, F.coalesce(cents, plain), lambda odd: F.round((F.coalesce(_amount_of(name), F.lit(0.0)) + odd) / n, 2))


def price_parts(name: str, price: Column) -> dict[str, Column]:
    """Aggregates from which `price_mean_of` follows; all of them are merged by adding up."""
    exact = F.abs(price) < F.lit(1e12)
    odd = F.when(~exact, price)
    return {
        f"{name}_decimal": F.sum(F.when(exact, price).try_cast("decimal(28,12)")).cast("decimal(38,12)"),
        f"{name}_odd": F.sum(odd), f"{name}_odds": F.count(odd), f"{name}_n": F.count(price),
    }


def price_mean_of(name: str) -> Column:
    """What `price_mean` gives, from stored parts."""
    total = F.col(f"{name}_decimal").cast("double")
    whole = _odd_or(name, total, lambda odd: F.coalesce(total, F.lit(0.0)) + odd)
    return F.round(F.try_divide(whole, F.col(f"{name}_n")), 2)
