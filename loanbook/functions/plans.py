"""Vectorized arithmetic of amortization plans.

Two Arrow functions work on whole batches of loans with numpy. Money is counted in
ten-thousandths and rates in units of 1e-10, as whole numbers, so every rounding is the
exact decimal HALF_UP. The rate search, whose plans are not rounded, takes doubles where they are sure and whole numbers elsewhere. Everything around them (joins, dates, expansion) is plain Spark.
"""

from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_UNIT = 10_000
RATE_UNIT = 10_000_000_000

# Search interval of the daily rate (0.001 to 0.020), tolerance on the interest.
RATE_LOW, RATE_HIGH = 10_000_000, 200_000_000
RATE_TOLERANCE = 0.0001
TOLERANCES = 10_000
WIDE = Context(prec=60)
# The interval is below one unit after 28 halvings.
RATE_STEPS = 40

_SPLIT = 100_000

ROWS = T.ArrayType(T.StructType([
    T.StructField("seq", T.IntegerType()),
    T.StructField("interes", T.LongType()),
    T.StructField("capital", T.LongType()),
]))


def plan_interest(principal, level, n, rate):
    """Total interest of a declining plan in closed form."""
    growth = np.power(1.0 + rate, n - 1)
    balance = principal * growth - level * (growth - 1.0) / rate
    return balance - principal + (n - 1) * level + rate * balance


def interest_error(principal, level, n, rate):
    """What doubles may be wrong by in plan_interest, with room to spare."""
    return 8 * np.finfo(float).eps * (n + 8) * np.power(1.0 + rate, n) * (principal + level / rate) + 1e-12


def exact_miss(principal: Decimal, level: Decimal, interest: Decimal, n: int, rate: int) -> int:
    """Interest of the plan, whose steps are not rounded, less the one wanted: below (-1), within the tolerance (0) or above (1).

    The closed form in whole numbers: amounts in 1e-14, powers of 1 + rate over the power of RATE_UNIT.
    """
    p, q, want = (int(x.scaleb(14, WIDE)) for x in (principal, level, interest))
    one = RATE_UNIT ** (n - 1)
    growth = (RATE_UNIT + rate) ** (n - 1)
    balance = p * growth - q * RATE_UNIT * ((growth - one) // rate)  # over `one`; the division leaves no rest
    miss = (balance - p * one + (n - 1) * q * one) * RATE_UNIT + rate * balance - want * one * RATE_UNIT
    within = 10 ** 14 * RATE_UNIT * one // TOLERANCES
    return 0 if abs(miss) < within else -1 if miss < 0 else 1


def search_rates(principal, level, interest, n, exact):
    """Bisection for all loans at once; the first trial within tolerance is kept.

    Doubles decide a trial wherever their error cannot; ``exact`` (row -> the amounts as decimals) decides the rest.
    """
    lo = np.full(len(n), RATE_LOW, dtype=np.int64)
    hi = np.full(len(n), RATE_HIGH, dtype=np.int64)
    rate = (lo + hi + 1) // 2
    open_ = np.ones(len(n), bool)
    for _ in range(RATE_STEPS):
        own = np.flatnonzero(open_)
        if not len(own):
            break
        r = rate[own] / RATE_UNIT
        miss = plan_interest(principal[own], level[own], n[own], r) - interest[own]
        sign = np.where(np.abs(miss) < RATE_TOLERANCE, 0, np.sign(miss)).astype(np.int64)
        doubt = ~(np.abs(np.abs(miss) - RATE_TOLERANCE) > interest_error(principal[own], level[own], n[own], r))
        for k in np.flatnonzero(doubt):
            sign[k] = exact_miss(*exact(own[k]), int(rate[own[k]]))
        lo[own[sign < 0]] = rate[own[sign < 0]]
        hi[own[sign > 0]] = rate[own[sign > 0]]
        open_[own[sign == 0]] = False
        again = own[sign != 0]
        rate[again] = (lo[again] + hi[again] + 1) // 2
    return rate


def times_rate(balance, rate, digits):
    """balance x rate rounded half up at 2 or 4 digits, in ten-thousandths.

    The balance is split so that products stay within 64 bits.
    """
    size = np.abs(balance)
    head = (size // _SPLIT) * rate
    whole = head // _SPLIT
    rest = (head % _SPLIT) * _SPLIT + (size % _SPLIT) * rate
    if digits == 4:
        out = whole + (rest + RATE_UNIT // 2) // RATE_UNIT
    else:
        unit = RATE_UNIT * 100
        out = (whole // 100 + ((whole % 100) * RATE_UNIT + rest + unit // 2) // unit) * 100
    return np.where(balance < 0, -out, out)


def beyond(principal, rate):
    """Loans whose products do not fit into 64 bits."""
    return np.abs(principal) // _SPLIT >= 2 ** 62 // np.maximum(rate, 1)


# Cells of the arrays that one chunk of a batch fills.
CHUNK_CELLS = 2_000_000


def plan_chunks(principal, rate, terms):
    """Row numbers of a batch, in chunks of like terms with a bounded number of cells.

    Loans beyond 64 bits have chunks of their own, so they do not slow the others down.
    """
    large = beyond(principal, rate)
    order = np.lexsort((terms, large))
    at = 0
    while at < len(order):
        to = at + 1
        while (to < len(order) and large[order[to]] == large[order[at]]
               and (to + 1 - at) * max(1, int(terms[order[to]])) <= CHUNK_CELLS):
            to += 1
        yield order[at:to]
        at = to


def plan_rows(principal, rate, level, n, digits=4, guarded=True):
    """Interest and capital per instalment, as two (loans x longest term) arrays.

    Amounts beyond 64-bit products are counted with Python's whole numbers; see plan_chunks.

    Guarded: interest within 0 and the instalment, capital within the balance, and the last
    row clears the balance. Unguarded: the plain recurrence.
    """
    longest = int(n.max()) if len(n) else 0
    if len(n) and beyond(principal, rate).any():
        principal, rate, level = (x.astype(object) for x in (principal, rate, level))
    interest = np.zeros((len(n), longest), dtype=np.int64)
    capital = np.zeros((len(n), longest), dtype=np.int64)
    balance = principal
    for i in range(longest):
        raw = times_rate(balance, rate, digits)
        if guarded:
            last = n == i + 1
            charged = np.where(last, raw, np.minimum(np.maximum(raw, 0), level))
            paid = np.where(last, balance, np.minimum(level - charged, balance))
        else:
            charged, paid = raw, level - raw
        interest[:, i], capital[:, i] = charged, paid
        balance = balance - paid
    return interest, capital


def _ints(a):
    return a.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _floats(a):
    return a.fill_null(0.0).to_numpy(zero_copy_only=False)


@F.arrow_udf(T.LongType())
def rate_units(principal: pa.Array, level: pa.Array, interest: pa.Array, n: pa.Array) -> pa.Array:
    """Hidden daily rate of decimal amounts, in units of 1e-10; 0 where an input is not positive."""
    p, q, want, k = (_floats(x.cast(pa.float64())) for x in (principal, level, interest, n))
    usable = np.flatnonzero((p > 0) & (want > 0) & (k > 0))
    out = np.zeros(len(p), dtype=np.int64)

    def exact(row):
        at = int(usable[row])
        return principal[at].as_py(), level[at].as_py(), interest[at].as_py(), int(k[at])

    out[usable] = search_rates(p[usable], q[usable], want[usable], k[usable], exact)
    return pa.array(out)


def plan_function(digits: int, guarded: bool):
    """Arrow function (principal, rate, level, n) -> array of (seq, interes, capital)."""

    @F.arrow_udf(ROWS)
    def plan(principal: pa.Array, rate: pa.Array, level: pa.Array, n: pa.Array) -> pa.Array:
        terms = np.maximum(_ints(n), 0)
        owed, rates, levels = _ints(principal), _ints(rate), _ints(level)
        offsets = np.concatenate([[0], np.cumsum(terms)])
        seq, interest, capital = (np.zeros(offsets[-1], np.int64) for _ in range(3))
        for rows in plan_chunks(owed, rates, terms):
            i, c = plan_rows(owed[rows], rates[rows], levels[rows], terms[rows], digits, guarded)
            step = np.arange(i.shape[1])
            used = step[None, :] < terms[rows][:, None]
            place = (offsets[:-1][rows][:, None] + step[None, :])[used]
            seq[place] = np.broadcast_to(step + 1, i.shape)[used]
            interest[place], capital[place] = i[used], c[used]
        parts = pa.StructArray.from_arrays(
            [pa.array(seq.astype(np.int32)), pa.array(interest), pa.array(capital)],
            names=["seq", "interes", "capital"])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), parts)

    return plan
