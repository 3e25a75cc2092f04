"""Seeded integer hashing as plain BIGINT column arithmetic.

Used wherever the reference draws random numbers (car ids, speeds, picks from a
table).  The mix below is deterministic, stays inside whole-stage codegen, and
is simple enough that an SQL engine can reproduce every value, so generated
data is checkable.  All intermediate products stay below 2^63 for any
non-negative BIGINT input (the id is folded to 31 bits first), so ANSI mode
never raises on overflow.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

M31 = 2147483648  # 2^31; every intermediate value is reduced modulo this
_MUL_1, _MUL_2, _MUL_3 = 2654435761, 2246822519, 3266489917
_SALT_STEP = 7919


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash31(id_col, salt: int = 0) -> Column:
    """Uniform 31-bit hash of a non-negative BIGINT column for a given salt."""
    x = _col(id_col).cast("bigint")
    folded = F.pmod(x.bitwiseXOR(F.shiftright(x, 31)), F.lit(M31))
    a = F.pmod((folded + F.lit(salt * _SALT_STEP + 1)) * F.lit(_MUL_1), F.lit(M31))
    b = F.pmod(a.bitwiseXOR(F.shiftright(a, 15)) * F.lit(_MUL_2), F.lit(M31))
    c = F.pmod(b.bitwiseXOR(F.shiftright(b, 13)) * F.lit(_MUL_3), F.lit(M31))
    return c.bitwiseXOR(F.shiftright(c, 16))


def uniform_int(id_col, lo: int, hi: int, salt: int = 0) -> Column:
    """Integer uniform on [lo, hi] (both inclusive), like ``random.randint``."""
    span = hi - lo + 1
    # (h * span) div 2^31, exact in BIGINT: h < 2^31 and span < 2^32
    return F.lit(lo).cast("bigint") + F.shiftright(hash31(id_col, salt) * F.lit(span), 31)


def uniform_index(id_col, n: Column, salt: int = 0) -> Column:
    """Index uniform on [0, n) where ``n`` is a column (e.g. a table's row count)."""
    return F.shiftright(hash31(id_col, salt) * n.cast("bigint"), 31)


def uniform_hundredths(id_col, lo: int, hi: int, salt: int = 0) -> Column:
    """Double uniform on [lo, hi] with two decimals (``round(uniform(lo, hi), 2)``)."""
    return uniform_int(id_col, lo * 100, hi * 100, salt).cast("double") / F.lit(100.0)
