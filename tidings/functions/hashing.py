"""32-bit polynomial string hash (the JVM ``String.hashCode`` rule).

h = 31*h + c over UTF-16 code units, wrapped to a signed 32-bit int.  Built as
a native higher-order expression so it stays inside whole-stage codegen; no
Python UDF.  ``split(s, '')`` yields code points, so a character above U+FFFF
is folded in as its surrogate pair: h = 961*h + 31*high + low.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_MOD = 4294967296  # 2**32
_HALF = 2147483648  # 2**31


def string_hash32(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    points = F.transform(F.split(c, ""), lambda ch: F.ascii(ch).cast("bigint"))

    def step(acc, cp):
        off = cp - F.lit(0x10000)
        high = F.lit(0xD800) + F.shiftright(off, 10)
        low = F.lit(0xDC00) + F.pmod(off, F.lit(0x400))
        bmp = F.pmod(acc * 31 + cp, F.lit(_MOD))
        pair = F.pmod(acc * 961 + high * 31 + low, F.lit(_MOD))
        return F.when(cp > F.lit(0xFFFF), pair).otherwise(bmp)

    h = F.aggregate(points, F.lit(0).cast("bigint"), step)
    # split('') of an empty string yields [''] whose ascii is 0: 31*0+0 = 0, as expected
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.when(h >= _HALF, h - _MOD).otherwise(h)).cast("int")
