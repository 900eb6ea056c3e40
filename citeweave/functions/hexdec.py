"""Hexadecimal id strings to decimal digits of any length, as column
expressions (JVM side).

``hex_to_decimal``: lower-case, then a positional base-16 fold. A character
outside 0-9a-f counts as digit -1 (the fold does not reject it), so the result
can be negative; empty or null input gives null.

``hex_to_decimal_string``: the same for hexadecimal input only; null for
empty input or any other character.

Up to WIDTH digits (a SHA-1 id has 40) the value is straight bigint arithmetic
that whole-stage codegen compiles: chunks of 7 digits, below 2^28, are
multiplied by the base-1e9 limbs of their place value and added up limb by
limb; no sum leaves 63 bits, and one pass of carries gives the decimal limbs.
Each chunk and carry is a common subexpression, evaluated once a row; that is
why the expression is built without conditions around it and made null
afterwards. Beyond WIDTH digits, chunks are folded in a loop over limbs. All are exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMB = 1_000_000_000
_CHUNK = 7
_CHUNK_BASE = 16 ** _CHUNK
_OFFSET = 1 << 32
#: Digits of the straight form: three times two chunks.
WIDTH = 42


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


# -- any length: a loop ---------------------------------------------------------

def _limbs(hexadecimal: Column) -> Column:
    """Base-1e9 limbs, least first, of a valid hexadecimal string."""
    width = F.ceil(F.length(hexadecimal) / _CHUNK) * _CHUNK
    padded = F.lpad(hexadecimal, width.cast("int"), "0")
    chunks = F.transform(F.regexp_extract_all(padded, F.lit(f".{{{_CHUNK}}}"), F.lit(0)), lambda h: F.conv(h, 16, 10).cast("bigint"))

    def add_chunk(limbs, chunk):
        # A limb times 2^28 plus a carry below 2^30 stays below 2^63.
        start = F.struct(F.array().cast("array<bigint>").alias("out"), chunk.alias("carry"))
        step = F.aggregate(limbs, start, lambda st, limb: F.struct(
            F.concat(st["out"], F.array((limb * _CHUNK_BASE + st["carry"]) % _LIMB)).alias("out"),
            _div(limb * _CHUNK_BASE + st["carry"], _LIMB).alias("carry")))
        return F.when(step["carry"] > 0, F.concat(step["out"], F.array(step["carry"]))).otherwise(step["out"])

    return F.aggregate(chunks, F.array(F.lit(0).cast("bigint")), add_chunk)


def _difference(more: Column, less: Column) -> Column:
    """Limbs of the difference; ``more`` is at least ``less``."""
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("borrow"))
    pairs = F.zip_with(more, less, lambda x, y: F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0)))
    step = F.aggregate(pairs, start, lambda st, d: F.struct(
        F.concat(st["out"], F.array(F.pmod(d - st["borrow"], F.lit(_LIMB).cast("bigint")))).alias("out"),
        F.when(d < st["borrow"], 1).otherwise(0).cast("bigint").alias("borrow")))
    return step["out"]


def _text(limbs: Column) -> Column:
    digits = F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
    return F.regexp_replace(digits, "^0+(?=[0-9])", "")


# -- up to WIDTH digits: straight arithmetic ------------------------------------

def _chunks(padded: Column) -> list[Column]:
    """The values of the chunks of WIDTH digits, least first, two from each conversion;
    null for some strings that are not hexadecimal."""
    out = []
    for k in range(WIDTH // (2 * _CHUNK)):
        pair = F.conv(F.substring(padded, WIDTH - 2 * _CHUNK * (k + 1) + 1, 2 * _CHUNK), 16, 10).try_cast("bigint")
        out += [pair.bitwiseAND(F.lit(_CHUNK_BASE - 1).cast("bigint")), F.shiftright(pair, 4 * _CHUNK)]
    return out


def _digits(chunks: list[Column]) -> Column:
    """The decimal digits of sum(chunk * 2^28 ** place), without leading zeros. Chunks
    lie within 2^28 of zero, and their sum is not negative."""
    n = -(-len(str(16 ** WIDTH)) // 9)
    limbs, carry = [], None
    for k in range(n):
        total = carry
        for place, chunk in enumerate(chunks):
            weight = _CHUNK_BASE ** place // _LIMB ** k % _LIMB
            if weight:
                term = chunk * F.lit(weight).cast("bigint")
                total = term if total is None else total + term
        # Six products within 2^28 * 1e9 of zero and a carry stay within 2^61. What is added makes
        # the sum positive and is a whole number of limbs, so division rounds down.
        total = total + F.lit(_OFFSET * _LIMB).cast("bigint")
        carry = _div(total, _LIMB) - F.lit(_OFFSET).cast("bigint")
        limbs.append(total % _LIMB)
    pairs = [limbs[k] + (limbs[k + 1] * _LIMB if k + 1 < n else F.lit(0).cast("bigint")) for k in range(0, n, 2)]
    # The last digit stands apart, so that of zero one digit stays when leading zeros go.
    last = pairs[0] % 10
    upper = [p.cast("string") for p in (*pairs[:0:-1], _div(pairs[0], 10))]
    width = [18] * (len(pairs) - 1) + [17]
    return F.concat(F.ltrim(F.concat(*[F.lpad(x, w, "0") for x, w in zip(upper, width)]), F.lit("0")), last.cast("string"))


def hex_to_decimal_string(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    # Concatenation evaluates all its parts, and gives null if one is.
    short = F.when((F.length(c) <= WIDTH) & c.rlike("^[0-9a-fA-F]+$"), F.lit(""))
    straight = F.concat(_digits(_chunks(F.lpad(c, WIDTH, "0"))), short)
    looped = F.when((F.length(c) > WIDTH) & c.rlike("^[0-9a-fA-F]+$"), _text(_limbs(c)))
    return F.coalesce(straight, looped)


def hex_to_decimal(col: Column | str) -> Column:
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    # The fold is (digits, others as 0) minus (others as 1, digits as 0): two
    # hexadecimal strings of one length, so they compare as their values do.
    plus = F.regexp_replace(c, "(?s)[^0-9a-f]", "0")
    minus = F.regexp_replace(F.regexp_replace(c, "[0-9a-f]", "0"), "(?s)[^0]", "1")
    more, less = F.lpad(F.greatest(plus, minus), WIDTH, "0"), F.lpad(F.least(plus, minus), WIDTH, "0")
    chunks = [x - y for x, y in zip(_chunks(more), _chunks(less))]
    short = F.when((F.length(c) > 0) & (F.length(c) <= WIDTH), F.when(plus >= minus, "").otherwise("-"))
    straight = F.concat(short, _digits(chunks))
    a, b = _limbs(plus), _limbs(minus)
    looped = F.when(plus >= minus, _text(_difference(a, b))).otherwise(F.concat(F.lit("-"), _text(_difference(b, a))))
    return F.coalesce(straight, F.when(F.length(c) > WIDTH, looped))
