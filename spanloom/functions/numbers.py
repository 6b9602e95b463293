"""Numeric expressions: angles, rotations, quantised codes, costs, rates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quaternion_to_rpy(x: Column, y: Column, z: Column, w: Column) -> Column:
    """Roll, pitch, yaw (radians) of a unit quaternion."""
    roll = F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y))
    pitch = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * (w * y - z * x))))
    yaw = F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))
    return F.array(roll, pitch, yaw)


def rotation(roll: Column, pitch: Column, yaw: Column) -> list[Column]:
    """The nine entries (row by row) of Rz(yaw) Ry(pitch) Rx(roll)."""
    cr, sr, cp, sp, cy, sy = F.cos(roll), F.sin(roll), F.cos(pitch), F.sin(pitch), F.cos(yaw), F.sin(yaw)
    return [cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr, sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr, -sp, cp * sr, cp * cr]


def turn_degrees(a: list[Column], b: list[Column]) -> Column:
    """The angle between two rotations given by their entries."""
    trace = sum((x * y for x, y in zip(a, b)), F.lit(0.0))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2))))


def quantised(x: Column, lo: Column, hi: Column, bits: int = 16) -> Column:
    """x between lo and hi as a code from 0; the top code stands for no reading."""
    top = (1 << bits) - 1
    step = (hi - lo) / (top - 1)
    code = F.when(step > 0, F.rint((x - lo) / step)).otherwise(0.0)
    return F.when(x.isNull() | F.isnan(x), F.lit(top)).otherwise(code.cast("long"))


def restored(code: Column, lo: Column, hi: Column, bits: int = 16) -> Column:
    top = (1 << bits) - 1
    return F.when(code < top, lo + code * (hi - lo) / (top - 1))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays of one length."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def spread_places(n: Column, k: int) -> Column:
    """At most k places evenly spread over 0..n-1, both ends included."""
    return F.when(n <= k, F.sequence(F.lit(0), n - 1)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (n - 1) / (k - 1)).cast("int"))))


def window_starts(length: Column, width: int, stride: int) -> Column:
    """Starts of sliding windows, the last flush with the end."""
    last = F.greatest(length - width, F.lit(0))
    return F.array_sort(F.array_union(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(stride).cast("long")), F.array(last.cast("long"))))


#: The digits of base 64, five bits a digit and one that says whether more follow.
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def number_text(n: Column) -> Column:
    """A whole number as a text of base 64 digits: the sign in the lowest bit, low digits first."""
    v = F.when(n < 0, -2 * n + 1).otherwise(2 * n).cast("long")
    last = F.ceil(F.length(F.bin(v)) / 5).cast("int") - 1
    digit = lambda i: F.call_function("div", v, F.pow(F.lit(32.0), i).cast("long")) % 32 + F.when(i < last, 32).otherwise(0)
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.lit(DIGITS), (digit(i) + 1).cast("int"), F.lit(1))), "")


def text_numbers(s: Column) -> Column:
    """The whole numbers of a text that ``number_text`` made of several, one after the other."""
    value = lambda c: F.call_function("instr", F.lit(DIGITS), c) - 1
    digits = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: (value(F.substring(w, i, F.lit(1))) % 32).cast("long") * F.pow(F.lit(32.0), i - 1).cast("long"))
    whole = lambda w: F.aggregate(digits(w), F.lit(0).cast("long"), lambda a, x: a + x)
    signed = lambda v: F.when(v % 2 == 1, -F.call_function("div", v, F.lit(2))).otherwise(F.call_function("div", v, F.lit(2)))
    return F.transform(F.regexp_extract_all(s, F.lit("[g-z0-9+/]*[A-Za-f]"), F.lit(0)), lambda w: signed(whole(w)))
