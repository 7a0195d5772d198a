"""Kafka wire forms of the reference's serdes as column expressions.

Long is 8-byte big-endian two's complement, Integer 4-byte big-endian, String
UTF-8; a null value is a tombstone and stays null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def encode_long(col: Column | str) -> Column:
    c = _c(col).cast("bigint")
    # hex() of a negative bigint is its 64-bit two's complement already.
    return F.unhex(F.lpad(F.hex(c), 16, "0"))


def decode_long(col: Column | str) -> Column:
    return F.conv(F.hex(_c(col)), 16, -10).cast("bigint")


def encode_int(col: Column | str) -> Column:
    c = _c(col).cast("bigint")
    # keep the low 32 bits (two's complement of a negative int)
    return F.unhex(F.lpad(F.hex(F.pmod(c, F.lit(1 << 32))), 8, "0"))


def decode_int(col: Column | str) -> Column:
    u = F.conv(F.hex(_c(col)), 16, 10).cast("bigint")
    return F.when(u >= F.lit(1 << 31), u - F.lit(1 << 32)).otherwise(u).cast("int")


def encode_string(col: Column | str) -> Column:
    return F.encode(_c(col).cast("string"), "UTF-8")


def decode_string(col: Column | str) -> Column:
    return F.decode(_c(col), "UTF-8")


KAFKA_ENCODERS = {"bigint": encode_long, "long": encode_long, "int": encode_int,
                  "string": encode_string}
KAFKA_DECODERS = {"bigint": decode_long, "long": decode_long, "int": decode_int,
                  "string": decode_string}
