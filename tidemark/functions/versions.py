"""Version numbers: BIGINT everywhere, 0 means "from the beginning", and hex text only at the edges.

The reference carries row versions as 8-byte binary / ``0x``-prefixed hex text.  We keep them as BIGINT and convert
with these helpers when text is needed (reports, replay commands).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the version representation.
BEGINNING = 0                    # "0x": before every version
MAX_VERSION = (1 << 63) - 1      # "no upper bound" (the reference's 0x9999999999999999 overflows BIGINT)
HEX_PREFIX = "0x"
HEX_DIGITS = 16
OPEN_UPPER_TEXT = "0x9999999999999999"


def rv_to_hex(col: Column | str) -> Column:
    """Version → ``0x`` + 16 upper-case hex digits."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(HEX_PREFIX), F.lpad(F.hex(c), HEX_DIGITS, "0"))


def hex_to_rv(col: Column | str) -> Column:
    """``0x…`` text → version; ``0x`` alone (or empty) is the beginning, NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    digits = F.regexp_replace(c, "^0[xX]", "")
    number = F.conv(digits, 16, 10)          # unsigned: text above 2^63 - 1 means the open upper bound
    known = F.coalesce(number.try_cast("bigint"), F.when(number.isNotNull(), F.lit((1 << 63) - 1)))
    return F.when(digits == "", F.lit(BEGINNING).cast("bigint")).otherwise(known)


def parse_version(value, default: int) -> int:
    """Driver-side bound parsing: None / '' → default; ``0x`` text → int; ints pass."""
    if value is None:
        return default
    if isinstance(value, int):
        return value
    text = str(value).strip()
    if text == "":
        return default
    if text.lower() == OPEN_UPPER_TEXT.lower():
        return MAX_VERSION
    if text.lower().startswith("0x"):
        digits = text[2:]
        return BEGINNING if digits == "" else int(digits, 16)
    return int(text)


def format_version(value: int) -> str:
    if value == BEGINNING:
        return HEX_PREFIX
    return HEX_PREFIX + format(value & ((1 << 64) - 1), "016X")
