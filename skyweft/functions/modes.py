"""Mode-S messages as column expressions on their hex text.

Built from the public Mode-S literature: fields are bit ranges, the CRC is linear
over GF(2), so the parity of a message is the XOR of one constant per set bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyweft.functions.let import col, let

#: Generator polynomial of the 24-bit CRC (fixed value).
GENERATOR = 0x1FFF409
#: Downlink formats that are decoded, those with the address in clear, and with it under parity.
KNOWN_DF = (0, 4, 5, 11, 16, 17, 18, 20, 21)
CLEAR_DF = (11, 17, 18)
PARITY_DF = (0, 4, 5, 16, 20, 21)


def normalised(msg) -> Column:
    """Trimmed upper-case hex of 14 or 28 digits, else null."""
    m = F.upper(F.trim(col(msg)))
    return F.when(m.rlike("^[0-9A-F]+$") & F.length(m).isin(14, 28), m)


def bits(msg, first: int, count: int) -> Column:
    """Bits ``first`` .. (0 is the first of the message), at most 53, as a long."""
    start, stop = first // 4, (first + count - 1) // 4
    n = F.conv(F.substring(col(msg), start + 1, stop - start + 1), 16, 10).cast("long")
    return F.shiftright(n, 4 * (stop + 1) - first - count).bitwiseAND(F.lit((1 << count) - 1))


def downlink_format(msg) -> Column:
    """The first five bits; formats from 24 share their first two."""
    df = bits(msg, 0, 5)
    return F.least(df, F.lit(24)).cast("int")


def crc_constants(n_bits: int) -> list[int]:
    """The remainder that each of ``n_bits`` data bits leaves, first bit first."""
    out, r = [], GENERATOR & 0xFFFFFF
    for _ in range(n_bits):
        out.append(r)
        r <<= 1
        if r >> 24:
            r ^= GENERATOR
    return out[::-1]


#: Data bits of a long message; they are read as two numbers of half as many.
DATA_BITS, HALF = 88, 44


def _masks(k: int) -> tuple[int, int]:
    """The data bits that CRC bit ``k`` is the parity of: of the last HALF, and before."""
    last_first = crc_constants(DATA_BITS)[::-1]
    pick = lambda part: sum(1 << j for j, c in enumerate(part) if c >> k & 1)
    return pick(last_first[:HALF]), pick(last_first[HALF:])


def crc24(msg) -> Column:
    """CRC of all digits but the last six of a message of 14 or 28.

    Constants go by the distance from the end, so both lengths take the same ones. The
    data are read once as two numbers; each CRC bit is a parity of their masked bits.
    """
    m = col(msg)
    size, digits = F.length(m) - 6, HALF // 4
    number = lambda start, n: F.conv(F.substr(m, start, n), 16, 10).cast("long")
    low = number(F.greatest(size - digits, F.lit(0)) + 1, F.least(size, F.lit(digits)))
    high = F.when(size > digits, number(F.lit(1), size - digits)).otherwise(F.lit(0).cast("long"))

    def crc(v):
        out = None
        for k in range(24):
            a, b = _masks(k)
            odd = F.bit_count(v["low"].bitwiseAND(F.lit(a))) + F.bit_count(v["high"].bitwiseAND(F.lit(b)))
            bit = F.shiftleft(odd.bitwiseAND(F.lit(1)), k)
            out = bit if out is None else out.bitwiseOR(bit)
        return out

    return let(F.struct(low.alias("low"), high.alias("high")), crc)


def parity(msg) -> Column:
    """CRC XOR the last 24 bits: 0 of a good clear message, the address of a parity one."""
    m = col(msg)
    last = F.conv(F.substr(m, F.length(m) - 5, F.lit(6)), 16, 10).cast("int")
    return crc24(m).bitwiseXOR(last)


def icao(msg) -> Column:
    """Address in clear or out of the parity; null for other formats and for 000000."""
    m, df = col(msg), downlink_format(msg)
    hidden = F.lpad(F.hex(parity(m).cast("long")), 6, "0")
    return F.when(df.isin(*CLEAR_DF), F.substring(m, 3, 6)).when(df.isin(*PARITY_DF), F.when(hidden != "000000", hidden))


def _gray(value: Column, width: int) -> Column:
    """Gray code to binary."""
    out, shift = value, 1
    while shift < width:
        out = out.bitwiseXOR(F.shiftright(out, shift))
        shift *= 2
    return out


def _bit(code: Column, i: int) -> Column:
    """Bit i of a 13-bit field, the first bit being 0."""
    return F.shiftright(code, 12 - i).bitwiseAND(F.lit(1))


def _word(code: Column, order: tuple) -> Column:
    out = F.lit(0)
    for i in order:
        out = out * 2 + _bit(code, i)
    return out


#: Positions in the 13-bit field: C1 A1 C2 A2 C4 A4 M/X B1 D1/Q B2 D2 B4 D4.
_C1, _A1, _C2, _A2, _C4, _A4, _X, _B1, _D1, _B2, _D2, _B4, _D4 = range(13)


def gillham_altitude(code) -> Column:
    """Feet of a 13-bit field in 100-ft Gillham code; null if impossible."""
    code = col(code)
    fives = _gray(_word(code, (_D2, _D4, _A1, _A2, _A4, _B1, _B2, _B4)), 8)
    raw = _gray(_word(code, (_C1, _C2, _C4)), 3)
    ones = F.when(raw == 7, 5).otherwise(raw)
    turned = F.when(fives % 2 == 1, F.lit(6) - ones).otherwise(ones)
    return F.when(raw.isin(1, 2, 3, 4, 7), (fives * 500 + turned * 100 - 1300).cast("int"))


def altitude_code(code) -> Column:
    """Feet of a 13-bit altitude field: 25-ft, Gillham or metric."""
    code = col(code)
    quarter = F.shiftright(code, 2).bitwiseAND(F.lit(0x7E0)).bitwiseOR(F.shiftright(code, 1).bitwiseAND(F.lit(0x10))).bitwiseOR(code.bitwiseAND(F.lit(0xF)))
    metric = F.shiftright(code, 1).bitwiseAND(F.lit(0xFC0)).bitwiseOR(code.bitwiseAND(F.lit(0x3F)))
    return (
        F.when(code == 0, F.lit(None).cast("int"))
        .when(_bit(code, _X) == 1, F.floor(metric * 3.28084).cast("int"))
        .when(_bit(code, _D1) == 1, (quarter * 25 - 1000).cast("int"))
        .otherwise(gillham_altitude(code))
    )


def altitude_12(code) -> Column:
    """Feet of a 12-bit airborne-position field (no M bit)."""
    code = col(code)
    return altitude_code(F.shiftleft(F.shiftright(code, 6), 7).bitwiseOR(code.bitwiseAND(F.lit(0x3F))))


def altitude_q(code) -> Column:
    """Feet of a 12-bit field with the Q bit, within -1000 .. 100000; else null."""
    code = col(code)
    n = F.shiftright(code.bitwiseAND(F.lit(0xFE0)), 1).bitwiseOR(code.bitwiseAND(F.lit(0xF)))
    feet = (n * 25 - 1000).cast("int")
    return F.when((code.bitwiseAND(F.lit(0x10)) != 0) & feet.between(-1000, 100000), feet)


def squawk_code(code) -> Column:
    """Four octal digits ABCD of a 13-bit identity field."""
    code = col(code)
    digits = ((_A4, _A2, _A1), (_B4, _B2, _B1), (_C4, _C2, _C1), (_D4, _D2, _D1))
    return F.concat(*[_word(code, d).cast("string") for d in digits])


def type_code(msg) -> Column:
    return F.when((F.length(col(msg)) == 28) & (downlink_format(msg) == 17), bits(msg, 32, 5)).cast("int")


def altitude_ft(msg) -> Column:
    """From the altitude field of DF 0, 4, 16 and 20 or a DF 17 airborne position."""
    df = downlink_format(msg)
    plain = F.when(df.isin(0, 4, 16, 20), altitude_code(bits(msg, 19, 13)))
    return F.coalesce(plain, F.when(type_code(msg).between(9, 18), altitude_12(bits(msg, 40, 12))))


def squawk(msg) -> Column:
    return F.when(downlink_format(msg).isin(5, 21), squawk_code(bits(msg, 19, 13)))


def position_fields(msg) -> Column:
    """struct<odd, lat_cpr, lon_cpr, alt_ft> of a DF 17 airborne position, else null."""
    fields = F.struct(
        bits(msg, 53, 1).cast("int").alias("odd"),
        bits(msg, 54, 17).cast("int").alias("lat_cpr"),
        bits(msg, 71, 17).cast("int").alias("lon_cpr"),
        altitude_q(bits(msg, 40, 12)).alias("alt_ft"),
    )
    return F.when(type_code(msg).between(9, 18), fields)


def velocity_fields(msg) -> Column:
    """struct<ew_knots, ns_knots, speed_kts, heading_deg, vrate_fpm> of a DF 17 ground velocity.

    Type code 19, subtype 1; a raw speed of 0 is unknown and gives null.
    """
    ew, ns, vr = bits(msg, 46, 10), bits(msg, 57, 10), bits(msg, 69, 9)
    sign = lambda bit: F.lit(1) - bits(msg, bit, 1) * 2

    def fields(v):
        heading = F.degrees(F.atan2(v["e"], v["n"]))
        return F.struct(
            v["e"].alias("ew_knots"),
            v["n"].alias("ns_knots"),
            F.sqrt(v["e"] * v["e"] + v["n"] * v["n"]).alias("speed_kts"),
            F.when(heading < 0, heading + 360).otherwise(heading).alias("heading_deg"),
            v["r"].alias("vrate_fpm"),
        )

    raw = F.struct(
        ((ew - 1) * sign(45)).cast("double").alias("e"),
        ((ns - 1) * sign(56)).cast("double").alias("n"),
        F.when(vr == 0, F.lit(0)).otherwise((vr - 1) * 64 * sign(68)).cast("int").alias("r"),
    )
    return F.when((type_code(msg) == 19) & (bits(msg, 37, 3) == 1) & (ew != 0) & (ns != 0), let(raw, fields))
