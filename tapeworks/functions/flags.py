"""Canonical trade flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapeworks.functions.parsing import let

# Venue flag code -> canonical flag.
FLAG_CODES = {
    "LRGS": "large_in_scale",
    "LIS": "large_in_scale",
    "BENC": "benchmark",
    "NPFT": "negotiated",
    "NLIQ": "negotiated",
    "OILQ": "offbook",
    "NOFF": "offbook",
    "MOFF": "agency_cross",
    "DARK": "dark",
    "RFPT": "dark",
    "SI": "systematic_internaliser",
    "SDIV": "systematic_internaliser",
    "DLAY": "late_publication",
    "CANC": "cancellation",
    "AMND": "amendment",
}

# Canonical flags from the strongest to the weakest.
FLAG_PRIORITY = (
    "large_in_scale", "benchmark", "negotiated", "dark", "systematic_internaliser",
    "offbook", "agency_cross", "late_publication", "cancellation", "amendment",
)


def canonical_trade_flag(raw: Column) -> Column:
    """Collapse a multi-flag field to its strongest canonical flag.

    The field is brought to the form ``,A,B,`` once; each known code is then a
    plain ``contains`` test, and the lowest rank wins.
    """
    names = ("normal",) + FLAG_PRIORITY

    def strongest(padded: Column) -> Column:
        ranks = [F.when(padded == ",,", F.lit(1))]
        for code, flag in FLAG_CODES.items():
            ranks.append(F.when(F.contains(padded, F.lit(f",{code},")),
                                F.lit(names.index(flag) + 1)))
        return F.coalesce(F.elt(F.least(*ranks), *[F.lit(n) for n in names]), F.lit("unknown"))

    joined = F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), r"[\s;,]*[;,][\s;,]*", ",")
    text = F.btrim(joined, F.lit(", \t\r\n\f\x0b"))
    return let(F.concat(F.lit(","), text, F.lit(",")), strongest)
