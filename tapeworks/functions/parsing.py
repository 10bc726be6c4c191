"""Lenient parsing of payload text: numbers, times, bytes and JSON values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_BLANKS = " \t\r\n\f\x0b"

_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
_NAN = r"(?i)^[+-]?nan$"
_INFINITE = r"(?i)^[+-]?inf(?:inity)?$"
_INTEGER = r"^[+-]?\d+(?:_\d+)*$"

_ZONE = r"(Z|[+-]\d{2}(?::?\d{2})?)"
_PLAIN_TIME = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?$"
_PLAIN_DATE = r"^(?!0000)\d{4}-\d{2}-\d{2}$"
# Any ISO form: extended or basic date, any one separator, partial times, comma
# fractions and short offsets.
_ANY_TIME = (r"^(?!0000)(\d{4})(-?)(\d{2})\2(\d{2})"
             r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?" + _ZONE + r"?)?$")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Spark repeats an expression wherever a filter or a branch refers to it; the
    element of a one-element array is a variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decode_utf8(content: Column) -> Column:
    """Bytes to text; bytes that are not UTF-8 are dropped."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.translate(F.make_valid_utf8(text), "�", ""))


def blank_to_null(text: Column) -> Column:
    """'' to null."""
    return F.nullif(text, F.lit(""))


def parse_double(text: Column) -> Column:
    """Text to double; anything that is not a number gives null.

    Spark's own cast also takes ``12d``, hence the pattern in front of it.
    """
    plain = F.btrim(text, F.lit(_BLANKS))
    grouped = F.regexp_replace(plain, r"(?<=\d)_(?=\d)", "")
    return (F.when(plain.rlike(_NUMBER), plain.try_cast("double"))
            .when(F.contains(plain, F.lit("_")) & grouped.rlike(_NUMBER),
                  grouped.try_cast("double"))
            .when(plain.rlike(_NAN), F.lit(float("nan")))
            .when(plain.rlike(_INFINITE), F.when(plain.startswith("-"), F.lit(float("-inf")))
                  .otherwise(F.lit(float("inf")))))


def is_integer_text(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS)).rlike(_INTEGER)


def parse_integer(text: Column) -> Column:
    """Text to long, null when it is not an integer that fits."""
    plain = F.replace(F.btrim(text, F.lit(_BLANKS)), F.lit("_"), F.lit(""))
    return F.when(is_integer_text(text), plain.try_cast("long"))


def parse_event_ts(text: Column) -> Column:
    """ISO-8601 text to a UTC timestamp; a time without offset is UTC.

    The zone is always made explicit, so the result does not depend on the
    session time zone.  The common forms are cast as they are; only rare ones
    are taken apart and put together again.
    """
    zoned = F.when(text.rlike(r"(?:Z|[+-]\d{2}:\d{2})$"), text).otherwise(
        F.concat(text, F.lit("Z")))

    def part(k: int) -> Column:
        return F.regexp_extract(text, _ANY_TIME, k)

    def two(k: int) -> Column:
        return F.coalesce(blank_to_null(part(k)), F.lit("00"))

    zone = part(10)
    offset = (F.when(zone.isin("", "Z"), F.lit("Z"))
              .when(F.length(zone) == 3, F.concat(zone, F.lit(":00")))
              .when(F.length(zone) == 5, F.concat(zone.substr(1, 3), F.lit(":"), zone.substr(4, 2)))
              .otherwise(zone))
    rebuilt = F.concat(part(1), F.lit("-"), part(3), F.lit("-"), part(4), F.lit("T"),
                       two(5), F.lit(":"), two(7), F.lit(":"), two(8),
                       F.lit("."), F.coalesce(blank_to_null(part(9)), F.lit("0")), offset)
    return (F.when(text.rlike(_PLAIN_TIME), zoned.try_cast("timestamp"))
            .when(text.rlike(_PLAIN_DATE),
                  F.concat(text, F.lit("T00:00:00Z")).try_cast("timestamp"))
            .when(text.rlike(_ANY_TIME), rebuilt.try_cast("timestamp")))


def notional(price: Column, size: Column) -> Column:
    """price * size, null when either is null or zero."""
    return F.when((price != 0) & (size != 0), price * size)


# --- texts as the hash recipes print them ---------------------------------

def double_text(value: Column) -> Column:
    """Shortest round-trip text of a double: fixed notation from 1e-4 to 1e16.

    Between 1e-3 and 1e7 Spark's own text already has that form.  Older Java
    runtimes print one digit more than needed for a few values above 1e16.
    """
    text = value.cast("string")
    size = F.abs(value)
    fixed = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    digits = F.regexp_replace(F.regexp_extract(text, r"^(.*)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    scientific = F.concat(digits, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
                          F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")),
                          F.abs(power).cast("string"))
    return (F.when(F.isnan(value), F.lit("nan"))
            .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when(((size >= 1e-3) & (size < 1e7)) | (size == 0), text)
            .when((size >= 1e-4) & (size < 1e16), fixed)
            .otherwise(scientific))


def timestamp_text(value: Column) -> Column:
    """``2025-08-01 09:00:00+00:00``; microseconds only where there are any."""
    micros = F.pmod(F.unix_micros(value), F.lit(1_000_000))
    return F.concat(F.date_format(value, "yyyy-MM-dd HH:mm:ss"),
                    F.when(micros != 0, F.date_format(value, ".SSSSSS")).otherwise(F.lit("")),
                    F.lit("+00:00"))


# --- JSON values held as VARIANT ------------------------------------------
#
# Most values need nothing but their text.  What kind of value it was matters in
# a few cases only, and is looked up only where the text leaves a doubt.

_FALSY_LOOK = r"^(?:|false|\[\]|\{\}|-?0(?:\.0*)?(?:[eE][+-]?\d+)?)$"


def json_text(value: Column, key: str | None = None) -> Column:
    """A JSON value as text; JSON null and a missing key give null."""
    return F.try_variant_get(value, "$" if key is None else f"$.{key}", "string")


def json_kind(value: Column, key: str | None = None) -> Column:
    if key is not None:
        value = F.try_variant_get(value, f"$.{key}", "variant")
    return F.schema_of_variant(value)


def truthy(text: Column, kind: Column) -> Column:
    """False for a missing key, null, '', 0, false, [] and {}; true otherwise.

    The string "0" counts, the number 0 does not.
    """
    doubtful = F.coalesce(F.substring(text, 1, 1).isin("", "f", "[", "{", "-", "0"), F.lit(True))
    return F.when(~doubtful, F.lit(True)).when(text.isNull(), F.lit(False)).when(
        text.rlike(_FALSY_LOOK), (text != "") & (kind == "STRING")).otherwise(F.lit(True))


def number_text(text: Column, kind: Column) -> Column:
    """JSON true and false as the numbers 1 and 0; other values as they are."""
    return F.when(text.isin("true", "false") & (kind == "BOOLEAN"),
                  F.when(text == "true", F.lit("1")).otherwise(F.lit("0"))).otherwise(text)


def json_printed(text: Column, kind: Column) -> Column:
    """The text a hash recipe prints for a JSON value.

    Whole numbers keep their digits, other numbers print as doubles.  A literal
    such as ``100.0`` is a decimal of scale 0 that would fit a long.
    """
    def printed(kind: Column) -> Column:
        number = text.try_cast("double")
        whole = (kind == "BIGINT") | (kind.rlike(r"^DECIMAL\(\d+,0\)$")
                                      & (F.abs(number) >= 9.2e18))
        return (F.when((kind == "STRING") | whole, text)
                .when(kind == "BOOLEAN", F.initcap(text))
                .when(kind.rlike("^(?:DECIMAL|DOUBLE|FLOAT)"), let(number, double_text))
                .otherwise(text))

    return F.when(text.isNotNull(), let(kind, printed))


def count_text(text: Column, kind: Column) -> Column:
    """Trade count as the text of an integer; null for a value that does not count,
    ``?`` for one that is no integer."""
    def whole(kind: Column) -> Column:
        number = F.when(kind == "STRING", parse_integer(text)).when(
            kind == "BOOLEAN", F.lit(1).cast("long")).otherwise(
            text.try_cast("double").try_cast("long"))
        return F.coalesce(number.cast("string"), F.lit("?"))

    return F.when(truthy(text, kind), let(kind, whole))
