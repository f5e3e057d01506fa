"""Column expressions that standardise raw text values (all JVM built-ins).

Every function takes and returns a ``Column`` so it composes inside one
``select`` and stays in whole-stage codegen; none needs a Python UDF.
"""
from __future__ import annotations

import datetime as dt
import unicodedata

from pyspark.sql import Column, functions as F

from .. import schema as S


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Characters with an ASCII decomposition, by rule from Unicode NFKD.

    One ASCII letter (``é`` -> ``e``, fullwidth ``Ａ`` -> ``A``) goes into a
    translation table, several (``ﬁ`` -> ``fi``, ``½`` -> ``12``, ``㎏`` ->
    ``kg``) into a dictionary; other characters are dropped by the slug.
    """
    src, dst, spelled = [], [], {}
    for code in range(0x00A0, 0x110000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        base = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
        elif len(base) > 1:
            spelled[ch] = base
    return "".join(src), "".join(dst), spelled


_ACCENT_SRC, _ACCENT_DST, _SPELLED = _fold_tables()
# days from the Excel epoch to 1970-01-01
EPOCH_TO_UNIX_DAYS = (dt.date(1970, 1, 1) - dt.date.fromisoformat(S.EXCEL_EPOCH)).days


def normalize_text(col) -> Column:
    """Trim."""
    return F.trim(_c(col))


def normalize_upper(col) -> Column:
    """Trim + upper."""
    return F.upper(F.trim(_c(col)))


def normalize_id(col) -> Column:
    """Keep digits only, zero-fill on the left to 14; longer ids stay whole."""
    digits = F.regexp_replace(_c(col).cast("string"), r"\D", "")
    return F.when(F.length(digits) < S.ID_WIDTH, F.lpad(digits, S.ID_WIDTH, "0")).otherwise(digits)


NUMBER_SHAPE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(col) -> Column:
    """Text to double, NULL when not a number.

    A cheap shape test runs first: only number-like text reaches the cast,
    so names and dates never pay for a failed parse.
    """
    text = F.trim(_c(col).cast("string"))
    return F.when(text.rlike(NUMBER_SHAPE), text.try_cast("double"))


def parse_mixed_date(col) -> Column:
    """P5: Excel serial, ``yyyyMMdd``, or date text to a timestamp (without zone).

    A value that reads as a number is a serial date only strictly inside
    (20000, 80000), fraction of day kept; eight digits that are a calendar date
    are that date; any other number is NULL. Text goes to
    :func:`parse_text_date`. Unparsable text is NULL.
    """
    text = F.trim(_c(col).cast("string"))
    num = to_number(text)
    serial_micros = F.floor((num - F.lit(float(EPOCH_TO_UNIX_DAYS))) * F.lit(86400000000.0)
                            + F.lit(0.5))
    serial = F.when(
        (num > S.SERIAL_MIN_EXCLUSIVE) & (num < S.SERIAL_MAX_EXCLUSIVE),
        F.timestamp_micros(serial_micros),
    ).when(text.rlike("^[0-9]{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    # plain dates stop at their first test; empty text matches no form
    parsed = _plain_dates(text).when(num.isNotNull(), serial).otherwise(parse_text_date(text))
    # wall-clock time, as in the source (no time zone attached)
    return parsed.cast("timestamp_ntz")


# A time of day, a fraction, a half-day mark and a zone, each optional. The zone
# is left out of the value: the wall-clock time of the text counts.
_TIME = (r"(?:[ T,]+[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]{1,9})?)?"
         r" ?[AaPp]?[.]?(?:[Mm][.]?)?(?: ?(?:[Zz]|UTC|GMT|[+-][0-9]{2}:?[0-9]{2}))?)?$")
_CLOCK = r"[ T,]([0-9]{1,2})(:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]{1,9})?)?) ?([AaPp])?"
# A weekday may stand before any form.
_WEEKDAY = r"^(?:[A-Za-zçÇáÁ]{3,13}(?:-feira)?[.]?,? +)?"
_NAME = r"([A-Za-zçÇ]{3,12})[.]?"
_GAP = r"[-/. ]+(?:de +)?"
_YEAR = r"([0-9]{4}|[0-9]{2})"
# Written forms in digits: pattern, and how its groups read as year-month-day.
_DAY_FIRST = _WEEKDAY + r"([0-9]{1,2})[-/. ]([0-9]{1,2})[-/. ]" + _YEAR + _TIME
_YEAR_FIRST = _WEEKDAY + r"([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})" + _TIME
_YEAR_MONTH = _WEEKDAY + r"([0-9]{4})[-/.]([0-9]{1,2})" + _TIME
# ... and with a month's name (its group, the others with a place for it): after the day, before it, after the year.
_NAMED = [(_WEEKDAY + r"([0-9]{1,2})" + _GAP + _NAME + _GAP + _YEAR + _TIME, 2, "$3-@-$1"),
          (_WEEKDAY + _NAME + r"[-/. ]+([0-9]{1,2})(?:st|nd|rd|th)?(?:,|[-/. ])[-/. ]*([0-9]{4})" + _TIME, 1, "$3-@-$2"),
          (r"^([0-9]{4})[-/. ]+" + _NAME + r"[-/. ]+([0-9]{1,2})" + _TIME, 2, "$1-@-$3")]
# Eight digits and a time, with and without seconds.
_COMPACT = [(r"^([0-9]{4})([0-9]{2})([0-9]{2})[ T]?([0-9]{2}):?([0-9]{2}):?([0-9]{2})$", "$1-$2-$3 $4:$5:$6"),
            (r"^([0-9]{4})([0-9]{2})([0-9]{2})[ T]?([0-9]{2}):?([0-9]{2})$", "$1-$2-$3 $4:$5:00")]
# The shapes that most files have, read by one built-in parser each.
_PLAIN_DAY_FIRST = "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
_PLAIN_ISO = "^[0-9]{4}-[0-9]{2}-[0-9]{2}(?: [0-9]{2}:[0-9]{2}:[0-9]{2})?$"
# First three letters of month names, English and Portuguese.
_MONTHS = {"jan": 1, "feb": 2, "fev": 2, "mar": 3, "apr": 4, "abr": 4, "may": 5, "mai": 5, "jun": 6,
           "jul": 7, "aug": 8, "ago": 8, "sep": 9, "set": 9, "oct": 10, "out": 10, "nov": 11,
           "dec": 12, "dez": 12}
# Two-digit years from here on belong to the 1900s.
_PIVOT_YEAR = 69


def _with_century(day: Column) -> Column:
    """A two-digit year at the beginning in full."""
    late = "|".join(str(y) for y in range(_PIVOT_YEAR, 100))
    return F.regexp_replace(F.regexp_replace(day, f"^(?=(?:{late})-)", "19"), "^(?=[0-9]{2}-)", "20")


def _at_clock(day: Column, text: Column) -> Column:
    """``day`` (year-month-day) at the time of day that ``text`` states, if it states one; NULL if no such moment."""
    hour, half = F.regexp_extract(text, _CLOCK, 1).try_cast("int"), F.lower(F.regexp_extract(text, _CLOCK, 3))
    hour = F.when((half == "p") & (hour < 12), hour + 12).when((half == "a") & (hour == 12), F.lit(0)).otherwise(hour)
    rest = F.translate(F.regexp_extract(text, _CLOCK, 2), ",", ".")
    return F.when(text.contains(":"), F.concat(day, F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), rest)
                  .try_cast("timestamp")).otherwise(day.try_cast("timestamp"))


def _plain_dates(text: Column) -> Column:
    """The two plain shapes; other cases may follow."""
    return (F.when(text.rlike(_PLAIN_DAY_FIRST), F.coalesce(F.try_to_timestamp(text, F.lit("d/M/yyyy")),
                                                            F.try_to_timestamp(text, F.lit("M/d/yyyy"))))
             .when(text.rlike(_PLAIN_ISO), text.try_cast("timestamp")))


def parse_text_date(col) -> Column:
    """Date text to a timestamp; NULL when it is none.

    Day first (``/``, ``-``, ``.`` or blank, two- or four-digit year); month
    first only where day first is impossible; year first (also without a day);
    month names in English and Portuguese after the day, before it or after the
    year; eight digits with a time; a weekday before any of them. Each with an
    optional time, fraction, am/pm and zone. Plain day-first and ISO dates go to
    one built-in parser; the shape of any other text picks the one form, which
    a replacement writes as year-month-day. Names and codes stop at the first
    test.
    """
    text = F.trim(_c(col).cast("string"))

    def written(pattern: str, how: str) -> Column:
        return F.regexp_replace(text, pattern, how)

    months = F.create_map(*[F.lit(x) for pair in _MONTHS.items() for x in pair])

    def named(pattern: str, group: int, how: str) -> Column:
        month = F.element_at(months, F.lower(F.substring(F.regexp_extract(text, pattern, group), 1, 3)))
        return F.replace(written(pattern, how), F.lit("@"), month.cast("string"))

    general = F.when(text.rlike(_DAY_FIRST), F.coalesce(
        _at_clock(_with_century(written(_DAY_FIRST, "$3-$2-$1")), text),
        _at_clock(_with_century(written(_DAY_FIRST, "$3-$1-$2")), text)))
    general = general.when(text.rlike(_YEAR_FIRST), _at_clock(written(_YEAR_FIRST, "$1-$2-$3"), text))
    general = general.when(text.rlike(_YEAR_MONTH), _at_clock(written(_YEAR_MONTH, "$1-$2-01"), text))
    for pattern, group, how in _NAMED:
        general = general.when(text.rlike(pattern), _at_clock(_with_century(named(pattern, group, how)), text))
    for pattern, how in _COMPACT:
        general = general.when(text.rlike(pattern), written(pattern, how).try_cast("timestamp"))
    # digits first, or a word (a weekday, a month) before a number or another word with a number after it
    shaped = text.rlike(r"^(?:[0-9]{1,4}[-/. ]+[0-9A-Za-z]|[0-9]{8}[ T]?[0-9]"
                        r"|[A-Za-zçÇáÁ-]{3,13}[.]?,? +(?:[A-Za-zçÇ]{3,12}[.]? +)?[0-9]{1,2}(?:st|nd|rd|th)?\b.*[0-9])")
    return _plain_dates(text).when(shaped, general)


_BEYOND_ASCII = r"[^\x00-\x7F]"


def spell_out(col) -> Column:
    """Characters whose decomposition spells several ASCII letters (``½`` ->
    ``12``, ``ﬁ`` -> ``fi``) written out; only rows that hold one are taken apart."""
    text = _c(col).cast("string")
    table = F.create_map(*[F.lit(x) for pair in _SPELLED.items() for x in pair])
    letters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    spelled = F.array_join(F.transform(letters, lambda c: F.coalesce(F.element_at(table, c), c)), "")
    # a class of hundreds of letters is slow to test: plain ASCII text never meets it
    return F.when(text.rlike(_BEYOND_ASCII) & text.rlike("[" + "".join(_SPELLED) + "]"), spelled).otherwise(text)


def slug(col) -> Column:
    """ASCII-fold, runs of non-alphanumerics to ``_``, trim ``_``, upper."""
    text = _c(col).cast("string")
    folded = F.regexp_replace(F.translate(spell_out(text), _ACCENT_SRC, _ACCENT_DST), _BEYOND_ASCII, "")
    ascii_only = F.when(text.rlike(_BEYOND_ASCII), folded).otherwise(text)
    joined = F.regexp_replace(ascii_only, r"[^A-Za-z0-9]+", "_")
    return F.upper(F.regexp_replace(joined, r"^_+|_+$", ""))


def synthetic_code(product) -> Column:
    """``SYN_`` + first 24 characters of the product slug."""
    return F.concat(F.lit(S.SYNTHETIC_PREFIX),
                    F.substring(F.coalesce(slug(product), F.lit("")), 1, S.SYNTHETIC_SLUG_LENGTH))


def numeric_code(col) -> Column:
    """A numeric code as integer text, NULL when not numeric."""
    return F.trim(_c(col).cast("string")).try_cast("decimal(20,0)").cast("string")


def coerce_amount(col) -> Column:
    """Text to decimal(38,6); text that is no number, or too large a one, counts as 0
    (and as a row without an amount in the ingest counts)."""
    return F.coalesce(F.trim(_c(col).cast("string")).try_cast(S.RAW_AMOUNT_TYPE),
                      F.lit(0).cast(S.RAW_AMOUNT_TYPE))


def coerce_quantity(col) -> Column:
    """Text to bigint truncated toward zero; unparsable counts as 0."""
    return F.coalesce(to_number(col).try_cast("bigint"), F.lit(0).cast("bigint"))


def unit_price(amount="amount", quantity="quantity") -> Column:
    """Amount / quantity when quantity > 0, else the amount."""
    a = _c(amount).cast("double")
    q = _c(quantity)
    return F.when(q > 0, a / q.cast("double")).otherwise(a)


def to_midnight(col) -> Column:
    """P10: drop the time of day."""
    return F.to_date(_c(col))
