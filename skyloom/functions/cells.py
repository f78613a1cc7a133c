"""Column rules for single cells: null markers, numbers, dates, categories, coordinates.

Everything here maps a Column to a Column with built-in functions, so a whole cleaning pass
stays inside one code-generated projection. Text that cannot be converted becomes NULL
through ``try_*`` functions; the table operators keep the original text next to it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.vocab import (
    DATE_LAYOUTS, MONTHS, NULL_TOKENS, STRPTIME_EXPRESSIONS, STRPTIME_PATTERNS, WHITE_SPACE,
)

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+$"
COORDINATE = r"^[-.]*[0-9][-.0-9]*$"
# [+-]deg/hours, minutes, seconds, with letters, colons or blanks between them
SEXAGESIMAL = (
    r"^([+-]?)([0-9]+)\s*[hd°:\s]\s*([0-9]+)\s*[m'′:\s]\s*([0-9]+[.]?[0-9]*)\s*[s\"″]?$"
)


def _plain(char: Column) -> Column:
    """Whether a character is visible ASCII, so certainly no white space."""
    return char.between("!", "~")


def strip(c: Column) -> Column:
    """Without white space at both ends.

    Trimming a set of characters is slow, so it is kept for text that has something else than
    blanks around visible characters.
    """
    text = F.trim(c)
    simple = _plain(F.substring(text, 1, 1)) & _plain(F.substring(text, -1, 1))
    return F.when(simple, text).otherwise(F.trim(c, F.lit(WHITE_SPACE)))


def nulls_to_null(c: Column) -> Column:
    """NULL for text that means a missing value; other text is kept as it is, blanks included.

    Most cells are told from a marker by their first character, without trimming them.
    """
    starts = WHITE_SPACE + "".join(token[:1] for token in NULL_TOKENS)
    suspect = F.lit(starts).contains(F.substring(c, 1, 1))
    marker = F.find_in_set(strip(c), F.lit(",".join(NULL_TOKENS))) > 0
    return F.when(suspect & marker, None).otherwise(c)


def slug(c: Column) -> Column:
    """Lower case, every run of other characters than letters and digits as one ``_``."""
    joined = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "_")
    return F.trim(joined, F.lit("_"))


def is_number(c: Column) -> Column:
    """Whether the text is a decimal number, with blanks around it allowed."""
    return strip(c).rlike(NUMBER)


#: What a cell holds, as bits: a whole number in the BIGINT range, a longer one, another number,
#: something else; whether a number has more digits than any DOUBLE is sure to keep, or a power of
#: ten; and whether it would come back from a DOUBLE as another number.
WHOLE, LONG, FRACTION, TEXT, SUSPECT, INEXACT = 1, 2, 4, 8, 16, 32
#: Up to so many digits of any number survive in a DOUBLE.
SAFE_DIGITS = 15
#: The most digits of a DECIMAL.
DECIMAL_DIGITS = 38


def number_kind(text: Column) -> Column:
    """The bits of a cell without white space at its ends, but for ``INEXACT``; NULL has none.

    Bits of several cells are joined with OR.
    """
    # Most text begins with a letter, which no number does.
    lettered = F.substring(text, 1, 1).between("A", "z")
    short = F.length(text) <= SAFE_DIGITS
    whole = F.when(short, WHOLE)
    whole = whole.when(text.try_cast("bigint").isNotNull(), WHOLE | SUSPECT).otherwise(LONG | SUSPECT)
    powered = text.contains("e") | text.contains("E")
    fraction = F.when(short & ~powered, FRACTION).otherwise(FRACTION | SUSPECT)
    kind = F.when(lettered, TEXT).when(text.rlike(INTEGER), whole)
    return F.when(text.isNotNull(), kind.when(text.rlike(NUMBER), fraction).otherwise(TEXT))


def number_parts(text: Column) -> tuple[Column, Column, Column]:
    """All digits of a number's text, how many of them stand behind the point, and the power of ten."""
    after = F.regexp_extract(text, r"[.]([0-9]*)", 1)
    power = F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1)
    # A power too long for a number is beyond all types anyway.
    far = F.when(power.startswith("-"), -(10**9)).otherwise(10**9)
    power = F.when(power == "", 0).otherwise(F.coalesce(power.try_cast("int"), far))
    digits = F.concat(F.regexp_extract(text, r"^[+-]?([0-9]*)", 1), after)
    return digits, F.length(after), power


def number_digits(digits: Column, places: Column, power: Column) -> tuple[Column, Column]:
    """The digits without zeros at both ends, and the power of ten of the last one."""
    kept = F.rtrim(digits, F.lit("0"))
    last = power - places + F.length(digits) - F.length(kept)
    kept = F.ltrim(kept, F.lit("0"))
    return kept, F.when(kept == "", 0).otherwise(last)


def exact_type(bits: int | None, before: int = 0, after: int = 0) -> str:
    """The narrowest type that holds all cells of a column without losing a digit.

    ``bits`` are those of ``number_kind`` with ``INEXACT``, ``before`` and ``after`` the most digits on
    either side of the point that a cell needs. BIGINT holds whole numbers in its range, DOUBLE numbers that all come back
    from it, DECIMAL the others up to its digits; text stays for everything else.
    """
    if not bits or bits & TEXT:
        return "string"
    if not bits & (LONG | FRACTION):
        return "bigint"
    if bits & FRACTION and not bits & INEXACT:
        return "double"
    if before + after <= DECIMAL_DIGITS:
        return f"decimal({max(before + after, 1)},{after})"
    return "string"


def to_bigint(c: Column) -> Column:
    """Whole numbers in the BIGINT range, else NULL."""
    text = strip(c)
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def to_double(c: Column) -> Column:
    """Decimal numbers, else NULL."""
    text = strip(c)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_decimal(c: Column, kind: str) -> Column:
    """Decimal numbers that a DECIMAL type holds to the last digit, else NULL.

    So is text of more than 38 characters with a power of ten.
    """
    digits, scale = map(int, re.findall(r"\d+", kind))
    text = strip(c)
    value = text.try_cast(kind)
    plain = text.rlike(rf"^[+-]?([0-9]+[.]?[0-9]{{0,{scale}}}|[.][0-9]{{1,{max(scale, 1)}}})0*$")
    finest = text.try_cast(f"decimal({DECIMAL_DIGITS},{DECIMAL_DIGITS - digits + scale})")
    same = (F.length(text) <= DECIMAL_DIGITS) & (value == finest)
    return F.when(plain, value).when(text.rlike(NUMBER) & same, value)


def coordinate_to_double(c: Column) -> Column:
    """Text made of digits, points and minus signs as a number, else NULL."""
    return F.when(c.rlike(COORDINATE), c.try_cast("double"))


def parse_coordinate(c: Column, sexagesimal: bool = False) -> Column:
    """Decimal degrees from text, else NULL.

    With ``sexagesimal`` the forms ``14h 29m 42.95s`` (hours) and ``-62d 40m 46s`` or
    ``-62:40:46`` (degrees) are read too.
    """
    decimal = to_double(c)
    if not sexagesimal:
        return decimal
    text = strip(c)
    part = [F.regexp_extract(text, SEXAGESIMAL, i) for i in range(5)]
    size = sum(
        part[i].try_cast("double") / scale for i, scale in ((2, 1), (3, 60), (4, 3600))
    )
    sign = F.when(part[1] == "-", -1.0).otherwise(1.0)
    hours = F.when(text.rlike(r"^[+-]?[0-9]+\s*h"), 15.0).otherwise(1.0)
    return F.coalesce(decimal, F.when(part[0] != "", sign * size * hours))


def format_coordinate(c: Column, precision: int = 6) -> Column:
    """Fixed decimals as text, correctly rounded from the exact binary value.

    ``format_string`` rounds the shortest decimal form instead, which differs on values such
    as 2.675. Here the part behind the point is taken off, which is exact, its product with the
    power of ten is split into a rounded part and its exact error, and the error settles the ties.
    Numbers from 2**63 on have nothing to round; they, NaN and infinities are written by
    ``format_string``, with zeros after the 17th digit. ``precision`` is 0 to 9.
    """
    if not 0 <= precision <= 9:
        raise ValueError(f"precision out of range: {precision}")
    x = c.cast("double")
    size, scale = F.when(F.abs(x) < 2.0**63, F.abs(x)), 10.0**precision
    negative = (x < 0) | ((x == 0) & x.cast("string").startswith("-"))
    parts = [F.when(negative, "-").otherwise("")]
    if precision:
        whole = F.floor(size)
        behind = size - whole
        product = behind * scale
        nearest = F.rint(product)
        # The split into two halves of 26 bits makes both partial products exact.
        high = behind * 134217729.0 - (behind * 134217729.0 - behind)
        error = (high * scale - product) + (behind - high) * scale
        # On a tie of the rounded product, the exact value lies on the side of the error.
        missed = (F.abs(product - nearest) == 0.5) & ((product - nearest) * error > 0)
        units = (nearest + F.when(missed, F.signum(error)).otherwise(0.0)).cast("bigint")
        decimals = (units % 10**precision).cast("string")
        carried = whole + F.when(units == 10**precision, 1).otherwise(0)
        parts += [carried.cast("string"), F.lit("."), F.lpad(decimals, precision, "0")]
    else:
        parts.append(F.rint(size).cast("bigint").cast("string"))
    other = F.when(x.isNotNull(), F.format_string(f"%.{precision}f", x))
    return F.coalesce(F.concat(*parts), other)


def date_pattern(fmt: str) -> str:
    """A Spark date pattern; ``strptime`` directives are translated, other text is kept.

    Read are ``%Y %y %m %d %H %I %M %S %p %b %B %j %%``. Spark's parser has nothing like the names of
    weekdays (``%a %A``), fractions of any length (``%f``) and offsets (``%z %Z``), which
    ``parse_date`` reads another way; here these and other directives raise a ValueError.
    """
    if "%" not in fmt:
        return fmt
    pattern, literal = "", ""
    pieces = iter(fmt)
    for char in pieces:
        if char == "%":
            directive = char + next(pieces, "")
            if directive == "%%":
                literal += "%"
                continue
            if directive not in STRPTIME_PATTERNS:
                raise ValueError(f"unsupported date directive: {directive}")
            pattern, literal = pattern + _quoted(literal) + STRPTIME_PATTERNS[directive], ""
        else:
            literal += char
    return pattern + _quoted(literal)


def _has_year(fmt: str) -> bool:
    return any(part in fmt for part in ("%Y", "%y")) if "%" in fmt else "y" in fmt or "u" in fmt


def _quoted(literal: str) -> str:
    quote = literal.replace("'", "''")
    return f"'{quote}'" if any(ch.isalpha() or ch in "'[]{}#" for ch in literal) else literal


def parse_date(c: Column, fmt: str | None = None) -> Column:
    """A TIMESTAMP_NTZ from the given layout or the first layout that fits, else NULL.

    The text is read as UTC and put on the zone-less time line by its distance from the
    epoch, so the session time zone and its clock changes have no influence. With ``%z`` the result is
    the time in UTC. Weekdays are read, but not held against the date.
    """
    if fmt and any(directive in fmt.replace("%%", "") for directive in UNPATTERNED):
        return _parse_expression(c, fmt)
    layouts = (date_pattern(fmt),) if fmt else DATE_LAYOUTS
    if fmt and not _has_year(fmt):
        # Without a year it is 1900.
        layouts, c = (f"yyyy {layouts[0]}",), F.concat(F.lit("1900 "), c)
    instant = F.coalesce(*(_parse_layout(c, layout) for layout in layouts))
    if fmt and "%y" in fmt:
        # Two-digit years from 69 on belong to the 20th century.
        late = F.unix_micros(instant) >= 3124224000000000
        instant = F.when(late, instant - F.make_interval(F.lit(100))).otherwise(instant)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


#: Directives that no Spark pattern stands for.
UNPATTERNED = ("%f", "%a", "%A", "%z", "%Z")
#: Stands between the parts of a date; no date has it.
_BETWEEN = "\u001f"


def date_expression(fmt: str) -> tuple[str, list[str]]:
    """A regular expression for a ``strptime`` format, and its directives in the order of its groups."""
    expression, found = "", []
    pieces = iter(re.sub(r"\s+", " ", fmt))
    for char in pieces:
        directive = char + next(pieces, "") if char == "%" else ""
        if directive in STRPTIME_EXPRESSIONS:
            if directive in found:
                raise ValueError(f"date directive twice: {directive}")
            found.append(directive)
            expression += f"({STRPTIME_EXPRESSIONS[directive]})"
        elif directive and directive != "%%":
            raise ValueError(f"unsupported date directive: {directive}")
        else:
            expression += r"\s+" if char == " " else re.escape(char)
    return f"(?i)^{expression}$", found


def _parse_expression(c: Column, fmt: str) -> Column:
    """The parts of the text by one regular expression, put together to a time."""
    expression, found = date_expression(fmt)
    groups = _BETWEEN.join(f"${i + 1}" for i in range(len(found)))
    parts = F.split(F.regexp_replace(c, expression, groups), _BETWEEN)
    # The one-element array binds the parts, so that they are worked out once.
    time = F.get(F.transform(F.array(parts), lambda p: _time_of(p, found)), F.lit(0))
    return F.when(c.rlike(expression), time)


def _time_of(parts: Column, found: list[str]) -> Column:
    def part(directive: str) -> Column | None:
        return F.get(parts, F.lit(found.index(directive))) if directive in found else None

    def whole(directive: str, default: int) -> Column:
        text = part(directive)
        return F.lit(default) if text is None else text.cast("int")

    year, month, day = whole("%Y", 1900), whole("%m", 1), whole("%d", 1)
    if "%Y" not in found and "%y" in found:
        short = whole("%y", 0)
        year = F.when(short < 69, short + 2000).otherwise(short + 1900)
    for directive in ("%b", "%B"):
        if directive in found:
            names = F.array(*(F.lit(name[:3].lower()) for name in MONTHS))
            month = F.array_position(names, F.lower(F.substring(part(directive), 1, 3))).cast("int")
    hour = whole("%H", 0)
    if "%H" not in found and "%I" in found:
        hour = whole("%I", 0) % 12
        if "%p" in found:
            hour = hour + F.when(F.upper(part("%p")) == "PM", 12).otherwise(0)
    second = F.lpad(whole("%S", 0).cast("string"), 2, "0")
    fraction = F.rpad(part("%f"), 6, "0") if "%f" in found else F.lit("0")
    second = F.concat(second, F.lit("."), fraction).cast("decimal(8,6)")
    if "%j" in found:
        date = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), whole("%j", 1) - 1)
        year, month, day = F.year(date), F.month(date), F.day(date)
    time = F.try_make_timestamp_ntz(year, month, day, hour, whole("%M", 0), second)
    if "%z" not in found:
        return time
    offset = F.translate(part("%z"), ":", "")
    sign = F.when(offset.startswith("-"), 1).otherwise(-1)  # towards UTC
    digits = F.when(F.upper(offset) == "Z", "0000").otherwise(F.substring(offset, 2, 20))
    seconds = F.rpad(F.substring(digits, 5, 20), 2, "0").cast("decimal(8,6)")
    return time + F.make_dt_interval(
        F.lit(0),
        sign * F.substring(digits, 1, 2).cast("int"),
        sign * F.substring(digits, 3, 2).cast("int"),
        sign * seconds,
    )


def _parse_layout(c: Column, layout: str) -> Column:
    parsed = F.try_to_timestamp(F.concat(c, F.lit("Z")), F.lit(layout + "X"))
    if layout not in DATE_LAYOUTS:
        return parsed
    # A failed parse costs far more than a look at the shape, so text of another shape is left out.
    shape = re.sub("[MdHms]", "[0-9]{1,2}", layout.replace("'", "").replace("yyyy", "[0-9]{4}"))
    return F.when(c.rlike(f"^{shape}$"), parsed)


def map_text(c: Column, mapping: Mapping[str, Any]) -> Column:
    """Mapped text, looked up without regard to case; unmapped text is kept. Text mapped to None
    becomes NULL."""
    lookup: dict[str, Any] = {}
    for key, value in mapping.items():
        lookup.setdefault(key.lower(), value)
    if not lookup:
        return c
    gone = [key for key, value in lookup.items() if value is None]
    pairs = [F.lit(part) for pair in lookup.items() if pair[1] is not None for part in pair]
    mapped = F.coalesce(F.create_map(*pairs)[F.lower(c)], c) if pairs else c
    return F.when(~F.lower(c).isin(gone), mapped) if gone else mapped
