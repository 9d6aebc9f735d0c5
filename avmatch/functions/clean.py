"""Typing and cleaning as Column -> Column functions. All are null in, null out unless they say otherwise."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A decimal number as text, with blanks around it: sign, digits with an optional point, optional exponent.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
#: Fixed value: cells that stand for "no number".
PLACEHOLDERS = ("M/O", "N/A", "-", "—", "NA", "TBD")
#: Fixed value: namespace of fleet row ids.
FLEET_NAMESPACE = "d7f64b2c2db54d2f9c1c5bbd8c2b2b6a"


def blank_to_null(x: Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.trim(x), F.lit(""))


def not_blank(x: Column) -> Column:
    return F.coalesce(F.trim(x) != "", F.lit(False))


def first_filled(*columns: Column) -> Column:
    """The first of several spellings of a field that is not blank."""
    return F.coalesce(*map(blank_to_null, columns))


def clip(x: Column, n: int) -> Column:
    """Trimmed to n characters; empty is null."""
    return F.nullif(F.substring(F.trim(x), 1, n), F.lit(""))


def clip_with_dots(x: Column, n: int = 1000) -> Column:
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


def strip_nulls(x: Column) -> Column:
    """Text without null bytes, trimmed; empty is null."""
    return blank_to_null(F.translate(x, "\u0000", ""))


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def price(x: Column, kind: str = "decimal(15,2)") -> Column:
    """Digits and dots of a price text; no digits or two dots give null, a range runs together."""
    digits = F.regexp_replace(x, "[^0-9.]", "")
    return F.when(digits.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"), digits).try_cast(kind)


def number(x: Column, kind: str = "double") -> Column:
    """A number with thousands commas."""
    plain = F.regexp_replace(x, ",", "")
    return F.when(plain.rlike(NUMBER), F.trim(plain)).try_cast(kind)


def whole(x: Column, kind: str = "int") -> Column:
    """A number with commas, cut toward zero."""
    wide = F.when(F.lit(kind == "bigint"), 9.2e18).otherwise(2147483647.0)
    value = number(x)
    return F.when(F.abs(value) <= wide, value).cast(kind)


def strict_whole(x: Column, kind: str = "int") -> Column:
    """Only -?digits; out of range is null."""
    return F.when(F.trim(x).rlike("^-?[0-9]+$"), F.trim(x)).try_cast(kind)


def money(x: Column, kind: str = "decimal(18,2)") -> Column:
    """A number without currency signs, commas and blanks; placeholders are null."""
    plain = F.translate(F.trim(x), "$€£, ", "")
    return F.when(~F.upper(F.trim(x)).isin(*PLACEHOLDERS) & plain.rlike(NUMBER), plain).try_cast(kind)


def _date(x: Column, shape: str, form: str) -> Column:
    return F.when(x.rlike(shape), F.try_to_timestamp(x, F.lit(form))).cast("date")


def date(x: Column) -> Column:
    """Y-m-d, m/d/Y, Y/m/d or d/m/Y, whichever parses first."""
    x = F.trim(x)
    year_first, day_first = r"^[0-9]{4}%s[0-9]{1,2}%s[0-9]{1,2}$", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
    return F.coalesce(
        _date(x, year_first % ("-", "-"), "yyyy-M-d"),
        _date(x, day_first, "M/d/yyyy"),
        _date(x, year_first % ("/", "/"), "yyyy/M/d"),
        _date(x, day_first, "d/M/yyyy"),
    )


def compact_date(x: Column) -> Column:
    """Exactly yyyymmdd."""
    return _date(F.trim(x), "^[0-9]{8}$", "yyyyMMdd")


def registry_date(x: Column) -> Column:
    return F.coalesce(compact_date(x), date(x))


def fleet_date(x: Column) -> Column:
    """ISO (cut at T), m/d/Y, m/d/y (69-99 are 19xx), d/m/Y."""
    x = F.substring(F.split(F.trim(x), "T")[0], 1, 10)
    short = _date(x, r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$", "M/d/yy")
    short = F.when(F.year(short) > 2068, F.add_months(short, -1200)).otherwise(short)
    day_first = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
    return F.coalesce(_date(x, r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"), _date(x, day_first, "M/d/yyyy"), short, _date(x, day_first, "d/M/yyyy"))


def iso_timestamp(x: Column) -> Column:
    return F.try_to_timestamp(x)


def registration(x: Column) -> Column:
    """Without (...), the first word, at most 50 characters."""
    first = F.split(F.trim(F.regexp_replace(x, r"\([^)]*\)", "")), r"\s+")[0]
    return F.nullif(F.substring(first, 1, 50), F.lit(""))


def registration_key(x: Column) -> Column:
    return F.nullif(F.replace(F.upper(registration(x)), F.lit("-"), F.lit("")), F.lit(""))


def canonical_n(x: Column) -> Column:
    """Upper case without blanks, hyphens and one leading N."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.upper(F.trim(x)), "[ -]", ""), "^N", ""), F.lit(""))


def plain_registration(x: Column) -> Column:
    """Upper case without blanks and hyphens; a leading N stays."""
    return F.regexp_replace(F.upper(F.trim(x)), "[ -]", "")


def squeezed_n(x: Column) -> Column:
    return F.upper(F.regexp_replace(x, r"\s+", ""))


def serial_norm(x: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(x)), "[ .-]", "")


def serial_key(x: Column) -> Column:
    """Equal for serials that match: the normalised text, or the number without leading zeros if all digits."""
    s = serial_norm(x)
    return F.when(s.rlike("^[0-9]+$"), F.regexp_replace(s, "^0+(?=[0-9])", "")).otherwise(s)


def serial_lookup_keys(x: Column, alias: bool = True) -> Column:
    """Keys to try in order: upper-cased text, then (optionally) the same without leading zeros."""
    s = blank_to_null(F.upper(x))
    if not alias:
        return F.array_compact(F.array(s))
    short = F.when(s.rlike("^0+[^0]"), F.regexp_replace(s, "^0+", ""))
    return F.array_compact(F.array(s, short))


def serial_is_tail(serial: Column, tail: Column) -> Column:
    """Whether a serial is really the tail number, with or without one leading N on either side."""
    a, b = registration_key(serial), registration_key(tail)
    bare = lambda x: F.regexp_replace(x, "^N", "")
    return F.coalesce((a == b) | (bare(a) == b) | (a == bare(b)), F.lit(False))


def status_name(x: Column) -> Column:
    """V is Active, all else (null, too) Inactive."""
    return F.when(F.trim(x) == "V", "Active").otherwise("Inactive")


def country_or_us(x: Column) -> Column:
    return F.coalesce(blank_to_null(x), F.lit("US"))


def kit_maker(x: Column, needs_comma: bool = False) -> Column:
    got = blank_to_null(F.split(x, ",", 2)[0])
    return F.when(x.contains(","), got) if needs_comma else got


def kit_model(x: Column) -> Column:
    return blank_to_null(F.get(F.split(x, ",", 2), F.lit(1)))


def filled_list(*columns: Column) -> Column:
    """Trimmed non-blank values as an array, null if there is none."""
    found = F.filter(F.array(*map(F.trim, columns)), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(found) > 0, found)


def list_from_json(x: Column) -> Column:
    """A JSON list, or else the text itself, as trimmed strings without blanks."""
    got = F.coalesce(F.from_json(x, "array<string>"), F.array(x))
    return F.filter(F.transform(got, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))


def overhaul_hours(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x, r"(?i)([0-9]+)\s*hrs", 1), F.lit("")).try_cast("int")


def overhaul_years(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x, r"(?i)([0-9]+)\s*years?", 1), F.lit("")).try_cast("int")


def make_of(title: Column) -> Column:
    """Second word of "YEAR MAKE MODEL..."."""
    return F.get(F.split(F.trim(title), r"\s+"), F.lit(1))


def model_of(title: Column) -> Column:
    words = F.split(F.trim(title), r"\s+")
    return F.nullif(F.array_join(F.slice(words, F.lit(3), F.greatest(F.size(words), F.lit(0))), " "), F.lit(""))


def year_in(x: Column) -> Column:
    """The first 19xx or 20xx that stands as a word."""
    return F.nullif(F.regexp_extract(x, r"\b((?:19|20)[0-9]{2})\b", 1), F.lit("")).try_cast("int")


def leading_year(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x, r"^\s*([0-9]{4})", 1), F.lit("")).try_cast("int")


def listing_id(url: Column) -> Column:
    """The path segment after for-sale, a number after details/, or else the last segment but one."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://[^/]*", ""), r"[?#].*$", "")
    rules = (r"/for-sale/([^/]+)", r"/details/([0-9]+)", r"/([^/]+)/[^/]*/?$")
    return F.coalesce(*(F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in rules))


def page_number(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"[?&]page=([0-9]+)", 1), F.lit("")).try_cast("int")


def id_in_path(url: Column, segment: str) -> Column:
    """The number in a path such as /manufacturer/12/name."""
    return F.nullif(F.regexp_extract(url, rf"/{re.escape(segment)}/([0-9]+)", 1), F.lit("")).try_cast("int")


def feature_labels(avionics: Column, equipment: Column, props: Column) -> Column:
    parts = [F.when(not_blank(c), F.concat(F.lit(f"{name}: "), F.substring(F.trim(c), 1, 200))) for name, c in (("Avionics", avionics), ("Equipment", equipment), ("Props", props))]
    found = F.array_compact(F.array(*parts))
    return F.when(F.size(found) > 0, found)


def comma_list(x: Column) -> Column:
    """A comma list as trimmed non-blank values, null if there is none."""
    found = F.filter(F.transform(F.split(x, ","), lambda v: F.trim(v)), lambda v: v != "")
    return F.when(F.size(found) > 0, found)


def deferred(amount: Column) -> Column:
    return F.coalesce(amount > 0, F.lit(False))


def is_true_text(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x)) == "true", F.lit(False))


def for_sale(x: Column) -> Column:
    """true is true, missing is false, anything else unknown."""
    return F.when(x.isNull(), False).when(F.lower(x) == "true", True)


def cell_text(x: Column) -> Column:
    """A cell's text: a JSON object's text, or the trimmed scalar."""
    return blank_to_null(F.when(x.startswith("{"), F.get_json_object(x, "$.text")).otherwise(x))


def cell_href(x: Column) -> Column:
    return F.when(x.startswith("{"), F.get_json_object(x, "$.href"))


def cell_shown(x: Column) -> Column:
    """text (href), Yes or No, or the scalar."""
    linked = F.concat(F.coalesce(cell_text(x), F.lit("")), F.lit(" ("), cell_href(x), F.lit(")"))
    return F.when(x == "true", "Yes").when(x == "false", "No").when(cell_href(x).isNotNull(), F.trim(linked)).otherwise(cell_text(x))


def either_cost(first: Column, second: Column) -> Column:
    """The first price unless it is missing or zero."""
    return F.coalesce(F.nullif(first, F.lit(0)), second)


def place(city: Column, state: Column) -> Column:
    return F.nullif(F.concat_ws(", ", blank_to_null(city), blank_to_null(state)), F.lit(""))


def normal_url(x: Column) -> Column:
    """Escapes for & and / decoded."""
    out = F.replace(F.trim(x), F.lit("&amp;"), F.lit("&"))
    return F.replace(F.replace(out, F.lit("\\u0026"), F.lit("&")), F.lit("\\u002f"), F.lit("/"))


def hours_text(x: Column) -> Column:
    """A time cell without commas and the marks for since-new and since-overhaul."""
    return F.trim(F.regexp_replace(x, r"(?i),|SNEW|SMOH|SINCE", ""))


def stable_id(*fields: Column) -> Column:
    """A version-5 UUID in the fleet namespace of the fields joined by |; nulls are empty."""
    name = F.concat_ws("|", *(F.coalesce(f.cast("string"), F.lit("")) for f in fields))
    h = F.sha1(F.concat(F.unhex(F.lit(FLEET_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), 1, 4)
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant.substr(nibble, F.lit(1)), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12)
    )
