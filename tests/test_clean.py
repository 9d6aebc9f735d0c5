"""Literal cases of the cleaning functions."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from avmatch.functions import clean

D = dt.date
CASES = [
    (clean.price, "USD $1,234,567", Decimal("1234567.00")),
    (clean.price, "Call for price", None),
    (clean.price, "1.2.3", None),
    (clean.price, "$1,000 - $2,000", Decimal("10002000.00")),
    (clean.date, "2024-01-15", D(2024, 1, 15)),
    (clean.date, "13/01/2024", D(2024, 1, 13)),
    (clean.date, "01/02/2024", D(2024, 1, 2)),
    (clean.date, "20240115", None),
    (clean.registry_date, "20240115", D(2024, 1, 15)),
    (clean.registry_date, "20241315", None),
    (clean.fleet_date, "2024-01-05T10:00:00", D(2024, 1, 5)),
    (clean.fleet_date, "1/5/98", D(1998, 1, 5)),
    (clean.fleet_date, "1/5/24", D(2024, 1, 5)),
    (clean.whole, "1,234", 1234),
    (clean.whole, "12.9", 12),
    (clean.whole, "-12.9", -12),
    (clean.whole, "inf", None),
    (clean.whole, "1d", None),
    (clean.whole, "99999999999", None),
    (clean.strict_whole, "12.0", None),
    (clean.money, "M/O", None),
    (clean.money, "$1,234.50", Decimal("1234.50")),
    (clean.registration, "N6EU (Registration Retained by Seller)", "N6EU"),
    (clean.registration_key, "n-6eu x", "N6EU"),
    (clean.canonical_n, " n-12 vp", "12VP"),
    (clean.canonical_n, "", None),
    (clean.serial_key, "00174", "174"),
    (clean.serial_key, "000", "0"),
    (clean.serial_key, "510-0369", "5100369"),
    (clean.serial_lookup_keys, "00174", ["00174", "174"]),
    (clean.overhaul_hours, "2000 hrs / 6 Years", 2000),
    (clean.overhaul_years, "2000 hrs / 6 Years", 6),
    (clean.make_of, "2001 CESSNA CITATION X", "CESSNA"),
    (clean.model_of, "2001 CESSNA CITATION X", "CITATION X"),
    (clean.model_of, "2001", None),
    (clean.year_in, "A 1998 jet", 1998),
    (clean.kit_model, "VANS, RV-7, extra", "RV-7, extra"),
    (clean.listing_id, "https://x.example/listing/for-sale/123/abc", "123"),
    (clean.listing_id, "https://x.example/details/77/a-b", "77"),
    (clean.comma_list, " a, ,b ,c", ["a", "b", "c"]),
    (clean.comma_list, " , ", None),
    (clean.list_from_json, '["a ", "", "b"]', ["a", "b"]),
    (clean.list_from_json, "solo", ["solo"]),
    (clean.strip_nulls, "\u0000 ", None),
    (clean.cell_text, '{"text": "A", "href": "/a"}', "A"),
    (clean.cell_shown, '{"text": "A", "href": "/a"}', "A (/a)"),
    (clean.cell_shown, "true", "Yes"),
    (clean.normal_url, "http://a/?x=1&amp;y=\\u0026", "http://a/?x=1&y=&"),
]


def test_cases(spark):
    columns = [f(F.lit(x)).alias(f"c{n}") for n, (f, x, _) in enumerate(CASES)]
    row = spark.range(1).select(*columns).first()
    got = [(f.__name__, x, row[n]) for n, (f, x, _) in enumerate(CASES)]
    assert got == [(f.__name__, x, y) for f, x, y in CASES]


@pytest.mark.parametrize("f", sorted({c[0] for c in CASES}, key=lambda f: f.__name__))
def test_null_stays_null(spark, f):
    assert spark.range(1).select(f(F.lit(None).cast("string"))).first()[0] in (None, [])


def test_flags(spark):
    row = spark.range(1).select(
        clean.serial_is_tail(F.lit("N123"), F.lit("123")), clean.serial_is_tail(F.lit("55"), F.lit("123")), clean.for_sale(F.lit(None).cast("string")), clean.for_sale(F.lit("maybe")), clean.deferred(F.lit(None).cast("int"))
    ).first()
    assert tuple(row) == (True, False, False, None, False)


def test_stable_id_is_uuid5(spark):
    fields = ("FL-1172", "N12VP", "Beechcraft", "King Air 350i", "2018", "2019", "Turboprop")
    got = spark.range(1).select(clean.stable_id(*map(F.lit, fields))).first()[0]
    assert got == str(uuid.uuid5(uuid.UUID(clean.FLEET_NAMESPACE), "|".join(fields)))
