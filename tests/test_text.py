from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from firmscope.functions import text as X
from firmscope.functions.expr import collapse_space, strip
from tests.helpers import apply


def test_pad_number(spark):
    given = ["41424", "NI706541", "123456789", "", "-5", None]
    want = ["00041424", "NI706541", "123456789", "00000000", "-0000005", None]
    assert apply(spark, X.pad_number, given) == want


def test_format_address_drops_null_and_empty(spark):
    fields = ", ".join(f"{p} string" for p in X.ADDRESS_PARTS)
    parts = ("12", None, "", "Leeds", None, "LS1 1AA", "")
    empty = (None,) * 7
    got = apply(spark, X.format_address, [parts, empty], f"struct<{fields.replace(' string', ':string')}>")
    assert got == ["12, Leeds, LS1 1AA", ""]


def test_url_domain(spark):
    given = [
        "https://www.Acme-Valves.co.uk/x", "https://acme.com:8080/", "acme.com",
        "https://ex_a.com/a|b?c", "//www.www.x.org#y", "http://user@x.com", None,
    ]
    want = ["acme-valves.co.uk", "acme.com:8080", "", "ex_a.com", "www.x.org", "user@x.com", None]
    assert apply(spark, X.url_domain, given) == want


def test_business_suffix(spark):
    given = ["acme.co.uk", "acme.com:8080", "acme.xyz", "acme.tech", "acmecom", ""]
    assert apply(spark, X.has_business_suffix, given) == [True, False, False, True, False, False]


def test_company_domain(spark):
    def check(url):
        return X.is_company_domain(url, F.lit("ACME VALVES LTD"))

    given = [
        "http://acmevalves.com", "http://zed.com", "http://ltd.com", "http://a-c-m-e.co.uk",
        "http://acme.xyz", "acme.com", None,
    ]
    assert apply(spark, check, given) == [True, False, False, True, False, False, False]


def test_suffix_letters_count_as_domain_letters(spark):
    got = apply(spark, lambda u: X.is_company_domain(u, F.lit("Info Couk")), ["http://x.co.uk", "http://x.info"])
    assert got == [True, True]


def test_name_tokens(spark):
    given = ["ACME & Sons (UK) Ltd", "A1B2 éclair caféteria plain", None]
    assert apply(spark, X.name_tokens, given) == [["acme", "sons"], ["plain"], None]


def test_candidate_link(spark):
    given = ["https://uk.LinkedIn.com/x", "", None, "https://acme.com/yell.community", "https://acme.com"]
    assert apply(spark, X.is_candidate_link, given) == [False, False, False, False, True]


def test_with_scheme(spark):
    given = ["acme.com", "http://a", "https://a", "HTTP://a", ""]
    want = ["https://acme.com", "http://a", "https://a", "https://HTTP://a", "https://"]
    assert apply(spark, X.with_scheme, given) == want


def test_clean_site_text(spark):
    given = [
        "Welcome to  Acme", " Welcome to Acme", "HOME |  x  y\n", "home - about us",
        "about welcome to x", "Aboutus",
    ]
    want = ["Acme", "Welcome to Acme", "x y", "about us", "welcome to x", "Aboutus"]
    assert apply(spark, X.clean_site_text, given) == want


def test_clean_meta_text(spark):
    given = ["a &amp;lt; b", " x&nbsp;&quot;y&quot; \t z ", "&amp;nbsp;"]
    want = ["a < b", 'x "y" z', "&nbsp;"]
    assert apply(spark, X.clean_meta_text, given) == want


def test_collapse_space_agrees_with_python(spark):
    rng = random.Random(9)
    blanks = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2003\u2028\u2029\u202f\u205f\u3000"
    given = ["".join(rng.choice("ab   " + blanks) for _ in range(50)) for _ in range(300)]
    assert apply(spark, collapse_space, given) == [re.sub(r"\s+", " ", text) for text in given]


def test_strip_knows_unicode_space(spark):
    given = [" a b \x1f", "\n\t", ""]
    assert apply(spark, strip, given) == [value.strip() for value in given]


def test_business_email(spark):
    given = [
        "noreply@x.com info@x.com", "No-Reply@x.com", "a b c", "éabc@x.com", "x@y.c|m", None,
        "sales@acme.co.uk.", "foo@bar@baz.com", "%x@y.com -é-z@y.com", "a+b.c@d-e.f.org",
    ]
    want = [
        "info@x.com", None, None, None, "x@y.c|m", None, "sales@acme.co.uk", "bar@baz.com",
        "x@y.com", "a+b.c@d-e.f.org",
    ]
    assert apply(spark, X.business_email, given) == want


def test_business_email_agrees_with_python(spark):
    rng = random.Random(5)
    given = ["".join(rng.choice("ab.é_-+%@@ Zx|1") for _ in range(60)) + "@c.de" for _ in range(400)]

    def found(text):
        people = [e for e in re.findall(X.EMAIL, text)]
        return people[0] if people else None

    assert apply(spark, X.business_email, given) == [found(text) for text in given]


def test_business_email_in_long_runs(spark):
    blob = "ab+cd/" * 100_000 + "x.y-z+" * 100_000
    assert apply(spark, X.business_email, [f"{blob} me@x.org {blob}"]) == ["me@x.org"]


def test_uk_phone_prefers_pattern_to_place(spark):
    given = [
        "0113 496 0000 +44 113 496 0000", "(0113) 496000 then 0113 496 0000", "(0113)496000", "12",
    ]
    want = ["+44 113 496 0000", "0113 496 0000", "(0113)496000", None]
    assert apply(spark, X.uk_phone, given) == want


def test_geocode_guard_and_format(spark):
    assert apply(spark, X.can_geocode, ["  short   ", "1 High Street", None]) == [False, True, False]
    got = apply(spark, lambda v: X.format_position(v, F.lit("-1.5"), F.lit(None).cast("string")), ["53.8", None])
    assert got == ["53.8,-1.5 ()", None]


def test_search_query(spark):
    assert apply(spark, X.search_query, ["A B"]) == ['"A B" official website']
