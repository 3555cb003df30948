from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from firmscope.functions import headcount as H
from firmscope.functions import markup as M
from firmscope.functions.expr import collapse_space, find_all, first, let
from firmscope.plans import oracle
from tests.helpers import apply

# Filings and sentences whose headcounts are given.
PLAIN = (
    '<html xmlns="http://www.xbrl.org/2003/instance"><uk-gaap:AverageNumberOfEmployees>25'
    "</uk-gaap:AverageNumberOfEmployees></html>"
)
DECLARED = (
    '<html xmlns:uk-gaap="http://www.xbrl.org/uk/gaap/pt/2023-01-01">'
    "<uk-gaap:AverageNumberOfEmployees>42</uk-gaap:AverageNumberOfEmployees></html>"
)
OTHER = "<html><uk-gaap:TotalAssets>1000000</uk-gaap:TotalAssets></html>"


def test_tagged_cases(spark):
    got = apply(spark, H.tagged_headcount, [PLAIN, DECLARED, OTHER, "<invalid>xml<content", "", None])
    assert got == [25, 42, None, None, None, None]


def test_tag_stage_order(spark):
    def tag(name, value):
        return f"<{name} a=\"x>y\">{value}</{name}>"

    given = [
        # tag order beats document order; the plain prefix beats the short one
        tag("uk-gaap:NumberOfEmployees", "7") + tag("uk-gaap:AverageNumberOfEmployees", "1,250"),
        tag("gaap:AverageNumberOfEmployees", "3") + tag("numberofemployees", "4"),
        # nested markup and blanks inside the value; out of range goes on
        tag("uk-gaap:EmployeesTotal", " <b>1</b> 2 "),
        tag("uk-gaap:EmployeesTotal", "0") + tag("uk-gaap:EmployeesTotal", "9"),
        # case matters here, and self-closing elements hold nothing
        tag("uk-gaap:averagenumberofemployees", "5"),
        "<uk-gaap:EmployeesTotal/><b>5</b><uk-gaap:EmployeesTotal>6</uk-gaap:EmployeesTotal>",
        "<uk-gaap:EmployeesTotal a='/' /><b>5</b><uk-gaap:EmployeesTotal a='x/y'>6</uk-gaap:EmployeesTotal>",
        tag("uk-gaap:EmployeesTotal " + "b='1' " * 20_000, "8").replace("</uk-gaap:EmployeesTotal b", "</uk-gaap:EmployeesTotal><c b"),
    ]
    assert apply(spark, H.tag_headcount, given) == [1250, 4, 12, 9, None, 6, 6, 8]


def test_markup_stage(spark):
    given = [
        '<ix:nonFraction name="uk:NumberOfEmployees">31</ix:nonFraction>',
        "<x>17</x:EmployeesTotal><y>8</averageNUMBERofEMPLOYEES>",
        "<NumberOfEmployees>1,250</NumberOfEmployees>",
        "<NumberOfEmployees>99999999999999999999999</NumberOfEmployees><NumberOfEmployees>5</NumberOfEmployees>",
    ]
    assert apply(spark, H.markup_headcount, given) == [31, 8, None, 5]


def test_namespace_stage(spark):
    def doc(binding, body):
        return f"<xbrl {binding}>{body}</xbrl>"

    new = 'xmlns:e="http://www.xbrl.org/uk/gaap/pt/2023-01-01"'
    old = "xmlns:f='http://www.xbrl.org/uk/gaap/core/2009-09-01'"
    default = 'xmlns="http://www.xbrl.org/uk/gaap/pt/2020-01-01"'
    given = [
        doc(new, "<e:EmployeesTotal>1,250</e:EmployeesTotal>"),
        # namespace order first, then tag order
        doc(
            f"{old} {new}",
            "<f:AverageNumberOfEmployees>1</f:AverageNumberOfEmployees>"
            "<e:EmployeesTotal>2</e:EmployeesTotal><e:NumberOfEmployees>3</e:NumberOfEmployees>",
        ),
        doc(default, "<NumberOfEmployees>4</NumberOfEmployees>"),
        doc(new, "<g:NumberOfEmployees>5</g:NumberOfEmployees>"),
        doc('xmlns:e="http://elsewhere.example.org"', "<e:NumberOfEmployees>5</e:NumberOfEmployees>"),
        doc(new, "<e:NumberOfEmployees></e:NumberOfEmployees>"),
    ]
    assert apply(spark, H.namespace_headcount, given) == [1250, 3, 4, None, None, None]


def test_numeric_value(spark):
    given = ["1,250", "25.5", "0", "1000000", "-5", "999 999", "n/a", "", None]
    want = [1250, 25, None, None, 5, 999999, None, None, None]
    assert apply(spark, H.numeric_value, given) == want


def test_text_phrases(spark):
    # Phrases and the numbers they give.
    cases = {
        "The average number of employees during the year was 35.": 35,
        "Average number of employees: 25": 25,
        "Number of employees 42": 42,
        "Employees: 15": 15,
        "Total employees 38": 38,
        "Staff numbers: 22": 22,
        "Employed an average of 31 people": 31,
        "Number of  persons\nemployed: 18": 18,
        "Nobody counted the employees of this place.": None,
        "Sales of 25 million pounds by hard-working employees.": None,
        # 'vat' hides in 'private'; the comma ends the number; six digits at most
        "ABC Private Limited employees: 12": None,
        "employees: 1,250": 1,
        "employees: 1234567": 123456,
        "employees: 0 staff number: 7": 7,
        "employees: 600000": None,
    }
    assert apply(spark, H.text_headcount, list(cases)) == list(cases.values())


def test_one_search_equals_eleven(spark):
    """Wordings beside, inside and after each other, against a search for each phrase by itself."""
    luck = random.Random(2)
    words = "average number of employees total staff numbers number persons employed an people directors and during the year was : 7 35 120 999999 1234567 600001 0 turnover private headcount x".split()
    starts = [re.sub(r"\\s[+]|\[:\\s\][+]", " ", p).replace("numbers?", "numbers").replace(r"(\d{1,6})", "41").replace(r"\b", "") for p in oracle.PHRASES]
    texts = []
    for _ in range(1_500):
        parts = [luck.choice(starts) if luck.random() < 0.3 else luck.choice(words) for _ in range(luck.randrange(1, 14))]
        texts.append(luck.choice([" ", "  ", "\n"]).join(p.upper() if luck.random() < 0.2 else p for p in parts))

    def eleven(text):
        def search(body):
            def accept(digits):
                return digits.try_cast("int").between(1, H.TEXT_LIMIT) & H.near_people(body, digits)

            return F.coalesce(*[first(F.filter(find_all(body, p, 1), accept)) for p in oracle.PHRASES]).try_cast("bigint")

        return let(F.lower(collapse_space(text)), search)

    got, want = apply(spark, H.text_headcount, texts), apply(spark, eleven, texts)
    assert got == want and 100 < sum(n is not None for n in got) < 1_400


def test_context_is_around_the_first_place_of_the_digits(spark):
    far = "x" * 150
    given = [f"profit 12 {far} employees: 12", f"profit {far} employees: 12"]
    assert apply(spark, H.text_headcount, given) == [None, 12]


def test_context_reaches_a_hundred_characters(spark):
    """A word counts while all of it is within a hundred characters of the number's first digit."""
    def before(word, gap):
        return f"{word}{'.' * gap}20000"

    def after(word, gap):
        return f"20000{'.' * gap}{word}"

    cases = {
        # Twenty thousand needs a word for people; none is too far when it ends at the edge.
        before("staff", 0): True, before("staff", 95): True, before("staff", 96): False,
        after("staff", 0): True, after("staff", 90): True, after("staff", 91): False,
        # A word for money beats one for people, until it is out of reach.
        before("profit", 0) + " staff": False, before("profit", 94) + " staff": False,
        before("profit", 95) + " staff": True, before("£", 99) + " staff": False,
        before("£", 100) + " staff": True, "staff " + after("profit", 83): False,
        "staff " + after("profit", 89): False, "staff " + after("profit", 90): True,
        "20000": False,
    }
    got = apply(spark, lambda text: H.near_people(text, F.lit("20000")), list(cases))
    assert dict(zip(cases, got)) == cases


def seconds(spark, function, text):
    apply(spark, function, [text[:100]])
    began = time.perf_counter()
    apply(spark, function, [text])
    return time.perf_counter() - began


@pytest.mark.parametrize(
    "function, piece",
    [
        (H.tag_headcount, "<uk-gaap:EmployeesTotal>"),
        (H.tag_headcount, "<uk-gaap:EmployeesTotal a "),
        (H.markup_headcount, "<a employees "),
        (H.markup_headcount, "<employeestotal NumberOfEmployees "),
        (H.namespace_headcount, "<e:EmployeesTotal xmlns:e='http://www.xbrl.org/uk/gaap/pt/2023-01-01' "),
        (M.page_title, "<title>"),
        (M.page_title, "<meta a "),
        (M.headings_description, "<h1>"),
        (M.headings_description, "<h2 <"),
        (M.page_text, "<a =' "),
        (M.first_paragraph, "<p><div <"),
    ],
)
def test_broken_markup_takes_time_in_proportion(spark, function, piece):
    once, twice = (min(seconds(spark, function, piece * n) for _ in range(2)) for n in (30_000, 60_000))
    assert twice < 2.5 * once + 0.5 and twice < 10


def test_document_choice(spark):
    rows = [
        (1, bytearray(PLAIN.encode()), None),
        (2, bytearray(b"%PDF-1.4 \xff"), "Employees: 15"),
        (3, None, "Employees: 16"),
        (4, bytearray(OTHER.encode() + b"<!-- XBRL -->"), "Employees: 17"),
        (5, bytearray(b" " * 1995 + b"<xbrl>" + PLAIN.encode()), None),
        (6, bytearray(b" " * 1996 + b"<xbrl>" + PLAIN.encode()), None),
        (7, bytearray(b"<html xmlns>\xff\xc3<uk-gaap:EmployeesTotal>1\xff2</uk-gaap:EmployeesTotal>"), None),
    ]
    df = spark.createDataFrame(rows, "id int, content binary, text string")
    got = df.select("id", H.document_headcount(F.col("content"), F.col("text")).alias("n"))
    assert [r.n for r in got.orderBy("id").collect()] == [25, 15, 16, 17, 25, None, 12]


def test_lossy_text(spark):
    given = ["plain é €".encode(), b"a\xffb\xc3", b"", "x".encode()]
    got = apply(spark, H.lossy_text, [bytearray(b) for b in given], "binary")
    assert got == [b.decode("utf-8", errors="ignore") for b in given]


def test_filing_year_and_document(spark):
    assert apply(spark, H.filing_year, ["2024-03-31", "202", "2024", None]) == ["2024", None, "2024", None]
    given = [
        {"document_metadata": "https://x/document/abc"}, {"document_metadata": ""}, {},
        {"document_metadata": "https://x/document/"}, {"document_metadata": "bare"},
    ]
    got = apply(spark, H.document_id, given, "map<string,string>")
    assert got == ["abc", None, None, None, "bare"]
