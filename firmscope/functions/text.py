"""Rules for company numbers, names, addresses, links and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmscope.functions.expr import (
    any_of,
    collapse_space,
    empty_to_null,
    find_all,
    first,
    holds_any,
    let,
    strip,
)

NUMBER_WIDTH = 8

# Domain endings accepted for a business site.
BUSINESS_SUFFIXES = (
    ".com", ".co.uk", ".uk", ".org", ".net", ".io", ".tech", ".biz", ".info",
    ".eu", ".gov.uk", ".ac.uk",
)

# Directories and social sites that are never a company's own.
DIRECTORY_SITES = (
    "facebook.com", "twitter.com", "linkedin.com", "instagram.com",
    "companies-house.gov.uk", "companieshouse.gov.uk", "yell.com", "yelp.com",
    "trustpilot.com", "wikipedia.org", "wikidata.org",
)

# The parts of a registered address, in writing order.
ADDRESS_PARTS = (
    "premises", "address_line_1", "address_line_2", "locality", "region",
    "postal_code", "country",
)

# Openings dropped from a scraped description.
SITE_OPENINGS = ("welcome to ", "about ", "home - ", "home | ")

# Entities undone in a meta text, in this order.
META_ENTITIES = (
    ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
)

# Contact patterns; phones are tried in this order.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
MACHINE_SENDERS = ("noreply", "no-reply", "donotreply")
PHONES = (
    r"(?U)\+44\s?\d{3}\s?\d{3}\s?\d{4}",
    r"(?U)0\d{3}\s?\d{3}\s?\d{4}",
    r"(?U)\(\d{4}\)\s?\d{6}",
)


# An address can only start in a run of its characters that ends at an at sign.
# Looking for that first keeps long runs without one (encoded data) linear.
_EMAIL_RUN = rf"(?U)(?<![A-Za-z0-9._%+-])(?=[A-Za-z0-9._%+-]++@)[A-Za-z0-9._%+-]*?({EMAIL})"


# Company numbers, names and addresses

def pad_number(number: Column) -> Column:
    """Left-pad with zeros to eight characters; longer numbers stay whole."""
    text = number.cast("string")
    signed = F.concat(
        F.left(text, F.lit(1)), F.lpad(F.substring(text, 2, NUMBER_WIDTH), NUMBER_WIDTH - 1, "0")
    )
    return (
        F.when(F.length(text) >= NUMBER_WIDTH, text)
        .when(text.rlike("^[+-]"), signed)
        .otherwise(F.lpad(text, NUMBER_WIDTH, "0"))
    )


def join_parts(parts: list[Column], separator: str = ", ") -> Column:
    """Join the parts that are neither null nor empty."""
    return F.array_join(F.filter(F.array(*parts), lambda part: part != ""), separator)


def format_address(address: Column) -> Column:
    """One line from a registered-address struct."""
    return join_parts([address[part] for part in ADDRESS_PARTS])


def search_query(name: Column) -> Column:
    return F.concat(F.lit('"'), name, F.lit('" official website'))


def name_tokens(name: Column) -> Column:
    """Words of four or more plain letters, lower case."""
    return find_all(F.lower(name), r"(?U)\b[a-z]{4,}\b")


# Links

def url_domain(url: Column) -> Column:
    """Network location in lower case without one leading ``www.``; '' if none."""
    clean = F.regexp_replace(F.lower(url), r"\A[\x00-\x20]+|[\t\r\n]", "")
    location = F.regexp_extract(clean, r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(location, r"^www\.", "")


def has_business_suffix(domain: Column) -> Column:
    return domain.rlike(rf"(?:{any_of(BUSINESS_SUFFIXES)})\z")


def domain_letters(domain: Column) -> Column:
    return F.regexp_replace(domain, "[^a-z]", "")


def is_company_domain(url: Column, name: Column) -> Column:
    """Accepted ending, and a word of the company's name inside the domain."""

    def check(domain: Column) -> Column:
        named = let(
            domain_letters(domain),
            lambda letters: F.exists(name_tokens(name), lambda word: letters.contains(word)),
        )
        return F.when(has_business_suffix(domain), named).otherwise(F.lit(False))

    return F.coalesce(let(url_domain(url), check), F.lit(False))


def is_directory_site(url: Column) -> Column:
    return let(F.lower(url), lambda lowered: holds_any(lowered, DIRECTORY_SITES))


def is_candidate_link(url: Column) -> Column:
    """Has a link, and it does not lead to a directory or social site."""
    return F.coalesce((url != "") & ~is_directory_site(url), F.lit(False))


def with_scheme(url: Column) -> Column:
    return F.when(url.rlike(r"\Ahttps?://"), url).otherwise(F.concat(F.lit("https://"), url))


# Free text

def clean_site_text(text: Column) -> Column:
    """Single blanks, one known opening dropped, ends trimmed (in that order)."""
    return strip(
        F.regexp_replace(collapse_space(text), rf"(?i)\A(?:{any_of(SITE_OPENINGS)})", "")
    )


def clean_meta_text(text: Column) -> Column:
    """Single blanks, then the five entities one after the other, then trim."""
    cleaned = collapse_space(text)
    for entity, char in META_ENTITIES:
        cleaned = F.replace(cleaned, F.lit(entity), F.lit(char))
    return strip(cleaned)


def business_email(text: Column) -> Column:
    """First e-mail address that is not a machine sender, else null."""

    def pick(body: Column) -> Column:
        people = F.filter(
            find_all(body, _EMAIL_RUN, 1),
            lambda address: ~holds_any(F.lower(address), MACHINE_SENDERS),
        )
        return F.when(body.contains("@"), first(people))

    return let(text, pick)


def uk_phone(text: Column) -> Column:
    """First match of the first phone pattern that matches at all, else null."""
    return let(
        text,
        lambda body: F.coalesce(
            *[empty_to_null(F.regexp_extract(body, pattern, 0)) for pattern in PHONES]
        ),
    )


# Geocoding

def can_geocode(address: Column) -> Column:
    return F.coalesce(F.length(strip(address)) >= 10, F.lit(False))


def format_position(lat: Column, lng: Column, name: Column) -> Column:
    """``lat,lng (name)``; null when there is no position."""
    return F.concat(
        lat.cast("string"), F.lit(","), lng.cast("string"),
        F.lit(" ("), F.coalesce(name, F.lit("")), F.lit(")"),
    )
