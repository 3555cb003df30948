"""Headcounts read from tagged (iXBRL) filings and from filing texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmscope.functions.expr import any_of, collapse_space, find_all, first, holds_any, let

# Element names that hold a headcount, in search order.
EMPLOYEE_TAGS = (
    "AverageNumberOfEmployees", "NumberOfEmployees", "EmployeesTotal",
    "DirectorsAndEmployees", "AverageNumberEmployeesDuringYear",
)

# Taxonomy namespaces, in search order, under their usual prefix.
TAXONOMIES = {
    "uk-gaap": (
        "http://www.xbrl.org/uk/gaap/pt/2023-01-01",
        "http://www.xbrl.org/uk/gaap/pt/2022-01-01",
        "http://www.xbrl.org/uk/gaap/pt/2021-01-01",
        "http://www.xbrl.org/uk/gaap/pt/2020-01-01",
    ),
    "gaap": (
        "http://www.xbrl.org/uk/gaap/core/2009-09-01",
        "http://www.xbrl.org/uk/gaap/core/2020-01-01",
    ),
}

# Names that are looked for loosely in the markup, in search
# order: in the start tag before a number, then in the end tag after it.
START_NAMES = ("AverageNumberOfEmployees", "NumberOfEmployees", "EmployeesTotal")
END_NAMES = ("AverageNumberOfEmployees", "NumberOfEmployees")

# Wording right before a headcount, in search order, in text of single blanks.
# Wording that ends in another one's words and stands after it in the order finds nothing new.
STATED = (
    "average number of employees[: ]+",
    "number of employees[: ]+",
    "employees[: ]+",
    "staff numbers?[: ]+",
    "number of persons employed[: ]+",
    "average number employed[: ]+",
    "average number of employees during the year was ",
    "employed an average of ",
)
#: The wording that only counts with this behind the number.
BEHIND = {"employed an average of ": " people"}

# Words near a number that speak against or for a headcount.
MONEY_WORDS = (
    "turnover", "revenue", "sales", "profit", "loss", "assets", "liabilities",
    "shares", "capital", "dividend", "tax", "vat", "percentage", "%",
    "thousand", "million", "billion", "pounds", "£", "euro", "€", "dollar",
    "$", "currency",
)
PEOPLE_WORDS = (
    "employee", "staff", "personnel", "workforce", "employed", "people",
    "persons", "individuals", "full-time", "part-time", "fte", "headcount",
)

TAG_LIMIT = 1_000_000
TEXT_LIMIT = 500_000
UNSUPPORTED_LIMIT = 10_000
CONTEXT = 100

# Inside of a start tag that is not self-closing. The loops are possessive, so
# a tag with thousands of attributes costs no stack, and do not run past the
# next tag, so a document full of open ones is read once.
_OPEN_REST = r"""(?:\s(?:[^<>=/]|/(?!>)|=\s*"[^"]*"|=\s*'[^']*'|=)*+)?"""


# Filings: which ones, and which document

def filing_year(made_up_date: Column) -> Column:
    """First four characters; null when there are fewer."""
    return F.when(F.length(made_up_date) >= 4, F.left(made_up_date, F.lit(4)))


def document_id(links: Column) -> Column:
    """Last path segment of the document link; null when missing or empty."""
    link = links["document_metadata"]
    return F.nullif(F.substring_index(link, "/", -1), F.lit(""))


def looks_tagged(content: Column) -> Column:
    """Whether the first 2000 bytes look like a tagged filing."""

    def check(head: Column) -> Column:
        return head.contains("<html xmlns") | F.lower(head).contains("xbrl")

    return let(F.decode(F.substring(content, 1, 2000), "ISO-8859-1"), check)


def lossy_text(content: Column) -> Column:
    """UTF-8 text of the bytes; bytes that are not UTF-8 are dropped."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


# Tagged filings

def numeric_value(text: Column) -> Column:
    """First run of digits once commas and blanks are gone, if in range."""
    digits = F.regexp_extract(F.regexp_replace(text, r"(?U)[,\s]", ""), r"\d+", 0)
    return let(
        digits.try_cast("bigint"), lambda n: F.when((n > 0) & (n < TAG_LIMIT), n)
    )


def _first_number(texts: Column) -> Column:
    return first(F.filter(F.transform(texts, numeric_value), lambda n: n.isNotNull()))


def _without_tags(text: Column) -> Column:
    """Text with every bracket up to the next closing one cut out.

    What follows the last closing bracket cannot hold one and is not searched.
    """

    def cut(tail: Column) -> Column:
        head = F.left(text, F.length(text) - F.length(tail))
        return F.concat(F.regexp_replace(head, "<[^>]*+>", ""), tail)

    return let(F.substring_index(text, ">", -1), cut)


def _element_texts(doc: Column, name: str) -> Column:
    """Texts of the elements that are closed before the next tag of their kind."""
    body = rf"((?:[^<]++|<(?!/?{name}[\s/>]))*+)"
    inner = find_all(doc, rf"<{name}{_OPEN_REST}>{body}</{name}\s*>", 1)
    return F.transform(inner, _without_tags)


def tag_headcount(doc: Column) -> Column:
    """Prefixed elements, then bare lower-case ones, tag by tag."""

    def search(text: Column) -> Column:
        # Bare names come with the first prefix; once they found nothing, they
        # need not be tried again with the second.
        first_prefix, *others = TAXONOMIES
        names = [n for tag in EMPLOYEE_TAGS for n in (f"{first_prefix}:{tag}", tag.lower())]
        names += [f"{prefix}:{tag}" for prefix in others for tag in EMPLOYEE_TAGS]
        return F.coalesce(
            *[
                F.when(text.contains(f"<{name}"), _first_number(_element_texts(text, name)))
                for name in names
            ]
        )

    return let(doc, search)


def _loose_hits(parts: Column, name: str, before: bool) -> Column:
    """First usable number beside a tag that holds ``name`` anywhere, in any case.

    ``parts`` is the document cut at closing brackets, lower-cased. A tag may
    hold open brackets, so it begins with the first one in its part. With
    ``before`` the tag stands before the number, which ends at an end tag; else
    after it. Each bracket serves one find only, as in a search from left to
    right.
    """
    wanted = name.lower()
    size = F.size(parts)
    start = F.struct(F.lit(False).alias("used"), F.lit(None).cast("bigint").alias("hit"))

    def holds(part: Column) -> Column:
        return F.when(F.instr(part, "<") > 0, F.substr(part, F.instr(part, "<"))).contains(wanted)

    def step(state: Column, place: Column) -> Column:
        part, after = F.get(parts, place), F.get(parts, place + 1)
        digits = r"^(\d+)</"
        if before:
            open_part = F.when(state["used"], F.regexp_replace(part, digits, "")).otherwise(part)
            number = F.regexp_extract(after, digits, 1)
            found = holds(open_part) & (number != "")
        else:
            number = F.regexp_extract(part, digits, 1)
            tag = F.regexp_replace(part, digits, "")
            found = (place > 0) & ~state["used"] & (number != "") & tag.contains(wanted)
        value = F.when(found, number.try_cast("bigint"))
        return F.when(state["hit"].isNotNull(), state).otherwise(
            F.struct(
                F.coalesce(found, F.lit(False)).alias("used"),
                F.when((value > 0) & (value < TAG_LIMIT), value).alias("hit"),
            )
        )

    places = F.when(size > 1, F.sequence(F.lit(0), size - 2)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, step, lambda state: state["hit"])


def markup_headcount(doc: Column) -> Column:
    """Numbers beside loosely read tags; these also see names inside attributes."""

    def search(text: Column) -> Column:
        finds = [(name, True) for name in START_NAMES] + [(name, False) for name in END_NAMES]
        return F.when(
            text.contains("employees"),
            let(
                F.split(text, ">", -1),
                lambda parts: F.coalesce(
                    *[
                        F.when(text.contains(name.lower()), _loose_hits(parts, name, before))
                        for name, before in finds
                    ]
                ),
            ),
        )

    return let(F.lower(doc), search)


def namespace_headcount(doc: Column) -> Column:
    """Elements under any prefix that the document binds to a known taxonomy.

    Candidates are ordered by namespace, then tag, then place in the document.
    """
    uris = [uri for group in TAXONOMIES.values() for uri in group]
    ranks = F.array(*[F.lit(uri) for uri in uris])
    binding = rf"""xmlns(?::[\w.-]+)?\s*=\s*["'](?:{any_of(uris)})["']"""

    def bindings(text: Column) -> Column:
        return F.transform(
            find_all(text, binding),
            lambda pair: F.struct(
                F.regexp_extract(pair, r"^xmlns:?([\w.-]*)", 1).alias("prefix"),
                F.array_position(
                    ranks, F.regexp_extract(pair, r"""["']([^"']*)""", 1)
                ).alias("rank"),
            ),
        )

    def candidates(text: Column, bound: Column, order: int, tag: str) -> Column:
        # The start tag and the text right after it; what follows does not count.
        start = rf"<(?:[\w.-]+:)?{tag}{_OPEN_REST}>"
        return F.transform(
            find_all(text, rf"{start}[^<]*"),
            lambda element, place: let(
                F.regexp_extract(element, rf"^<(?:([\w.-]+):)?{tag}", 1),
                lambda prefix: F.struct(
                    first(F.filter(bound, lambda b: b["prefix"] == prefix))["rank"].alias("rank"),
                    F.lit(order).alias("tag"),
                    place.alias("place"),
                    numeric_value(F.regexp_replace(element, rf"\A{start}", "")).alias("n"),
                ),
            ),
        )

    def search(text: Column) -> Column:
        def within(bound: Column) -> Column:
            every = F.concat(
                *[
                    candidates(text, bound, order, tag)
                    for order, tag in enumerate(EMPLOYEE_TAGS)
                ]
            )
            usable = F.filter(every, lambda c: c["rank"].isNotNull() & c["n"].isNotNull())
            return F.when(F.size(bound) > 0, F.array_min(usable)["n"])

        return F.when(text.contains("xmlns"), let(bindings(text), within))

    return let(doc, search)


def tagged_headcount(doc: Column) -> Column:
    return let(
        doc,
        lambda text: F.coalesce(
            tag_headcount(text), markup_headcount(text), namespace_headcount(text)
        ),
    )


# Filing texts

def near_people(text: Column, digits: Column) -> Column:
    """Whether the words around the digits' first place in the text allow a headcount."""

    def judge(context: Column) -> Column:
        return (
            F.when(holds_any(context, MONEY_WORDS), F.lit(False))
            .when(holds_any(context, PEOPLE_WORDS), F.lit(True))
            .otherwise(digits.try_cast("int").between(1, UNSUPPORTED_LIMIT))
        )

    def around(place: Column) -> Column:
        start = F.greatest(F.lit(1), place - CONTEXT)
        return let(F.substr(text, start, place + CONTEXT - start), judge)

    return F.when(~text.contains(digits), F.lit(True)).otherwise(
        let(F.instr(text, digits), around)
    )


def _stated(body: Column) -> Column:
    """Every stated number as (rank of its wording, place among all, digits), from one search.

    Wordings end right before their number, so no two of them share one, and a
    search from left to right meets each number with its longest wording.
    """
    behind = "|".join(BEHIND.values())
    # No wording begins with another letter.
    starts = "".join(sorted({wording[0] for wording in STATED}))
    every = rf"(?=[{starts}])(?:{'|'.join(STATED)})\d{{1,6}}(?:{behind})?"

    def candidate(found: Column, place: Column) -> Column:
        rank = F.lit(None).cast("int")
        for k in reversed(range(len(STATED))):
            needed = BEHIND.get(STATED[k], "")
            rank = F.when(found.rlike(rf"\A{STATED[k]}\d+{needed or f'(?:{behind})?'}\z"), F.lit(k)).otherwise(rank)
        digits = F.regexp_extract(found, r"\d+", 0)
        return F.struct(rank.alias("rank"), place.alias("place"), digits.alias("digits"))

    return F.transform(find_all(body, every), candidate)


def text_headcount(text: Column) -> Column:
    """First accepted number, wording by wording, in normalised lower-case text."""

    def search(body: Column) -> Column:
        def accept(digits: Column) -> Column:
            return digits.try_cast("int").between(1, TEXT_LIMIT) & near_people(body, digits)

        usable = F.filter(_stated(body), lambda c: c["rank"].isNotNull() & accept(c["digits"]))
        return F.array_min(usable)["digits"].try_cast("bigint")

    # Every wording holds one of these, so other texts need not be normalised.
    return F.when(
        text.rlike("(?i)employ|staff"), let(F.lower(collapse_space(text)), search)
    )


def document_headcount(content: Column, text: Column) -> Column:
    """Tagged reading when the bytes look tagged, else (or when it fails) the text."""
    tagged = F.when(looks_tagged(content), tagged_headcount(lossy_text(content)))
    return F.coalesce(tagged, text_headcount(text))
