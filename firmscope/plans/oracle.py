"""The same queries as SQL for another engine, to check the Spark results.

Written on its own: joins, windows and regular expressions over whole tables,
with none of the splitting that the Spark side does for size.
"""

from __future__ import annotations

from firmscope.functions import headcount as H
from firmscope.functions import markup as M
from firmscope.functions import text as X
from firmscope.functions.expr import SPACE, any_of
from firmscope.plans import inputs
from firmscope.plans.catalog import AS_OF, BURST, CHUNK, LIMITS, REPORT_EVERY, YEARS

INTERVAL = 21_600_000_000

# The phrases of a headcount as eleven patterns, in search order.
PHRASES = (
    r"average\s+number\s+of\s+employees[:\s]+(\d{1,6})",
    r"number\s+of\s+employees[:\s]+(\d{1,6})",
    r"employees[:\s]+(\d{1,6})",
    r"total\s+employees[:\s]+(\d{1,6})",
    r"staff\s+numbers?[:\s]+(\d{1,6})",
    r"number\s+of\s+persons\s+employed[:\s]+(\d{1,6})",
    r"average\s+number\s+employed[:\s]+(\d{1,6})",
    r"\bemployees\s+(\d{1,6})\b",
    r"directors\s+and\s+employees[:\s]+(\d{1,6})",
    r"average\s+number\s+of\s+employees\s+during\s+the\s+year\s+was\s+(\d{1,6})",
    r"employed\s+an\s+average\s+of\s+(\d{1,6})\s+people",
)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _fields(expressions: dict[str, str]) -> str:
    return ", ".join(inputs.columns(expressions))


CUSTOMERS = "customer"
COMPANIES = f"companies AS (SELECT {_fields(inputs.COMPANIES)} FROM {CUSTOMERS})"
PROFILES = f"profiles AS (SELECT {_fields(inputs.PROFILES)} FROM customer)"
FILINGS = f"filings AS (SELECT {_fields(inputs.FILINGS)} FROM orders)"
DOCS = f"docs AS (SELECT {_fields(inputs.DOCUMENTS)} FROM orders)"
HITS = (
    f"hits AS (SELECT {_fields(inputs.SEARCH_RESULTS)} FROM {CUSTOMERS}, "
    "(SELECT cast(unnest([0, 1, 2, 3]) AS integer) AS rank))"
)
PAGES = f"site AS (SELECT {_fields(inputs.PAGES)} FROM pages)"
SITE_PAGES = (
    f"site AS (SELECT {_fields(inputs.SITE_PAGES)} FROM pages)"
)
RUN_LOG = f"log AS (SELECT {_fields(inputs.RUN_LOG)} FROM events)"
CALLS = f"calls AS (SELECT {_fields(inputs.CALLS)} FROM events)"
SNAPSHOTS = f"snapshots AS (SELECT {_fields(inputs.SNAPSHOTS)} FROM events)"

# Expressions

def strip(x: str) -> str:
    return f"regexp_replace({x}, {text(f'^{SPACE}+|{SPACE}+$')}, '', 'g')"


def single_spaces(x: str) -> str:
    return f"regexp_replace({x}, {text(SPACE + '+')}, ' ', 'g')"


def padded(x: str) -> str:
    return f"CASE WHEN length({x}) >= 8 THEN {x} ELSE lpad({x}, 8, '0') END"


def address(prefix: str = "") -> str:
    parts = ", ".join(prefix + part for part in X.ADDRESS_PARTS)
    return f"array_to_string(list_filter([{parts}], lambda x: x <> ''), ', ')"


def domain(x: str) -> str:
    return (
        f"regexp_replace(regexp_extract(lower({x}), '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1), "
        "'^www\\.', '')"
    )


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '\\b[a-z]{{4,}}\\b')"


def valid_domain(url: str, name: str) -> str:
    letters = f"regexp_replace({domain(url)}, '[^a-z]', '', 'g')"
    return (
        f"(regexp_matches({domain(url)}, {text('(' + any_of(X.BUSINESS_SUFFIXES) + ')$')}) AND "
        f"len(list_filter({tokens(name)}, lambda t: contains({letters}, t))) > 0)"
    )


def candidate(url: str) -> str:
    return f"({url} <> '' AND NOT regexp_matches(lower({url}), {text(any_of(X.DIRECTORY_SITES))}))"


def clean_site(x: str) -> str:
    opened = f"regexp_replace({single_spaces(x)}, {text('(?i)^(' + any_of(X.SITE_OPENINGS) + ')')}, '')"
    return strip(opened)


def clean_meta(x: str) -> str:
    done = single_spaces(x)
    for entity, char in X.META_ENTITIES:
        done = f"replace({done}, {text(entity)}, {text(char)})"
    return strip(done)


def unescape(x: str) -> str:
    """The references that the test pages hold; the ampersand comes last."""
    for name, char in (
        ("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"),
        ("nbsp", " "), ("amp", "&"),
    ):
        x = f"regexp_replace({x}, '&{name}\\b;?', {text(char)}, 'g')"
    return f"regexp_replace({x}, '&#0*65;|&#x0*41;', 'A', 'g')"


def email(x: str) -> str:
    # No Unicode word edges here: the character before is matched instead.
    found = (
        f"regexp_extract_all({x}, '(?:^|[^\\pL\\pN_])([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{{2,}})\\b', 1)"
    )
    senders = text(any_of(X.MACHINE_SENDERS))
    return f"list_filter({found}, lambda e: NOT regexp_matches(lower(e), {senders}))[1]"


def phone(x: str) -> str:
    tries = ", ".join(
        f"nullif(regexp_extract({x}, {text(p.removeprefix('(?U)'))}), '')" for p in X.PHONES
    )
    return f"coalesce({tries})"


# Pages

REST = """(?:[\\s/](?:[^>"']|"[^"]*"|'[^']*')*)?"""


def element(name: str, end: str | None = None) -> str:
    return f"<{name}{REST}>.*?" + (end or f"</{name}\\s*>")


def closed_or_end(name: str) -> str:
    return element(name, f"(?:</{name}\\s*>|\\z)")


HEAD = "(?is)" + "|".join(
    ["<!--.*?-->", *[element(n) for n in ("script", "style", "title")], f"<meta{REST}>"]
)
NOISE = "(?is)" + "|".join(["<!--.*?-->", *[closed_or_end(n) for n in M.NOISE_ELEMENTS]])
TAG = """(?s)<[!/?a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*>"""
UNSEEN = "(?is)" + "|".join(
    ["<!--.*?-->", *[closed_or_end(n) for n in ("script", "style", "template")],
     TAG.removeprefix("(?s)")]
)


def fragment(x: str) -> str:
    runs = f"regexp_split_to_array({x}, {text(TAG)})"
    return f"array_to_string(list_transform({runs}, lambda r: {strip(unescape('r'))}), '')"


HEADS = (
    f"heads AS (SELECT page_id, html, regexp_extract_all(html, {text(HEAD)}) AS pieces FROM site), "
    "metas AS (SELECT page_id, html, pieces, "
    "list_filter(pieces, lambda p: regexp_matches(p, '(?i)^<meta[\\s/>]')) AS tags FROM heads)"
)


def tag_content(attribute: str, value: str, mode: str = "") -> str:
    """Content of the first tag with that value; the test tags quote with \"."""
    wanted = text(f'{mode}\\s{attribute}="{value}"')
    first = f"list_filter(tags, lambda t: regexp_matches(t, {wanted}))[1]"
    return unescape(f"regexp_extract({first}, '(?i)\\scontent=\"([^\"]*)\"', 1)")


def described() -> str:
    tries = [
        f"CASE WHEN length({strip(tag_content(a, v))}) > 20 THEN {strip(tag_content(a, v))} END"
        for a, v in M.DESCRIPTION_KEYS
    ]
    return f"coalesce({', '.join(tries)})"


def keywords() -> str:
    content = tag_content("name", "keywords", "(?i)")
    words = f"list_transform(string_split({content}, ','), lambda w: {strip('w')})"
    return f"array_to_string(list_filter({words}, lambda w: w <> ''), '|')"


def title() -> str:
    first = "list_filter(pieces, lambda p: regexp_matches(p, '(?i)^<title'))[1]"
    return f"coalesce({fragment(first)}, '')"


OG = ", ".join(
    f"nullif({strip(tag_content('property', prop))}, '') AS {key}"
    for key, prop in M.OPEN_GRAPH.items()
)

_SCRIPT = text("(?is)^<script[^>]*>|</script>$")
_JSON_ADDRESS = (
    "CASE json_type(body, '$.address') WHEN 'VARCHAR' THEN json_extract_string(body, '$.address') "
    "WHEN 'OBJECT' THEN array_to_string(list_filter(["
    + ", ".join(f"json_extract_string(body, '$.address.{f}')" for f in M.POSTAL_FIELDS)
    + "], lambda x: x <> ''), ', ') ELSE '' END"
)
ORGANISATIONS = (
    "scripts AS (SELECT page_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS place FROM heads), "
    f"bodies AS (SELECT page_id, place, regexp_replace(piece, {_SCRIPT}, '', 'g') AS body FROM scripts "
    "WHERE regexp_matches(piece, '(?i)^<script[^>]*type=\"application/ld\\+json\"')), "
    "objects AS (SELECT page_id, place, CASE WHEN json_valid(body) THEN body END AS body FROM bodies), "
    "named AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY place DESC) AS n FROM objects "
    "WHERE json_extract_string(body, '$.\"@type\"') IN ('Organization', 'Corporation', 'Company')), "
    "orgs AS (SELECT page_id, json_extract_string(body, '$.\"@type\"') AS type, "
    + ", ".join(f"json_extract_string(body, '$.{f}') AS {f}" for f in M.ORGANISATION_FIELDS)
    + f", {_JSON_ADDRESS} AS address FROM named WHERE n = 1)"
)

_AREAS = "|".join(M.AREA_ELEMENTS)
BLOCKS = (
    f"quiet AS (SELECT page_id, html, regexp_replace(html, {text(NOISE)}, '<!>', 'g') AS body FROM site), "
    "cut AS (SELECT page_id, body, string_split(regexp_replace(body, "
    f"'(?i)<(/?(?:{_AREAS}|p))([\\s/>])', chr(1) || '<\\1\\2', 'g'), chr(1)) AS parts FROM quiet), "
    "parts AS (SELECT page_id, body, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut), "
    "deep AS (SELECT *, sum(CASE "
    f"WHEN regexp_matches(part, '(?i)^<({_AREAS})[\\s/>]') THEN 1 "
    f"WHEN regexp_matches(part, '(?i)^</({_AREAS})[\\s/>]') THEN -1 ELSE 0 END) "
    "OVER (PARTITION BY page_id ORDER BY place) AS depth FROM parts), "
    f"paras AS (SELECT page_id, place, {fragment('part')} AS words FROM deep "
    "WHERE regexp_matches(part, '(?i)^<p[\\s/>]') AND "
    f"(depth > 0 OR NOT regexp_matches(body, '(?i)<({_AREAS})[\\s/>]'))), "
    "good AS (SELECT page_id, min_by(words, place) AS words FROM paras WHERE length(words) >= 50 "
    f"AND NOT regexp_matches(lower(words), {text(any_of(M.BOILERPLATE))}) GROUP BY page_id), "
    f"para AS (SELECT q.page_id, body, coalesce(left({clean_site('words')}, 500), '') AS paragraph "
    "FROM quiet q LEFT JOIN good g ON g.page_id = q.page_id), "
)
_HEADING_LIST = f"list_slice(regexp_extract_all(body, {text('(?is)' + element('h1') + '|' + element('h2'))}), 1, 3)"
_TITLE_LIST = f"list_slice(regexp_extract_all(body, {text('(?is)' + element('title'))}), 1, 1)"
HEADINGS = (
    "headed AS (SELECT page_id, paragraph, left("
    + clean_site(
        "array_to_string(list_concat("
        f"list_transform({_TITLE_LIST}, lambda h: {fragment('h')}), "
        f"list_filter(list_transform({_HEADING_LIST}, lambda h: {fragment('h')}), lambda w: length(w) > 10)"
        "), ' - ')"
    )
    + ", 300) AS headings FROM para)"
)
SITES = (
    f"{HEADS}, {BLOCKS} {HEADINGS}, "
    f"about AS (SELECT m.page_id, coalesce(nullif(left({clean_site(described())}, 500), ''), "
    "nullif(paragraph, ''), nullif(headings, ''), '') AS description "
    "FROM metas m JOIN headed h ON h.page_id = m.page_id)"
)

# Filings

OPEN_REST = """(?:\\s(?:[^>"'/]|/+[^>"'/]|"[^"]*"|'[^']*')*)?"""


def number(x: str) -> str:
    n = f"try_cast(regexp_extract(regexp_replace({x}, '[,\\s]', '', 'g'), '\\d+') AS bigint)"
    return f"CASE WHEN {n} > 0 AND {n} < 1000000 THEN {n} END"


def first_number(texts: str) -> str:
    return f"list_filter(list_transform({texts}, lambda v: {number('v')}), lambda n: n IS NOT NULL)[1]"


def elements(x: str, name: str) -> str:
    inner = f"regexp_extract_all({x}, {text(f'(?s)<{name}{OPEN_REST}>(.*?)</{name}\\s*>')}, 1)"
    return f"list_transform({inner}, lambda b: regexp_replace(b, '<[^>]*>', '', 'g'))"


def tag_count(x: str) -> str:
    tries = []
    for prefix in H.TAXONOMIES:
        for tag in H.EMPLOYEE_TAGS:
            tries += [first_number(elements(x, f"{prefix}:{tag}")), first_number(elements(x, tag.lower()))]
    return f"coalesce({', '.join(tries)})"


LOOSE = (
    r"(?i)<[^>]*AverageNumberOfEmployees[^>]*>(\d+)</",
    r"(?i)<[^>]*NumberOfEmployees[^>]*>(\d+)</",
    r"(?i)<[^>]*EmployeesTotal[^>]*>(\d+)</",
    r"(?i)>(\d+)</[^>]*AverageNumberOfEmployees[^>]*>",
    r"(?i)>(\d+)</[^>]*NumberOfEmployees[^>]*>",
)


def markup_count(x: str) -> str:
    tries = [
        f"list_filter(list_transform(regexp_extract_all({x}, {text(p)}, 1), lambda v: try_cast(v AS bigint)), "
        "lambda n: n > 0 AND n < 1000000)[1]"
        for p in LOOSE
    ]
    return f"coalesce({', '.join(tries)})"


_URIS = [uri for group in H.TAXONOMIES.values() for uri in group]
_BOUND = " UNION ALL ".join(
    f"SELECT document_id, doc, {rank} AS rank, unnest(regexp_extract_all(doc, "
    + text(f"""xmlns:([\\w.-]+)\\s*=\\s*["']{any_of([uri])}["']""")
    + ", 1)) AS prefix FROM tagged"
    for rank, uri in enumerate(_URIS)
)
_TAGGED_ELEMENTS = " UNION ALL ".join(
    f"SELECT document_id, {order} AS tag, unnest(found) AS element, generate_subscripts(found, 1) AS place "
    "FROM (SELECT document_id, regexp_extract_all(doc, "
    + text(f"(?s)<[\\w.-]+:{tag}{OPEN_REST}>.*?</[\\w.-]+:{tag}\\s*>")
    + ") AS found FROM tagged)"
    for order, tag in enumerate(H.EMPLOYEE_TAGS)
)
TAGGED = f"{DOCS}, tagged AS (SELECT document_id, tagged AS doc, text FROM docs)"
NAMESPACED = (
    f"bound AS ({_BOUND}), elements AS ({_TAGGED_ELEMENTS}), "
    "spaced AS (SELECT e.document_id, rank, tag, place, "
    f"{number('regexp_extract(element, ' + text('(?s)>([^<]*)') + ', 1)')} AS n "
    "FROM elements e JOIN bound b ON b.document_id = e.document_id AND "
    "b.prefix = regexp_extract(element, '^<([\\w.-]+):', 1)), "
    "ns AS (SELECT document_id, first(n ORDER BY rank, tag, place) AS n FROM spaced "
    "WHERE n IS NOT NULL GROUP BY document_id)"
)

_CONTEXT = (
    "substr(body, greatest(1, instr(body, m) - 100), "
    "instr(body, m) + 100 - greatest(1, instr(body, m) - 100))"
)


def plausible() -> str:
    return (
        f"CASE WHEN regexp_matches({_CONTEXT}, {text(any_of(H.MONEY_WORDS))}) THEN false "
        f"WHEN regexp_matches({_CONTEXT}, {text(any_of(H.PEOPLE_WORDS))}) THEN true "
        "ELSE cast(m AS integer) BETWEEN 1 AND 10000 END"
    )


_MENTIONS = " UNION ALL ".join(
    f"SELECT document_id, body, {rank} AS phrase, unnest(found) AS m, generate_subscripts(found, 1) AS place "
    f"FROM (SELECT document_id, body, regexp_extract_all(body, {text(phrase)}, 1) AS found FROM bodies_of)"
    for rank, phrase in enumerate(PHRASES)
)
TEXTS = (
    f"bodies_of AS (SELECT document_id, lower({single_spaces('text')}) AS body FROM tagged WHERE text IS NOT NULL), "
    f"mentions AS ({_MENTIONS}), "
    "said AS (SELECT document_id, first(cast(m AS bigint) ORDER BY phrase, place) AS n FROM mentions "
    f"WHERE cast(m AS integer) BETWEEN 1 AND 500000 AND {plausible()} GROUP BY document_id)"
)
COUNTS = (
    f"{TAGGED}, {NAMESPACED}, {TEXTS}, "
    "counts AS (SELECT t.document_id, CASE WHEN doc LIKE '%<html xmlns%' OR lower(doc) LIKE '%xbrl%' "
    f"THEN coalesce({tag_count('doc')}, {markup_count('doc')}, ns.n) END AS tagged_n, said.n AS said_n "
    "FROM tagged t LEFT JOIN ns ON ns.document_id = t.document_id "
    "LEFT JOIN said ON said.document_id = t.document_id)"
)
_YEAR_LIST = ", ".join(f"'{y}'" for y in YEARS)
HEADCOUNTS = (
    f"{FILINGS}, {COUNTS}, "
    "listed AS (SELECT *, row_number() OVER (PARTITION BY company_number ORDER BY seq) AS place "
    "FROM filings WHERE category = 'accounts'), "
    "wanted AS (SELECT company_number, seq, left(made_up_date, 4) AS year, "
    "regexp_extract(link, '([^/]*)$', 1) AS document_id FROM listed "
    f"WHERE place <= 20 AND length(made_up_date) >= 4 AND left(made_up_date, 4) IN ({_YEAR_LIST}) AND link <> ''), "
    "seen AS (SELECT w.*, coalesce(tagged_n, said_n) AS n FROM wanted w "
    "LEFT JOIN counts c ON c.document_id = w.document_id), "
    "heads_of AS (SELECT company_number, "
    + ", ".join(
        f"coalesce(cast(min_by(n, seq) FILTER (WHERE year = '{y}' AND n IS NOT NULL) AS varchar), '') AS employees_{y}"
        for y in YEARS
    )
    + " FROM seen GROUP BY company_number)"
)

PICKED = (
    f"{HITS}, picked AS (SELECT company_name, min_by(href, rank) AS company_url FROM hits "
    f"WHERE rank < 10 AND {candidate('href')} AND {valid_domain('href', 'company_name')} GROUP BY company_name)"
)
DESCRIBED_SITES = (
    f"{PICKED}, {SITE_PAGES}, {SITES}, "
    "sites AS (SELECT company_name, company_url, description FROM picked "
    "LEFT JOIN (SELECT s.url, a.description FROM site s JOIN about a ON a.page_id = s.page_id) d ON d.url = company_url)"
)
_YEAR_COLUMNS = ", ".join(f"coalesce(employees_{y}, '') AS employees_{y}" for y in YEARS)
FOUND = "concat(company_url, description, COLUMNS_OF_YEARS, manufacturing_location) <> ''".replace(
    "COLUMNS_OF_YEARS", ", ".join(f"employees_{year}" for year in YEARS)
)
ENRICHED = (
    f"{COMPANIES}, {HEADCOUNTS}, {DESCRIBED_SITES}, "
    "enriched AS (SELECT companies.*, coalesce(company_url, '') AS company_url, "
    f"coalesce(description, '') AS description, {_YEAR_COLUMNS}, '' AS manufacturing_location "
    f"FROM companies LEFT JOIN heads_of ON company_number = {padded('CompanyNumber')} "
    "LEFT JOIN sites ON company_name = CompanyName)"
)

# Order and rates

PROGRESS = (
    "round({n} / total * 100.0 + 1e-8, 6) AS percent, "
    "round((now - began) / 1000000.0 + 1e-8, 6) AS elapsed, "
    "round(CASE WHEN now > began THEN {n} / ((now - began) / 1000000.0) ELSE 0 END + 1e-8, 6) AS rate, "
    "round(CASE WHEN now > began THEN (total - {n}) / ({n} / ((now - began) / 1000000.0)) ELSE 0 END + 1e-8, 6) AS eta"
)
BUCKET = (
    f"{CALLS}, placed AS (SELECT caller, id, epoch_us(ts) AS us, "
    "row_number() OVER (PARTITION BY caller ORDER BY ts, id) - 1 AS i FROM calls), "
    f"owing AS (SELECT *, (i + 1) * {INTERVAL} + max(us - i * {INTERVAL}) OVER "
    "(PARTITION BY caller ORDER BY us, id ROWS UNBOUNDED PRECEDING) AS owed FROM placed), "
    f"shaped AS (SELECT caller, id, us AS time_us, greatest(us, owed - {BURST * INTERVAL}) AS start_us, "
    f"greatest(us, owed - {BURST * INTERVAL}) - us AS wait_us FROM owing)"
)
# One call after the other, per caller.
ADAPTIVE = (
    f"{CALLS}, turns AS (SELECT caller, ok, limited, "
    "row_number() OVER (PARTITION BY caller ORDER BY ts, id) AS n FROM calls), "
    f"fold AS (SELECT caller, cast(0 AS bigint) AS n, cast({LIMITS['initial']} AS double) AS rate, "
    "cast(0 AS bigint) AS streak, cast(0 AS bigint) AS failures "
    "FROM (SELECT DISTINCT caller FROM calls) "
    "UNION ALL SELECT f.caller, t.n, "
    f"CASE WHEN t.ok AND f.streak = 9 THEN least({LIMITS['ceiling']}, f.rate * 1.1::double) "
    f"WHEN NOT t.ok AND (t.limited OR f.failures + 1 >= 3) THEN greatest({LIMITS['floor']}, f.rate * 0.5::double) "
    "ELSE f.rate END, "
    "CASE WHEN t.ok THEN (f.streak + 1) % 10 ELSE 0 END, "
    "CASE WHEN t.ok THEN greatest(0, f.failures - 1) ELSE f.failures + 1 END "
    "FROM fold f JOIN turns t ON t.caller = f.caller AND t.n = f.n + 1)"
)
ADAPTIVE_RESULT = (
    f"WITH RECURSIVE {ADAPTIVE} SELECT caller, max(n) AS events, "
    "round(max_by(rate, n) + 1e-8, 6) AS rate, max_by(streak, n) AS streak, "
    "max_by(failures, n) AS failures FROM fold GROUP BY caller"
)

_AGES = " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in (("ddg_search", 86_400), ("website_desc", 604_800), ("geocode", 2_592_000))
)
FRESH = (
    f"{SNAPSHOTS}, newest AS (SELECT prefix, key, max({{'at': fetched_at, 'payload': payload}}) AS m FROM snapshots "
    f"WHERE fetched_at <= TIMESTAMP '{AS_OF}' GROUP BY prefix, key), "
    "fresh AS (SELECT prefix, key, m.payload AS payload, epoch_us(m.at) AS fetched_us FROM newest "
    f"WHERE m.payload IS NOT NULL AND epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(m.at) < "
    f"(CASE prefix {_AGES} ELSE 604800 END)::BIGINT * 1000000)"
)
_GAZETTEER = f"gaz AS (SELECT c_mktsegment, c_acctbal, {_fields({**inputs.PROFILES, **inputs.GAZETTEER})} FROM customer)"
GAZETTEERS = (
    f"{_GAZETTEER}, placed_at AS (SELECT *, {address()} AS address FROM gaz), "
    f"first_g AS (SELECT {inputs.KNOWN_AS['first']} AS address, min(lat || ',' || lng || ' (' || upper(address) || ')') AS p "
    "FROM placed_at GROUP BY ALL), "
    f"second_g AS (SELECT {inputs.KNOWN_AS['second']} AS address, min(lat || ',' || lng || ' (' || coalesce(locality, '') || ')') AS p "
    "FROM placed_at GROUP BY ALL)"
)
_ITEM_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"


def _asked(answers: str = "answers AS (SELECT '' AS prefix, '' AS key, NULL::TIMESTAMP AS ts)") -> str:
    """Requests asked for one after the other, beginning after the answers that are known."""
    return (
        f"WITH RECURSIVE {SNAPSHOTS}, {answers}, timed AS (SELECT prefix, key, fetched_at AS ts, "
        "CASE prefix WHEN 'ddg_search' THEN 1 WHEN 'geocode' THEN 30 ELSE 7 END AS days FROM snapshots), "
        "asked AS (SELECT t.prefix, t.key, min(t.ts) AS ts FROM timed t LEFT JOIN answers a ON a.prefix = t.prefix AND a.key = t.key "
        "WHERE a.ts IS NULL OR t.ts >= a.ts + to_days(t.days) GROUP BY t.prefix, t.key UNION ALL "
        "SELECT t.prefix, t.key, min(t.ts) FROM asked a JOIN timed t ON a.prefix = t.prefix AND a.key = t.key "
        "AND t.ts >= a.ts + to_days(t.days) GROUP BY t.prefix, t.key, a.ts) "
        "SELECT prefix, key, epoch_us(ts) AS asked_us FROM asked"
    )


def _value(ctes: str, key: str, expression: str, name: str, source: str) -> str:
    return f"WITH {ctes} SELECT {key}, {expression} AS {name} FROM {source}"


def statements() -> dict[str, str]:
    company_columns = ", ".join(inputs.COMPANIES)
    progress_final = PROGRESS.format(n="processed")
    return {
        "read_companies": f"WITH {COMPANIES} SELECT * FROM companies",
        "write_roundtrip": f"WITH {ENRICHED} SELECT * FROM enriched",
        "append_batches": f"WITH {COMPANIES} SELECT * FROM companies UNION ALL SELECT * FROM companies",
        "ingest_companies": (
            f"WITH {COMPANIES} SELECT CompanyName AS Company_Name, {padded('CompanyNumber')} AS CompanyNumber, "
            "CompanyStatus AS Company_Status, SICCode_SicText_1, SICCode_SicText_2 AS SIC_second FROM companies"
        ),
        "clean_columns": (
            "SELECT o_orderkey AS order_key, o_custkey AS customer_key_fk, o_orderstatus AS Order_Status, "
            "o_totalprice AS total_, o_orderpriority AS Priority FROM orders"
        ),
        "read_profiles": f"WITH {PROFILES} SELECT company_number, company_status, postal_code, region FROM profiles",
        "read_filings": (
            f"WITH {FILINGS} SELECT company_number, cast(0 AS bigint) AS seq, category, made_up_date, link FROM filings "
            "UNION ALL SELECT company_number, 1, 'officers', NULL, NULL FROM filings"
        ),
        "read_search_results": (
            f"WITH {HITS} SELECT company_name || '/' || cast(rank AS varchar) AS company_name, "
            "cast(unnest([0, 1]) AS integer) AS rank, href FROM hits"
        ),
        "normalise_company_number": _value(COMPANIES, "CompanyName", padded("CompanyNumber"), "company_number", "companies"),
        "format_address": _value(PROFILES, "company_number", address(), "address", "profiles"),
        "search_query_text": _value(COMPANIES, "CompanyNumber", "'\"' || CompanyName || '\" official website'", "query", "companies"),
        "company_name_tokens": _value(COMPANIES, "CompanyNumber", f"array_to_string({tokens('CompanyName')}, '|')", "tokens", "companies"),
        "clean_site_text": f"SELECT doc_id, {strip(single_spaces('text'))} AS cleaned FROM documents",
        "clean_meta_text": _value(PAGES, "page_id", clean_meta("html"), "cleaned", "site"),
        "url_domain": f"SELECT page_id, url, {domain('url')} AS domain FROM pages",
        "valid_business_domain": f"WITH {HITS} SELECT company_name, rank, href, {valid_domain('href', 'company_name')} AS valid FROM hits",
        "search_blacklist_filter": f"WITH {HITS} SELECT company_name, rank, href FROM hits WHERE {candidate('href')}",
        "normalise_url": (
            "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://' || regexp_replace(url, '^https?://', '') ELSE url END AS url FROM pages"
        ),
        "filing_year_filter": (
            f"WITH {FILINGS} SELECT company_number, seq, left(made_up_date, 4) AS year FROM filings "
            f"WHERE length(made_up_date) >= 4 AND left(made_up_date, 4) IN ({_YEAR_LIST})"
        ),
        "filing_document_id": f"WITH {FILINGS} SELECT company_number, seq, regexp_extract(link, '([^/]*)$', 1) AS document_id FROM filings WHERE link <> ''",
        "document_format": f"WITH {DOCS} SELECT document_id, coalesce(tagged LIKE '%<html xmlns%' OR lower(tagged) LIKE '%xbrl%', false) AS is_tagged FROM docs",
        "lossy_decode": "SELECT doc_id, text AS decoded FROM documents",
        "company_profile_join": (
            f"WITH {COMPANIES}, {PROFILES} SELECT CompanyNumber, {padded('CompanyNumber')} AS company_number, company_status, "
            f"CASE WHEN company_status IS NOT NULL THEN {address()} ELSE '' END AS address "
            f"FROM companies LEFT JOIN profiles p ON p.company_number = {padded('CompanyNumber')}"
        ),
        "company_filings_join": (
            f"WITH {COMPANIES}, {FILINGS} SELECT CompanyNumber, {padded('CompanyNumber')} AS company_number, seq, category, made_up_date "
            f"FROM companies LEFT JOIN filings f ON f.company_number = {padded('CompanyNumber')}"
        ),
        "filing_documents_join": (
            f"WITH {FILINGS}, {DOCS}, named AS (SELECT *, regexp_extract(link, '([^/]*)$', 1) AS document_id FROM filings WHERE link <> '') "
            "SELECT company_number, seq, document_id, length(coalesce(tagged, text)) AS size FROM named JOIN docs USING (document_id) "
            "WHERE length(coalesce(tagged, text, '')) > 0"
        ),
        "laid_out_joins": (
            f"WITH {COMPANIES}, {PROFILES}, {FILINGS}, {DOCS}, "
            "named AS (SELECT *, regexp_extract(link, '([^/]*)$', 1) AS document_id FROM filings WHERE link <> '') "
            f"SELECT CompanyNumber, company_status, seq, document_id, length(coalesce(tagged, text)) AS size FROM companies "
            f"LEFT JOIN profiles p ON p.company_number = {padded('CompanyNumber')} "
            f"JOIN named n ON n.company_number = {padded('CompanyNumber')} JOIN docs USING (document_id) "
            "WHERE length(coalesce(tagged, text, '')) > 0"
        ),
        "official_site": (
            f"WITH {COMPANIES}, {PICKED} SELECT CompanyNumber, CompanyName, company_url "
            "FROM companies LEFT JOIN picked ON company_name = CompanyName"
        ),
        "site_description_join": f"WITH {DESCRIBED_SITES} SELECT * FROM sites",
        "geocode_lookup": (
            f"WITH {PROFILES}, {GAZETTEERS}, asked AS (SELECT company_number, "
            f"CASE WHEN company_status = 'active' THEN {address()} ELSE postal_code END AS address FROM profiles) "
            "SELECT company_number, a.address, CASE WHEN length(trim(a.address)) >= 10 THEN coalesce(f.p, s.p) END AS position "
            "FROM asked a LEFT JOIN first_g f ON f.address = a.address LEFT JOIN second_g s ON s.address = a.address"
        ),
        "resume_pending": (
            f"WITH {COMPANIES} SELECT CompanyName, CASE WHEN CompanyNumber NOT LIKE 'NI%' THEN CompanyNumber END AS CompanyNumber "
            "FROM companies WHERE CompanyStatus <> 'Active'"
        ),
        "profile_table": (
            f"WITH {COMPANIES} "
            + " UNION ALL ".join(
                f"SELECT {n} AS position, '{c}' AS column_name, 'string' AS column_type, count({c}) AS non_null, "
                f"count(*) AS rows, {len(inputs.COMPANIES)} AS columns FROM companies"
                for n, c in enumerate(inputs.COMPANIES, 1)
            )
        ),
        "headcount_by_year": f"WITH {HEADCOUNTS} SELECT * FROM heads_of",
        "run_progress_final": (
            f"WITH {RUN_LOG}, sums AS (SELECT run, count(*) AS total, count(*) AS processed, count(*) FILTER (WHERE ok) AS successful, "
            "count(*) FILTER (WHERE NOT ok) AS failed, epoch_us(min(ts)) AS began, epoch_us(max(ts)) AS now FROM log GROUP BY run) "
            f"SELECT run, total, processed, successful, failed, {progress_final} FROM sums"
        ),
        "snapshot_stats": (
            f"WITH {SNAPSHOTS} SELECT prefix, count(*) AS entries, cast(coalesce(sum(strlen(payload)), 0) AS bigint) AS volume "
            "FROM snapshots GROUP BY prefix"
        ),
        "chunk_rows": (
            "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, "
            f"(row_number() OVER (ORDER BY {_ITEM_ORDER}) - 1) // 1000 AS chunk_id FROM lineitem"
        ),
        "checkpoint_prefix": (
            f"WITH {COMPANIES}, cut_up AS (SELECT CompanyNumber, CompanyName, "
            f"(row_number() OVER (ORDER BY CompanyNumber) - 1) // {CHUNK} AS chunk_id FROM companies) "
            "SELECT * FROM cut_up WHERE chunk_id <= 1"
        ),
        "run_progress_running": (
            f"WITH {RUN_LOG}, counted AS (SELECT run, row_number() OVER w AS processed, "
            "cast(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER w AS bigint) AS successful, epoch_us(ts) AS now, "
            "count(*) OVER (PARTITION BY run) AS total, epoch_us(min(ts) OVER (PARTITION BY run)) AS began FROM log "
            "WINDOW w AS (PARTITION BY run ORDER BY ts, id ROWS UNBOUNDED PRECEDING)) "
            f"SELECT run, total, processed, successful, processed - successful AS failed, {progress_final} "
            f"FROM counted WHERE processed % {REPORT_EVERY} = 0"
        ),
        "token_bucket_shape": f"WITH {BUCKET} SELECT * FROM shaped",
        "token_bucket_weighted": (
            f"WITH {CALLS}, used AS (SELECT caller, id, epoch_us(ts) AS us, id % 4 AS asked, "
            "cast(sum(id % 4) OVER (PARTITION BY caller ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS bigint) AS used FROM calls), "
            f"owing AS (SELECT *, used * {INTERVAL} + max(us - (used - asked) * {INTERVAL}) OVER "
            "(PARTITION BY caller ORDER BY us, id ROWS UNBOUNDED PRECEDING) AS owed FROM used) "
            f"SELECT caller, id, us AS time_us, greatest(us, owed - {BURST * INTERVAL}) AS start_us, "
            f"greatest(us, owed - {BURST * INTERVAL}) - us AS wait_us FROM owing"
        ),
        "token_bucket_available": (
            f"WITH {BUCKET}, last_owed AS (SELECT caller, max(owed) AS owed FROM owing WHERE us <= epoch_us(TIMESTAMP '{AS_OF}') GROUP BY caller) "
            f"SELECT c.caller, cast(CASE WHEN owed IS NULL THEN {BURST} ELSE least({BURST}, greatest(0, floor((epoch_us(TIMESTAMP '{AS_OF}') - owed + {BURST * INTERVAL}) / {INTERVAL}.0))) END AS integer) AS tokens "
            "FROM (SELECT DISTINCT caller FROM calls) c LEFT JOIN last_owed l ON l.caller = c.caller"
        ),
        "token_bucket_reset": f"SELECT DISTINCT user_id AS caller, {BURST} AS tokens FROM events",
        "adaptive_rate": ADAPTIVE_RESULT,
        "sample_head": f"WITH {COMPANIES} SELECT {company_columns} FROM companies ORDER BY CompanyNumber LIMIT 3",
        "latest_filings": (
            f"WITH {FILINGS}, listed AS (SELECT *, row_number() OVER (PARTITION BY company_number ORDER BY seq) AS place "
            "FROM filings WHERE category = 'accounts') SELECT company_number, seq, made_up_date FROM listed WHERE place <= 10"
        ),
        "slice_rows": f"WITH {COMPANIES} SELECT CompanyNumber, CompanyName FROM companies ORDER BY CompanyNumber LIMIT 100 OFFSET 40",
        "page_title": _value(f"{PAGES}, {HEADS}", "page_id", title(), "title", "heads"),
        "meta_description": _value(f"{PAGES}, {HEADS}", "page_id", f"coalesce({clean_meta(described())}, '')", "description", "metas"),
        "meta_keywords": _value(f"{PAGES}, {HEADS}", "page_id", f"coalesce({keywords()}, '')", "keywords", "metas"),
        "open_graph": f"WITH {PAGES}, {HEADS} SELECT page_id, {OG} FROM metas",
        "jsonld_organization": f"WITH {PAGES}, {HEADS}, {ORGANISATIONS} SELECT * FROM orgs",
        "page_text": _value(PAGES, "page_id", unescape(f"regexp_replace(html, {text(UNSEEN)}, '', 'g')"), "page_text", "site"),
        "first_paragraph": f"WITH {PAGES}, {BLOCKS} {HEADINGS} SELECT page_id, paragraph FROM headed",
        "headings_description": f"WITH {PAGES}, {BLOCKS} {HEADINGS} SELECT page_id, headings FROM headed",
        "site_description": f"WITH {PAGES}, {SITES} SELECT page_id, description FROM about",
        "contact_email": f"SELECT doc_id, {email('text')} AS email FROM documents",
        "contact_phone": f"WITH {PAGES}, seen AS (SELECT page_id, {unescape(f'regexp_replace(html, {text(UNSEEN)}, {text("")}, {text("g")})')} AS words FROM site) SELECT page_id, {phone('words')} AS phone FROM seen",
        "document_phone": f"SELECT doc_id, {phone('text')} AS phone FROM documents",
        "page_metadata": (
            f"WITH {PAGES}, {HEADS}, {ORGANISATIONS}, seen AS (SELECT page_id, "
            f"{unescape(f'regexp_replace(html, {text(UNSEEN)}, {text("")}, {text("g")})')} AS words FROM site), "
            f"graph AS (SELECT page_id, {title()} AS title, coalesce({clean_meta(described())}, '') AS description, "
            f"coalesce({keywords()}, '') AS keywords, {OG} FROM metas) "
            "SELECT g.page_id, title, g.description, keywords, "
            "array_to_string(list_sort(list_filter(["
            + ", ".join(
                f"CASE WHEN {source}{field} <> '' THEN '{field}' END"
                for source, field in [("o.", f) for f in (*M.ORGANISATION_FIELDS, "address")]
                + [("g.", f) for f in M.OPEN_GRAPH]
            )
            + "], lambda x: x IS NOT NULL)), '|') AS company_fields, "
            "nullif(o.name, '') AS company_name, nullif(o.address, '') AS company_address, og_title, "
            f"{email('words')} AS email, {phone('words')} AS phone "
            "FROM graph g JOIN seen s ON s.page_id = g.page_id LEFT JOIN orgs o ON o.page_id = g.page_id"
        ),
        "ixbrl_tag_headcount": _value(TAGGED, "document_id", tag_count("doc"), "headcount", "tagged"),
        "ixbrl_regex_headcount": _value(TAGGED, "document_id", markup_count("doc"), "headcount", "tagged"),
        "ixbrl_namespace_headcount": (
            f"WITH {TAGGED}, {NAMESPACED} SELECT t.document_id, ns.n AS headcount FROM tagged t LEFT JOIN ns ON ns.document_id = t.document_id"
        ),
        "ixbrl_headcount": (
            f"WITH {TAGGED}, {NAMESPACED} SELECT t.document_id, coalesce({tag_count('doc')}, {markup_count('doc')}, ns.n) AS headcount "
            "FROM tagged t LEFT JOIN ns ON ns.document_id = t.document_id"
        ),
        "ixbrl_numeric_value": f"SELECT doc_id, {number('text')} AS number FROM documents",
        "text_headcount": f"WITH {TAGGED}, {TEXTS} SELECT t.document_id, said.n AS headcount FROM tagged t LEFT JOIN said ON said.document_id = t.document_id",
        "headcount_context_check": (
            f"WITH {DOCS}, found AS (SELECT document_id, lower({single_spaces('text')}) AS body, "
            "regexp_extract(text, '(\\d+)\\D*$', 1) AS m FROM docs WHERE text IS NOT NULL) "
            f"SELECT document_id, m AS digits, {plausible()} AS plausible FROM found WHERE m <> ''"
        ),
        "document_headcount": f"WITH {COUNTS} SELECT document_id, coalesce(tagged_n, said_n) AS headcount FROM counts",
        "packed_documents": f"WITH {COUNTS} SELECT document_id, coalesce(tagged_n, said_n) AS headcount FROM counts",
        "fresh_lookup": f"WITH {FRESH} SELECT * FROM fresh",
        "lookup_misses": f"WITH {FRESH} SELECT DISTINCT prefix, key FROM snapshots EXCEPT SELECT prefix, key FROM fresh",
        "enrich_companies": f"WITH {ENRICHED} SELECT * FROM enriched",
        "enrich_resume": f"WITH {ENRICHED} SELECT * FROM enriched",
        "enrich_run_log": (
            f"WITH {ENRICHED}, log AS (SELECT CompanyNumber AS id, {FOUND} AS ok FROM enriched) "
            "SELECT 'first' AS run, id, ok, count(*) OVER () AS processed, "
            "(count(*) FILTER (WHERE NOT ok) OVER ()) AS failed FROM log"
        ),
        "stream_kept_lookups": f"WITH {ENRICHED} SELECT * FROM enriched",
        "enrich_committed_runs": (
            f"WITH {ENRICHED} SELECT CASE WHEN CompanyStatus = 'Active' THEN 'first' ELSE 'second' END AS run, "
            f"CompanyNumber AS id, {FOUND} AS ok, count(*) OVER () AS enriched FROM enriched"
        ),
        "stream_run_log": f"WITH {ENRICHED} SELECT 'stream' AS run, CompanyNumber AS id, {FOUND} AS ok FROM enriched",
        "enrich_with_location": (
            f"WITH {COMPANIES}, {PROFILES}, {GAZETTEERS}, asked AS (SELECT company_number, {address()} AS address FROM profiles) "
            "SELECT CompanyNumber, CompanyName, coalesce(CASE WHEN length(trim(a.address)) >= 10 THEN coalesce(f.p, s.p) END, a.address, '') AS manufacturing_location "
            f"FROM companies LEFT JOIN asked a ON a.company_number = {padded('CompanyNumber')} "
            "LEFT JOIN first_g f ON f.address = a.address LEFT JOIN second_g s ON s.address = a.address"
        ),
        "map_rows_safe": (
            "SELECT event_id, CASE WHEN event_type <> 'error' AND user_id % 10 <> 0 THEN event_id // (user_id % 10) END AS result, "
            "CASE WHEN event_type = 'error' THEN 'ValueError: event ' || event_id || ' failed' "
            "WHEN user_id % 10 = 0 THEN 'ZeroDivisionError' END AS error FROM events"
        ),
        "stream_enrich": f"WITH {ENRICHED} SELECT * FROM enriched",
        "first_requests": _asked(),
        "stream_lookup_misses": _asked(),
        "stream_lookup_answered": _asked(f"answers AS (SELECT prefix, key, max(fetched_at) AS ts FROM (SELECT {_fields(inputs.ANSWERS)} FROM events) GROUP BY prefix, key)"),
        "stream_token_bucket": f"WITH {BUCKET} SELECT * FROM shaped",
        "stream_adaptive_rate": ADAPTIVE_RESULT,
        "stream_progress": (
            f"WITH {RUN_LOG} SELECT run, count(*) AS processed, count(*) FILTER (WHERE ok) AS successful, "
            "count(*) FILTER (WHERE NOT ok) AS failed FROM log GROUP BY run"
        ),
    }
