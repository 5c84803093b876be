"""Text, URL and key functions as column expressions."""

from __future__ import annotations

import functools
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, the four separators of ASCII too.
BLANK = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SPACE = BLANK + "+"

# Patterns that define what counts as an address or a number.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"
# Letters of context on either side of a snippet, and its greatest length.
SNIPPET_CONTEXT, SNIPPET_LENGTH = 40, 180
# Link parts that lead to an intake page.
INTAKE_TOKENS = ("intake", "referral", "appointment", "new-patient", "newpatient", "contact")


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def normalize_text(c: Column) -> Column:
    """White space runs as one blank, none at the ends; null as the empty text."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))


def stripped(c: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(c, f"^{SPACE}|{SPACE}$", "")


# Names of entities without a semicolon are at most this long; and what a numeric reference that names no character gives.
SHORT_NAME, NO_CHARACTER = 6, "\ufffd"
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@functools.cache
def _entity_names() -> tuple[dict[str, dict[str, str]], dict[str, str]]:
    """All names by their first two letters, and those that need no semicolon."""
    by_head: dict[str, dict[str, str]] = {}
    for name, letters in html5.items():
        by_head.setdefault(name[:2], {})[name] = letters
    return by_head, {n: v for n, v in html5.items() if not n.endswith(";")}


def _literal(values: object, kind: str) -> Column:
    """A table as one literal; made of a column for each entry it would take seconds to plan."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _number_letters(number: Column) -> Column:
    """The letter of a numeric reference: 128 to 159 as in Windows-1252, none for control and non-characters."""
    windows = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    letter = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    low = number % 65536
    nothing = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127) | number.between(0xFDD0, 0xFDEF) | (low >= 65534)
    return (
        F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), NO_CHARACTER)
        .when(number.between(0x80, 0x9F), F.element_at(_literal(list(windows.values()), "array<string>"), F.least(F.greatest(number - 127, F.lit(1)), F.lit(32)).cast("int")))
        .when(nothing, "").otherwise(letter)
    )


def unescape(c: Column) -> Column:
    """HTML entities as their letters: names by the longest that is known, decimal and hexadecimal numbers; what is no entity stays."""
    by_head, short = _entity_names()
    heads, shorts = _literal(by_head, "map<string,map<string,string>>"), _literal(short, "map<string,string>")

    def letters(hit: Column) -> Column:
        body = F.substr(hit, F.lit(2))
        digits = F.regexp_replace(body, "^#[xX]?0*(?=[^;])|;$", "")
        # eight digits hold every character's number, hexadecimal or decimal
        number = F.when(F.length(digits) > 8, F.lit(0x110000)).when(body.rlike("^#[xX]"), F.conv(digits, 16, 10).cast("long")).otherwise(digits.try_cast("long"))
        whole = F.try_element_at(F.try_element_at(heads, F.substring(body, 1, 2)), body)
        # the longest name without a semicolon that the text begins with
        known = [F.when(F.length(body) > n, F.concat(F.try_element_at(shorts, F.substring(body, 1, n)), F.substr(body, F.lit(n + 1)))) for n in range(SHORT_NAME, 1, -1)]
        return F.when(body.startswith("#"), let(number, _number_letters)).otherwise(F.coalesce(whole, *known, hit))

    def replaced(v: Column) -> Column:
        hits, rest = F.regexp_extract_all(v, F.lit(_REFERENCE), F.lit(0)), F.split(v, _REFERENCE)
        tail = F.zip_with(hits, F.slice(rest, F.lit(2), F.size(hits)), lambda h, r: F.concat(letters(h), r))
        return F.concat(rest[0], F.array_join(tail, ""))

    return let(c, lambda v: F.when(v.contains("&"), replaced(v)).otherwise(v))


def make_pk(prefix: str, *parts: Column) -> Column:
    """Stable key: prefix and 16 hex digits of the SHA-1 over the normalised lower-case parts."""
    base = F.concat_ws("|", *(F.lower(normalize_text(p.cast("string"))) for p in parts))
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(base), 1, 16))


def content_hash(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def _authority(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def normalize_domain(c: Column) -> Column:
    """Lower-case authority without ``www.``; a port stays; https is assumed where there is no scheme."""
    # one pattern, so that the text is looked at once: a scheme at the start or none anywhere
    return F.regexp_extract(F.lower(normalize_text(c)), r"^(?:[a-z][a-z0-9+.-]*://|(?!.*://))(?:www\.)?([^/?#]*)", 1)


def same_domain(a: Column, b: Column) -> Column:
    return normalize_domain(a) == normalize_domain(b)


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")), c)


def _encoded(c: Column) -> Column:
    # the JVM's encoder leaves * as it is and escapes ~, the common form has it the other way round
    return F.regexp_replace(F.regexp_replace(F.url_encode(c), r"\*", "%2A"), "%7E", "~")


def normalize_url(c: Column) -> Column:
    """Scheme and host in lower case, no ``www.``, no fragment, no trailing slash, non-blank query pairs in order.

    Names and values of the query are decoded and encoded again, so one address has one form; escapes
    that are broken stay. Escapes in the path stay.
    """
    def address(full: Column) -> Column:
        scheme = F.lower(F.regexp_extract(full, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
        host = F.regexp_replace(F.lower(_authority(full)), r"^www\.", "")
        path = F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#;]*)", 1)
        path = let(path, lambda p: F.when(p == "", F.lit("/")).when(p == "/", p).otherwise(F.regexp_replace(p, r"/$", "")))
        pairs = F.filter(F.split(F.regexp_extract(full, r"\?([^#]*)", 1), "&"), lambda p: p.rlike(r"^[^=]*=.+$"))
        decoded = F.transform(pairs, lambda p: F.struct(_decoded(F.regexp_extract(p, r"^([^=]*)=", 1)).alias("k"), _decoded(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).alias("v")))
        query = F.array_join(F.transform(F.array_sort(decoded), lambda x: F.concat(_encoded(x["k"]), F.lit("="), _encoded(x["v"]))), "&")
        return F.concat(scheme, F.lit("://"), host, path, let(query, lambda q: F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q))))

    def whole(v: Column) -> Column:
        return let(F.when(v.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), v).otherwise(F.concat(F.lit("https://"), v)), address)

    return let(normalize_text(c), whole)


def strip_html(c: Column, drop_scripts: bool = False) -> Column:
    """Tags become blanks, blanks collapse. Bodies of script and style elements stay unless ``drop_scripts``."""
    v = F.coalesce(c, F.lit(""))
    if drop_scripts:
        for name in ("script", "style", "noscript"):
            v = F.regexp_replace(v, rf"(?is)<{name}\b[^>]*>.*?</{name}>", " ")
    return normalize_text(F.regexp_replace(v, r"<[^>]+>", " "))


def extract_title(html: Column) -> Column:
    """Text of the first title element, or of the first h1 where that is blank."""
    def first(tag: str) -> Column:
        return strip_html(F.regexp_extract(F.coalesce(html, F.lit("")), rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1))

    return F.coalesce(F.nullif(first("title"), F.lit("")), first("h1"))


def extract_links(html: Column) -> Column:
    """Distinct link targets up to their fragment, in order of first appearance."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?i)href=["']([^"'#]+)"""), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != ""))


def first_link_with(links: Column, tokens: tuple[str, ...] = INTAKE_TOKENS) -> Column:
    """First link, in order, that contains one of the tokens; the empty text if none does."""
    def has(x: Column) -> Column:
        return F.lower(x).rlike("|".join(t.replace(".", r"\.") for t in tokens))

    return F.coalesce(F.try_element_at(F.filter(links, has), F.lit(1)), F.lit(""))


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments; what leads above the root stays at the root."""
    def joined(segments: Column) -> Column:
        kept = F.aggregate(
            F.slice(segments, 2, 10_000), F.array().cast("array<string>"),
            lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(x))),
        )
        last = F.element_at(segments, -1).isin(".", "..")
        return let(kept, lambda k: F.concat(F.lit("/"), F.array_join(k, "/"), F.when(last & (F.size(k) > 0), F.lit("/")).otherwise(F.lit(""))))

    return let(F.split(path, "/"), joined)


def resolve_link(base: Column, link: Column) -> Column:
    """Absolute normalised form of a link found on a page: whole, by scheme, by root, by query, or relative to the page's folder."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path, tail = F.regexp_extract(link, r"^([^?#]*)", 1), F.regexp_extract(link, r"^[^?#]*(.*)$", 1)

    def under(path: Column) -> Column:
        folder = let(F.regexp_extract(page, r"^(.*/)", 1), lambda f: F.when(f == "", F.lit("/")).otherwise(f))
        return F.when(path.startswith("/"), path).when(path == "", page).otherwise(F.concat(folder, path))

    whole_path = let(let(path, under), lambda j: F.when(j == "", F.lit("")).otherwise(_without_dots(j)))
    absolute = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), link))
        .otherwise(F.concat(root, whole_path, tail))
    )
    return normalize_url(absolute)


def extract_domain(c: Column) -> Column:
    """Domain of an address, whatever it lacks; the empty text for none."""
    return normalize_domain(F.regexp_replace(normalize_text(c), r"^//", ""))


def emails(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({EMAIL})"), F.lit(1))


def first_phone(c: Column) -> Column:
    return normalize_text(F.regexp_extract(F.coalesce(c, F.lit("")), PHONE, 0))


def is_valid_email(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit("")))).rlike(f"^{EMAIL}$")


def is_valid_phone(c: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^0-9]", "")).between(10, 15)


def snippet(c: Column, pattern: str) -> Column:
    """The first match with its context, trimmed, line ends as blanks, cut to the greatest length; empty without a match."""
    return F.when(c.isNull() | (F.regexp_extract(c, pattern, 0) == ""), F.lit("")).otherwise(snippet_at(c, F.regexp_instr(c, F.lit(pattern)), F.length(F.regexp_extract(c, pattern, 0))))


def snippet_at(c: Column, start: Column, length: Column) -> Column:
    """The text around ``length`` letters from ``start`` (1 is the first), trimmed and cut like a snippet."""
    first = F.greatest(start - SNIPPET_CONTEXT, F.lit(1))
    end = start + length + SNIPPET_CONTEXT
    return F.substring(F.regexp_replace(stripped(F.substring(c, first, end - first)), "\n", " "), 1, SNIPPET_LENGTH)


def slug(c: Column) -> Column:
    """Letters and digits, all else as hyphens, none at the ends; ``record`` where nothing is left."""
    v = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]", "-"), r"^-+|-+$", "")
    return F.when(v == "", F.lit("record")).otherwise(v)


def format_phone(c: Column) -> Column:
    """Ten digits as (ddd) ddd-dddd, eleven that begin with 1 as +1 (ddd) ddd-dddd; anything else as it is."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), r"[^0-9]", "")
    ten, eleven = r"^(\d{3})(\d{3})(\d{4})$", r"^1(\d{3})(\d{3})(\d{4})$"
    return F.when(digits.rlike(ten), F.regexp_replace(digits, ten, "($1) $2-$3")).when(digits.rlike(eleven), F.regexp_replace(digits, eleven, "+1 ($1) $2-$3")).otherwise(F.trim(F.coalesce(c, F.lit(""))))


def json_array(c: Column) -> Column:
    """A JSON array's trimmed non-blank items as text; a text that is no array is its only item, a blank one has none."""
    v = F.trim(F.coalesce(c, F.lit("")))
    found = F.from_json(v, "array<string>")
    items = F.when(v.startswith("[") & found.isNotNull(), found).otherwise(F.array(v))
    return F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: F.coalesce(x, F.lit("")) != "")


def unique_nonempty(values: Column) -> Column:
    """Trimmed values without blanks, first appearance kept."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""))
