"""Entity names: display form, match key, seed key and blocking keys, as Column expressions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-form words removed wherever a comma or white space precedes them.
LEGAL_WORDS = [
    r"inc\.?", "incorporated", r"llc\.?", r"l\.l\.c\.?", r"corp\.?", "corporation", r"ltd\.?", "limited", "gmbh", "sas", r"s\.a\.s\.?", "se", "pbc", r"pty\.?\s+ltd\.?", r"co\.?", "company",
    "technologies", "technology", "holdings", "group", "systems", "software",
]
# One of these endings is removed from a name that looks like a domain.
DOMAIN_ENDINGS = ["com", "io", "ai", "co", "org", "net", "so", "app", "sh", "art", "dev", "tech", "me", r"co\.uk", "de", "eu"]
# Whole words removed from seed keys.
SEED_WORDS = ["inc", "incorporated", "llc", "pbc", "ltd", "limited", "corp", "corporation", "gmbh", "sas", "se", "co", "company"]
#: All named character references, as "\x01name\x02text" one after the other: a lookup is one search in a text.
NAMED_REFERENCES = "".join(f"\x01{name[:-1]}\x02{text}" for name, text in sorted(html5.items()) if name.endswith(";")) + "\x01"
#: The names that count without their semicolon too, the longest first.
BARE_REFERENCES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
#: What the numbers 128 to 159 stand for: characters of Windows-1252 where it has them.
WINDOWS = [bytes([n]).decode("cp1252") if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(n) for n in range(128, 160)]

LEGAL_PATTERN = rf"(?i)(?:,\s*|\s+)\b({'|'.join(LEGAL_WORDS)})\b\.?"
DOMAIN_PATTERN = rf"(?i)\.({'|'.join(DOMAIN_ENDINGS)})$"
EDGE_PATTERN = r"^[,\-_.|\s]+|[,\-_.|\s]+$"
SEED_PATTERN = rf"\b({'|'.join(SEED_WORDS)})\b"


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, however often use refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def _numbered(part: Column) -> Column:
    """The character of a reference by number at the start of part; null if there is none. Numbers that are no character give U+FFFD, those of controls nothing."""
    beyond = F.lit(0x110000).cast("long")

    def value(digits: Column, most: int, parsed: Column) -> Column:
        return F.when(F.length(digits) > most, beyond).when(digits == "", F.lit(0).cast("long")).otherwise(parsed)

    decimal, sixteen = F.regexp_extract(part, "^#0*([0-9]*)", 1), F.regexp_extract(part, "^#[xX]0*([0-9a-fA-F]*)", 1)
    number = F.when(part.rlike("^#[0-9]"), value(decimal, 9, decimal.try_cast("long"))).when(part.rlike("^#[xX][0-9a-fA-F]"), value(sixteen, 8, F.conv(sixteen, 16, 10).try_cast("long")))

    def character(n: Column) -> Column:
        unknown = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        unseen = n.between(1, 8) | n.between(14, 31) | (n == 11) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n % 0x10000 >= 0xFFFE)
        old = F.get(F.array(*[F.lit(c) for c in WINDOWS]), (n - 128).cast("int"))
        return F.when(n.isNull(), F.lit(None)).when(unknown, F.lit("\ufffd")).when(n.between(128, 159), old).when(unseen, F.lit("")).otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    return let(number, character)


def unescape(col: Column) -> Column:
    """Character references decoded, each once, as HTML does: by number, by name, and by the old names without a semicolon. Unknown ones stay."""

    def decoded(part: Column) -> Column:
        number = F.regexp_extract(part, "^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?)", 1)
        body = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1)
        bare = F.regexp_extract(part, rf"^({'|'.join(BARE_REFERENCES)})", 1)

        def named(name: Column) -> Column:
            at = F.concat(F.lit("\x01"), name, F.lit("\x02"))
            return F.when(name != "", F.nullif(F.split_part(F.split_part(F.lit(NAMED_REFERENCES), at, F.lit(2)), F.lit("\x01"), F.lit(1)), F.lit("")))

        return F.coalesce(
            F.concat(_numbered(part), F.substr(part, F.length(number) + 1)),
            F.concat(named(body), F.substr(part, F.length(body) + 2)),
            F.concat(named(bare), F.substr(part, F.length(bare) + 1)),
            F.concat(F.lit("&"), part),
        )

    def whole(parts: Column) -> Column:
        return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), decoded), ""))

    return F.when(F.contains(col, F.lit("&")), let(F.split(col, "&"), whole)).otherwise(col)


def display_name(raw: Column) -> Column:
    """The name without URL parts, one domain ending, legal-form words and stray punctuation; blank or null gives ''.

    If nothing would be left, the trimmed input is kept.
    """
    text = strip(unescape(raw))
    text = F.regexp_replace(text, r"(?i)^https?://", "")
    text = F.regexp_replace(text, r"(?i)^www\.", "")
    text = strip(F.substring_index(text, "/", 1))

    def undomained(t: Column) -> Column:
        bare = F.contains(t, F.lit(".")) & ~t.rlike(r"(?U)\s")
        return F.when(bare, F.regexp_replace(t, DOMAIN_PATTERN, "")).otherwise(t)

    text = strip(F.regexp_replace(let(text, undomained), LEGAL_PATTERN, ""))
    text = strip(F.regexp_replace(text, EDGE_PATTERN, ""))
    text = strip(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.coalesce(F.nullif(text, F.lit("")), strip(raw), F.lit(""))


def match_key(name: Column) -> Column:
    """The display form's ASCII letters and digits, lower case."""
    return F.lower(F.regexp_replace(display_name(name), "[^a-zA-Z0-9]", ""))


def seed_key(name: Column) -> Column:
    """The key under which a name is looked up in the seed list; '' for null."""
    text = F.lower(strip(F.coalesce(name, F.lit(""))))
    text = F.regexp_replace(F.regexp_replace(text, "^https?://", ""), r"^www\.", "")
    text = F.substring_index(text, "/", 1)
    return F.regexp_replace(F.regexp_replace(text, SEED_PATTERN, ""), "[^a-z0-9]", "")


def blocking_keys(key: Column, clean: Column) -> Column:
    """Distinct key:, tok: and pref: keys of an entity; an entity without ASCII letters or digits has none."""
    whole = F.when(key != "", F.array(F.concat(F.lit("key:"), key))).otherwise(F.array().cast("array<string>"))
    words = F.transform(F.regexp_extract_all(F.lower(clean), F.lit("([a-z0-9]{3,})"), 1), lambda w: F.concat(F.lit("tok:"), w))
    start = F.when(F.length(key) >= 3, F.array(F.concat(F.lit("pref:"), F.substring(key, 1, 3)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(whole, words, start))
