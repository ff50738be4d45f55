"""Row-level rules on text: classification, labels, chunking, URLs and replies, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role families in the order in which they are tried, and each board's keywords (substrings).
FAMILIES = ["Engineering", "Data", "Product", "Design", "Sales", "Marketing"]
ROLE_KEYWORDS = {
    "remoteok": [
        ["engineer", "developer", "machine learning", "ml", "ai engineer", "deep learning", "software"],
        ["data scientist", "data analyst", "data science"],
        ["product manager", "product management", "pm"],
        ["designer", "ui", "ux", "design"],
        ["sales", "account executive", "bdr", "sdr"],
        ["marketing", "growth", "seo"],
    ],
    "jobicy": [
        ["engineer", "developer", "machine learning", "ml", "ai", "software", "devops", "cloud"],
        ["data scientist", "data analyst", "data science"],
        ["product", "product manager"],
        ["design", "ui", "ux"],
        ["sales", "account executive", "bdr", "sdr"],
        ["marketing", "growth", "content"],
    ],
    "arbeitnow": [
        ["engineer", "developer", "software", "machine learning", "ml", "ai", "backend", "frontend", "fullstack", "devops"],
        ["data scientist", "data analyst", "data"],
        ["product", "product manager"],
        ["designer", "ui", "ux", "design"],
        ["sales", "account executive", "account manager"],
        ["marketing", "social media", "growth", "content"],
    ],
    "remotive": [
        ["software", "development", "engineer", "developer", "ml", "ai"],
        ["data"],
        ["product"],
        ["design"],
        ["sales"],
        ["marketing"],
    ],
}
# Whole words of the hiring-thread variant.
ROLE_WORDS = [
    ["engineer", "engineering", "developer", "software", "architect", "infrastructure", "devops", "sre", "systems", "ml", "ai", "machine learning"],
    ["data scientist", "data analyst", "data science", "analytics"],
    ["product manager", "product management", "pm"],
    ["designer", "ui/ux", "ux/ui", "ux", "ui", "design"],
    ["sales", "account executive", "bdr", "sdr"],
    ["marketing", "growth", "content"],
]
# Pricing labels in the order in which substrings are tried.
PRICING = {
    "free": "FREE", "open source": "FREE", "open-source": "FREE", "freemium": "FREEMIUM", "free trial": "FREEMIUM", "free plan": "FREEMIUM", "paid": "PAID", "commercial": "PAID", "subscription": "PAID", "enterprise": "ENTERPRISE",
}
PRICING_MODELS = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]
# Keywords of a relevant news item (substrings).
RELEVANT = [
    "ai", "artificial intelligence", "machine learning", "llm", "openai", "anthropic", "deepmind", "generative ai", "neural", "robotics", "model", "chip", "nvidia", "hardware", "tech", "computing",
]
# Header segments that are no job titles.
NON_TITLES = [
    "remote", "onsite", "on-site", "hybrid", "full-time", "part-time", "contract", "intern", "internship", "full time", "part time", "fulltime", "parttime", "webrtc", "voiceai",
]
# Words that make a segment a job title.
TITLE_WORDS = [
    "engineer", "engineering", "developer", "dev", "software", "architect", "infrastructure", "lead", "leader", "manager", "management", "director", "head", "vp", "chief", "specialist", "trainer", "analyst", "scientist", "researcher",
    "administrator", "consultant", "designer", "counsel", "intern", "internship", "fellow", "executive", "coordinator", "recruiter", "writer", "marketer", "advocate", "sre", "qa", "technician", "operator", "officer", "associate", "strategist",
]
# Openings of a header that names no company.
GREETINGS = [r"hi\b", r"hello\b", r"we\s+are\b", r"i\s+am\b", r"i\s+run\b", r"seeking\b", r"looking\b", r"ask\s+hn\b", r"hiring\s*:\b"]

MIN_CONTENT, MAX_CONTENT = 30, 12_000


def any_of(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | F.contains(text, F.lit(word))
    return out


def whole_words(words: list[str]) -> str:
    return rf"\b({'|'.join(words)})\b"


def _first_family(tests: list[Column]) -> Column:
    out = F.when(tests[0], F.lit(FAMILIES[0]))
    for family, test in zip(FAMILIES[1:], tests[1:], strict=True):
        out = out.when(test, F.lit(family))
    return out


def role_family(text: Column, board: str) -> Column:
    """The first family of which a keyword occurs in the lower-cased text; null if none does."""
    low = F.lower(text)
    return _first_family([any_of(low, words) for words in ROLE_KEYWORDS[board]])


def hiring_role_family(title: Column, text: Column) -> Column:
    """The whole-word variant, on the title and the text's first 400 characters."""
    low = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.substring(text, 1, 400)))
    return _first_family([low.rlike(whole_words(words)) for words in ROLE_WORDS])


def is_remote(text: Column) -> Column:
    return text.rlike(r"(?i)\bremote\b")


def is_relevant(title: Column, categories: Column) -> Column:
    """Whether a keyword occurs anywhere in the title or the categories (an array)."""
    return any_of(F.lower(F.concat_ws(" ", title, F.array_join(categories, " "))), RELEVANT)


def pricing_model(label: Column) -> Column:
    """The label's model: exactly, else by the first entry it contains; null if it contains none."""
    low = F.lower(F.trim(label))
    out = F.try_element_at(F.create_map(*[F.lit(x) for pair in PRICING.items() for x in pair]), low)
    inside = None
    for key, model in PRICING.items():
        test = F.contains(low, F.lit(key))
        inside = F.when(test, F.lit(model)) if inside is None else inside.when(test, F.lit(model))
    return F.coalesce(out, inside)


def valid_pricing(model: Column) -> Column:
    return F.when(model.isin(PRICING_MODELS), model)


def team_size(text: Column) -> Column:
    """An integer, the upper end of a range, or the number before a plus sign; null otherwise."""
    t = F.trim(text)
    number = r"^\s*[+-]?\d+\s*$"

    def whole(x: Column) -> Column:
        return F.when(x.rlike(number), F.trim(x).try_cast("int"))

    top = F.element_at(F.split(t, "-"), -1)
    return F.coalesce(whole(t), F.when(F.contains(t, F.lit("-")), whole(top)), F.when(t.endswith("+"), whole(F.regexp_replace(t, r"\+$", ""))))


def is_url(segment: Column) -> Column:
    s = F.trim(segment)
    return s.rlike(r"(?i)https?://|www\.") | s.rlike(r"^[a-zA-Z0-9-]+\.[a-zA-Z]{2,}(/.*)?$")


def is_pay(segment: Column) -> Column:
    low = F.lower(segment)
    return low.rlike(r"\$?\d+k\b") | any_of(low, ["usd", "eur", "gbp"])


def is_title(candidate: Column) -> Column:
    """A segment that reads like a job title: a role word, or at least two capitalised alphabetic words."""
    c = F.trim(candidate)
    capital = F.size(F.filter(F.split(c, r"\s+"), lambda w: w.rlike(r"^\p{Lu}\p{L}*$"))) >= 2
    role = c.rlike("(?i)" + whole_words(TITLE_WORDS))
    return F.coalesce((c != "") & ~F.lower(c).isin(NON_TITLES) & ~is_pay(c) & (role | capital), F.lit(False))


def header_parts(header: Column) -> Column:
    """The segments between pipes that are not empty, URLs or bare domains; null where there are fewer than two segments."""
    raw = F.filter(F.transform(F.split(header, r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    clean = F.filter(F.transform(raw, lambda p: F.trim(F.regexp_replace(p, "<[^>]+>", ""))), lambda p: (p != "") & ~is_url(p))
    return F.when(F.contains(header, F.lit("|")) & (F.size(raw) >= 2), clean)


def header_company(header: Column) -> Column:
    """The first segment, unless it is a greeting or longer than 60 characters."""
    company = F.get(header_parts(header), F.lit(0))
    return F.when(~company.rlike(f"(?i)^({'|'.join(GREETINGS)})") & (F.length(company) <= 60), company)


def header_title(header: Column) -> Column:
    """The first later segment that reads like a title; null if none does."""
    parts = header_parts(header)
    later = F.when(F.size(parts) > 1, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))))
    return F.get(F.filter(later, is_title), F.lit(0))


def chunk_html(html: Column) -> Column:
    """Markup to spaces, white space collapsed, cut at the limit. Fewer than 30 characters are left as they are."""
    text = F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"\s+", " "))
    cut = F.when(F.length(text) <= MAX_CONTENT, text).otherwise(F.concat(F.substring(text, 1, MAX_CONTENT), F.lit(" [...]")))
    return F.when(F.length(html) < MIN_CONTENT, html).otherwise(cut)


def chunk_comment(html: Column) -> Column:
    """Markup to lines; a text beyond the limit keeps its first line and as much of the rest as the limit leaves, 500 characters at least."""
    text = F.regexp_replace(F.regexp_replace(html, "<[^>]+>", "\n"), r"\n{3,}", "\n\n")
    text = F.regexp_replace(text, r"^\s+|\s+$", "")
    head = F.substring_index(text, "\n", 1)
    body = F.when(F.contains(text, F.lit("\n")), F.substring(text, F.length(head) + 2, F.length(text))).otherwise(F.lit(""))
    room = F.greatest(F.lit(500), F.lit(MAX_CONTENT - 50) - F.length(head))
    cut = F.when(F.length(body) > room, F.concat(F.substring(body, F.lit(1), room), F.lit("\n[...truncated...]"))).otherwise(body)
    long = F.concat(head, F.lit("\n"), cut)
    return F.when(F.length(html) < MIN_CONTENT, html).when(F.length(text) <= MAX_CONTENT, text).otherwise(long)


def chunk_article(text: Column, title: Column | None = None) -> Column:
    """An article with its title before it; beyond the limit the first three paragraphs and the last, with a mark between."""
    whole = text if title is None else F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit("Title: "), title, F.lit("\n\n"), text)).otherwise(text)
    paragraphs = F.filter(F.transform(F.split(whole, "\n\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")
    hard = F.lit("\n[...truncated...]")
    few = F.concat(F.substring(whole, 1, MAX_CONTENT), hard)
    ends = F.concat(F.array_join(F.slice(paragraphs, 1, 3), "\n\n"), F.lit("\n\n[...content truncated for brevity...]\n\n"), F.element_at(paragraphs, -1))
    ends = F.when(F.length(ends) > MAX_CONTENT, F.concat(F.substring(ends, 1, MAX_CONTENT), hard)).otherwise(ends)
    return (
        F.when(F.length(text) < MIN_CONTENT, text)
        .when(F.length(whole) <= MAX_CONTENT, whole)
        .when(F.size(paragraphs) <= 4, few)
        .otherwise(ends)
    )


def paper_url(url: Column) -> Column:
    """An arXiv abstract URL without its version; other URLs unchanged."""
    return F.when(F.contains(url, F.lit("arxiv.org/abs/")), F.regexp_replace(url, r"v\d+$", "")).otherwise(url)


def repo_owner(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?i)github\.com/([^/]+)/([^/?#]+)", 1)
    return F.nullif(found, F.lit(""))


def repo_name(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?i)github\.com/([^/]+)/([^/?#]+)", 2)
    return F.nullif(F.regexp_replace(found, r"\.git$", ""), F.lit(""))


def product_slug(href: Column) -> Column:
    """The product named by a category page's link; null for other links and for the 'best' listing."""
    slug = F.regexp_extract(href, r"^/([a-z0-9][\w.-]*)-alternatives$", 1)
    return F.when((slug != "") & (slug != "best"), slug)


def title_product(title: Column) -> Column:
    """The product's name at the start of a product page's title."""
    return F.nullif(F.trim(F.regexp_extract(F.trim(title), r"(?i)^(.+?)\s+(?:reviews|alternatives)", 1)), F.lit(""))


def authors_json(authors: Column) -> Column:
    """A list of authors as JSON text; null and empty lists are null."""
    return F.when(F.size(authors) > 0, F.to_json(authors))


def authors_text(authors: Column) -> Column:
    """A JSON list as 'A; B'; text that is no list is trimmed; null is ''."""
    parsed = F.from_json(F.when(F.trim(authors).startswith("["), authors), "array<string>", {"mode": "PERMISSIVE"})
    names = F.filter(F.transform(parsed, lambda a: F.trim(a)), lambda a: a != "")
    return F.coalesce(F.array_join(names, "; "), F.trim(authors), F.lit(""))


def shorten(text: Column, most: int) -> Column:
    """The first characters with '...' behind where the text is longer."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def reply_json(raw: Column) -> Column:
    """The JSON object of a model's reply, as text: all of it, a fenced block, or the outermost braces; null if none parses."""
    text = F.regexp_replace(raw, r"^\s+|\s+$", "")
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)

    def valid(x: Column) -> Column:
        return F.when(F.try_parse_json(x).isNotNull(), x)

    return F.coalesce(valid(text), valid(F.nullif(fenced, F.lit(""))), valid(F.nullif(braces, F.lit(""))))
