"""String, digest and hash functions as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

FRAGMENT_TOKENS = 12
#: Upper bounds of the length buckets; longer texts are in ">4096".
LENGTH_BOUNDS = (16, 32, 64, 128, 256, 512, 1024, 2048, 4096)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Texts of these characters alone (ASCII without separators 1C-1F, Latin-1 letters, oe, typographic dashes and quotes) have
#: their canonical form by lower case and sharp s as ss; all others need compatibility forms, case folding or other white space.
PLAIN = r"^[\t-\r\x20-\x7EÀ-ÖØ-öø-ÿŒœ–—‘’“”]*$"


def canonical_form(text: str) -> str:
    """Exact canonical form: NFKC, casefold, white space collapsed."""
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split())


@F.pandas_udf(StringType())
def canonical_udf(text):
    return text.map(lambda x: None if x is None else canonical_form(x))


def canonical(text: Column | str) -> Column:
    """NFKC, casefold, white space collapsed and trimmed: by built-in functions for PLAIN texts, only the others go to Python."""
    text = _col(text)
    plain = text.rlike(PLAIN)
    native = F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), r"\s+", " "))
    return F.when(plain, native).otherwise(canonical_udf(F.when(~plain, text)))


def digest(text: Column | str) -> Column:
    """Identity of a canonical text."""
    return F.md5(canonical(text))


def tokens(text: Column | str) -> Column:
    """White-space tokens; an empty array for blank or null texts."""
    return F.filter(F.split(F.coalesce(_col(text), F.lit("")), r"\s+"), lambda t: t != "")


def token_count(text: Column | str) -> Column:
    return F.size(tokens(text)).cast("long")


def fragments(text: Column | str, n: int = FRAGMENT_TOKENS) -> Column:
    """Distinct digests of all n-token windows of the canonical text; none if there are fewer tokens."""
    return F.element_at(F.transform(F.array(F.split(canonical(text), " ")), lambda t: _windows(t, n)), 1)


def _windows(t: Column, n: int) -> Column:
    """Digests of the windows of a bound token array (bound: an expression would be evaluated for each window)."""
    windows = F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), lambda i: F.md5(F.array_join(F.slice(t, i, n), " ")))
    return F.when(F.size(t) >= n, F.array_distinct(windows)).otherwise(F.array().cast("array<string>"))


def hash_fraction(seed: str, *parts: Column | str) -> Column:
    """Uniform fraction in [0, 1) from a seeded md5 of the parts; the same in every SQL engine."""
    key = F.concat_ws("\x1f", F.lit(seed), *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sample_key(seed: str, digest_: Column | str) -> Column:
    """Seeded order of digests."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(digest_)))


def positive_id(key: Column | str) -> Column:
    """A non-negative 63-bit id of a string."""
    return F.xxhash64(_col(key)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def slug(text: Column | str, size: int = 48, default: str = "unknown") -> Column:
    low = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(_col(text), F.lit(""))), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    cut = F.regexp_replace(F.substring(low, 1, size), r"-+$", "")
    return F.when(cut == "", F.lit(default)).otherwise(cut)


def partition_name(lang: Column | str, task: Column | str) -> Column:
    """slug(lang)__slug(task)__ and four bytes of a hash of both."""
    return F.concat_ws("__", slug(lang), slug(task), F.substring(F.md5(F.concat_ws("\x1f", _col(lang), _col(task))), 1, 8))


def alias(text: Column | str, names: Mapping[str, str]) -> Column:
    """Looks up a name after ``_`` and ``-`` became spaces and case is dropped; null if unknown."""
    key = F.lower(F.trim(F.regexp_replace(_col(text), "[_-]", " ")))
    return reduce(lambda rest, kv: F.when(key == kv[0], F.lit(kv[1])).otherwise(rest), names.items(), F.lit(None).cast("string"))


def length_bucket(n: Column | str, bounds: Sequence[int] = LENGTH_BOUNDS) -> Column:
    out = F.lit(f">{bounds[-1]}")
    for b in reversed(bounds):
        out = F.when(_col(n) <= b, F.lit(f"<={b}")).otherwise(out)
    return out


def user_text(instruction: Column | str, inputs: Column | str) -> Column:
    """The instruction, and after a blank line the inputs unless they are blank."""
    extra = F.trim(F.coalesce(_col(inputs), F.lit("")))
    return F.when(extra == "", _col(instruction)).otherwise(F.concat(_col(instruction), F.lit("\n\n"), extra))


def with_prefix(prefix: str, text: Column | str) -> Column:
    return F.concat(F.lit(f"{prefix}\n\n"), _col(text)) if prefix else _col(text)


def qa_normal(text: Column | str) -> Column:
    """Answer form for scoring: case, punctuation and articles dropped, white space collapsed."""
    plain = F.regexp_replace(F.lower(_col(text)), r"[\p{Punct}]", "")
    return F.array_join(F.filter(F.split(plain, r"\s+"), lambda t: ~t.isin("", "a", "an", "the")), " ")


def transcript_normal(text: Column | str) -> Column:
    """Transcript form: straight apostrophes, no <TAGS>, upper case, no punctuation but apostrophes, single spaces."""
    out = F.regexp_replace(F.regexp_replace(_col(text), "[‘’]", "'"), r"<[^>]*>", " ")
    out = F.regexp_replace(F.replace(F.upper(out), F.lit("_"), F.lit(" ")), r"[^\w\s']", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def is_question(text: Column | str, terms: Sequence[str] = ()) -> Column:
    """Whether a question mark (also the Ethiopic one) or one of the terms is in the text."""
    found = _col(text).contains("?") | _col(text).contains("፧")
    for t in terms:
        found = found | F.lower(_col(text)).contains(t.lower())
    return F.coalesce(found, F.lit(False))


def latin_share(text: Column | str) -> tuple[Column, Column]:
    """(number of letters, number of Latin letters)."""
    text = F.coalesce(_col(text), F.lit(""))
    return F.regexp_count(text, F.lit(r"\p{L}")).cast("long"), F.regexp_count(text, F.lit(r"[\p{IsLatin}&&\p{L}]")).cast("long")


def latin_script(text: Column | str, share: float = 0.8, least: int = 10) -> Column:
    """At least ``share`` of the letters are Latin, or there are fewer than ``least`` letters."""
    letters, latin = latin_share(text)
    return (letters < least) | (latin >= letters * F.lit(share))


def url_suffix(url: Column | str, allowed: Sequence[str], default: str = "") -> Column:
    """Lower-case file suffix of the url's path if allowed."""
    path = F.regexp_extract(_col(url), r"^[^?#]*", 0)
    found = F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1))
    return F.when(found.isin(list(allowed)), found).otherwise(F.lit(default))


def strip_endpoint(url: Column | str) -> Column:
    """Drops trailing slashes and a trailing /v1."""
    return F.regexp_replace(F.regexp_replace(_col(url), "/+$", ""), "/v1$", "")


def blank_to(value: Column | str, fallback: Column | str | None) -> Column:
    text = F.trim(_col(value))
    other = F.lit(None) if fallback is None else fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(F.nullif(text, F.lit("")), other)


def utc_millis(ts: Column | str) -> Column:
    """ISO time with milliseconds and Z."""
    return F.date_format(_col(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def contains_marker(text: Column | str, marker: str) -> Column:
    """Whether a source name has the marker, ``_`` and ``-`` read as spaces."""
    return F.coalesce(F.lower(F.regexp_replace(_col(text), "[_-]", " ")).contains(marker.lower()), F.lit(False))


def topic_of(text: Column | str, topics: Sequence[str]) -> Column:
    """The first topic whose letters and digits, squashed, are in the squashed text."""
    squashed = F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]", "")
    out = F.lit(None).cast("string")
    for t in reversed(list(topics)):
        key = "".join(c for c in t.lower() if c.isascii() and c.isalnum())
        out = F.when(squashed.contains(key), F.lit(t)).otherwise(out)
    return out


def strip_html(html: Column | str) -> Column:
    """Visible text of a page: no scripts, styles or tags; five entities decoded; white space collapsed."""
    out = F.regexp_replace(_col(html), r"(?is)<(script|style)\b.*?</\1>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def parse_count(text: str) -> int:
    """ "500M" -> 500_000_000 (driver side; K, M, B and T)."""
    text = text.strip().replace("_", "").replace(",", "")
    scale = {"K": 10**3, "M": 10**6, "B": 10**9, "T": 10**12}.get(text[-1:].upper())
    return int(float(text[:-1]) * scale) if scale else int(float(text))
