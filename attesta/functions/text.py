"""Scalar extraction and normalisation, as column expressions that stay inside code generation."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"(\d+(?:\.\d+)?)"


def clean(text: Column) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(text, r"[ \t\r\n\f\x0b]+", " "))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)``, with the value made once however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def plain_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def nfkc(text: Column) -> Column:
    """Unicode NFKC, for which Spark has no expression: an Arrow-batched function that gets the texts that are not plain ASCII."""

    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return F.coalesce(normal(F.when(~plain_ascii(text), text)), text)


#: Characters that listings have in other forms: spaces, superscripts and fractions, signs, Roman and circled numbers, units, ligatures, full-width forms.
FORMS = ((0xA0, 0xA0), (0xB2, 0xB3), (0xB9, 0xB9), (0xBC, 0xBE), (0x2000, 0x200A), (0x2122, 0x2122), (0x2160, 0x217F), (0x2460, 0x2473), (0x3000, 0x3000), (0x338E, 0x33A1), (0xFB00, 0xFB06), (0xFF01, 0xFF5E))


@lru_cache(1)
def _compatible() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters that NFKC turns into one other character, those characters, and the ones that it turns into several, with these."""
    found = [(chr(c), n) for lo, hi in FORMS for c in range(lo, hi + 1) if (n := unicodedata.normalize("NFKC", chr(c))) != chr(c)]
    one = [(a, b) for a, b in found if len(b) == 1]
    return "".join(a for a, _ in one), "".join(b for _, b in one), tuple((a, b) for a, b in found if len(b) > 1)


def compatible(text: Column) -> Column:
    """The characters of FORMS in the form that NFKC gives them, as native expressions; others stay as they are, which ``nfkc`` changes too."""
    old, new, several = _compatible()
    marks = "".join(a for a, _ in several)
    table = F.str_to_map(F.lit("\x01".join(f"{a}\x02{b}" for a, b in several)), F.lit("\x01"), F.lit("\x02"))
    apart = lambda t: F.array_join(F.transform(F.split(t, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    wide = let(text, lambda t: F.when(plain_ascii(t), t).otherwise(F.translate(t, old, new)))
    return let(wide, lambda t: F.when(plain_ascii(t), t).when(t.rlike(f"[{marks}]"), apart(t)).otherwise(t))


def casefolded(text: Column) -> Column:
    """NFKC, white space folded, full case folding (ß as ss), which lower case is not; Arrow-batched as well."""

    @F.pandas_udf("string")
    def folded(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else " ".join(unicodedata.normalize("NFKC", t).split()).casefold())

    return folded(text)


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_number(text: Column) -> Column:
    """The first number of a text; zero counts as missing, as in a chain of alternatives."""
    return F.nullif(F.regexp_extract(text, NUMBER, 1).try_cast("double"), F.lit(0.0))


def price(text: Column) -> Column:
    """The first number with thousands separators."""
    return F.replace(F.regexp_extract(text, r"(\d[\d,]*(?:\.\d+)?)", 1), F.lit(","), F.lit("")).try_cast("double")


def amount_before(text: Column, units: str) -> Column:
    """The number before any of the units (a regular expression), in any case."""
    return F.regexp_extract(text, rf"(?i){NUMBER}\s*(?:{units})", 1).try_cast("double")


def capacity_gb(text: Column) -> Column:
    """The largest capacity named in a text, terabytes as 1,024 gigabytes; fractions of the largest are cut."""
    of = lambda t, unit, by: F.transform(F.regexp_extract_all(t, F.lit(rf"(?i){NUMBER}\s*{unit}"), 1), lambda x: x.cast("double") * by)
    return F.floor(F.array_max(let(compatible(text), lambda t: F.concat(of(t, "GB", 1), of(t, "TB", 1024)))))


def tri_state(text: Column, negative: str, positive: str, negation_first: bool = True) -> Column:
    """False, true or unknown, from two regular expressions; which one wins where both match is a parameter."""
    no, yes = F.when(text.rlike(negative), F.lit(False)), F.when(text.rlike(positive), F.lit(True))
    return F.coalesce(no, yes) if negation_first else F.coalesce(yes, no)


def coerce_bool(c: Column, yes: tuple[str, ...] = ("true", "1", "yes", "y"), no: tuple[str, ...] = ("false", "0", "no", "n")) -> Column:
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin(*yes), True).when(t.isin(*no), False)


def ordered_class(text: Column, rules: list[tuple[str, str]], otherwise: str = "unknown") -> Column:
    """The name of the first rule (name, regular expression) that matches."""
    out = F.lit(otherwise)
    for name, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def first_match(text: Column, patterns: list[str]) -> Column:
    """What the first matching pattern's first group holds, or the text itself."""
    return F.coalesce(*(empty_to_null(F.regexp_extract(text, p, 1)) for p in patterns), text)


def alias(text: Column, table: dict[str, str], otherwise: Column | None = None) -> Column:
    """Dictionary lookup after folding case, spaces, underscores and hyphens; unknown names fall through."""
    key = F.lower(F.regexp_replace(F.trim(text), r"[\s_\-]+", ""))
    entries = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), otherwise if otherwise is not None else F.coalesce(empty_to_null(F.upper(F.trim(text))), F.lit("UNKNOWN")))


def contains_first(text: Column, needles: list[tuple[str, str]], otherwise: Column) -> Column:
    """The value of the first needle (needle, value) that the lower-cased text contains."""
    hit = let(F.lower(text), lambda t: F.coalesce(*(F.when(t.contains(needle), F.lit(value)) for needle, value in needles)))
    return F.coalesce(hit, otherwise)


def source_tokens(text: Column, nulls: tuple[str, ...] = ("", "-", "none", "null")) -> Column:
    """The different names of a list written with any of the usual separators, in order."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"[,，+、|/]"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: ~F.lower(x).isin(*nulls)))


#: Letters and digits of Unicode 14 and 15, which the classes of Java 17 lack.
LATER = """870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 2C2F 2C5F 9FFD-9FFF A7C0-A7C1 A7D0-A7D1 A7D3 A7D5-A7D9 A7F2-A7F4
10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 10780-10785 10787-107B0 107B2-107BA
10F70-10F81 11071-11072 11075 1123F-11240 11740-11746 11AB0-11ABF 11F02 11F04-11F10 11F12-11F33 11F50-11F59 12F90-12FF0 1342F
13441-13446 16A70-16ABE 16AC0-16AC9 1AFF0-1AFF3 1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1D2C0-1D2D3 1DF00-1DF1E 1DF25-1DF2A
1E030-1E06D 1E290-1E2AD 1E4D0-1E4EB 1E4F0-1E4F9 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE 2A6DE-2A6DF 2B735-2B739 31350-323AF"""

#: Neither letters nor digits; what comes before all of LATER is not compared with it.
MARKS = r"[\P{L}&&\P{N}&&[\x00-\x{86F}[^" + "".join("-".join(rf"\x{{{c}}}" for c in r.split("-")) for r in LATER.split()) + "]]]+"


def identity_text(text: Column) -> Column:
    """Lower case, letters and digits only; each character has one lower case, wherever it is (Σ is σ at the end of a word too, İ is i)."""
    bare = F.regexp_replace(text, MARKS, "")
    return F.lower(F.replace(F.replace(bare, F.lit("Σ"), F.lit("σ")), F.lit("İ"), F.lit("i")))


def identity_key(*parts: Column, empty: bool = False) -> Column:
    """24 hex digits of the SHA-256 of the parts; null where all are empty (``empty``: only where all are null)."""
    joined = F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts))
    known = F.coalesce(*parts).isNotNull() if empty else F.length(F.replace(joined, F.lit("|"), F.lit(""))) > 0
    return F.when(known, F.substring(F.sha2(joined, 256), 1, 24))


def quality(c: Column, kind: str) -> Column:
    """How much a value says, by its type: a boolean 4, a number 3, a text its length up to 10, an array its size and one up to 5."""
    by = {"boolean": F.lit(4), "number": F.lit(3), "string": F.least(F.lit(10), F.length(c)), "array": F.when(F.size(c) > 0, F.least(F.lit(5), F.size(c) + 1)).otherwise(0)}[kind]
    return F.when(c.isNull(), 0).otherwise(by)


def clean_text(text: Column) -> Column:
    """NFKC, then white space collapsed and trimmed; nothing is the empty text."""
    return clean(F.coalesce(nfkc(text), F.lit("")))


def redacted_url(url: Column) -> Column:
    """An address without its path, which may hold a secret."""
    host = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)", 1)
    return F.when(F.coalesce(host, F.lit("")) == "", "<invalid-url>").otherwise(F.concat(host, F.lit("/***")))


def redacted_log(text: Column) -> Column:
    """A log without names and passwords in addresses and without long tokens."""
    return F.regexp_replace(F.regexp_replace(text, r"(://)[^/@\s]+@", "$1***@"), r"[A-Za-z0-9+/=_\-]{24,}", "***")


def with_defaults(text: Column, defaults: dict[str, str | float], broken: dict[str, str | float]) -> Column:
    """The fields of a JSON object as a struct: a default for one that is missing or of another kind; all ``broken`` where the text is no JSON."""
    v = F.try_parse_json(text)
    kind = lambda d: "double" if isinstance(d, float) else "string"
    get = {n: F.when(v.isNull(), F.lit(broken.get(n, d))).otherwise(F.coalesce(F.try_variant_get(v, f"$.{n}", "string").try_cast(kind(d)), F.lit(d))) for n, d in defaults.items()}
    return F.struct(*(c.alias(n) for n, c in get.items()))


def without_nulls(text: Column) -> Column:
    """A JSON text without the members of objects that are null, at any depth; elements of lists stay."""
    import json

    def bare(v):
        return {k: bare(x) for k, x in v.items() if x is not None} if isinstance(v, dict) else [bare(x) for x in v] if isinstance(v, list) else v

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else json.dumps(bare(json.loads(t)), ensure_ascii=False))

    return run(text)


def request_manifest(prompt: Column, version: str = "v1") -> Column:
    """struct(version, request_id, prompt_sha256) that binds an answer to its prompt."""
    return let(F.sha2(prompt, 256), lambda h: F.struct(F.lit(version).alias("version"), F.substring(h, 1, 16).alias("request_id"), h.alias("prompt_sha256")))


def redacted(text: Column) -> Column:
    """User names and passwords in URLs become stars."""
    return F.regexp_replace(text, r"(\w+://)[^/@\s]+@", "$1***@")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]+)", 1)


def minutes_of_day(ts: Column, zone: str) -> Column:
    local = F.from_utc_timestamp(ts, zone)
    return F.hour(local) * 60 + F.minute(local)


def max_amount(text: Column, patterns: list[str]) -> Column:
    """The largest number that any pattern's first group finds; 0 if none."""
    found = F.concat(*(F.transform(F.regexp_extract_all(text, F.lit(p), 1), lambda x: x.try_cast("bigint")) for p in patterns))
    return F.coalesce(F.array_max(found), F.lit(0).cast("bigint"))


def number(c: Column) -> Column:
    """A field as a number, whatever type it came in; what is none is null."""
    return c.cast("string").try_cast("double")


def money(c: Column) -> Column:
    """A price for display: whole, with thousands separators; what is none is said to be open."""
    n = number(c)
    return F.when(n.isNull() | F.isnan(n), "价格待确认").otherwise(F.concat(F.lit("¥"), F.format_number(F.round(n, 0), 0)))


def display(c: Column, suffix: str = "") -> Column:
    """A value for display, with its unit, or a dash; a whole number without its point, markup escaped."""
    t = F.regexp_replace(c.cast("string"), r"^(-?\d+)\.0$", "$1")
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        t = F.replace(t, F.lit(mark), F.lit(name))
    return F.coalesce(F.concat(empty_to_null(t), F.lit(suffix)), F.lit("—"))


def utc_second(ts: Column) -> Column:
    """An instant in ISO form, to the second, in UTC."""
    return F.date_format(F.date_trunc("second", F.to_utc_timestamp(ts, F.current_timezone())), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def canonical_json(names: list[str]) -> Column:
    """The columns as a JSON object with its keys in order and nulls kept, so that equal rows give equal texts."""
    return F.to_json(F.struct(*sorted(names)), {"ignoreNullFields": "false"})
