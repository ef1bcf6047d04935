"""Normalisation and extraction of names, addresses and countries, as Column expressions.

Two conventions live side by side: the *library* one (accents stripped, every abbreviation
expanded) and the *production* one (ASCII only, legal forms stripped at the end of names only).
Empty strings stand for missing values; null in, empty string out.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal and business abbreviations.
NAME_TERMS = {
    "pvt": "private", "priv": "private", "ltd": "limited", "ltda": "limited", "inc": "incorporated",
    "incorp": "incorporated", "corp": "corporation", "llc": "llc", "llp": "llp", "plc": "plc", "co": "company",
    "gmbh": "gmbh", "ag": "ag", "sa": "sa", "sarl": "sarl", "srl": "srl", "bv": "bv", "nv": "nv", "pty": "proprietary",
    "ste": "societe", "assn": "association", "assoc": "association", "grp": "group", "intl": "international",
    "natl": "national", "mfg": "manufacturing", "mgmt": "management", "svcs": "services", "svc": "service",
    "tech": "technology", "techs": "technologies", "soln": "solution", "solns": "solutions", "engg": "engineering",
    "engr": "engineering", "infra": "infrastructure", "govt": "government", "edu": "education", "hosp": "hospital",
    "pharm": "pharmacy", "pharma": "pharmaceuticals", "labs": "laboratories", "lab": "laboratory", "mktg": "marketing",
    "advt": "advertising", "advtg": "advertising", "ind": "industries", "inds": "industries", "est": "establishment",
    "estb": "establishment", "dept": "department", "hq": "headquarters", "hdqrs": "headquarters", "fdn": "foundation",
    "fndn": "foundation",
}
# Address abbreviations.
ADDRESS_TERMS = {
    "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "rd": "road", "dr": "drive",
    "ln": "lane", "ct": "court", "pl": "place", "sq": "square", "hwy": "highway", "pkwy": "parkway", "cir": "circle",
    "apt": "apartment", "ste": "suite", "fl": "floor", "bldg": "building", "ofc": "office", "dept": "department",
    "rm": "room", "no": "number", "nr": "near", "opp": "opposite", "dist": "district", "sec": "sector", "blk": "block",
    "extn": "extension", "ext": "extension", "nagar": "nagar", "ngr": "nagar", "marg": "marg", "mg": "mahatma gandhi",
    "rly": "railway", "stn": "station", "jn": "junction", "jct": "junction", "xrd": "crossroad", "mkt": "market",
    "indl": "industrial", "est": "estate", "twp": "township", "vlg": "village", "vill": "village", "po": "post office",
    "ph": "phase", "pkg": "parking", "rte": "route", "rt": "route", "n": "north", "s": "south", "e": "east", "w": "west",
    "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
}
# Country names and codes.
COUNTRY_TERMS = {
    "us": "us", "usa": "us", "united states": "us", "united states of america": "us", "u.s.": "us", "u.s.a.": "us",
    "in": "in", "ind": "in", "india": "in", "fr": "fr", "fra": "fr", "france": "fr", "uk": "gb", "gb": "gb",
    "united kingdom": "gb", "de": "de", "deu": "de", "germany": "de", "cn": "cn", "chn": "cn", "china": "cn", "jp": "jp",
    "jpn": "jp", "japan": "jp", "au": "au", "aus": "au", "australia": "au", "ca": "ca", "can": "ca", "canada": "ca",
    "br": "br", "bra": "br", "brazil": "br", "sg": "sg", "sgp": "sg", "singapore": "sg",
}
# Fixed values of the production convention: legal forms and address abbreviations.
LEGAL_FORMS = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "llc", "ltd", "limited", "plc", "pvt", "private", "llp",
    "sarl", "sas", "gmbh", "sa", "sasu", "eurl", "snc", "sci", "bv", "nv", "ag", "oy", "ab", "srl", "spa", "ltda",
)
PRODUCTION_ADDRESS_TERMS = {
    "rd": "road", "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard",
    "bd": "boulevard", "bvd": "boulevard", "dr": "drive", "ln": "lane", "hwy": "highway", "nh": "highway",
    "pkwy": "parkway", "pky": "parkway", "ct": "court", "apt": "apartment", "ste": "suite", "fl": "floor", "no": "number",
    "nr": "near", "rue": "rue", "pl": "place", "ch": "chemin", "imp": "impasse", "all": "allee", "allee": "allee",
    "bat": "batiment", "batiment": "batiment", "res": "residence", "cedex": "cedex", "sec": "sector", "blk": "block",
    "bldg": "building",
}
DOTTED_ADDRESS_TERMS = ("blvd", "ave", "rd", "st", "dr", "ln", "av", "pl")
# Letters that decomposition leaves as they are, in ASCII.
TRANSLITERATION = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L",
    "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i",
}


def _mapped(token: Column, terms: dict[str, str]) -> Column:
    pairs = [F.lit(x) for k, v in terms.items() for x in (k, v)]
    return F.coalesce(F.element_at(F.create_map(*pairs), token), token)


@cache
def _accents() -> tuple[str, str]:
    """Characters and their base letters, then the marks that go: one argument pair for translate()."""
    single, marks = [], []
    for point in range(0x80, 0x10000):
        char = chr(point)
        if 0xD800 <= point < 0xE000:
            continue
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != char:
            single.append((char, base))
    return "".join(c for c, _ in single) + "".join(marks), "".join(b for _, b in single)


def normalize_unicode(text: Column) -> Column:
    """Compatibility decomposition without marks, for characters that have one base character.

    JVM-side.  Characters that decompose into several base characters (ligatures, fractions,
    Hangul) stay; ``normalize_unicode_exact`` decomposes those too.
    """
    return F.translate(F.coalesce(text, F.lit("")), *_accents())


@F.pandas_udf(T.StringType())
def normalize_unicode_exact(texts: pd.Series) -> pd.Series:
    """NFKD without marks, for any character; an Arrow batch at a time."""

    def one(text: str | None) -> str:
        if not text or text.isascii():
            return text or ""
        return "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn")

    return texts.map(one)


def normalize_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def words(text: Column) -> Column:
    """Words of a string with single blanks; none for an empty string."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def _expanded(text: Column, terms: dict[str, str]) -> Column:
    return F.array_join(F.transform(F.split(text, " "), lambda t: _mapped(t, terms)), " ")


def normalize_name(raw: Column) -> Column:
    text = F.regexp_replace(F.lower(normalize_unicode(raw)), "&", " and ")
    return _expanded(normalize_whitespace(F.regexp_replace(text, r"(?U)[^\w\s\-']", " ")), NAME_TERMS)


def normalize_address(raw: Column) -> Column:
    text = F.regexp_replace(F.lower(normalize_unicode(raw)), "&", " and ")
    return _expanded(normalize_whitespace(F.regexp_replace(text, r"(?U)[^\w\s\-/#]", " ")), ADDRESS_TERMS)


def normalize_country(raw: Column) -> Column:
    """A two-letter code where known; any other country stays as it is, lowered."""
    text = normalize_whitespace(F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), r"(?U)[^\w\s]", ""))
    return _mapped(text, COUNTRY_TERMS)


def compact(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", "")


def numeric_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\d+)"), 1)


def extract_postal(address: Column) -> Column:
    """The first group of 5 digits (a ZIP+4 ending may follow), else the first of 6, else empty."""
    text = F.coalesce(address, F.lit(""))
    five = F.regexp_extract(text, r"\b(\d{5})(?:-\d{4})?\b", 1)
    return F.when(five != "", five).otherwise(F.regexp_extract(text, r"\b(\d{6})\b", 1))


def ascii_text(text: Column) -> Column:
    """Transliteration to base letters; what has none stays and is dropped by later steps."""
    out = normalize_unicode(text)
    for char, plain in TRANSLITERATION.items():
        out = F.replace(out, F.lit(char), F.lit(plain))
    return out


def production_base(text: Column) -> Column:
    out = F.replace(F.replace(F.lower(ascii_text(text)), F.lit("&"), F.lit(" and ")), F.lit("/"), F.lit(" "))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^a-z0-9\s]", " "), r"\s+", " "))


def production_name(raw: Column) -> Column:
    """ASCII words without the legal forms at the end."""
    return F.trim(F.regexp_replace(_plain(production_base(raw)), rf"(?:(?:^| )(?:{'|'.join(LEGAL_FORMS)}))+$", ""))


def production_address(raw: Column) -> Column:
    """ASCII words, abbreviations expanded before punctuation goes."""
    text = production_base(raw)
    for term in DOTTED_ADDRESS_TERMS:  # "rd." right before a word character loses its dot
        text = F.regexp_replace(text, rf"\b{term}\.\b", PRODUCTION_ADDRESS_TERMS[term])
    parts = F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9_]+|[^A-Za-z0-9_]+)"), 1)
    return _plain(F.array_join(F.transform(parts, lambda t: _mapped(t, PRODUCTION_ADDRESS_TERMS)), ""))


def production_compact(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-z0-9]", "")


def production_postal(address_norm: Column) -> Column:
    """The last run of 4 to 6 digits of a normalised address."""
    return F.regexp_extract(address_norm, r"^.*(?<!\d)(\d{4,6})(?!\d)", 1)


def grams(text: Column, n: int) -> Column:
    """All n-character windows; none if the text is shorter."""
    return F.when(
        F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))
    ).otherwise(F.array().cast("array<string>"))


def url_cache_key(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 24)
