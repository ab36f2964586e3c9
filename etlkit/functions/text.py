"""String cleaning, extraction and comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "area_code", "clean_text", "email_domain", "first_token", "format_phone", "last_token",
    "name_parts", "no_space_length", "similar", "url_parts", "word_count",
]

# Patterns that define what these functions find.
EMAIL_DOMAIN = "@(.+)"
AREA_CODE = r"\((\d{3})\)"
PHONE_DIGITS, PHONE_FORM = r"(\d{3})(\d{3})(\d{4})", "($1) $2-$3"
URL_PARTS = {"protocol": "^(https?)://", "domain": "://([^/]+)", "path": "://[^/]+(/.*)"}


def clean_text(text: Column) -> Column:
    """Keep letters, digits and spaces; lower-case, squeeze runs of space, trim."""
    kept = F.regexp_replace(text, r"[^a-zA-Z0-9\s]", "")
    return F.trim(F.regexp_replace(F.lower(kept), r"\s+", " "))


def name_parts(text: Column) -> Column:
    return F.split(clean_text(text), " ")


def first_token(text: Column) -> Column:
    return F.element_at(name_parts(text), 1)


def last_token(text: Column) -> Column:
    return F.element_at(name_parts(text), -1)


def email_domain(email: Column) -> Column:
    return F.lower(F.regexp_extract(email, EMAIL_DOMAIN, 1))


def area_code(phone: Column) -> Column:
    """The three digits in parentheses; empty when there are none."""
    return F.regexp_extract(phone, AREA_CODE, 1)


def format_phone(phone: Column) -> Column:
    """Digits only, then ``(ddd) ddd-dddd``."""
    digits = F.regexp_replace(phone, "[^0-9]", "")
    return F.regexp_replace(digits, PHONE_DIGITS, PHONE_FORM)


def url_parts(url: Column) -> Column:
    """Struct of protocol, domain and path (query and fragment stay with the path)."""
    return F.struct(*[F.regexp_extract(url, pattern, 1).alias(part) for part, pattern in URL_PARTS.items()])


def word_count(text: Column) -> Column:
    """Parts between runs of white space; an empty text counts as one part."""
    return F.size(F.split(text, r"\s+"))


def no_space_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\s", ""))


def similar(a: Column, b: Column, limit: int = 3) -> Column:
    """Edit distance below ``limit``; the distance search stops at the limit."""
    distance = F.levenshtein(a, b, limit - 1)
    return distance >= 0
