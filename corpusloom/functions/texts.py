"""Scalar functions on text that Spark lacks or that several operators share."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_form(text: Column, form: str = "NFC") -> Column:
    """Unicode normal form NFC, NFD, NFKC or NFKD; in Arrow batches, as there is no built-in."""

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([t if t is None or t.isascii() else unicodedata.normalize(form, t) for t in batch.to_pylist()], pa.string())

    return run(text)


#: White space of any script, as a character class.
SPACES = r"[\s\x0B\x{85}\p{Z}\x1C-\x1F]+"


def even_spaces(text: Column) -> Column:
    """Runs of white space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def without_marks(text: Column) -> Column:
    """Base letters only: decomposed, without combining marks and zero-width joiners."""
    return F.regexp_replace(normal_form(text, "NFD"), r"[\p{Mn}‌‍]", "")


def slug(text: Column) -> Column:
    """Lower-case ASCII letters and digits, all else as single hyphens, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-|-$", "")


def localized_digits(text: Column, zero: str) -> Column:
    """ASCII digits as the ten digits that begin with ``zero``."""
    return F.translate(text, "0123456789", "".join(chr(ord(zero) + i) for i in range(10)))


def unquoted(text: Column) -> Column:
    """The text without one pair of quotation marks around it."""
    return F.regexp_replace(F.trim(text), r'(?s)^(?:"(.*)"|“(.*)”|\'(.*)\'|‘(.*)’)$', "$1$2$3$4")


def zoned_time(text: Column) -> Column:
    """Timestamp of an ISO 8601 text with a zone; null without a zone or if it is none."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})$"), F.try_to_timestamp(text))
