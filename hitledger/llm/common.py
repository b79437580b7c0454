"""Small expressions that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words are the longest runs of anything but these six white-space characters.
SEPARATORS = r"[\x20\x09-\x0D]+"
def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower case for A-Z alone, so that every engine agrees on the result."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def let(value: Column, body) -> Column:
    """``body`` of a value computed once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def in_fold(doc_id: Column | str, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder modulo five (null id: crc of '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == fold
