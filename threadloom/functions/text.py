"""Text helpers: Unicode strip, relation names, tag extraction."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept in relation names, markdown fences in model
# answers, and the length above which an untagged answer is taken whole.
RELATION_UNSAFE = "[^a-zA-Z0-9_]"
FENCES = ("```xml", "```")
UNTAGGED_MIN_LENGTH = 50

# Every character Unicode counts as white space, and the four separators \x1c-\x1f.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def has_content(text: Column) -> Column:
    """Whether anything is left after ``strip``; cheaper than comparing its result."""
    return text.rlike(f"[^{WHITE_SPACE}]")


def relation_name(predicate: Column) -> Column:
    """Upper-case name with every other character replaced by ``_``."""
    return F.upper(F.regexp_replace(predicate, RELATION_UNSAFE, "_"))


def extract_tag(answer: Column, tag: str) -> Column:
    """Content of the first ``<tag>…</tag>``; long untagged answers whole; else ''."""
    clean = answer
    for fence in FENCES:
        clean = F.replace(clean, F.lit(fence), F.lit(""))
    clean = strip(clean)
    name = re.escape(tag)
    found = F.regexp_extract_all(clean, F.lit(f"(?s)<{name}>(.*?)</{name}>"), F.lit(1))
    first = F.get(found, F.lit(0))
    return (
        F.when(first.isNotNull(), strip(first))
        .when(F.length(clean) > UNTAGGED_MIN_LENGTH, clean)
        .otherwise(F.lit(""))
    )


def contains_any(text: Column, words: list[str]) -> Column:
    """Case-insensitive match of any of the words; never without words."""
    if not words:
        return F.lit(False)
    return text.rlike("(?iu)" + "|".join(re.escape(w) for w in words))


def batch_number(key: str, n: Column) -> Column:
    """Even, repeatable spread of keys over ``n`` batches."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % n
