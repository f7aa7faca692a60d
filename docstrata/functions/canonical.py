"""Canonical forms of the columns on which snapshots are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"(?U)^\s+|\s+\z"


def stripped(c: Column) -> Column:
    """Without surrounding white space of any kind (trim() takes only blanks)."""
    return F.regexp_replace(c, BLANK, "")


def digest(c: Column) -> Column:
    """The digest a hash spells: lower case, no surrounding blanks, no algorithm in front. Blank is null.

    A 64-digit one is packed to its 32 bytes, others keep their characters.
    """
    bare = F.regexp_replace(F.lower(stripped(c)), r"^[a-z][a-z0-9_/-]*\s*[:=]\s*", "")
    return F.when(bare == "", None).when(bare.rlike(r"^[0-9a-f]{64}\z"), F.unhex(bare)).otherwise(F.encode(bare, "UTF-8"))


def plain_slug(c: Column) -> Column:
    """The path a slug spells: no surrounding blanks or slashes, no leading './', no final '.md'."""
    bare = F.regexp_replace(c, r"(?U)^(?:\s|/|\./)+|[\s/]+\z", "")
    return F.regexp_replace(F.regexp_replace(bare, r"\.md\z", ""), r"(?U)[\s/]+\z", "")


def instant(c: Column) -> Column:
    """The instant a time text names; without an offset it is UTC. Null where it is blank or names none."""
    text = stripped(c)
    zoned = F.when(text.rlike(r"(?i)(?:z|utc|[+-]\d{2}:?\d{2})\z"), text).otherwise(F.concat(text, F.lit("Z")))
    return zoned.try_cast("timestamp")
