"""Deterministic keys: name-based UUIDs computed by built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# RFC 4122 namespace for ISO OIDs (fixed value).
OID_NAMESPACE = "6ba7b8129dad11d180b400c04fd430c8"


def _text(part) -> Column:
    return (F.col(part) if isinstance(part, str) else part).cast("string")


def uuid3(*parts) -> Column:
    """Version-3 UUID of the concatenated parts; NULL if any part is NULL.

    Parts are column names or Columns.  Nothing is put between them, which is
    unambiguous only for fixed-length parts such as UUIDs.
    """
    text = _text(parts[0]) if len(parts) == 1 else F.concat(*[_text(p) for p in parts])
    digest = F.md5(F.concat(F.lit(bytearray.fromhex(OID_NAMESPACE)), text.cast("binary")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-3"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def known_uuid3(*parts) -> Column:
    """``uuid3`` of parts that are never NULL.

    Declared non-NULL, the key needs no null check in later joins; such a
    check would compute the whole hash once more.
    """
    return uuid3(*[F.coalesce(_text(p), F.lit("")) for p in parts])
