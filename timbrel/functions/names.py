"""Ids, hashes and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters not allowed in file names.
INVALID_NAME_CHARS = '<>:"/\\|?*'


# Fixed value: hex digits of a generated id.
ID_DIGITS = 12


def random_id(prefix: str, digits: int = ID_DIGITS) -> Column:
    """``prefix_`` and random hex digits; batch use only, as a retry draws anew."""
    return F.concat(F.lit(prefix + "_"), F.substr(F.replace(F.uuid(), F.lit("-"), F.lit("")), F.lit(1), F.lit(digits)))


def stable_id(prefix: str, *key: Column, digits: int = ID_DIGITS) -> Column:
    """``prefix_`` and hex digits derived from a key: equal on every retry.

    Twelve digits collide once in some tens of millions of keys; take more for
    larger sets.
    """
    seed = F.concat_ws("|", F.lit(prefix), *[k.cast("string") for k in key])
    return F.concat(F.lit(prefix + "_"), F.substr(F.sha2(seed, 256), F.lit(1), F.lit(digits)))


def given_or(value: Column, generated: Column) -> Column:
    """The given id, or a generated one when it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), generated)


def content_hash(content: Column, length: int = 64) -> Column:
    """SHA-256 in hex, optionally cut to a prefix."""
    digest = F.sha2(content, 256)
    return digest if length >= 64 else F.substr(digest, F.lit(1), F.lit(length))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem_to_first_dot(path: Column) -> Column:
    return F.substring_index(basename(path), ".", 1)


def stem_to_last_dot(path: Column) -> Column:
    """File name without its last extension; names such as ``.a`` or ``a.`` stay whole."""
    return F.regexp_replace(basename(path), r"(?s)^(.+)\.[^.]+$", "$1")


def decoder_suffix(filename: Column) -> Column:
    """Text after the last dot as it is; ``mp3`` when there is no dot."""
    return F.when(F.contains(filename, F.lit(".")), F.substring_index(filename, ".", -1)).otherwise(F.lit("mp3"))


def sanitize_name(name: Column) -> Column:
    return F.translate(name, INVALID_NAME_CHARS, "_" * len(INVALID_NAME_CHARS))


def join_names(people: Column) -> Column:
    """``", "``-joined ``name`` fields of an array of structs."""
    return F.array_join(F.transform(people, lambda p: p["name"]), ", ")


def search_text(track_name: Column, artists: Column) -> Column:
    return F.concat(track_name, F.lit(" "), artists)


def display_name(track_name: Column, artists: Column) -> Column:
    return F.concat(artists, F.lit(" - "), track_name)
