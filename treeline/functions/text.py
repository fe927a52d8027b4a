"""Names and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes of release tags, of textures that are no skins, and the text that stands for the player's name.
TAG = r"(?:data|upstream|gamedata)-(.+?)(?:-v\d+)?$"
NICKNAME, READER = "{@nickname}", "博士"
ART_PREFIXES = ("chararts/", "skinpack/")


def _or_null(c: Column) -> Column:
    """An expression that matches nothing gives an empty string; here that is null."""
    return F.nullif(c, F.lit(""))


def version_of_tag(tag: Column) -> Column:
    """The version id in a release tag, without a trailing revision; null if it is no such tag."""
    return _or_null(F.regexp_extract(tag, TAG, 1))


def clean_rich_text(text: Column, name: str = READER) -> Column:
    """Text without markup, with the reader's name filled in, stripped of white space of any script."""
    filled = F.replace(text, F.lit(NICKNAME), F.lit(name))
    return F.regexp_replace(F.regexp_replace(filled, "<[^>]+>", ""), r"(?U)^\s+|\s+$", "")


def skin_id(texture: Column) -> Column:
    """The skin that a texture shows: ``char_<n>_<name>#<form>``, or ``char_<n>_<skin>@<form>``; null for other textures."""
    named = F.regexp_replace(texture, r"(?s)^[^_]*_([^_]*)_(.*)_([^_]*)$", "char_$1_$2@$3")
    plain = F.regexp_replace(texture, r"^(char_[0-9]+_[a-z0-9]+)_([0-9]+\+?)$", "$1#$2")
    return (
        F.when(texture.startswith("build_") | texture.contains("[alpha]"), F.lit(None))
        .when(texture.contains("#"), F.nullif(named, texture))
        .otherwise(F.nullif(plain, texture))
    )


def art_kind(skin: Column) -> Column:
    return F.when(skin.contains("@"), "skin").otherwise("base")


def art_shard(skin: Column) -> Column:
    return F.when(skin.contains("@"), "skinpack").otherwise("chararts")


def is_art_bundle(name: Column) -> Column:
    return name.startswith(ART_PREFIXES[0]) | name.startswith(ART_PREFIXES[1])


def cache_name(bundle: Column) -> Column:
    """A file name for a bundle. Not one to one: keep the bundle's name as the key."""
    return F.concat(F.replace(F.replace(bundle, F.lit("/"), F.lit("_")), F.lit("#"), F.lit("__")), F.lit(".ab"))
