"""Column functions. All are compositions of built-in ones, so they stay inside code generation."""

from .geometry import thumbnail_size
from .records import record_count, same_content, sha256_hex
from .text import art_kind, art_shard, cache_name, clean_rich_text, skin_id, version_of_tag

__all__ = ["art_kind", "art_shard", "cache_name", "clean_rich_text", "record_count", "same_content", "sha256_hex", "skin_id", "thumbnail_size", "version_of_tag"]
