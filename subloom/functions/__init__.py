"""Column functions."""

from subloom.functions.tags import has_tags, is_translatable, plain_text, protect, strip_tags, tag_issues
from subloom.functions.text import cyrillic_ratio, dedupe_key, is_caption, latin_ratio, word_count
from subloom.functions.timecode import to_seconds, to_stamp

__all__ = ["cyrillic_ratio", "dedupe_key", "has_tags", "is_caption", "is_translatable", "latin_ratio", "plain_text", "protect", "strip_tags", "tag_issues", "to_seconds", "to_stamp", "word_count"]
