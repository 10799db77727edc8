"""Fixed values of the record vocabulary."""

from __future__ import annotations

# Fixed values that define the reference's record vocabulary.
LEVEL_HIGH = "HIGH"
LEVEL_LOW = "LOW"
TAG_FIRST = "first"
TAG_UPDATE = "update"
