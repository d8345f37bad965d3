from refsync.functions.text import (
    fold,
    is_coordinate,
    is_uuid,
    iso_time,
    present_or,
    qualified_name,
    zone_code,
)

__all__ = [
    "fold",
    "is_coordinate",
    "is_uuid",
    "iso_time",
    "present_or",
    "qualified_name",
    "zone_code",
]
