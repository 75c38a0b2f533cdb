"""Column-level functions: keys, hashes and scalar helpers."""

from fxlake.functions.keys import business_payload_hash, payload_hash, surrogate_key
from fxlake.functions.scalar import (
    booking_reference,
    date_prefix,
    decode_object_key,
    file_stem,
    is_blank,
    is_lost_amount,
    period_name,
    safe_amount,
    stable_id,
)

__all__ = [
    "booking_reference", "business_payload_hash", "date_prefix", "decode_object_key",
    "file_stem", "is_lost_amount", "is_blank", "payload_hash", "period_name",
    "safe_amount", "stable_id", "surrogate_key",
]
