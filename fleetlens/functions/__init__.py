from fleetlens.functions.scalar import (
    clamp_at_zero,
    epoch_micros,
    epoch_millis,
    from_epoch_micros,
    is_blank,
    java_string_hash,
    millis_to_minutes,
    status_icon,
    to_kes,
)

__all__ = [
    "clamp_at_zero",
    "epoch_micros",
    "epoch_millis",
    "from_epoch_micros",
    "is_blank",
    "java_string_hash",
    "millis_to_minutes",
    "status_icon",
    "to_kes",
]
