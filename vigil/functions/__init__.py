from vigil.functions.scalar import (  # noqa: F401
    ms_to_seconds,
    readable_time,
    scale_decimals,
    round_half_up,
    size_bucket,
    size_bucket_rank,
    bit_is_set,
    safe_divide,
    equal_width_bin,
)
