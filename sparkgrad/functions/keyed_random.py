"""Uniform random numbers that are a function of a key.

``rand(seed)`` changes with the partition count and with a retried task; a hash of
(seed, key) gives the same draw for a row wherever and however often it runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits, exact in a double


def keyed_uniform(seed: int, *keys: Column | str) -> Column:
    """Uniform in [0, 1), one independent draw per distinct key."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys])
    head = F.substring(F.md5(text.cast("binary")), 1, _HEX_DIGITS)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(16**_HEX_DIGITS))
