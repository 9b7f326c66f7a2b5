"""Size limits that choose between two exact physical plans.

None of them changes a result: below a limit the simple plan is used, above it
an equivalent plan that splits the work further.
"""

# Rows one task may hold for an exact in-memory step (percentile buffers, one
# window partition, one candidate set).
IN_MEMORY_ROWS = 1_000_000
# Rows of a lookup table that may be broadcast (counted before the hint is given).
BROADCAST_ROWS = 1_000_000
# Bytes of a lookup table that may be broadcast (measured before the hint is given).
BROADCAST_BYTES = 64 << 20
# Rows of one join key beyond which the key is treated as hot.
HOT_KEY_ROWS = 5_000_000
# Rows that may be read back to the driver (parameters, cut-offs, tree nodes).
DRIVER_ROWS = 200_000
