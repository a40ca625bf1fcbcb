"""Human-readable byte sizes as one CASE expression (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit labels and the step between them.  A size is divided by
# the step *while it is strictly greater than* the step, so 1024 stays
# "1024 B" and 1 MiB is "1024.0 KB".  Above the last unit there is no label.
UNITS = ("B", "KB", "MB", "GB", "TB")
STEP = 1024


def format_bytes(size: Column | str) -> Column:
    """Render a byte count: integer text for bytes, float text above.

    Division by a power of two is exact in binary floating point, so one
    division by ``STEP**k`` equals k repeated divisions.  Sizes beyond the
    last unit (over 1024 TB) have no label and give null; the byte total stands
    beside it in every report.
    """
    n = F.col(size) if isinstance(size, str) else size
    expr = F.when(n <= STEP, F.concat(n.cast("bigint").cast("string"), F.lit(" B")))
    for k, unit in enumerate(UNITS[1:], start=1):
        scaled = n.cast("double") / F.lit(float(STEP**k))
        expr = expr.when(n <= STEP ** (k + 1), F.concat(scaled.cast("string"), F.lit(" " + unit)))
    return expr
