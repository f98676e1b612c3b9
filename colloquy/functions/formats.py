"""Display formatting: label text, percentages, previews, ratio rounding.

Percentages are rounded with integer arithmetic (``floor(x * 10^d + 0.5)``)
so that the result is the same on every engine; Java's ``%.2f`` rounds the
shortest decimal form half-up, which differs from rounding the binary value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Label text shown for batch / stream results.
SCAM_LABELS = {0: "Non-Scam (Safe)", 1: "Potentially Scam"}
# Label text used inside explanation prompts.
FRAUD_LABELS = {0: "Non-Fraudulent (Safe)", 1: "Potentially Fraudulent"}
# Text shown for a missing confidence in the live feed.
MISSING_CONFIDENCE = "N/A"
# Fallback label in the live feed.
UNKNOWN_LABEL = "Unknown"
PREVIEW_CHARS = 100
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_text(c, mapping=SCAM_LABELS, default=None) -> Column:
    """Map a numeric label to text.  ``default=None`` keeps the value itself
    as text (a double prediction 2.0 gives "2.0"); otherwise ``default``."""
    col = _col(c)
    expr = None
    for k, v in mapping.items():
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    fallback = col.cast("string") if default is None else F.lit(default)
    return expr.otherwise(fallback)


def round_half_up(x, digits: int) -> Column:
    """``x`` rounded to ``digits`` decimals, half up, computed as an integer
    count of 10^-digits units (exactly reproducible across engines)."""
    scale = 10 ** digits
    return F.floor(_col(x) * F.lit(float(scale)) + F.lit(0.5)).cast("bigint")


def _units_to_text(units: Column, digits: int) -> Column:
    if digits == 0:
        return units.cast("string")
    scale = 10 ** digits
    whole = _int_div(units, F.lit(scale))
    frac = F.pmod(units, F.lit(scale)).cast("string")
    return F.concat(whole.cast("string"), F.lit("."), F.lpad(frac, digits, "0"))


def _int_div(a: Column, b: Column) -> Column:
    """Exact integer division for non-negative bigints (SQL ``a div b``)."""
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def percent_text(c, digits: int = 2, scale: float = 100.0, suffix: str = "%",
                 missing=None, zero_is_missing: bool = False) -> Column:
    """Format a [0, 1] confidence as ``"12.34%"``.

    ``missing`` is returned for null (and, with ``zero_is_missing``, for 0.0,
    mirroring a truthiness test on the raw value)."""
    col = _col(c)
    units = round_half_up(col * F.lit(scale), digits)
    text = F.concat(_units_to_text(units, digits), F.lit(suffix))
    cond = col.isNull()
    if zero_is_missing:
        cond = cond | (col == F.lit(0.0))
    miss = F.lit(missing).cast("string")
    return F.when(cond, miss).otherwise(text)


def round_ratio(num, den, digits: int = 3, zero=0.0) -> Column:
    """``round(num / den, digits)`` half up on the exact rational, for
    non-negative integer counts; ``zero`` when ``den`` is 0."""
    n, d = _col(num).cast("bigint"), _col(den).cast("bigint")
    scale = 10 ** digits
    units = _int_div(F.lit(2 * scale) * n + d, F.lit(2) * d)
    return F.when(d == 0, F.lit(float(zero))).otherwise(units / F.lit(float(scale)))


def preview(c, n: int = PREVIEW_CHARS, ellipsis: str = "...") -> Column:
    """First ``n`` characters followed by an ellipsis (always appended)."""
    return F.concat(F.substring(_col(c), 1, n), F.lit(ellipsis))
