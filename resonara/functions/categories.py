"""Category clean-up and colour keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from resonara.functions.text import strip

# --- fixed values -----------------------------------------------------------
UNKNOWN = "Unknown"
INSTRUMENT_COUNTS = (2, 5)
GENRE_PALETTE = {
    "Pop": "#1f77b4",
    "Folk": "#ff7f0e",
    "Urbà": "#2ca02c",
    "Urbà/Pop": "#7fbc41",
    "Urbà/Trap": "#4d9221",
    "Urbà/Trap Català": "#276419",
    "Urbà/Reggaeton": "#c51b7d",
    "Urbà/Bossa Nova": "#de77ae",
    "Reggaeton": "#d62728",
    "Trap": "#9467bd",
    "Trap Català": "#8c6d31",
    "Bossa Nova": "#8c564b",
    "Unknown": "#7f7f7f",
}
SPARE_COLOURS = ("#8c564b", "#e377c2", "#7f7f7f", "#bcbd22", "#17becf")
# ----------------------------------------------------------------------------


def instrumentation_bucket(value: Column) -> Column:
    """``Instruments (n)`` for 2 to 5, everything else ``Unknown``."""
    whole = value.try_cast("double").cast("int")
    return F.when(
        whole.between(*INSTRUMENT_COUNTS),
        F.concat(F.lit("Instruments ("), whole.cast("string"), F.lit(")")),
    ).otherwise(UNKNOWN)


def category_clean(value: Column) -> Column:
    """Trimmed category; NULL and blank become ``Unknown``."""
    return F.coalesce(F.nullif(strip(value), F.lit("")), F.lit(UNKNOWN))


def voice_class(value: Column) -> Column:
    """Both voices in either order are one class.  ``Female`` alone does not
    contain the capitalised word ``Male``."""
    value = strip(value)
    both = F.contains(value, F.lit("Male")) & F.contains(value, F.lit("Female"))
    return F.when(both, "Male & Female").otherwise(value)
