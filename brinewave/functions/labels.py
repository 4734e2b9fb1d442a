"""Value maps: recodes, display labels and factor order.

A factor is a label column plus an integer position column, so that display order is a plain sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from brinewave.functions.nulls import as_col

# Label of each sampling week, by its middle day.
SAMPLING_WEEK_LABELS = {
    18: "May 5",
    19: "May 12",
    20: "May 19",
    21: "May 26",
    22: "June 2",
    23: "June 9",
    24: "June 16",
    25: "June 23",
    26: "June 30",
    27: "July 6",
    28: "July 13",
}

# Display names.
SPECIES_LABELS = {"HE": "Herring", "CU": "Chum", "PI": "Pink", "SO": "Sockeye"}
SALMON_LABELS = {"SO": "Sockeye", "PI": "Pink", "CU": "Chum"}
REGION_LABELS = {"DI": "Discovery Islands", "JS": "Johnstone Strait"}
ZONE_LABELS = {"C": "Central", "E": "Eastern", "W": "Western"}
PRESENCE_LABELS = {"A": "Absent", "P": "Present"}
CATCH_LABELS = {
    "so_total": "Sockeye",
    "pi_total": "Pink",
    "cu_total": "Chum",
    "co_total": "Coho",
    "he_total": "Herring",
    "ck_total": "Chinook",
}


def value_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])


def lookup(c: Column | str, mapping: dict) -> Column:
    """Mapped value, null where the key is not in the map."""
    return F.try_element_at(value_map(mapping), as_col(c))


def recode(c: Column | str, mapping: dict) -> Column:
    """Mapped value, unmatched values kept."""
    return F.coalesce(lookup(c, mapping), as_col(c))


def position(c: Column | str, levels: Sequence) -> Column:
    """1-based place in the level list, null for other values."""
    return lookup(c, {level: i + 1 for i, level in enumerate(levels)})


def sampling_week_label(week: Column | str) -> Column:
    return lookup(week, SAMPLING_WEEK_LABELS)


def sampling_week_position(label: Column | str) -> Column:
    return position(label, list(SAMPLING_WEEK_LABELS.values()))
