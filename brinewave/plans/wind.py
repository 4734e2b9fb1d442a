"""Wind table and rose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.functions.nulls import complete
from brinewave.functions.numeric import knots
from brinewave.operators.bins import wind_rose
from brinewave.operators.joins import natural_left_join
from brinewave.operators.reshape import separate

# Speed breaks of the rose.
SPEED_BREAKS = [0.0, 3.0, 6.0, 9.0]


def wind_table(direction: DataFrame, speed: DataFrame, year: int) -> DataFrame:
    """Direction and speed readings of a year by stamp, complete rows only, with speed in knots."""
    joined = separate(natural_left_join(direction, speed), "stamp", ["date", "time"], " ")
    return complete(joined).filter(F.col("year") == year).withColumn("knots", knots("wind_spd"))


def monthly_rose(wind: DataFrame, speed_max: float = 25.0) -> DataFrame:
    return wind_rose(complete(wind), "wind_spd", "wind_dir", SPEED_BREAKS, speed_max, keys=["month"])
