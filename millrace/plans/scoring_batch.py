"""The small batch of machines scored as a demonstration, and the scoring job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.telemetry import with_temperature_difference

# Twenty test machines (id, air K, process K, rpm, torque Nm, wear min).
TEST_MACHINES = [
    ("CNC_001", 298.1, 308.6, 1540, 42.5, 45),
    ("CNC_002", 298.2, 308.7, 1565, 41.2, 12),
    ("CNC_003", 292.9, 308.5, 2542, 58.1, 199),
    ("CNC_004", 298.5, 309.1, 1600, 39.5, 85),
    ("CNC_005", 299.1, 310.2, 1180, 68.5, 225),
    ("CNC_006", 297.5, 308.2, 1555, 42.0, 55),
    ("CNC_007", 298.0, 308.5, 1570, 41.5, 30),
    ("CNC_008", 298.1, 308.6, 1545, 42.8, 140),
    ("CNC_009", 298.4, 308.8, 1580, 40.2, 95),
    ("CNC_010", 297.8, 308.4, 1560, 41.8, 60),
    ("CNC_011", 298.2, 308.7, 1550, 42.4, 75),
    ("CNC_012", 303.5, 314.1, 1350, 58.2, 205),
    ("CNC_013", 298.0, 308.5, 1565, 41.9, 15),
    ("CNC_014", 297.9, 308.4, 1555, 42.1, 40),
    ("CNC_015", 298.1, 308.6, 1540, 43.0, 125),
    ("CNC_016", 298.3, 308.9, 1575, 40.5, 80),
    ("CNC_017", 298.1, 308.5, 1550, 42.2, 50),
    ("CNC_018", 298.5, 309.2, 1100, 72.1, 190),
    ("CNC_019", 298.2, 308.8, 1560, 41.6, 20),
    ("CNC_020", 298.0, 308.5, 1555, 69.2, 10),
]
BATCH_SCHEMA = ("machine_id string, air_temperature_k double, process_temperature_k double, "
                "rotational_speed_rpm int, torque_nm double, tool_wear_min int")


def literal_batch(spark: SparkSession) -> DataFrame:
    """The test machines with the temperature difference at position 3."""
    return with_temperature_difference(spark.createDataFrame(TEST_MACHINES, BATCH_SCHEMA), position=3)
