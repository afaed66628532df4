"""pitchlake: DataFrame operators and layered jobs for pitch-by-pitch telemetry on Spark."""

__version__ = "0.1.0"
