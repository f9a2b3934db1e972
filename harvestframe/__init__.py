"""harvestframe: a Spark-native feature engine for daily market and weather series.

Layers: bronze (landed rows) -> silver (one row per symbol and trading day) ->
gold (80 features + forward target) -> quality gate -> model data.
Everything is a DataFrame plan; see README.md for the map of modules.
"""

from harvestframe.config import Config

__all__ = ["Config"]
__version__ = "0.1.0"
