"""Service reliability from snapshots of predicted stop times, on Spark."""

from railpulse.params import Params

__all__ = ["Params"]
