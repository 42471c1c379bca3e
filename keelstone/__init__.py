"""Star-schema analytics on Spark: read, profile, clean, shape, write, query."""

from keelstone.operators.gates import DataQualityError
from keelstone.plans.batch import Run, Settings, run_all
from keelstone.session import get_session

__all__ = ["DataQualityError", "Run", "Settings", "get_session", "run_all"]
