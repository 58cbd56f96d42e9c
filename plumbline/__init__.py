"""Telemetry data quality and trajectory tables on Spark."""

from plumbline.plans.contracts import OUTPUT_SCHEMA_VERSION
from plumbline.plans.gates import GateConfig, ValidationError, assert_publishable, check_all

__version__ = "0.1.0"

__all__ = [
    "OUTPUT_SCHEMA_VERSION",
    "GateConfig",
    "ValidationError",
    "assert_publishable",
    "check_all",
    "__version__",
]
