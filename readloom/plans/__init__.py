"""Registered queries and their SQL oracles."""

from readloom.plans import calibration, detection, reporting, scanning, scoring, signals, sinks, streams, training  # noqa: F401
from readloom.plans.detection import flagship  # noqa: F401
from readloom.plans.registry import ORACLES, QUERIES  # noqa: F401
