"""All queries outside the training-data subpackage."""

from __future__ import annotations

import importlib

from assayer.plans.base import QUERIES, SQL

MODULES = ("metrics", "text", "typed", "more", "extra", "review", "runs")
for _name in MODULES:
    importlib.import_module(f"assayer.plans.{_name}")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)


def flagship(spark, sf_dir):
    """Calibration report by slice."""
    return QUERIES["d8_calibration_by_slice"](spark, sf_dir)
