"""The registered queries."""

import importlib

for _name in ("catalog", "spatial", "geometry", "telemetry", "function", "file", "source", "volume", "scalar", "dataset"):  # each after those that it imports
    importlib.import_module(f"lattica.plans.{_name}_queries")
