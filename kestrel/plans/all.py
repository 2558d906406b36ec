"""Importing this module registers every query."""

from kestrel.plans import (anomaly, drift, features, ml, objects, profile, runs, scalars,  # noqa: F401
                           series, streams, vectors)
