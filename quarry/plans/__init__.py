"""Query catalogue: each registered query reads the driver tables (or
fixtures Spark derives from them) and returns a DataFrame."""

from .registry import ORACLE, QUERIES, register  # noqa: F401


def load_all() -> None:
    """Import every plan module so their queries register."""
    from . import (q_timeseries, q_profile, q_treatment, q_mining, q_evaluate,  # noqa: F401
                   q_outlier, q_models, q_more, q_neighbours, q_boost, q_checks)
