"""Named queries over the test tables, each with the SQL it must agree with."""

from rollcall.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "load_all"]


def load_all() -> None:
    """Import the query modules, which register themselves."""
    from rollcall.plans import (  # noqa: F401
        aggregates,
        joins,
        models,
        scalars,
        state,
        streams,
        windows,
    )
