"""Every operator as a query over the test tables."""

from tilelake.queries.registry import ORACLES, QUERIES


def load() -> None:
    """Import all query modules, which register themselves."""
    from tilelake.queries import (  # noqa: F401
        catalogs,
        connectors,
        logs,
        rasters,
        scalars,
        spatial,
        streams,
    )


__all__ = ["ORACLES", "QUERIES", "load"]
