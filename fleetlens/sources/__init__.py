from fleetlens.sources.dimension import SACCO_ROWS, sacco_dim
from fleetlens.sources.fixtures import fares_view, load_events, locations_view

__all__ = ["SACCO_ROWS", "sacco_dim", "fares_view", "load_events", "locations_view"]
