from clicktide.sources.dimensions import DimensionSnapshot, read_dimension, uuid_ranges
from clicktide.sources.events import read_events, register_views
from clicktide.sources.replay import Replay

__all__ = ["DimensionSnapshot", "Replay", "read_dimension", "read_events", "register_views", "uuid_ranges"]
