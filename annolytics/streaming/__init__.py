"""State of tracks over frames, on streams and, by the same steps, on tables."""

from .events import track_events
from .lifecycle import Rules, track_frames, track_stream
from .tables import assign_object_ids, assign_object_ids_stream, run_available, stream_dedup, streaming_meter

__all__ = ["Rules", "assign_object_ids", "assign_object_ids_stream", "run_available", "stream_dedup", "streaming_meter", "track_events", "track_frames", "track_stream"]
