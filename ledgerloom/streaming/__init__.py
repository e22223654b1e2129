from ledgerloom.streaming.upsert import stream_upsert

__all__ = ["stream_upsert"]
