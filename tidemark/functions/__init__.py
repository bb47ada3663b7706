from .cdc import for_topic, parse_changes, split_corrupt, stamp, table_of, unwrap_envelope
from .time import ms_to_ts, ts_to_ms

__all__ = ["for_topic", "parse_changes", "split_corrupt", "stamp", "table_of",
           "unwrap_envelope", "ms_to_ts", "ts_to_ms"]
