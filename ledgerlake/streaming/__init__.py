from ledgerlake.streaming.events import (build_events, consume, decode, encode, gold_extract,
                                        latest_events, publish, read_consumed)

__all__ = ["build_events", "consume", "decode", "encode", "gold_extract", "latest_events",
           "publish", "read_consumed"]
