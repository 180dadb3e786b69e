from strata.streaming.incremental import (merge_into_partitions, read_stream, run_available, stream_dedup,
                                         stream_land, stream_merge)

__all__ = ["merge_into_partitions", "read_stream", "run_available", "stream_dedup", "stream_land",
           "stream_merge"]
