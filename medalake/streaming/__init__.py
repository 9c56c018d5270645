from medalake.streaming.incremental import landing_stream, run_incremental_silver

__all__ = ["landing_stream", "run_incremental_silver"]
