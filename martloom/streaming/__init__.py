"""Micro-batch driver: run a load per Structured Streaming micro-batch."""

from martloom.streaming.microbatch import load_micro_batch, start_incremental_load

__all__ = ["load_micro_batch", "start_incremental_load"]
