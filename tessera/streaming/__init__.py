from tessera.streaming.control import await_queries, stop_all, with_trigger
from tessera.streaming.export import enriched_stream, run_export, start_export, write_batch_both
from tessera.streaming.replay import replay_stream, run_replay, start_replay

__all__ = [name for name in dir() if not name.startswith("_")]
