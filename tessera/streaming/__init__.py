from tessera.streaming.scoring import prepare_stream, run_available_now, score_stream, zone_stream

__all__ = ["score_stream", "zone_stream", "prepare_stream", "run_available_now"]
