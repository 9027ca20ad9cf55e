from eventweave.streaming.fanout import FanOut, python_transform, run_bounded, run_fanout, start_fanout, stream_identity

__all__ = ["FanOut", "python_transform", "run_bounded", "run_fanout", "start_fanout", "stream_identity"]
