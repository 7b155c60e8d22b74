from casebook.streaming.visits import start, visit_summary_stream

__all__ = ["start", "visit_summary_stream"]
