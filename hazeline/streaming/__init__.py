from hazeline.streaming.incremental import load_increment, load_latest

__all__ = ["load_increment", "load_latest"]
