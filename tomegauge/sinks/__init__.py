from tomegauge.sinks import files, keyed

__all__ = ["files", "keyed"]
