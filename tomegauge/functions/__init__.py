from tomegauge.functions import grades, text

__all__ = ["grades", "text"]
