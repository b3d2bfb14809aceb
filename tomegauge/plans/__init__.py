from tomegauge.plans import catalog, oracle

__all__ = ["catalog", "oracle"]
