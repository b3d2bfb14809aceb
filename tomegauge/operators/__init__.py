from tomegauge.operators import documents, passages, scores, search, sentences, sentiment, vocabulary

__all__ = ["documents", "passages", "scores", "search", "sentences", "sentiment", "vocabulary"]
