"""Training-data operators: text, vectors and mixtures of whole corpora."""
