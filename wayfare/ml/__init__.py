"""Model side: splits, scaling, feature vectors, training, scoring, metrics, runs."""
