"""DataFrame operators: cleaning, features, splits, metrics, exploration, models' kernels."""
