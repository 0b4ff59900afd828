"""The operators: cleaning, profiling, resampling, trees, forests, boosting, metrics, explanations."""
