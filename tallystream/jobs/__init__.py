"""Programs for spark-submit; each has a ``main`` that takes its arguments."""
