"""presslens: news-feed analytics expressed as PySpark DataFrame operators."""
