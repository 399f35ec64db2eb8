"""martloom: warehouse layers and data marts as Spark DataFrame pipelines."""
