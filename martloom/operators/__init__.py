"""DataFrame-to-DataFrame operators that the mart pipelines are made of."""
