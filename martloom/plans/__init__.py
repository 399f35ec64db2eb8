"""Named pipelines: dimensions, facts and marts composed from the operators."""
