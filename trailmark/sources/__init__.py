"""Table catalog, loaders, sinks and the stand-in views over the test tables."""
