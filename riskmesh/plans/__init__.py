"""Plans: the named query catalog, incremental upserts, and the pipeline
runner that builds the layers in dependency order."""
