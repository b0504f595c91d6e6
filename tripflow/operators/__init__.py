"""DataFrame-to-DataFrame operators; they work in batch and streaming unless they say otherwise."""
