"""DataFrame-to-DataFrame operators; unless noted they serve batch and streaming input alike."""
