"""DataFrame operators around anchors; each can be used alone."""
