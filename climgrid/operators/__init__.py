"""DataFrame-to-DataFrame operators over the ``cells`` layout."""
