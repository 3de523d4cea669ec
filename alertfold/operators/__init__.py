"""DataFrame -> DataFrame operators (dedup, date resolution, quality, grouping)."""
