"""Plan-shaping helpers: lineage cuts, skew-proof joins, blocked windows and dense ids."""
