"""Plan helpers: lineage cuts, checked broadcasts, run-once steps."""
