"""Analog tables, the registered query catalogue with its SQL oracle, and the
end-to-end pipeline."""
