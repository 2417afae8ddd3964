"""Column expressions (built-in Catalyst functions only): tiers, month arithmetic, exact
HALF_UP percentages and means, date parsing, display formatting."""
