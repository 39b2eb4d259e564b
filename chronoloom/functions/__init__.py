"""Column expressions: normalisation, units, geometry."""
