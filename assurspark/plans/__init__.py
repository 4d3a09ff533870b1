"""The reports (claims, production), their stages and their typed parameters."""
