"""Input tables: catalog access, storage layout and the driver-data derivations."""
