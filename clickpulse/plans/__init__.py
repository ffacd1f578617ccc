"""Named query plans over the driver's tables, and the composite dashboard jobs."""
