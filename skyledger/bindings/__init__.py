"""The launch domain bound to the driver's tables, and the query catalogue."""
