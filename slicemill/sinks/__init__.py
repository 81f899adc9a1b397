"""Writers, layouts, snapshots and publication."""
