"""Table loading and derived datasets (snapshots, clustered layouts)."""
