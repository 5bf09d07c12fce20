"""voxelith: labeled 3-D volumes as DataFrames, planned by Catalyst."""
