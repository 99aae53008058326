"""Plans that compose operators: ranking, shard packing, conversion flows."""
