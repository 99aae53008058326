"""Sources: COCO annotation JSON, image / text files, listings, tables, shards."""
