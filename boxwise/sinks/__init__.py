"""Sinks: managed tables, COCO JSON documents, files, copies (shards: plans.shards)."""
