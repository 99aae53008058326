"""Operators on tables of images, boxes and detections."""
