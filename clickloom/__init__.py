"""Clickstream feature, classification and segmentation engine on Spark."""
