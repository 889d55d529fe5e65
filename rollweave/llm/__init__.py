"""Operators for training-data pipelines. Nothing else in rollweave imports this subpackage."""
