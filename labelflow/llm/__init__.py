"""Operators for training-data pipelines. One module per operator; ``queries`` registers them.

Nothing else in the package imports this folder.
"""
