"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Each module holds one operator with its own interface; ``queries`` registers them.
"""
