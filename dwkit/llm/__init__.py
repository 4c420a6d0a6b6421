"""Operators of a training-data pipeline over ``documents`` and ``conversations``.

Nothing outside this package imports it; it may import general helpers of the library.
"""
