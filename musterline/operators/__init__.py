"""DataFrame-in, DataFrame-out operators without a clock.

They only build plans. Exceptions that run jobs: ``features.encode`` and everything in ``models``, which fit.
"""
