"""Structured Streaming forms of the flows.

Stateless flows reuse the batch transforms unchanged. Windowed revenue uses
``withWatermark`` + ``window`` in append mode (emit once on close). The
per-vehicle and per-route folds and the silence detector are
``transformWithStateInPandas`` processors (``processors``).
"""
