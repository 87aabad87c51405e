"""medallion.streaming: incremental ingestion of a landing folder into the raw layer.

The reference has no streaming operator; ``ingest`` is the Structured
Streaming form of the raw layer's append (K3), run with ``availableNow``.
"""
