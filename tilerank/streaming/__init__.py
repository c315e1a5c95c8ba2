"""Streaming.

The pipeline this library rebuilds is batch only: it has no stream source, watermark,
window over event time or stateful operator. Nothing is registered here. The column
functions in ``tilerank.functions`` are stateless and work unchanged on a streaming
DataFrame if tiles ever arrive as a stream.
"""
