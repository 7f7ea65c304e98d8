"""Streaming: the reference pipeline is batch only (no stream reader, watermark
or stateful operator exists in it). The one piece that carries over to
Structured Streaming unchanged is the silver *cleaning* projection, which is
stateless; see ``clean_stream``. Keep-latest de-duplication needs every copy
of a key, so it stays in the batch layer."""
