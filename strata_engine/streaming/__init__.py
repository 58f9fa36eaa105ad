"""Incremental runs of the row-local layer steps with Structured Streaming."""

from strata_engine.streaming.incremental import row_local_layer, start_file_sink, survey_stream  # noqa: F401
