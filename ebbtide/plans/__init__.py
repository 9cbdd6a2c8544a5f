"""The jobs and queries, put together from sources, operators and sinks."""
