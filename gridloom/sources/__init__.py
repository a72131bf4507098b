"""Readers, landed payloads, file versions, routing and sinks."""
