"""Structured Streaming entry points.

The original system has no stream processing; its online part is a request
/ response API scoring one request at a time. Here that serving path is a
streaming job: request rows arriving as files are validated, defaulted,
encoded and scored by the same batch operators (stream-static joins with
the fitted dictionaries), and written with exactly-once file-sink
semantics. No windows or watermarks are needed because every request is
scored independently (no state across requests).
"""
