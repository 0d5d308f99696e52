"""Structured Streaming forms of the stateful jobs.

Every query takes its checkpoint folder from the session (one folder per query,
see `spindle.session.streaming_checkpoint`) so a restart resumes offsets and
state. Sources are replayable (files, Kafka); a socket source is for demos.
"""
