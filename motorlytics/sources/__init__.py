"""Inputs and outputs: messages, tables, fleet dimensions and telemetry derived from events."""
