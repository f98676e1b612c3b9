"""Operators for training-data pipelines.  Nothing else in the library
imports this subpackage; ``colloquy.llm.registry`` lists its queries."""
