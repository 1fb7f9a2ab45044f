"""The chain of stages and the command line."""
