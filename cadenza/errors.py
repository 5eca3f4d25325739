"""Errors that end a command with exit code 1."""


class HardError(Exception):
    """A problem in the input or configuration; nothing has been written."""
