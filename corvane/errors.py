"""Errors of the engine."""


class EngineError(Exception):
    """Base of all errors raised here."""


class InvalidArgument(EngineError):
    """A query, document or schema that breaks a rule."""


class Unsupported(EngineError):
    """A construct that the query language doesn't have."""

    def __init__(self, what: str):
        super().__init__(f"Unsupported: {what}")


class NotFound(EngineError):
    """A collection, partition or dataset that doesn't exist."""


class AlreadyExists(EngineError):
    """A collection that exists already."""


class SchemaError(InvalidArgument):
    """All that is wrong with a set of documents or fields, in one error."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems
