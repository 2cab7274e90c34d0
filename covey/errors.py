"""One exception class per guard; all are ``ValueError`` for callers that catch broadly."""


class GuardError(ValueError):
    """Base of every input guard."""


class EmptyInput(GuardError):
    def __init__(self) -> None:
        super().__init__("the input table has no rows")


class NoNumericColumns(GuardError):
    def __init__(self) -> None:
        super().__init__("the input table has no numeric top-level column")


class NoCompleteColumns(GuardError):
    def __init__(self, ratio: float) -> None:
        super().__init__(f"no numeric column is filled in at least {ratio:.0%} of the rows")


class NoVaryingColumns(GuardError):
    def __init__(self) -> None:
        super().__init__("every sufficiently filled numeric column is constant")


class TooFewRows(GuardError):
    def __init__(self, rows: int, needed: int) -> None:
        super().__init__(f"{rows} working rows, at least {needed} are needed")


class TooFewRowsForSweep(GuardError):
    def __init__(self, rows: int, k_min: int) -> None:
        super().__init__(f"{rows} rows cannot be split into {k_min} or more clusters")


class ReservedNames(GuardError):
    def __init__(self, names: list[str]) -> None:
        super().__init__(f"columns {names} have names that the results need; rename them")


class EmptyCollection(GuardError):
    def __init__(self, name: str) -> None:
        super().__init__(f"collection {name!r} holds no rows")


class MissingModel(FileNotFoundError):
    def __init__(self, path: str) -> None:
        super().__init__(f"no saved model under {path}")


class SchemaConflict(GuardError):
    def __init__(self, name: str, stored: str, given: str) -> None:
        super().__init__(f"field {name!r} is {stored} in the collection and {given} in the new rows")
