"""Error types raised by the library (plain exceptions, one per boundary)."""


class IngestError(RuntimeError):
    """A source could not be read or lacks a required column."""


class ContractViolation(ValueError):
    """A frame failed its data contract; the message names the boundary and every failure."""


class ModelConfigError(ValueError):
    """Unknown model or resampling strategy, or a missing hyperparameter."""


class EvaluationError(ValueError):
    """An evaluation operator got arguments it cannot work with (e.g. non-positive costs)."""
