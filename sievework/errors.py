"""Failures a caller is expected to handle."""


class SieveworkError(RuntimeError):
    """Base of every expected failure."""


class SchemaContractError(SieveworkError):
    """A source or a model does not match its declared contract."""


class ArtifactError(SieveworkError):
    """A described file is missing or cannot be told from another."""


class ObjectConflictError(SieveworkError):
    """A landing key already belongs to different content."""


class CommitConflictError(SieveworkError):
    """Another run has taken the commit number first; nothing was changed."""


class AlreadyPublishedError(SieveworkError):
    """A dataset version is published, or being published, by another run."""


class DuplicateKeyError(SieveworkError):
    """A batch holds a business key more than once."""
